"""The fold against a plain Python replay, and known cases."""

import json
import random

import pytest
from pyspark.sql import functions as F

from dialoom.functions import fixed
from dialoom.operators import harness

FOODS = [
    (1, "Potatoes", 150.0, None, 30.0),
    (2, "Bread", None, 1.0, 15.0),
    (3, "Cheese", 30.0, 1.0, 1.0),
    (4, "Milk", 200.0, None, 10.0),
    (5, "Bean soup", 85.0, 2.0, 15.0),
    (6, "Odd", 7.0, 3.0, -2.0),
]


class Replay:
    """Reads the calls one by one, as the operator's definition says."""

    def __init__(self, idx):
        self.settings = fixed.SETTINGS[idx]
        self.clear()

    def clear(self):
        self.known, self.tally, self.next, self.hour = set(), [], 1, None
        return {}

    def search(self, a):
        self.known |= {f[0] for q in a["queries"] for f in FOODS if q.lower() in f[1].lower()}
        return {}

    def add(self, a):
        made = []
        for item in a["items"]:
            if item["food_id"] not in self.known:
                return {"error": f"Unknown food_id: {item['food_id']}. Search first."}
            _, name, g, p, carbs = FOODS[item["food_id"] - 1]
            if item["unit"] in ("g", "ml") and g:
                c = item["quantity"] * carbs / g
            elif item["unit"] in ("pcs", "cup", "tbsp", "slice") and p:
                c = item["quantity"] * carbs / p
            else:
                return {"error": "execution failed"}
            made.append((self.next, name, item["quantity"], item["unit"], round(max(c, 0.0), 2)))
            self.next += 1
        total = 0.0
        for e in made:
            total += e[4]
        self.tally += made
        return {"entries": made, "tally_total": round(total, 2)}

    def total(self):
        t = 0.0
        for e in self.tally:
            t += e[4]
        return t

    def remove(self, a):
        left = [e for e in self.tally if e[0] not in a["entry_ids"]]
        gone, self.tally = len(self.tally) - len(left), left
        return {"removed": gone, "tally_total": round(self.total(), 2)}

    def final(self, a):
        if not self.tally:
            return {"error": "Add at least one food first."}
        hour, bg = a.get("meal_hour"), a.get("blood_glucose")
        inferred = "midday" if hour is None or 12 <= hour < 17 else "morning" if 4 <= hour < 12 else "evening"
        meal = a.get("meal_time") or inferred
        if hour is not None:
            self.hour = hour
        threshold, baseline, divisor, *dividers = self.settings
        divider = dict(zip(("morning", "midday", "evening"), dividers)).get(meal, 15)
        food = self.total() / divider
        high = bg is not None and bg >= threshold
        correction = max(0, (bg - baseline) / divisor) if high else 0.0
        text = f"({bg} - {baseline}) / {divisor} = {correction:.2f}U" if high else "" if bg is None else f"BG {bg} < {threshold} threshold, correction skipped"
        return {
            "final_result": round(food + correction, 2), "food_insulin": round(food, 2), "glucose_correction": round(correction, 2), "glucose_skipped": not high, "tally_total": round(self.total(), 2),
            "meal_divider": divider, "meal_time": meal, "meal_hour": hour or self.hour, "breakdown_food": f"{self.total():.2f}g / {divider} = {food:.2f}U", "breakdown_glucose": text,
        }

    def run(self, name, a):
        step = {fixed.SEARCH: self.search, fixed.ADD: self.add, fixed.REMOVE: self.remove, fixed.FINAL: self.final, fixed.CLEAR: lambda _: self.clear(), fixed.SUMMARY: lambda _: {"entries": list(self.tally)}}.get(name)
        return step(a) if step else {"error": "execution failed"}


@pytest.fixture(scope="module")
def foods(spark):
    rows = [("en", i, n, g, p, c, g is not None, p is not None) for i, n, g, p, c in FOODS]
    return spark.createDataFrame(rows, "lang string, id int, name string, standard_quantity_g double, standard_quantity_pcs double, carbs double, has_grams_mode boolean, has_pieces_mode boolean")


def replayed(spark, foods, conversations):
    rows = [(c, "en", idx, s, name, json.dumps(a)) for c, (idx, calls) in enumerate(conversations) for s, (name, a) in enumerate(calls)]
    calls = spark.createDataFrame(rows, "conv_id long, lang string, idx int, seq long, name string, arguments string")
    return {r["conv_id"]: r for r in harness.run(calls, foods, harness.settings(spark)).collect()}


def test_fold_equals_replay(spark, foods):
    r = random.Random(11)
    conversations = []
    for _ in range(250):
        calls = []
        for _ in range(r.randint(1, 9)):
            name = r.choice([fixed.SEARCH, fixed.SEARCH, fixed.ADD, fixed.ADD, fixed.REMOVE, fixed.FINAL, fixed.CLEAR, fixed.SUMMARY, "nope"])
            a = {}
            if name == fixed.SEARCH:
                a = {"queries": r.sample(["o", "BREAD", "e", "zz", "milk", "i"], r.randint(0, 3))}
            elif name == fixed.ADD:
                a = {"items": [{"food_id": r.randint(1, 7) % 7 + (r.random() < 0.02), "quantity": r.choice([1.0, 2.5, 80.0, 133.0]), "unit": r.choice(["g", "pcs", "ml", "cup", "bag"] if r.random() < 0.2 else ["g", "pcs"])} for _ in range(r.randint(0, 3))]}
                a["items"] = [x for x in a["items"] if x["food_id"] > 0]
            elif name == fixed.REMOVE:
                a = {"entry_ids": r.sample(range(1, 6), r.randint(0, 2))}
            elif name == fixed.FINAL:
                a = {"meal_hour": r.choice([None, 0, 3, 4, 12, 16, 17, 23]), "blood_glucose": r.choice([None, 80.0, 130.0, 187.5]), "meal_time": r.choice([None, "morning", "brunch", ""])}
            calls.append((name, a))
        conversations.append((r.randrange(5), calls))
    got = replayed(spark, foods, conversations)
    for c, (idx, calls) in enumerate(conversations):
        replay = Replay(idx)
        for (name, a), out in zip(calls, got[c]["outputs"], strict=True):
            want = replay.run(name, a)
            for k, v in want.items():
                have = out[k]
                if k == "entries":
                    have = [tuple(e) for e in have]
                assert have == v, (calls, name, k)
            assert (out["error"] is None) == ("error" not in want)
        assert [tuple(e) for e in got[c]["tally"]] == replay.tally
        assert set(got[c]["known"]) == replay.known


def test_rounding_adds_up(spark, foods):
    """Entries are rounded before they are added: 80 g and 100 g of 15 g in 85 g make 14.12 + 17.65."""
    calls = [(fixed.SEARCH, {"queries": ["bean"]}), (fixed.ADD, {"items": [{"food_id": 5, "quantity": 80.0, "unit": "g"}, {"food_id": 5, "quantity": 100.0, "unit": "g"}]})]
    assert replayed(spark, foods, [(0, calls)])[0]["outputs"][1]["tally_total"] == 31.77


def test_context_block(spark):
    rows = spark.range(1).select(
        F.expr(f"CAST(array(struct(1, 'Milk', 80.0D, 'ml', 4.0D), struct(3, 'Bread', 1.5D, 'slice', 22.55D)) AS array<{harness.TALLY_ENTRY}>)").alias("t"), F.expr("array(struct(4 AS id, 'Milk' AS name), struct(2 AS id, 'Bread' AS name))").alias("k")
    )
    text = rows.select(F.expr(harness.context_block("t", "k"))).first()[0]
    assert text == "[CURRENT TALLY: 2 items, 26.6g total]\n  Milk 80.0ml = 4.0g (entry_id: 1)\n  Bread 1.5slice = 22.55g (entry_id: 3)\n\n[KNOWN FOOD IDS: Bread(2), Milk(4)]"
    empty = rows.select(F.expr(harness.context_block("slice(t, 1, 0)", "k"))).first()[0]
    assert empty == "[CURRENT TALLY: empty]\n[KNOWN FOOD IDS: none]"
