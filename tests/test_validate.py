import json

from pyspark.sql import functions as F

from dialoom.functions import fixed
from dialoom.operators import harness, prompts, validate
from dialoom.sources.schemas import CONVERSATION

SCHEMA = f"conv_id int, {CONVERSATION}"
CONTEXT = "[CURRENT TALLY: empty]\n[KNOWN FOOD IDS: none]"
DOSE = {"final_result": 5.33, "food_insulin": 3.33, "glucose_correction": 2.0, "glucose_skipped": False, "tally_total": 50.0, "meal_divider": 15}


def call(name, **arguments):
    return {"role": "assistant", "action": "tool_call", "tool_calls": [{"name": name, "arguments": json.dumps(arguments)}]}


def tool(**results):
    return {"role": "tool", "tool_results": json.dumps(results)}


def conversation(said="The dose is 5.33 units for 50 g.", stated=DOSE):
    entries = [{"entry_id": 1, "food_name": "Milk", "quantity": 1000, "unit": "ml", "carbs": 50.0}]
    add = call("add_foods_to_tally", items=[{"food_id": 4, "quantity": 1000, "unit": "ml"}])
    final = call("calculate_final", meal_hour=13, blood_glucose=180) | {"tool_results": json.dumps({"calculate_final": stated})}
    return [
        {"role": "user", "content": "a litre of milk please, my glucose is 180 now and it is 13 o'clock, what do I take?", "context_block": CONTEXT},
        call("search_foods", queries=["milk"]),
        tool(search_foods={"results": [[{"id": 4, "name": "Milk"}]]}),
        add,
        tool(add_foods_to_tally={"entries": entries, "tally_total": 50.0}),
        final,
        tool(calculate_final=stated),
        {"role": "assistant", "action": "text", "content": said},
    ]


def foods(spark):
    rows = [("en", 4, "Milk", 200.0, None, 10.0, True, False), ("en", 2, "Bread", None, 1.0, 15.0, False, True)]
    return spark.createDataFrame(rows, "lang string, id int, name string, standard_quantity_g double, standard_quantity_pcs double, carbs double, has_grams_mode boolean, has_pieces_mode boolean")


def test_all_rules_together(spark):
    good = conversation()
    bad_unit = conversation()
    bad_unit[3] = call("add_foods_to_tally", items=[{"food_id": 4, "quantity": 1, "unit": "slice"}, {"food_id": 77, "quantity": 1, "unit": "g"}])
    rows = [
        (1, "MULTIPLE_FOODS_WITH_GLUCOSE", "en", good, None),
        (2, "SIMPLE_SINGLE_FOOD", "en", conversation(said="Take 9.99 units."), 0),
        (3, "SIMPLE_SINGLE_FOOD", "en", conversation(stated=DOSE | {"final_result": 5.0}), 0),
        (4, "SIMPLE_SINGLE_FOOD", "en", bad_unit, 0),
        (5, "SIMPLE_SINGLE_FOOD", "en", [{"role": "user", "content": "hi"}], 0),
        (6, "SIMPLE_SINGLE_FOOD", "en", [{"role": "user", "content": "x" * 500, "context_block": CONTEXT}, call("calculate_final"), {"role": "assistant", "action": "text", "content": ""}], 0),
    ]
    convs = spark.createDataFrame([{"conv_id": c, "scenario_type": s, "language": lang, "turns": t, "user_settings_idx": i} for c, s, lang, t, i in rows], SCHEMA)
    got = {r["conv_id"]: r["errors"] for r in validate.errors(convs, foods(spark), harness.settings(spark)).collect()}
    assert got[1] == []
    assert got[2] == ["Turn 7: number 9.99 in assistant text does not match any tool result or argument"]
    assert got[3] == ["Math mismatch for calculate_final.final_result: expected 5.33, got 5.0"]
    assert got[4][:2] == ["food_id 77 not in known IDs", "food_id 4 (Milk): unit 'slice' used but food has no piece mode"]
    assert got[5] == ["Too short: ~0 tokens", "Turn 0: missing context_block in user message"]
    assert got[6] == ["calculate_final called before add_foods_to_tally", "Turn 2: empty assistant text", "Turn 0: user utterance ~125 tokens (max ~100)"]


def test_settings_as_text(spark):
    pool = harness.settings(spark)
    plain = {r["idx"]: r["text"] for r in prompts.settings_text(pool).collect()}
    assert "- Glucose threshold: 130 mg/dL (only correct BG above this)\n" in plain[0] and "Morning=8, Midday=9, Evening=7" in plain[1]
    assert plain[2].endswith("Morning 4:00-12:00, Midday 12:00-17:00, Evening 17:00-4:00")
    training = {r["idx"]: r["text"] for r in prompts.settings_text(pool, training=True).collect()}
    assert "threshold=140.0 mg/dL, baseline=105.0 mg/dL, divisor=50.0 mg/dL per unit" in training[4]
    assert training[3].endswith("Morning (4:00-12:00), Midday (12:00-17:00), Evening (17:00-4:00)")


def test_food_lines(spark):
    rows = foods(spark).withColumns({"gram_unit": F.when(F.col("id") == 4, "ml"), "piece_unit": F.when(F.col("id") == 2, "slice")})
    text = prompts.food_list(rows).first()["text"]
    assert text == '  2: Bread (1.0slice = 15.0g carbs) [USE: unit="slice" only]\n  4: Milk (200.0ml = 10.0g carbs) [USE: unit="ml" only]'


def test_usage_lines_and_personas(spark):
    ex = spark.createDataFrame([("avoid", 1, "A", 5), ("avoid", 2, "B", 9), ("prefer", 3, "C", 0)], "kind string, id long, name string, uses long")
    got = {r["kind"]: r["text"] for r in prompts.usage_lines(ex).collect()}
    assert got["avoid"] == "  AVOID B (2) - used 9x already\n  AVOID A (1) - used 5x already" and got["prefer"] == "  PREFER C (3) - used only 0x"
    assert [r[0] for r in spark.range(6).select(prompts.persona(F.col("id"))).collect()] == [*prompts.PERSONAS, prompts.PERSONAS[0]]
    assert fixed.PERIODS[0][0] == "morning"
