import json
import random

import pytest
from pyspark.sql import functions as F

from dialoom.functions import fixed, foodtext, pyjson
from dialoom.functions.exact import fixed_sql, number_sql, py_round_sql, strip
from dialoom.operators import generation, logs, rules, scoring


def test_rounding_equals_python(spark):
    r = random.Random(1)
    xs = [2.675, 17.645, 0.125, 1.005, -2.675, 0.0, 0.5, 1.5, 2.5, 1e9 + 0.125, 0.285] + [r.uniform(-500, 500) for _ in range(2000)] + [k / 8 for k in range(-100, 100)] + [round(r.uniform(0, 99), 3) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    rows = df.selectExpr("x", *(f"{py_round_sql('x', d)} AS r{d}" for d in (0, 1, 2)), *(f"{fixed_sql('x', d)} AS f{d}" for d in (1, 2)), f"{number_sql('x')} AS n").collect()
    for row in rows:
        x = row["x"]
        assert [row[f"r{d}"] for d in (0, 1, 2)] == [round(x, d) for d in (0, 1, 2)], x
        assert row["f2"] == f"{x:.2f}" and row["f1"] == f"{x:.1f}", x
        assert row["n"] == (str(int(x)) if x == int(x) else f"{x:.2f}".rstrip("0").rstrip(".")), x


@pytest.mark.parametrize(
    "text, number, unit",
    [("150,5 g", 150.5, "g"), ("150g", 150.0, "g"), ("1/2", 1.0, None), ("", None, None), ("abc", None, None), ("3/4 cup", 3.0, "cup"), ("  12 ", 12.0, None), ("१२ g", 12.0, "g"), ("2 c. sopa", 2.0, "c. sopa")],
)
def test_quantities(spark, text, number, unit):
    row = spark.createDataFrame([(text,)], "t string").select(foodtext.leading_number(F.col("t")), foodtext.unit_text(F.col("t"))).first()
    assert tuple(row) == (number, unit)


def test_units_are_normalised(spark):
    for values, f in ((fixed.GRAM_UNITS, foodtext.gram_unit), (fixed.COUNT_UNITS, foodtext.count_unit)):
        df = spark.createDataFrame([(f"  {k.upper() if k.isascii() else k} ", v) for k, v in values.items()] + [(" Bunch ", "Bunch"), (None, None)], "k string, v string")
        assert df.where(~f(F.col("k")).eqNullSafe(F.col("v"))).count() == 0


def test_strip_takes_all_white_space(spark):
    df = spark.createDataFrame([(" \t x y \n",)], "t string")
    assert df.select(strip(F.col("t"))).first()[0] == "x y"


def test_number_matching(spark):
    rows = [(2.5, 2.52, True), (2.5, 2.4, True), (3.5, 4.4, True), (2.5, 3.4, False), (0.4, 0.9, False), (10.0, 11.0, False)]
    df = spark.createDataFrame(rows, "a double, b double, want boolean")
    assert df.where(rules.matches_number(F.col("a"), F.col("b")) != F.col("want")).count() == 0


def test_numbers_of_json(spark):
    df = spark.createDataFrame([(json.dumps({"a": [1, {"b": 2.5, "c": True}], "d": "7"}),), ("not json",), (None,)], "j string")
    assert [r[0] for r in df.select(rules.json_numbers(F.col("j"))).collect()] == [[1.0, 2.5, 1.0], [], []]


def test_call_syntax_round_trip():
    args = {"queries": ["a, b", "c"], "n": 3, "x": 1.5, "t": "two words", "items": [{"food_id": 1, "unit": "g"}], "none": None}
    text = pyjson.chatml_call("f", args)
    assert text == 'f(queries=["a, b", "c"], n=3, x=1.5, t="two words", items=[{"food_id": 1, "unit": "g"}], none=None)'
    back = pyjson.chatml_arguments(text[2:-1])
    assert back == args | {"none": "None"}
    assert pyjson.chatml_arguments('entry_ids=[1, 3, 5], meal_time="morning", bad, z=[x "q" y]') == {"entry_ids": [1, 3, 5], "meal_time": "morning", "z": ["q"]}
    assert pyjson._gemma_turn_call('x f({"a": 1}) y') == {"name": "f", "arguments": '{"a": 1}'} and pyjson._gemma_turn_call("f({bad})") is None
    assert pyjson._canonical('{"b": 1.0, "a": true}') == pyjson._canonical('{"a": 1, "b": 1}')


def test_first_result_and_closeness(spark):
    df = spark.createDataFrame([('{"final_result": 5.33} "final_result":9', 5.33), ("none", None)], "t string, v double")
    assert df.where(~scoring.final_result(F.col("t")).eqNullSafe(F.col("v"))).count() == 0
    row = spark.range(1).select(scoring.close(F.lit(1.0), F.lit(1.01)), scoring.close(F.lit(1.0), F.lit(1.02))).first()
    assert tuple(row) == (True, False)


def test_model_choice_prefers_within_margin(spark):
    for a, b, want in ((0.75, 0.79, "a"), (0.75, 0.81, "b"), (0.69, 0.72, "b"), (0.9, 0.7, "a")):
        assert scoring.choose(spark.createDataFrame([("a", a), ("b", b)], "model string, score double"), "a").first()[0] == want


def test_log_errors(spark):
    lines = [
        "t | WARNING | p | [el] SIMPLE -- retry 2/3: Validation errors: Turn 3: number 4.5 in assistant text does not match any tool result or argument; Too short: ~5 tokens (backoff 2s)",
        "t | ERROR | p | [de] OTHER -- FAIL: x -- food_id 9 not in known IDs: {1, 2}",
        "t | INFO | p | OK: Saved 12/800",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = sorted(tuple(r) for r in logs.errors(logs.events(df)).collect())
    assert got == [
        ("fail", "food_id N not in known IDs: {...}", "Invalid food_id (not in DB)"),
        ("retry", "Too short: ~N tokens", "Conversation too short"),
        ("retry", "number N in assistant text does not match any tool result or argument", "Hallucinated numbers"),
    ]
    assert logs.saved(df).first()[0] == 12


def test_generation_asks_again(spark):
    requests = spark.createDataFrame([(1, "a"), (2, "bad")], "id long, prompt string")

    def load():
        return lambda prompt: "fixed" if "previous response" in prompt else prompt

    rows = generation.generate(requests, load, lambda a: ["wrong"] if a.startswith("bad") else []).orderBy("id", "attempt").collect()
    assert [(r["id"], r["attempt"], r["answer"], r["errors"]) for r in rows] == [(1, 1, "a", []), (2, 1, "bad", ["wrong"]), (2, 2, "fixed", [])]


def test_retry_messages(spark):
    df = spark.createDataFrame([("json", ["x"], "r"), ("validation", ["e" * 600], None), ("schema", list("abcd"), ""), ("other", ["z"], "r")], "kind string, errors array<string>, results string")
    got = [r[0] for r in df.select(generation.retry_message(F.col("kind"), F.col("errors"), F.col("results"))).collect()]
    assert got[0].endswith("nothing else.") and got[1].endswith("e...") and "... and 1 more" in got[2] and got[3].endswith("\nr")


def test_durations(spark):
    df = spark.createDataFrame([(-5.0, "0s"), (59.9, "59s"), (61.0, "1m 1s"), (3600.0, "1h 0m 0s"), (7325.5, "2h 2m 5s")], "s double, t string")
    assert df.where(generation.duration(F.col("s")) != F.col("t")).count() == 0
