import json

import pytest
from pyspark.sql import functions as F

from dialoom.functions import fixed
from dialoom.operators import asof, assembly, audit, render, rules, spans
from dialoom.operators.harness import settings
from dialoom.sources import config, readers, writers

CONV = {
    "scenario_type": "SIMPLE_SINGLE_FOOD",
    "language": "en",
    "turns": [
        {"role": "user", "content": "add 80 g milk", "context_block": "[CURRENT TALLY: empty]\n[KNOWN FOOD IDS: none]"},
        {"role": "assistant", "action": "tool_call", "tool_calls": [{"name": "search_foods", "arguments": {"queries": ["milk"]}}]},
        {"role": "tool", "tool_results": {"search_foods": {"results": [[{"id": 4, "name": "Milk", "x": 2.50}]]}}},
        {"role": "assistant", "action": "tool_call", "tool_calls": [{"name": "add_foods_to_tally", "arguments": {"items": [{"food_id": 4, "quantity": 80, "unit": "ml"}, {"food_id": 9, "quantity": 1, "unit": "pcs"}]}}]},
        {"role": "assistant", "action": "text", "content": "That is 80 ml.\nDone é?"},
    ],
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("raw")
    lines = [json.dumps(CONV, ensure_ascii=False), "", "{broken", json.dumps(CONV | {"turns": [{"role": "robot"}]}), json.dumps(CONV | {"user_settings_idx": 3})]
    (d / "en.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(d)


@pytest.fixture(scope="module")
def convs(spark, folder):
    good, _ = readers.conversations(spark, folder)
    return good.withColumn("conv_id", F.row_number().over(__import__("pyspark").sql.Window.orderBy("line_no"))).cache()


def exploded(convs):
    t = convs.select("conv_id", F.posexplode("turns").alias("turn", "t")).select("conv_id", "turn", "t.*")
    calls = t.select("conv_id", "turn", F.posexplode("tool_calls").alias("call", "c")).select("conv_id", "turn", "call", "c.*")
    return t.withColumn("n_calls", F.size("tool_calls")), calls


def test_tolerant_and_strict_scans(spark, folder):
    good, bad = readers.conversations(spark, folder)
    assert good.count() == 2 and sorted(r["error"].split(":")[0] for r in bad.collect()) == ["JSONDecodeError", "ValueError"]
    assert {r["file"] for r in good.collect()} == {"en"}
    first = good.orderBy("line_no").first()
    assert first["turns"][2]["tool_results"] == json.dumps(CONV["turns"][2]["tool_results"]) and first["user_settings_idx"] is None
    with pytest.raises(Exception, match="en: "):
        readers.strict_conversations(spark, folder).collect()
    assert readers.raw_json(spark, folder, ["SIMPLE_SINGLE_FOOD"]).count() == 3
    assert readers.raw_json(spark, folder, ["OTHER"]).count() == 0


def test_food_tables(spark, tmp_path):
    text = "﻿Food;g;n;carbs\nMilk;200 ml;;10 g\nshort;1\n Bread ;;1 scheibe;15,5 g\nSoup;3/4 cup;2 x;\n"
    (tmp_path / "de.csv").write_text(text, encoding="utf-8")
    rows = {r["id"]: r for r in readers.foods(spark, str(tmp_path)).collect()}
    assert sorted(rows) == [1, 3, 4]
    assert (rows[1]["lang"], rows[1]["gram_unit"], rows[1]["carbs_per_100g"], rows[1]["category"], rows[1]["is_liquid"]) == ("de", "ml", 5.0, "dairy", True)
    assert (rows[3]["name"], rows[3]["piece_unit"], rows[3]["carbs_per_piece"], rows[3]["has_grams_mode"]) == ("Bread", "slice", 15.5, False)
    assert (rows[4]["standard_quantity_g"], rows[4]["gram_unit"], rows[4]["carbs"]) == (3.0, "cup", 0.0)
    with pytest.raises(Exception):
        readers.foods(spark, str(tmp_path), ["xx"]).collect()


def test_rules_on_full_conversations(spark, convs):
    turns, calls = exploded(convs.where("conv_id = 1"))
    assert rules.tool_order(calls).count() == 0
    wrong = rules.tool_order(calls.where("name <> 'search_foods'")).first()
    assert wrong["error"] == "add_foods_to_tally called before search_foods"
    known = rules.context_ids(turns).unionByName(rules.searched_ids(turns))
    assert [r["id"] for r in rules.unknown_ids(rules.added_ids(calls), known).collect()] == [9]
    foods = spark.createDataFrame([(4, "Milk", False, True), (9, "Egg", True, False)], "id int, name string, has_grams_mode boolean, has_pieces_mode boolean")
    assert sorted(r["error"] for r in rules.unit_errors(rules.added_ids(calls), foods).collect()) == [
        "food_id 4 (Milk): unit 'ml' used but food has no grams/ml mode",
        "food_id 9 (Egg): unit 'pcs' used but food has no piece mode",
    ]
    assert rules.empty_turns(turns).count() == 0 and rules.missing_context(turns).count() == 0
    assert rules.missing_context(turns.withColumn("context_block", F.lit(None).cast("string"))).first()["error"] == "Turn 0: missing context_block in user message"


def test_rendering_both_formats(spark, convs):
    one = convs.where("conv_id = 1")
    chatml = render.full_conversation(one, "chatml", F.lit("SYS")).first()["text"]
    assert chatml.startswith("<|startoftext|><|im_start|>system\nSYS<|im_end|><|im_start|>user\nadd 80 g milk\n\n[CURRENT TALLY: empty]")
    assert '<|im_start|>assistant\n<|tool_call_start|>search_foods(queries=["milk"])<|tool_call_end|><|im_end|>' in chatml
    assert '<|im_start|>tool\n{"search_foods": {"results": [[{"id": 4, "name": "Milk", "x": 2.5}]]}}<|im_end|>' in chatml
    gemma = render.full_conversation(one, "gemma", F.lit("SYS")).first()["text"]
    assert '<|turn>model\nsearch_foods({"queries": ["milk"]})<turn|>' in gemma
    assert '<|turn>model\nTool results:\nsearch_foods -> {\n  "results": [' in gemma
    df = spark.createDataFrame([(chatml, gemma)], "chatml string, gemma string")
    for model in render.MODELS:
        parsed = render.parse(df.select(model), model, model).orderBy("turn").collect()
        assert [r["role"] for r in parsed][:3] == ["system", "user", "assistant"] and parsed[-1]["content"] == CONV["turns"][-1]["content"]


def python_spans(text, model):
    import re

    if model == "chatml":
        return [m.span(1) for m in re.finditer(spans.CHATML, text)]
    return [m.span(1) for m in re.finditer(spans.GEMMA, text) if not m[1].startswith("Tool results:")]


def test_spans_equal_python(spark):
    import random

    r = random.Random(5)
    bits = ["<|im_start|>assistant\n", "<|im_end|>", "<|turn>model\n", "<turn|>", "a", "é😀", "\n", "\r", " ", "Tool results:", "<|tool_call_start|>", "<|tool_call_end|>"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 25))) for _ in range(600)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for model in render.MODELS:
        got = [[(p["s"], p["e"]) for p in row[0]] for row in df.select(spans.spans(F.col("t"), model)).collect()]
        assert got == [python_spans(t, model) for t in texts]


@pytest.mark.parametrize(
    "offsets, inside, want",
    [
        ([(0, 3), (3, 6), (6, 9), (9, 12)], [(3, 9)], [1, 2]),
        ([(0, 5), (5, 10), (10, 15)], [(2, 7)], [0, 1]),
        ([(0, 3), (3, 6), (6, 9), (9, 12), (12, 15)], [(0, 3), (9, 15)], [0, 3, 4]),
        ([(0, 3), (3, 6)], [(10, 12)], []),
        ([(0, 0), (0, 5), (5, 10)], [(0, 10)], [1, 2]),
    ],
)
def test_labels(spark, offsets, inside, want):
    df = spark.createDataFrame([(list(range(1, len(offsets) + 1)), offsets, inside)], "ids array<int>, o array<struct<s int, e int>>, p array<struct<s int, e int>>")
    got = df.select(spans.labels(F.col("ids"), F.col("o"), F.col("p"))).first()[0]
    assert [i for i, x in enumerate(got) if x != spans.IGNORED] == want


def test_own_tokenizers_can_be_plugged_in(spark):
    df = spark.createDataFrame([("<bos><|turn>model\nhi<turn|>",)], "text string")

    def load():
        return lambda t: (list(range(1, len(t) + 1)), [(i, i + 1) for i in range(len(t))])

    row = spans.masked(spans.tokenized(df, load), "gemma").first()
    assert [x for x in row["labels"] if x != -100] == list(range(19, 19 + 9))


def test_splits_agree_and_cover(spark):
    rows = spark.range(700).select(F.col("id").alias("k"), (F.col("id") % 4).alias("g")).unionByName(spark.createDataFrame([(9000, 9)], "k long, g long"))
    a = {r["k"]: r["split"] for r in assembly.stratified_split(rows, ["g"], "k").collect()}
    b = {r["k"]: r["split"] for r in assembly.large_split(spark, rows, ["g"], "k", cells=8).collect()}
    assert a == b and a[9000] == "eval"
    for g in range(4):
        assert sum(v == "train" for k, v in a.items() if k % 4 == g and k < 700) == int(175 * 0.9)


def test_quotas_add_up(spark):
    none = spark.createDataFrame([], "scenario string")
    rows = assembly.quota(spark, 800, none).collect()
    assert sum(r["to_make"] for r in rows) == 800
    some = assembly.quota(spark, 7, none, list(fixed.SCENARIOS)[:3]).orderBy("ordinal").collect()
    assert [r["to_make"] for r in some] == [3, 2, 2]
    assert sum(fixed.SCENARIOS.values()) == pytest.approx(1.0)


def test_results_are_copied_forward(spark):
    turns = spark.createDataFrame([(1, i, r) for i, r in enumerate("a a t a t t a".split())], "conv_id int, turn int, role string").replace({"a": "assistant", "t": "tool"})
    results = spark.createDataFrame([(1, 0, "k", "old"), (1, 1, "k", "new"), (1, 0, "j", "x"), (1, 3, "k", "z"), (1, 6, "k", "lost")], "conv_id int, turn int, key string, value string")
    assert sorted(tuple(r) for r in asof.copy_forward(results, turns).collect()) == [(1, 2, "j", "x"), (1, 2, "k", "new"), (1, 4, "k", "z")]


def test_placeholders_are_filled_from_before(spark):
    texts = spark.createDataFrame([(1, 2, "{{carbs_1}}g, {{carbs_2}} {{gone}}"), (1, 5, "now {{carbs_1}}"), (2, 0, "none")], "conv_id int, turn int, text string")
    given = spark.createDataFrame([(1, 1, [4.0, 17.65]), (1, 4, [0.5])], "conv_id int, turn int, v array<double>").select("conv_id", "turn", F.explode(asof.numbered(F.col("v"), "carbs")).alias("key", "value"))
    got = {(r["conv_id"], r["turn"]): (r["filled"], r["left"]) for r in asof.fill(texts, given).collect()}
    assert got == {(1, 2): ("4g, 17.65 {{gone}}", ["gone"]), (1, 5): ("now 0.5", []), (2, 0): ("none", [])}


def test_settings_are_inferred(spark):
    pool = settings(spark)
    rows = [(1, 130.0, 100.0, 40.0, "morning", 14), (1, 130.0, 100.0, 40.0, "evening", 12), (2, 130.0, 100.0, 40.0, "morning", 15), (3, 130.0, 100.0, 40.0, None, None), (3, 120.0, 90.0, 30.0, None, None)]
    results = spark.createDataFrame(rows, "conv_id int, threshold double, baseline double, divisor double, meal_time string, meal_divider int")
    assert sorted(tuple(r) for r in audit.matching_settings(results, pool).collect()) == [(1, 2, 0), (2, 1, None), (3, 2, None)]


def test_sinks(spark, convs, tmp_path):
    base = str(tmp_path)
    writers.append(convs.drop("file", "line_no"), f"{base}/raw")
    writers.append(convs.drop("file", "line_no"), f"{base}/raw")
    assert spark.read.json(f"{base}/raw").count() == 4
    writers.migrated(convs.select("conv_id"), f"{base}/copy")
    writers.rewrite(spark, spark.read.json(f"{base}/copy").withColumn("new", F.lit(1)), f"{base}/copy")
    assert spark.read.json(f"{base}/copy").where("new = 1").count() == 2
    writers.splits(convs.select(F.lit("chatml").alias("model_type"), F.lit("train").alias("split"), F.lit("x").alias("text")), f"{base}/out")
    assert spark.read.json(f"{base}/out/model_type=chatml/split=train").count() == 2
    text = writers.report([("Languages", writers.table(convs.groupBy("language").count()))], f"{base}/report", spark)
    assert "| en | 2 |" in text and readers.log(spark, f"{base}/report").count() >= 5


def test_environments():
    assert config.environment({"COLAB_GPU": "1"}) == "colab" and config.environment({}) == "local"
    assert config.JobConfig.of("kaggle").data.startswith("/kaggle")


def test_running_sums_equal_a_plain_loop(spark):
    import random

    r = random.Random(3)
    rows = [(i, r.choice(["a", "a", "a", "b", None]), r.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, g string, v int")
    seen: dict = {}
    want = {}
    for k, g, v in rows:
        want[k] = tuple(seen.get(g, (0, 0)))
        n, s = seen.get(g, (0, 0))
        seen[g] = (n + 1, s + v)
    for cells in (1, 7, 50):
        got = assembly.before(df, ["g"], "k", {"n": F.lit(1), "s": F.col("v")}, cells)
        assert got.columns == ["k", "g", "v", "n", "s"]
        assert {x["k"]: (x["n"], x["s"]) for x in got.collect()} == want
    assert assembly.before(df.limit(0), ["g"], "k", {"n": F.lit(1)}).count() == 0


def test_samples_are_the_least_keys(spark):
    df = spark.createDataFrame([(i, i % 3, i % 5 != 0) for i in range(100)], "k long, g long, ok boolean")
    for x in assembly.with_samples(df, ["g"], "ok", "k", 4).collect():
        bad = [i for i in range(100) if i % 3 == x["g"] and i % 5 == 0]
        assert (x["invalid"], x["samples"]) == (len(bad), bad[:4])
