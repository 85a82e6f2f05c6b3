import logging
import os
import time

from pyspark.sql import functions as F

from dialoom.functions import pyjson
from dialoom.operators import assembly, evaluation, render, scoring
from dialoom.sources import readers, writers


def test_lines_are_numbered_over_splits(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 50) for i in range(3000)]
    lines[7] = lines[2999] = ""
    for name in ("a", "b"):
        (tmp_path / f"{name}.txt").write_text("\n".join(name + x for x in lines) + "\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "64")
        rows = readers.numbered(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 1
        got = {(os.path.basename(r["path"])[0], r["line_no"]): r["value"] for r in rows.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {(name, i): name + x for name in "ab" for i, x in enumerate(lines)}


def test_arguments_are_split_outside_of_quotes_and_brackets():
    assert pyjson.split_arguments('a=[1, 2], b="x, y", c={"d": 1, "e": 2}, f=3') == ["a=[1, 2]", ' b="x, y"', ' c={"d": 1, "e": 2}', " f=3"]
    assert pyjson.split_arguments("") == [""] and pyjson.split_arguments("a,b") == ["a", "b"]
    assert pyjson.chatml_arguments("") == {} and pyjson.chatml_arguments("a=1.5, b=-2, c=x") == {"a": 1.5, "b": -2, "c": "x"}


def test_evaluation_in_the_other_format(spark):
    head = "<bos><|turn>system\nS<turn|><|turn>user\nhi<turn|>"
    call, result = '<|turn>model\nf({"a": 1})<turn|>', "<|turn>model\nTool results:\nf -> 1<turn|>"
    rows = spark.createDataFrame(
        [(1, head + call + result + '<|turn>model\nso "final_result": 2.0 g<turn|>'), (2, head + "<|turn>model\nWhat?<turn|>"), (3, head), (4, head + call + call + result)], "conv_id long, text string"
    )

    def load():
        def answer(text):
            return "<|turn>model\nf({\"a\": 1.0})<turn|>" if text.count("Tool results:") == 0 and "f({" not in text else '<|turn>model\n"final_result": 2.01 g<turn|>'

        return answer

    got = {r["conv_id"]: tuple(r)[1:] for r in evaluation.evaluate(rows, "gemma", load).collect()}
    assert got == {1: (1, 1, True, True, False, False), 2: (0, 0, False, False, True, False), 4: (2, 1, False, False, False, False)}
    gold = {r["conv_id"]: r for r in scoring.gold(evaluation.parsed(rows, "gemma")).collect()}
    assert [t["content"] for t in gold[1]["results"]] == ["Tool results:\nf -> 1"] and gold[2]["asks"] and gold[3]["final_text"] is None
    one = evaluation.metrics(evaluation.evaluate(rows.where("conv_id = 3"), "gemma", load)).first()
    assert tuple(one) == (0, 0.0, 0.0, 0.0)


def test_a_model_that_always_calls_is_stopped(spark):
    rows = spark.createDataFrame([(1, "<|im_start|>user\nx<|im_end|><|im_start|>assistant\ny<|im_end|>")], "conv_id long, text string")
    gold = scoring.gold(evaluation.parsed(rows, "chatml"))
    said = evaluation.answers(rows, gold, "chatml", lambda: lambda text: "<|tool_call_start|>f()<|tool_call_end|>", 5)
    assert len(said.first()["said"]) == 5


def test_chat_helpers_agree_with_the_renderer(spark):
    turns = spark.createDataFrame([(1, 0, "user", "u\n\nC"), (1, 1, "assistant", "a"), (1, 2, "tool", "r")], "conv_id long, turn long, role string, text string")
    whole = render.conversation(turns, "chatml", F.lit("S")).first()["text"]
    parts = spark.range(1).select(F.concat(render.chat_prefix("chatml", F.lit("S")), render.chat_user("chatml", F.lit("u"), F.lit("C")), F.lit(render.chat_assistant("chatml") + "a<|im_end|>"), render.chat_result("chatml", F.lit("r")))).first()[0]
    assert whole == parts


def test_tracker_quirk_and_its_correction(spark):
    calls = spark.createDataFrame(
        [(1, "search_foods", '{"queries": ["milk", "milk"]}'), (1, "add_foods_to_tally", '{"food_id": 0, "items": [{"food_id": 4}]}'), (2, "add_foods_to_tally", '{"food_id": 7, "items": [{"food_id": 4}]}')], "conv_id long, name string, arguments string"
    )
    turns = spark.createDataFrame([(1,)] * 6 + [(2,)] * 2, "conv_id long")
    uses, lengths = assembly.trackers(calls, turns)
    assert sorted(map(tuple, uses.collect())) == [("7", 1), ("milk", 1)] and tuple(lengths.first()) == (2, 1, 1)
    assert sorted(map(tuple, assembly.trackers(calls, turns, corrected=True)[0].collect())) == [("4", 2), ("milk", 1)]


def test_logs_rotate_and_old_ones_go(tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "LOG_BYTES", 300)
    old = tmp_path / "run.log.9"
    old.write_text("old")
    os.utime(old, (time.time() - 8 * 86_400,) * 2)
    log = writers.logger(str(tmp_path / "run.log"))
    for i in range(10):
        log.debug("Saved %d/800", i)
    names = sorted(p.name for p in tmp_path.iterdir())
    assert not old.exists() and len(names) > 2
    assert "| DEBUG    | dialoom:test_logs_rotate" in (tmp_path / "run.log").read_text()
    for h in list(log.handlers):
        log.removeHandler(h)
        h.close()
    assert logging.getLogger("dialoom") is log
