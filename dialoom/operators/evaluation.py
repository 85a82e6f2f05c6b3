"""Evaluating a model on rendered conversations: it answers from a conversation's beginning, is given the recorded result
for each call that it makes, and what it says is held against what the conversation says.

Only the model itself runs in Python, once for each answer; all parsing and scoring is by DataFrames.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.functions import pyjson
from dialoom.operators import render, scoring

Model = Callable[[str], str]


def parsed(rows: DataFrame, model: str) -> DataFrame:
    """Turns of rendered texts ``(conv_id, text)`` with the calls they make: conv_id, turn, role, content, name, arguments."""
    read = pyjson.chatml_turn_call if model == "chatml" else pyjson.gemma_turn_call
    turns = render.parse(rows.select("conv_id", "text"), model)
    call = read(F.when(F.col("role") == "assistant", F.col("content")))
    return turns.withColumn("call", call).select("conv_id", "turn", "role", "content", "call.name", "call.arguments")


def answers(rows: DataFrame, gold: DataFrame, model: str, load: Callable[[], Model], most_turns: int = 8) -> DataFrame:
    """What a model says, answer by answer: conv_id, said (an array). ``load`` makes the model once in each worker.

    Each conversation is given up to its first assistant's marker. After a call, the recorded result of the same place
    follows, if there is one; an answer without a call is the last. A conversation without a marker isn't asked.
    """
    results = F.transform("results", lambda t: render.simple_turn(model, t["role"], t["content"]))
    asked = rows.select("conv_id", scoring.prompt_prefix(F.col("text"), model).alias("prefix")).where("prefix IS NOT NULL")
    asked = asked.join(gold.select("conv_id", results.alias("results")), "conv_id")
    calls = pyjson.is_call[model]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answer = load()
        for batch in batches:
            out = []
            for prefix, given in zip(batch.column("prefix").to_pylist(), batch.column("results").to_pylist(), strict=True):
                said: list[str] = []
                text = prefix
                while len(said) < most_turns:
                    said.append(answer(text))
                    text += said[-1]
                    if not calls(said[-1]):
                        break
                    text += "".join(given[len(said) - 1 : len(said)])
                out.append(said)
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(out, pa.list_(pa.string()))], names=["conv_id", "said"])

    kind = dict(asked.dtypes)["conv_id"]
    return asked.select("conv_id", "prefix", "results").mapInArrow(run, f"conv_id {kind}, said array<string>")


def compare(turns: DataFrame, gold: DataFrame, said: DataFrame, model: str) -> DataFrame:
    """A row for each conversation asked: calls, right (calls of the same place, name and arguments), compared and close
    (results stated last), asks, asked (whether the model asks back where the conversation does)."""
    read = pyjson.chatml_turn_call if model == "chatml" else pyjson.gemma_turn_call
    each = said.select("conv_id", F.posexplode("said").alias("turn", "content")).withColumn("c", read(F.col("content")))
    same = lambda d: d.withColumn("arguments", pyjson.canonical(F.col("arguments")))
    predicted = same(each.where("c.name IS NOT NULL").select("conv_id", "turn", F.lit(0).alias("call"), "c.name", "c.arguments"))
    wanted = same(turns.where("name IS NOT NULL").select("conv_id", "turn", F.lit(0).alias("call"), "name", "arguments"))
    right = scoring.zip_calls(wanted, predicted).groupBy("conv_id").agg(F.count_if("correct").alias("right"))
    last = each.groupBy("conv_id").agg(F.max(F.when(F.col("c.name").isNull(), F.struct("turn", "content")))["content"].alias("final_said"))
    rows = gold.join(last, "conv_id").join(right, "conv_id", "left")
    got, want = scoring.final_result(F.col("final_said")), scoring.final_result(F.col("final_text"))
    both = got.isNotNull() & want.isNotNull()
    return rows.select(
        "conv_id",
        "calls",
        F.coalesce("right", F.lit(0)).alias("right"),
        F.coalesce(both, F.lit(False)).alias("compared"),
        F.coalesce(both & scoring.close(got, want), F.lit(False)).alias("close"),
        "asks",
        (F.col("asks") & scoring.is_clarification(F.coalesce("final_said", F.lit("")))).alias("asked"),
    )


def metrics(compared: DataFrame) -> DataFrame:
    """One row: the shares of right calls, close results and questions asked back, over all conversations (0 where there is
    nothing to count), and how many there were."""
    n = lambda c: F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0))
    return compared.agg(
        F.count("*").alias("conversations"),
        scoring.ratio(n("right"), n("calls")).alias("tool_calls"),
        scoring.ratio(n("close"), n("compared")).alias("sequence"),
        scoring.ratio(n("asked"), n("asks")).alias("clarification"),
    )


def evaluate(rows: DataFrame, model: str, load: Callable[[], Model], most_turns: int = 8) -> DataFrame:
    """``compare`` for rendered conversations ``(conv_id, text)`` and a model."""
    turns = parsed(rows, model)
    gold = scoring.gold(turns)
    return compare(turns, gold, answers(rows, gold, model, load, most_turns), model)
