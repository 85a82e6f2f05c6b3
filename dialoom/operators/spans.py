"""Loss masks: spans of assistants' texts, and the tokens that overlap them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions.exact import let

# Patterns of what is trained, an assistant's turn with its end marker, on one line unless ``dotall``.
CHATML = r"<\|im_start\|>assistant\n(.*?(?:<\|tool_call_start\|>.*?<\|tool_call_end\|>)?.*?<\|im_end\|>)"
GEMMA = r"<\|turn>model\n(.*?<turn\|>)"
IGNORED = -100


def spans(text: Column, model: str, dotall: bool = False) -> Column:
    """Character spans [s, e) of what assistants said, in order; in the Gemma format tool results are left out."""
    pattern, head = (CHATML, "<|im_start|>assistant\n") if model == "chatml" else (GEMMA, "<|turn>model\n")
    found = F.regexp_extract_all(text, F.lit(("(?s)" if dotall else "(?d)") + pattern), F.lit(0))
    folded = F.aggregate(
        found,
        F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<s:int,e:int>>").alias("out")),
        lambda a, m: _next(a, m, text, len(head)),
    )
    out = folded["out"]
    if model == "gemma":
        out = F.filter(out, lambda p: ~F.startswith(F.substring(text, p["s"] + 1, F.lit(13)), F.lit("Tool results:")))
    return out


def _next(a: Column, m: Column, text: Column, head: int) -> Column:
    at = F.call_function("locate", m, text, a["at"])
    span = F.struct((at - 1 + head).cast("int").alias("s"), (at - 1 + F.length(m)).cast("int").alias("e"))
    return F.struct((at + F.length(m)).cast("int").alias("at"), F.array_append(a["out"], span).alias("out"))


def covered(offsets: Column, inside: Column) -> Column:
    """For each token's [s, e), whether it overlaps a span; empty tokens don't."""
    return F.transform(offsets, lambda o: (o["s"] != o["e"]) & F.exists(inside, lambda p: (o["e"] > p["s"]) & (o["s"] < p["e"])))


def labels(ids: Column, offsets: Column, inside: Column) -> Column:
    """Ids of covered tokens, ``IGNORED`` for others."""
    return let(inside, lambda spans_: F.zip_with(ids, covered(offsets, spans_), lambda i, c: F.when(c, i).otherwise(IGNORED)))


def char_tokens(text: Column) -> tuple[Column, Column]:
    """The test tokenizer: a token for each character, ids from 1. (ids, offsets)"""
    n = F.length(text)
    ids = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return ids, F.transform(ids, lambda i: F.struct((i - 1).alias("s"), i.alias("e")))


def tokenized(rows: DataFrame, load: Callable[[], Callable[[str], tuple[list[int], list[tuple[int, int]]]]], text: str = "text") -> DataFrame:
    """Adds ids and offsets by a tokenizer; ``load`` makes, once in each worker, a function from a text to both."""
    schema = rows.withColumns({"ids": F.array().cast("array<int>"), "offsets": F.array().cast("array<struct<s int, e int>>")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load()
        kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
        for batch in batches:
            got = [encode(t) if t is not None else ([], []) for t in batch.column(text).to_pylist()]
            spans_ = [[{"s": s, "e": e} for s, e in o] for _, o in got]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([i for i, _ in got], pa.list_(pa.int32())), pa.array(spans_, kind)], names=[*batch.schema.names, "ids", "offsets"])

    return rows.mapInArrow(run, schema)


def masked(rows: DataFrame, model: str, dotall: bool = False, text: str = "text") -> DataFrame:
    """Training rows from tokenised ones: input_ids and labels."""
    return rows.select(F.col("ids").alias("input_ids"), labels(F.col("ids"), F.col("offsets"), spans(F.col(text), model, dotall)).alias("labels"))
