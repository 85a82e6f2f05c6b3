"""Around the generator of conversations: an adapter for any model, attempts with feedback, prompt parts."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions import fixed
from dialoom.functions.exact import py_round_sql

Generator = Callable[[str], str]


@dataclass(frozen=True)
class Limits:
    attempts: int = 3
    temperature: float = 0.8
    top_p: float = 0.95
    max_tokens: int = 4096


def generate(requests: DataFrame, load: Callable[[], Generator], check: Callable[[str], list[str]], limits: Limits = Limits(), wait: float = 0.0) -> DataFrame:
    """Asks a model for each of ``requests(id, prompt)``; ``load`` makes it once in each worker, ``check`` says what is
    wrong with an answer. A wrong answer is asked for again with that, after growing waits. One row for each attempt:
    id, attempt, answer, errors. Use ``repartition`` to bound how many ask at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for batch in batches:
            rows = []
            for i, prompt in zip(batch.column("id").to_pylist(), batch.column("prompt").to_pylist(), strict=True):
                ask = prompt
                for attempt in range(1, limits.attempts + 1):
                    answer = model(ask)
                    wrong = check(answer)
                    rows.append((i, attempt, answer, wrong))
                    if not wrong:
                        break
                    ask = prompt + "\n" + retry_text("; ".join(wrong))
                    if attempt < limits.attempts:
                        time.sleep(wait * attempt)
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["id", "attempt", "answer", "errors"])

    return requests.select(F.col("id").cast("long").alias("id"), "prompt").mapInArrow(run, "id long, attempt int, answer string, errors array<string>")


# Fixed value: the first line of feedback.
HEAD = "Your previous response had errors. Please fix them and regenerate:\n"


def retry_text(errors: str, most: int = 500) -> str:
    """Feedback on validation errors, cut to a length."""
    return f"{HEAD}\n- {errors[:most]}{'...' if len(errors) > most else ''}"


def retry_message(kind: Column, errors: Column, results: Column | None = None) -> Column:
    """Feedback by the kind of failure: json, validation (an array of errors), schema (the first three), other."""
    joined = F.array_join(errors, "; ")
    cut = lambda n, tail: F.when(F.length(joined) > n, F.concat(F.substring(joined, 1, n), F.lit(tail))).otherwise(joined)
    more = F.size(errors) - 3
    schema = F.concat(F.array_join(F.transform(F.slice(errors, 1, 3), lambda e: F.concat(F.lit("- "), e)), "\n"), F.when(more > 0, F.concat(F.lit("\n- ... and "), more.cast("string"), F.lit(" more structural issues"))).otherwise(""))
    body = (
        F.when(kind == "json", "- Output was NOT valid JSON. Generate ONLY valid JSON, nothing else.")
        .when(kind == "validation", F.concat(F.lit("- "), cut(500, "...")))
        .when(kind == "schema", schema)
        .otherwise(F.concat(F.lit("- "), cut(300, "\n- ... (truncated)")))
    )
    text = F.concat(F.lit(HEAD + "\n"), body)
    if results is None:
        return text
    tail = F.concat(F.lit("\n\nTool results from your previous attempt (reference these numbers when writing assistant text):\n"), results)
    return F.when((kind == "json") | (F.coalesce(results, F.lit("")) == ""), text).otherwise(F.concat(text, tail))


def excerpt(results: Column, turn: Column, most: int = 400) -> Column:
    """A tool turn's results for feedback, cut to a length."""
    return F.concat(F.lit("Turn "), turn.cast("string"), F.lit(": "), F.when(F.length(results) > most, F.concat(F.substring(results, 1, most), F.lit("..."))).otherwise(results))


def cost(tokens_in: Column, tokens_out: Column) -> Column:
    return tokens_in / F.lit(1e6) * F.lit(fixed.PRICE_IN) + tokens_out / F.lit(1e6) * F.lit(fixed.PRICE_OUT)


def duration(seconds: Column) -> Column:
    """Whole hours, minutes and seconds; negative counts as none."""
    s = F.greatest(F.lit(0), F.floor(seconds)).cast("long")
    h, m, r = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    text = lambda *parts: F.concat(*(x for v, u in parts for x in (v.cast("string"), F.lit(u))))
    return F.when(h > 0, text((h, "h "), (m, "m "), (r, "s"))).when(m > 0, text((m, "m "), (r, "s"))).otherwise(text((r, "s")))


def training_steps(rows: Column, batch: Column, epochs: Column) -> tuple[Column, Column]:
    """Optimiser steps of all epochs, and how many lie between checkpoints."""
    total = F.ceil(rows / batch) * epochs
    return total, F.greatest(F.lit(50), F.floor(total / 3))


def final_dose_sql(total: str, divider: str, glucose: str, threshold: str, baseline: str, divisor: str) -> str:
    """Rounded dose: carbs by the divider, and a correction if glucose reaches the threshold."""
    correction = f"CASE WHEN {glucose} >= {threshold} THEN greatest(CAST(0 AS DOUBLE), ({glucose} - {baseline}) / {divisor}) ELSE CAST(0 AS DOUBLE) END"
    return py_round_sql(f"({total} / {divider} + {correction})")


def sanitized(turns: Column) -> Column:
    """Turns whose missing or non-object results become ``{}`` where a result belongs."""
    owns = lambda t: (t["role"] == "tool") | ((t["role"] == "assistant") & (t["action"] == "tool_call"))
    broken = lambda t: F.when(t["role"] == "tool", F.json_object_keys(t["tool_results"]).isNull()).otherwise(t["tool_results"].isNull())
    return F.transform(turns, lambda t: t.withField("tool_results", F.when(owns(t) & broken(t), F.lit("{}")).otherwise(t["tool_results"])))


def accepted(requests: DataFrame, load: Callable[[], Generator], check: Callable[[str], list[str]], done: DataFrame, limits: Limits = Limits()) -> tuple[DataFrame, DataFrame]:
    """Conversations that a model makes for ``requests(id, prompt)``, as far as they are right and new, and all attempts.

    An answer without errors is read as a line of JSON; one that isn't a conversation is dropped, and so is one whose
    scenario and key (of its user's texts) are in ``done(scenario_type, key)`` or come from a lower id already. The first
    result has conv_id, key and a conversation's columns, and goes to ``sources.writers.append``. Attempts should be saved,
    else a model is asked again whenever they are read.
    """
    from dialoom.operators import assembly
    from dialoom.sources import readers

    attempts = generate(requests, load, check, limits)
    right = attempts.where(F.size("errors") == 0).select(F.lit("").alias("file"), F.col("id").alias("line_no"), F.col("answer").alias("line"))
    read = readers.parse_lines(right).where("conv IS NOT NULL").select(F.col("line_no").alias("conv_id"), "conv.*")
    said = F.transform(F.filter("turns", lambda t: t["role"] == "user"), lambda t: F.coalesce(t["content"], F.lit("")))
    read = read.withColumn("key", F.substring(F.sha2(F.array_join(said, "|"), 256), 1, 16))
    return assembly.resume(read, done, ["scenario_type", "key"], "conv_id"), attempts
