"""Evaluation: gold against predicted calls and answers, weighted scores, model choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dialoom.functions import fixed
from dialoom.functions.exact import fixed_sql


def final_result(text: Column) -> Column:
    """The first ``"final_result": number`` of a text."""
    return F.nullif(F.regexp_extract(text, r'"final_result"\s*:\s*([0-9.]+)', 1), F.lit("")).try_cast("double")


def close(a: Column, b: Column, tolerance: float = fixed.RESULT_TOLERANCE) -> Column:
    return F.abs(a - b) <= F.lit(tolerance) * F.greatest(F.abs(a), F.abs(b))


def is_clarification(text: Column) -> Column:
    """A question without a call in either syntax."""
    called = text.rlike(r"(?s)<\|tool_call_start\|>.*?<\|tool_call_end\|>") | text.rlike(r"(?sU)\w+\(\{.*?\}\)")
    return F.coalesce(F.contains(text, F.lit("?")) & ~called, F.lit(False))


def zip_calls(gold: DataFrame, predicted: DataFrame, by: str = "conv_id") -> DataFrame:
    """The i-th gold call beside the i-th predicted one, by ``turn, call``; a missing one is wrong: adds i, correct."""
    w = Window.partitionBy(by).orderBy("turn", "call")
    number = lambda d: d.withColumn("i", F.row_number().over(w) - 1)
    p = number(predicted).select(by, "i", F.col("name").alias("got_name"), F.col("arguments").alias("got_arguments"))
    rows = number(gold).join(p, [by, "i"], "left")
    return rows.withColumn("correct", F.coalesce((F.col("name") == F.col("got_name")) & (F.col("arguments") == F.col("got_arguments")), F.lit(False)))


def ratio(right: Column, of: Column) -> Column:
    """right / of, 0 if there are none."""
    return F.coalesce(right.cast("double") / F.nullif(of.cast("double"), F.lit(0.0)), F.lit(0.0))


def weighted(tool_calls: Column, sequence: Column, clarification: Column, language: Column | float = 3.5, latency: Column | float = 1.0, memory: Column | float = 1.0) -> Column:
    """The weighted score; language is of 5."""
    col = lambda x: x if isinstance(x, Column) else F.lit(float(x))
    w = fixed.WEIGHTS
    return (
        tool_calls * w["tool_calls"] + sequence * w["sequence"] + clarification * w["clarification"] + col(language) / 5.0 * w["language"] + col(latency) * w["latency"] + col(memory) * w["memory"]
    )


def passes(score: Column) -> Column:
    return score >= fixed.PASS_SCORE


def choose(scores: DataFrame, preferred: str) -> DataFrame:
    """Of ``scores(model, score)`` the best; the preferred one if it and the best pass and are within the margin."""
    best = scores.agg(F.max_by("model", "score").alias("best"), F.max("score").alias("top"), F.max(F.when(F.col("model") == preferred, F.col("score"))).alias("own"))
    near = (F.col("own") >= fixed.PASS_SCORE) & (F.col("top") >= fixed.PASS_SCORE) & (F.col("top") - F.col("own") <= fixed.TIE_MARGIN)
    return best.select(F.when(near, preferred).otherwise(F.col("best")).alias("model"))


def gold(turns: DataFrame) -> DataFrame:
    """What a rendered conversation's parsed turns ``(conv_id, turn, role, content, name)`` say: number of calls, whether a
    turn asks back, the last text that neither calls, asks nor tells results, and the turns that tell results in order."""
    said = F.col("role") == "assistant"
    asks = said & F.col("name").isNull() & is_clarification(F.col("content"))
    told = (F.col("role") == "tool") | (said & F.col("name").isNull() & ~asks & F.startswith("content", F.lit(fixed.GEMMA["results"])))
    last = F.max(F.when(said & F.col("name").isNull() & ~asks & ~told, F.struct("turn", "content")))
    results = F.transform(F.array_sort(F.collect_list(F.when(told, F.struct("turn", "role", "content")))), lambda t: F.struct(t["role"], t["content"]))
    return turns.groupBy("conv_id").agg(F.count(F.when(said, F.col("name"))).alias("calls"), F.coalesce(F.max(asks), F.lit(False)).alias("asks"), last["content"].alias("final_text"), results.alias("results"))


def prompt_prefix(text: Column, model: str) -> Column:
    """The text before the first assistant marker; null if there is none."""
    marker = "<|im_start|>assistant\n" if model == "chatml" else "<|turn>model\n"
    at = F.instr(text, marker)
    return F.when(at > 0, F.substring(text, F.lit(1), at - 1))


def report(scores: DataFrame) -> DataFrame:
    """Adds ``report`` to rows that have a column for each metric and ``score``: a line for each, with its weight, and the sum."""
    lines = [F.concat(F.lit(f"{k}: "), F.expr(fixed_sql(k, 3)), F.lit(f" (weight {w:.0%})")) for k, w in fixed.WEIGHTS.items()]
    return scores.withColumn("report", F.concat_ws("\n", *lines, F.concat(F.lit("weighted score: "), F.expr(fixed_sql("score", 4)))))
