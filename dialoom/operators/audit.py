"""Which settings a conversation's calculations agree with, and whether that is what it says."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def matching_settings(results: DataFrame, pool: DataFrame) -> DataFrame:
    """Settings that all results ``(conv_id, threshold, baseline, divisor, meal_time, meal_divider)`` of a conversation
    agree with (relational division): conv_id, n_results, inferred (null unless exactly one does)."""
    p = pool.select("idx", *(F.col(c).alias(f"p_{c}") for c in ("threshold", "baseline", "divisor", "dividers")))
    same = (F.col("threshold") == F.col("p_threshold")) & (F.col("baseline") == F.col("p_baseline")) & (F.col("divisor") == F.col("p_divisor"))
    meal = F.coalesce("meal_time", F.lit("")) == ""
    fits = same & (meal | (F.col("meal_divider") == F.col("p_dividers")[F.col("meal_time")]))
    rows = results.join(F.broadcast(p), fits, "left")
    of = rows.groupBy("conv_id", "idx").agg(F.count("*").alias("fitting"))
    n = results.groupBy("conv_id").agg(F.count("*").alias("n_results"))
    whole = of.join(n, "conv_id").where("idx is not null and fitting = n_results").groupBy("conv_id").agg(F.count("*").alias("ways"), F.min("idx").alias("idx"))
    return n.join(whole, "conv_id", "left").select("conv_id", "n_results", F.when(F.col("ways") == 1, F.col("idx")).alias("inferred"))


def audit(conversations: DataFrame, inferred: DataFrame) -> DataFrame:
    """Class of each of ``conversations(conv_id, file, idx)``: unverifiable without results, inconsistent if no one
    setting agrees with all, else verified or mismatched."""
    rows = conversations.join(inferred, "conv_id", "left")
    kind = (
        F.when(F.coalesce("n_results", F.lit(0)) == 0, "unverifiable")
        .when(F.col("inferred").isNull(), "inconsistent")
        .when(F.col("inferred") == F.coalesce("idx", F.lit(0)), "verified")
        .otherwise("mismatched")
    )
    return rows.withColumn("class", kind)


def counts(audited: DataFrame) -> DataFrame:
    """Conversations by file and class, with totals over all files (a null file)."""
    per = audited.rollup("class", "file").agg(F.count("*").alias("n"))
    return per.where("class is not null").select("file", "class", "n")


def usable_results(results: DataFrame, payload: str = "payload") -> DataFrame:
    """Results that are objects without an error."""
    return results.where(F.json_object_keys(payload).isNotNull() & F.get_json_object(payload, "$.error").isNull())
