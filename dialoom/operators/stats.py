"""Dataset statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions.exact import percentiles


def length_summary(rows: DataFrame, value: Column, shares: list[tuple[str, float]], limit: int | None = None) -> DataFrame:
    """One row: n, mean, least, largest, elements at the given shares of the rank, and the percentage over ``limit``.

    Values are counted first, so that what is sorted is one row for each distinct length.
    """
    per = rows.select(value.cast("long").alias("value")).where("value is not null").groupBy("value").agg(F.count("*").alias("n"))
    over = F.sum(F.when(F.col("value") > limit, F.col("n")).otherwise(0)) if limit is not None else F.lit(0)
    one = per.agg(
        F.sum("n").alias("n"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"),
        F.min("value").alias("least"),
        F.max("value").alias("largest"),
        (over / F.sum("n") * 100).alias("percent_over"),
        F.collect_list(F.struct("value", "n")).alias("counts"),
    )
    return one.select("n", "mean", "least", "largest", *percentiles("counts", shares), *([] if limit is None else ["percent_over"]))


def pivot(rows: DataFrame, by: str, kind: str, values: list[str]) -> DataFrame:
    """Counts by two columns, a column for each of the fixed values (0 where none), and their total."""
    counts = [F.sum((F.col(kind) == v).cast("long")).alias(v) for v in values]
    return rows.groupBy(by).agg(*counts, F.count("*").alias("total"))


def shares(rows: DataFrame, by: str) -> DataFrame:
    """Counts of each value and their percentage of all rows."""
    per = rows.groupBy(by).agg(F.count("*").alias("n"))
    # a row for each value: joined to their sum
    return per.crossJoin(F.broadcast(per.agg(F.sum("n").alias("of")))).select(by, "n", (F.col("n") * 100.0 / F.col("of")).alias("percent"))
