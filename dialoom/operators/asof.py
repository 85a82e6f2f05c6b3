"""Ordered joins within conversations: results carried forward, placeholders filled from what came before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dialoom.functions.exact import number_sql


def next_turn(turns: DataFrame, role: str, name: str = "target") -> DataFrame:
    """Adds the next turn of a role after each turn."""
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(1, Window.unboundedFollowing)
    return turns.withColumn(name, F.min(F.when(F.col("role") == role, F.col("turn"))).over(w))


def copy_forward(results: DataFrame, turns: DataFrame, role: str = "tool") -> DataFrame:
    """Results ``(conv_id, turn, key, value)`` given to the next turn of a role; of equal keys the last wins: conv_id, target, key, value."""
    to = next_turn(turns.select("conv_id", "turn", "role"), role).where("target is not null").select("conv_id", "turn", "target")
    last = F.max(F.struct("turn", "value")).alias("r")
    return results.join(to, ["conv_id", "turn"]).groupBy("conv_id", "target", "key").agg(last).select("conv_id", "target", "key", "r.value")


def latest(wanted: DataFrame, given: DataFrame) -> DataFrame:
    """For ``wanted(conv_id, turn, key, …)`` the value of the last earlier ``given(conv_id, turn, key, value)``.

    Both are put in one order by (conversation, key) and the last value is carried on: one shuffle, no range join.
    """
    extra = [c for c in wanted.columns if c not in ("conv_id", "turn", "key")]
    w = wanted.withColumns({"_side": F.lit(1), "value": F.lit(None).cast(given.schema["value"].dataType)})
    g = given.select("conv_id", "turn", "key", "value").withColumn("_side", F.lit(0))
    both = w.unionByName(g, allowMissingColumns=True)
    order = Window.partitionBy("conv_id", "key").orderBy("turn", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn("value", F.last("value", ignorenulls=True).over(order)).where("_side = 1").select("conv_id", "turn", "key", *extra, "value")


def numbered(values: Column, prefix: str) -> Column:
    """An array's values keyed ``<prefix>_1``, ``<prefix>_2`` and so on: a map."""
    keys = F.transform(values, lambda _, i: F.concat(F.lit(f"{prefix}_"), (i + 1).cast("string")))
    return F.map_from_arrays(keys, values)


def fill(texts: DataFrame, given: DataFrame) -> DataFrame:
    """Texts ``(conv_id, turn, text)`` whose ``{{key}}`` are replaced by the last earlier values: adds filled, left (keys without one)."""
    asked = texts.select("conv_id", "turn", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"(?U)\{\{(\w+)\}\}"), F.lit(1)))).alias("key"))
    values = latest(asked, given).withColumn("shown", F.expr(number_sql("value")))
    per = values.groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(F.struct("key", "shown"))).alias("vs"))
    rows = texts.join(per, ["conv_id", "turn"], "left").withColumn("vs", F.coalesce("vs", F.array().cast("array<struct<key string, shown string>>")))
    filled = F.aggregate("vs", F.col("text"), lambda t, v: F.when(v["shown"].isNull(), t).otherwise(F.replace(t, F.concat(F.lit("{{"), v["key"], F.lit("}}")), v["shown"])))
    left = F.transform(F.filter("vs", lambda v: v["shown"].isNull()), lambda v: v["key"])
    return rows.withColumns({"filled": filled, "left": left}).drop("vs")
