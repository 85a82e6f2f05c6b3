"""Putting a dataset together: deduplication, resumption, quotas, rotation, splits, samples."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dialoom.functions import fixed
from dialoom.functions.exact import cuts_below
from dialoom.operators import rules


def utterance_key(turns: DataFrame, content: str = "text") -> DataFrame:
    """First 16 hex digits of the SHA-256 of each conversation's user texts, joined by ``|``: conv_id, key."""
    texts = F.transform(F.array_sort(F.collect_list(F.when(F.col("role") == "user", F.struct("turn", F.coalesce(content, F.lit("")).alias("t"))))), lambda x: x["t"])
    return turns.groupBy("conv_id").agg(F.substring(F.sha2(F.array_join(texts, "|"), 256), 1, 16).alias("key"))


def first_of_each(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row of each key, the first by ``order``: a min over structs, combined before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    least = rows.groupBy(*keys).agg(F.min(F.struct(order, *(c for c in rest if c != order))).alias("r"))
    return least.select(*keys, "r.*").select(rows.columns)


def resume(new: DataFrame, done: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """What is new: not already done, and each key once (the first by ``order``)."""
    rest = new.join(done.select(keys).distinct(), keys, "left_anti").select(new.columns)
    return first_of_each(rest, keys, order) if order else rest.dropDuplicates(keys)


def trackers(calls: DataFrame, turns: DataFrame, short: int = 5, corrected: bool = False) -> tuple[DataFrame, DataFrame]:
    """What earlier output says of the next prompts: uses of each id ``(id, uses)``, each conversation counting once, and
    how many conversations are short and long ``(conversations, short, long)``. ``turns`` has a row for each turn."""
    uses = usage_counts(rules.food_ids(calls, corrected))
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("turns"))
    lengths = sizes.agg(F.count("*").alias("conversations"), F.count_if(F.col("turns") <= short).alias("short"), F.count_if(F.col("turns") > short).alias("long"))
    return uses, lengths


def rank_key(seed: int, *columns: str) -> Column:
    """A reproducible random order: SHA-256 of the seed and the key."""
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *(F.col(c).cast("string") for c in columns)), 256)


def stratified_split(rows: DataFrame, strata: list[str], key: str, share: float = 0.9, seed: int = 42) -> DataFrame:
    """Adds ``split``: of each stratum, in reproducible random order, the first int(n * share) are train, the others eval."""
    w = Window.partitionBy(*strata)
    ranked = rows.withColumns({"_n": F.count("*").over(w), "_r": F.row_number().over(w.orderBy(rank_key(seed, key), key))})
    return ranked.withColumn("split", F.when(F.col("_r") <= F.floor(F.col("_n") * F.lit(share)), "train").otherwise("eval")).drop("_n", "_r")


def large_split(spark: SparkSession, rows: DataFrame, strata: list[str], key: str, share: float = 0.9, seed: int = 42, cells: int = 4096) -> DataFrame:
    """As ``stratified_split`` for strata too large for a task: ranks come from counts of hash cells, and only the cell
    that a stratum's cut falls in is sorted."""
    h = rank_key(seed, key)
    rows = rows.withColumns({"_h": h, "_cell": F.floor(F.conv(F.substring(h, 1, 8), 16, 10).cast("long") * cells / F.lit(1 << 32))})
    per = rows.groupBy(*strata, "_cell").count()
    w = Window.partitionBy(*strata)
    per = per.withColumns({"_n": F.sum("count").over(w), "_upto": F.sum("count").over(w.orderBy("_cell"))})
    per = per.withColumn("_train", F.floor(F.col("_n") * F.lit(share))).withColumn("_before", F.col("_upto") - F.col("count"))
    joined = rows.join(per.select(*strata, "_cell", "_upto", "_before", "_train"), [*strata, "_cell"])
    cut = (F.col("_before") < F.col("_train")) & (F.col("_train") < F.col("_upto"))
    whole = joined.where(~cut).withColumn("split", F.when(F.col("_upto") <= F.col("_train"), "train").otherwise("eval"))
    inside = Window.partitionBy(*strata, "_cell").orderBy("_h", key)
    part = joined.where(cut).withColumn("split", F.when(F.col("_before") + F.row_number().over(inside) <= F.col("_train"), "train").otherwise("eval"))
    return whole.unionByName(part).drop("_h", "_cell", "_upto", "_before", "_train")


def scenarios(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, n, w) for i, (n, w) in enumerate(fixed.SCENARIOS.items())], "ordinal int, scenario string, weight double")


def quota(spark: SparkSession, count: int, existing: DataFrame, only: list[str] | None = None) -> DataFrame:
    """How many of each scenario to make: rounded shares of ``count`` less what exists; the last takes the rest.
    With a list of scenarios the count is divided evenly, the remainder to the first ones."""
    dim = scenarios(spark)
    if only is not None:
        dim = dim.where(F.col("scenario").isin(only))
        n = dim.count()
        target = F.lit(count // n) + (F.row_number().over(Window.orderBy("ordinal")) <= count % n).cast("int")
        dim = dim.withColumn("target", target.cast("long"))
    else:
        last = len(fixed.SCENARIOS) - 1
        dim = dim.withColumn("rounded", F.rint(F.lit(count) * F.col("weight")).cast("long"))
        others = F.sum(F.when(F.col("ordinal") < last, F.col("rounded"))).over(Window.partitionBy(F.lit(1)))
        dim = dim.withColumn("target", F.when(F.col("ordinal") == last, F.lit(count) - others).otherwise(F.col("rounded")))
    got = existing.groupBy("scenario").agg(F.count("*").alias("existing"))
    rows = dim.join(F.broadcast(got), "scenario", "left").withColumn("existing", F.coalesce("existing", F.lit(0)).cast("long"))
    return rows.select("scenario", "ordinal", "target", "existing", F.greatest(F.lit(0).cast("long"), F.col("target") - F.col("existing")).alias("to_make"))


def work(quotas: DataFrame, languages: DataFrame) -> DataFrame:
    """A row for each conversation to make, in each language: language, scenario, number."""
    return quotas.where("to_make > 0").crossJoin(F.broadcast(languages)).select("language", "scenario", F.explode(F.sequence(F.lit(1).cast("long"), F.col("to_make"))).alias("number"))


def before(rows: DataFrame, by: list[str], order: str, sums: dict[str, Column], cells: int | None = None) -> DataFrame:
    """Adds, for each of ``sums``, the sum over the rows of the same group that come before by the numeric ``order``.

    A group may hold a large share of all rows, so no task gets a whole one: ``order`` is cut into ranges of about
    equal numbers of rows, sums of (group, range) are carried on over the ranges, and what is sorted together is one
    range of one group. Rows with equal ``order`` come in any order among themselves; null comes first.
    """
    n = cells or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marks = [i / n for i in range(1, n)]
    cuts = sorted({float(x) for x in rows.stat.approxQuantile(order, marks, 0.2 / n)}) if marks else []  # n - 1 numbers at most
    keyed = rows.withColumns({f"_x_{k}": v.cast("long") for k, v in sums.items()} | {"_cell": F.when(F.col(order).isNull(), -1).otherwise(cuts_below(cuts, F.col(order).cast("double")))})
    per = keyed.groupBy(*by, "_cell").agg(*(F.sum(f"_x_{k}").alias(f"_s_{k}") for k in sums))
    over = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*(F.col(b).alias(f"_b_{b}") for b in by), F.col("_cell").alias("_c"), *(F.coalesce(F.sum(f"_s_{k}").over(over), F.lit(0)).alias(f"_s_{k}") for k in sums))
    same = (F.col("_cell") == F.col("_c")) & functools.reduce(Column.__and__, (F.col(b).eqNullSafe(F.col(f"_b_{b}")) for b in by), F.lit(True))
    here = Window.partitionBy(*by, "_cell").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    joined = keyed.join(per, same)
    return joined.select(*rows.columns, *((F.col(f"_s_{k}") + F.coalesce(F.sum(f"_x_{k}").over(here), F.lit(0))).alias(k) for k in sums))


def rotate(rows: DataFrame, by: list[str], order: str, n: int, name: str) -> DataFrame:
    """Adds the ordinal within each group modulo n."""
    return before(rows, by, order, {"_ordinal": F.lit(1)}).withColumn(name, (F.col("_ordinal") % n).cast("int")).drop("_ordinal")


def length_bias(rows: DataFrame, by: list[str], order: str, turns: str, short: int = 5) -> DataFrame:
    """Adds ``bias``: what length the next conversation should have, from the share of short ones so far."""
    rows = before(rows, by, order, {"short_before": F.coalesce((F.col(turns) <= short).cast("long"), F.lit(0)), "seen_before": F.lit(1)})
    share = F.col("short_before") / F.col("seen_before")
    return rows.withColumn("bias", F.when(F.col("seen_before") < 3, "none").when(share > 0.6, "long").when(share < 0.4, "short").otherwise("balanced"))


def sample(rows: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows at random, the same ones each time; all if there are no more."""
    return rows.orderBy(rank_key(seed, key), key).limit(n)


def usage_extremes(counts: DataFrame, names: DataFrame, most_over: int = 8, most_under: int = 12) -> DataFrame:
    """Overused ids (at least 4 % of all uses) and hardly used ones (at most 1), the first few of each, and only if
    there are two: kind, id, name, uses. ``counts(id, uses)``, ``names(id, name)`` with the ids to look at."""
    # one total row and at most a few result rows: the rest stays distributed
    total = counts.agg(F.coalesce(F.sum("uses"), F.lit(0)).alias("n"))
    rows = names.join(counts, "id", "left").withColumn("uses", F.coalesce("uses", F.lit(0)).cast("long")).crossJoin(F.broadcast(total))
    threshold = F.greatest(F.lit(1).cast("long"), F.floor(F.greatest(F.lit(1).cast("long"), F.col("n")) * F.lit(0.04)))
    over = rows.where(F.col("uses") >= threshold).orderBy(F.desc("uses"), "id").limit(most_over).withColumn("kind", F.lit("avoid"))
    under = rows.where("uses <= 1").orderBy("id").limit(most_under).withColumn("kind", F.lit("prefer"))
    both = over.unionByName(under).withColumn("of_kind", F.count("*").over(Window.partitionBy("kind")))
    return both.where("of_kind >= 2").select("kind", "id", "name", "uses")


def usage_counts(items: DataFrame) -> DataFrame:
    """How often each food id is added, each conversation counting once: id, uses."""
    return items.select("conv_id", "id").distinct().groupBy("id").agg(F.count("*").alias("uses"))


def with_samples(rows: DataFrame, by: list[str], good: str, key: str, most: int = 5) -> DataFrame:
    """Counts of rows that are valid and not, and the first few keys of those that aren't: by, valid, invalid, samples.

    The rank's limit is applied in each task before the shuffle, so a group of any size gives a few rows a task.
    """
    counts = rows.groupBy(*by).agg(F.count_if(F.col(good)).alias("valid"), F.count_if(~F.col(good)).alias("invalid"))
    ranked = rows.where(~F.col(good)).select(*by, key).withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(key))).where(F.col("_r") <= most)
    some = ranked.groupBy(*by).agg(F.array_sort(F.collect_list(key)).alias("samples"))
    return counts.join(some, by, "left").withColumn("samples", F.coalesce("samples", F.array().cast(some.schema["samples"].dataType)))
