"""Sharding along a Hilbert curve.

Metadata (language, source, size, id) is quantised to a few bits each, and the cell's index on a Hilbert
curve orders the documents, so that a run of the order is compact in every dimension: a reader that filters
by any of them skips most shards by their least and largest values. Equal texts are a group: the group takes
the least curve index of its members and stays together, so that at most a cut goes through it. Runs are cut
by rows: shards differ by one row at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from dialoom.llm.shared import Scratch, partitions

#: Bits of each dimension, and values of a category that get a cell of their own.
BITS = 5
OWN = (1 << BITS) - 1


def curve_index(axes: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of points, one in each row, with coordinates below 2**bits (Skilling's transform)."""
    x = [a.astype(np.int64).copy() for a in axes.T]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            x[i] = x[i] ^ t if i else np.where(high, x[0], x[0])
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = out << 1 | ((x[i] ^ t) >> b & 1)
    return out


@F.pandas_udf(LongType())
def _curve(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for axes in parts:
        yield pd.Series(curve_index(np.stack([a.to_numpy() for a in axes], axis=1), BITS))


def _category(docs: DataFrame, column: str) -> Column:
    """The rank by name of the most frequent values (as many as have a cell); the last cell for all others and null."""
    top = docs.where(F.col(column).isNotNull()).groupBy(column).count().orderBy(F.desc("count"), column).limit(OWN).collect()
    names = sorted(r[column] for r in top)
    if not names:
        return F.lit(OWN)
    return F.coalesce(F.create_map(*(F.lit(x) for i, v in enumerate(names) for x in (v, i * OWN // len(names))))[F.col(column)], F.lit(OWN))


def shards(spark: SparkSession, docs: DataFrame, number: int = 40) -> DataFrame:
    """One row per row of ``docs(doc_id, text, lang, source)``: doc_id, size, text_crc32, law, shard, slot,
    grown_shard, curve, lang, source.

    Null text has size 16 and checksum 0. Null ids, languages and sources have cells of their own; ties are
    ordered by id, equal rows in any order. With fewer rows than shards, the last shards are empty; an empty
    table gives no rows. Other columns of ``docs`` are ignored.
    """
    scratch = Scratch(spark, "hilbert")
    raw = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    span = raw.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).first()
    low, high = span["a"] or 0, span["b"] or 0
    cell = F.coalesce(F.floor((F.col("doc_id") - F.lit(low)).cast("double") / F.lit(float(high - low + 1)) * (OWN + 1)).cast("int"), F.lit(0))
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = raw.select(
        "doc_id",
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.xxhash64(body).alias("text_hash"),
        _category(raw, "lang").alias("x0"),
        _category(raw, "source").alias("x1"),
        cell.alias("x3"),
        "lang",
        "source",
    )
    rows = rows.withColumn("x2", F.least(F.lit(OWN), F.floor(F.log2("size") * 1.5).cast("int")))
    rows = scratch.save(rows.withColumn("curve", _curve("x0", "x1", "x2", "x3")).drop("x0", "x1", "x2", "x3"), "rows")
    # only groups of several rows can move; written, so that the join may split a large group's partition
    groups = rows.groupBy("text_hash").agg(F.min("curve").alias("at"), F.count("*").alias("copies")).where("copies > 1").select("text_hash", "at")
    groups = scratch.save(groups, "groups")
    placed = rows.join(groups, "text_hash", "left").withColumn("at", F.coalesce("at", "curve"))
    placed = placed.repartitionByRange(partitions(spark), "at", "text_hash", "doc_id").sortWithinPartitions("at", "text_hash", "doc_id")
    placed = scratch.save(placed.withColumn("m", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("m", 33).cast("int")
    counts = sorted((r["part"], r["n"]) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())  # a row for each partition
    total = sum(n for _, n in counts)
    scratch.drop("rows", "groups")
    sizes = dict(counts)
    before = [0]
    for p in range(max(sizes, default=0)):
        before.append(before[-1] + sizes.get(p, 0))
    first = F.element_at(F.array(*map(F.lit, before)), part + 1)
    at = first.cast("long") + F.col("m").bitwiseAND(F.lit((1 << 33) - 1))
    small, extra = divmod(total, number)
    cut = extra * (small + 1)
    shard = F.when(F.col("pos") < cut, F.floor(F.col("pos") / F.lit(small + 1))).otherwise(F.floor((F.col("pos") - cut) / F.lit(max(small, 1))) + extra)
    slot = F.when(F.col("pos") < cut, F.col("pos") % (small + 1)).otherwise((F.col("pos") - cut) % max(small, 1))
    return placed.withColumn("pos", at).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.cast("int").alias("shard"), slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("at").alias("curve"), "lang", "source"
    )


def statistics(placed: DataFrame) -> DataFrame:
    """Least and largest values of each shard of ``shards``' result, by which a reader skips shards; nulls have none."""
    ends = [f(c).alias(f"{n}_{c}") for c in ("doc_id", "lang", "source", "size") for n, f in (("least", F.min), ("largest", F.max))]
    return placed.groupBy("shard").agg(F.count("*").alias("rows"), *ends)


def pruned(stats: DataFrame, **equal) -> DataFrame:
    """How many shards a reader of rows with given values has to open, and how many there are: opened, shards."""
    fits = F.lit(True)
    for column, value in equal.items():
        fits = fits & F.coalesce(F.lit(value).between(F.col(f"least_{column}"), F.col(f"largest_{column}")), F.lit(False))
    return stats.agg(F.count_if(fits).alias("opened"), F.count("*").alias("shards"))
