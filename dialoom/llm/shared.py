"""Shared folder handling, query-independent helpers and connected components."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom import folders

#: Bytes of a Parquet row group, which a writer holds in memory.
GROUP_BYTES = 16 << 20


class Scratch:
    """Intermediate tables of one query, written as Parquet below the shared folder.

    A written table cuts lineage and survives lost executors. Tables that the result reads stay until
    the driver's interpreter ends; ``drop`` removes the others early.
    """

    def __init__(self, spark: SparkSession, tag: str):
        self.spark = spark
        self.root = folders.own(spark, tag)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").option("parquet.block.size", GROUP_BYTES).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def load(self, name: str, like: DataFrame) -> DataFrame:
        """A table saved before, with the columns of another."""
        return self.spark.read.schema(like.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            folders.remove(self.spark, self.path(name))

    def reclaim(self) -> None:
        """Have the shuffles of jobs that are over cleaned, whose files stay until the driver collects its garbage."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    """Partitions of a shuffle dealt out by key, as the session sets them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32 of the id's decimal text leaves 1 when divided by 3; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def components(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(id, comp)``; comp is the smallest id reachable.

    Each round, every node joins its neighbour that is smallest under an order drawn anew, and the
    graph is contracted: the node that is smallest of all vanishes into no other, while its neighbours do, so each
    round takes at least a node away from every component and the rounds end; on average they take a constant share.
    Minima are aggregated before shuffling, so a node with very many neighbours is no burden.
    """
    e = scratch.save(edges.select("a", "b").where("a <> b").distinct(), f"{name}-e0")
    nodes = e.select(F.col("a").alias("id")).union(e.select("b"))
    labels = scratch.save(nodes.distinct().withColumn("lab", F.col("id")), f"{name}-l0")
    r = 0
    while not e.isEmpty():
        r += 1
        both = e.union(e.select("b", "a"))
        rank = F.struct(F.xxhash64(F.col("b"), F.lit(r)).alias("h"), F.col("b").alias("v"))
        own = F.struct(F.xxhash64(F.col("a"), F.lit(r)).alias("h"), F.col("a").alias("v"))
        to = both.groupBy("a").agg(F.min(rank).alias("m")).select("a", F.least("m", own)["v"].alias("to"))
        to = scratch.save(to, f"{name}-m{r}")
        left = e.join(to, "a").select(F.col("to").alias("x"), "b")
        right = to.select(F.col("a").alias("b"), F.col("to").alias("y"))
        e2 = left.join(right, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        e2 = scratch.save(e2, f"{name}-e{r}")
        moved = labels.join(to.select(F.col("a").alias("lab"), "to"), "lab", "left").select("id", F.coalesce("to", "lab").alias("lab"))
        labels = scratch.save(moved, f"{name}-l{r}")
        scratch.drop(f"{name}-e{r - 1}", f"{name}-l{r - 1}", f"{name}-m{r}")
        e = e2
    least = labels.groupBy("lab").agg(F.min("id").alias("comp"))
    return scratch.save(labels.join(least, "lab").select("id", "comp"), f"{name}-out")
