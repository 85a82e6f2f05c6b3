"""The folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only where the driver is the executor as well.
LOCAL_DIR = "/tmp/dialoom-shared"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; without one a folder of our own on a local master, else an error."""
    conf = spark.sparkContext.getConf()
    found = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    master = conf.get("spark.master", "")
    if master.startswith("local") and not master.startswith("local-cluster"):
        return LOCAL_DIR
    raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, whatever store it is in; does nothing if it can't."""
    with contextlib.suppress(Exception):
        sc = spark.sparkContext
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def own(spark: SparkSession, tag: str) -> str:
    """A new folder's path below the shared one, removed when the driver's interpreter ends."""
    path = f"{shared_dir(spark)}/dialoom-{tag}-{uuid.uuid4().hex[:12]}"
    atexit.register(remove, spark, path)
    return path


def saved(rows: DataFrame, tag: str) -> DataFrame:
    """The rows written below the shared folder and read again, which cuts their lineage."""
    path = own(rows.sparkSession, tag)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
