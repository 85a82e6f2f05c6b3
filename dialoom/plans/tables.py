"""The driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def put(spark: SparkSession, path: str, text: str) -> str:
    """Write a small text file to whatever store a path is in; returns the path."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(sc._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(text.encode()))
    out.close()
    return path


def one_file(lines: DataFrame, path: str) -> str:
    """Write ordered lines as a single text file; returns its path."""
    spark = lines.sparkSession
    lines.coalesce(1).write.mode("overwrite").text(f"{path}.parts")
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(sc._jsc.hadoopConfiguration())
    part = next(f.getPath() for f in fs.listStatus(at(f"{path}.parts")) if f.getPath().getName().startswith("part-"))
    fs.rename(part, at(path))
    fs.delete(at(f"{path}.parts"), True)
    return path


def view(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)
