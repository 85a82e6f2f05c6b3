"""Sinks: appended conversations, rendered splits, staged rewrites, reports."""

from __future__ import annotations

import logging
import logging.handlers
import os
import sys
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append(conversations: DataFrame, path: str) -> None:
    """Append accepted conversations, a folder for each language."""
    conversations.write.mode("append").partitionBy("language").json(path)


def splits(rendered: DataFrame, path: str) -> None:
    """Rendered examples ``(model_type, split, text)`` as JSON lines in a folder for each model and split."""
    rendered.select("model_type", "split", "text").write.mode("overwrite").partitionBy("model_type", "split").json(path)


def migrated(df: DataFrame, path: str) -> None:
    """A migrated copy beside the source."""
    df.write.mode("overwrite").option("ignoreNullFields", True).json(path)


def rewrite(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Replace the table that ``df`` reads: written beside it, then swapped by renaming, never read while overwritten."""
    sc = spark.sparkContext
    new, old = (f"{path.rstrip('/')}.{k}-{uuid.uuid4().hex[:8]}" for k in ("new", "old"))
    df.write.option("ignoreNullFields", True).json(new)
    at = sc._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(sc._jsc.hadoopConfiguration())
    if fs.exists(at(path)) and not fs.rename(at(path), at(old)):
        raise OSError(f"{path} can't be renamed")
    if not fs.rename(at(new), at(path)):
        fs.rename(at(old), at(path))
        raise OSError(f"{new} can't be renamed")
    fs.delete(at(old), True)


def table(df: DataFrame, order: list[str] | None = None) -> list[str]:
    """A small aggregate as the lines of a Markdown table."""
    rows = (df.orderBy(*order) if order else df).collect()
    head = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return head + ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows]


def report(sections: list[tuple[str, list[str]]], path: str, spark: SparkSession) -> str:
    """A Markdown report of titled sections, written as one text file; returns its text."""
    text = "\n".join(["# Dataset report", *(line for title, body in sections for line in ("", f"## {title}", "", *body))]) + "\n"
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return text


def with_settings(df: DataFrame, index: str = "user_settings_idx") -> DataFrame:
    """The column of assigned settings, 0 where none is."""
    return df.withColumn(index, F.coalesce(F.col(index), F.lit(0)))


#: Bytes after which a log file is begun anew, and days that old ones are kept.
LOG_BYTES, LOG_DAYS = 10_000_000, 7


def logger(path: str | None = None, verbose: bool = False, trace: bool = False) -> logging.Logger:
    """The driver's log: on the console, and in a file whose lines read as ``operators.logs`` takes them."""
    out = logging.getLogger("dialoom")
    for h in list(out.handlers):
        out.removeHandler(h)
        h.close()
    out.setLevel(1 if trace else logging.DEBUG)
    out.propagate = False
    console = logging.StreamHandler(sys.stderr)
    console.setLevel(logging.DEBUG if verbose else logging.INFO)
    console.setFormatter(logging.Formatter("%(asctime)s.%(msecs)03d | %(levelname)-8s | %(message)s", "%H:%M:%S"))
    out.addHandler(console)
    if path:
        folder = os.path.dirname(path) or "."
        os.makedirs(folder, exist_ok=True)
        for name in os.listdir(folder):
            old = os.path.join(folder, name)
            if name.startswith(os.path.basename(path) + ".") and os.path.getmtime(old) < time.time() - LOG_DAYS * 86_400:
                os.remove(old)
        file = logging.handlers.RotatingFileHandler(path, maxBytes=LOG_BYTES, backupCount=1000, encoding="utf-8")
        file.setFormatter(logging.Formatter("%(asctime)s.%(msecs)03d | %(levelname)-8s | %(name)s:%(funcName)s:%(lineno)d | %(message)s", "%Y-%m-%d %H:%M:%S"))
        out.addHandler(file)
    return out
