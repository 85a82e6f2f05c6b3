"""Streams: admission by sliding windows, deduplication, resumable appends, sessions with state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.window import Window

from dialoom.functions import fixed


def usage(requests: DataFrame, by: list[str], seconds: int = 60) -> DataFrame:
    """Requests ``(ts, tokens)`` with what was asked in the window up to and including each: in_window, tokens_in_window."""
    zoned = dict(requests.dtypes)["ts"] == "timestamp"
    micros = F.unix_micros("ts") if zoned else F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    w = Window.partitionBy(*by).orderBy(micros).rangeBetween(-seconds * 1_000_000, Window.currentRow)
    return requests.withColumns({"in_window": F.count("*").over(w), "tokens_in_window": F.sum("tokens").over(w)})


def admitted(used: DataFrame, requests: int = fixed.ADMITTED_REQUESTS, tokens: int = fixed.ADMITTED_TOKENS) -> DataFrame:
    """Adds whether a request stays within both limits."""
    return used.withColumn("admitted", (F.col("in_window") <= requests) & (F.col("tokens_in_window") <= tokens))


def windowed(stream: DataFrame, by: list[str], late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Counts and sums of tumbling windows over event time; rows later than the watermark are left out."""
    rows = stream.withWatermark("ts", late).groupBy(F.window("ts", size), *by).agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens"))
    return rows.select(F.col("window.start").alias("start"), *by, "n", "tokens")


def once(stream: DataFrame, keys: list[str], late: str | None = None) -> DataFrame:
    """The first row of each key; with a watermark, state older than it is dropped."""
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys) if late else stream.dropDuplicates(keys)


def append_new(stream: DataFrame, path: str, keys: list[str], checkpoint: str):
    """Appends to the table at ``path`` what it doesn't have yet, batch by batch, each batch at most once: a batch that is
    repeated after a failure finds its rows there. Returns the query."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        jvm, sc = spark.sparkContext._jvm, spark.sparkContext._jsc
        at = jvm.org.apache.hadoop.fs.Path(path)
        new = batch.dropDuplicates(keys)
        if at.getFileSystem(sc.hadoopConfiguration()).exists(at):
            new = new.join(spark.read.parquet(path).select(keys), keys, "left_anti")
        new.write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def to_table(stream: DataFrame, spark: SparkSession, folder: str, mode: str = "append") -> DataFrame:
    """Run a stream over all that is available now, and read what it wrote."""
    if mode == "append":
        query = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    else:

        def write(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{folder}/out")

        query = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


SESSION = "user_id long, events long, total double, last_type string"


def _session(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    n, total, last, at = state.get if state.exists else (0, 0.0, None, None)
    for p in parts:
        for ts, i, kind, value in sorted(zip(p["ts"], p["event_id"], p["event_type"], p["value"], strict=True), key=lambda r: (r[0], r[1])):
            n, total = n + 1, total + (0.0 if value is None or value != value else float(value))
            mark = f"{ts.isoformat()}|{int(i):020d}"
            if at is None or mark >= at:
                last, at = kind, mark
    state.update((n, total, last, at))
    yield pd.DataFrame({"user_id": [key[0]], "events": [n], "total": [total], "last_type": [last]})


def sessions(stream: DataFrame) -> DataFrame:
    """State of each user's session after each batch: events, total value, last type. ``stream(user_id, event_id, ts, event_type, value)``."""
    return stream.groupBy("user_id").applyInPandasWithState(_session, SESSION, "n long, total double, last string, at string", "update", GroupStateTimeout.NoTimeout)


class _Transcript(StatefulProcessor):
    """Keeps the text of a session; what is said is added in order, and a message without a piece begins it anew."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.text = handle.getValueState("text", T.StructType([T.StructField("text", T.StringType())]))

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        text = self.text.get()[0] if self.text.exists() else None
        for r in sorted(rows, key=lambda r: r["seq"]):
            text = r["prefix"] if r["piece"] is None else (r["prefix"] if text is None else text) + r["piece"]
        self.text.update((text,))
        yield Row(session=key[0], text=text)

    def close(self) -> None:
        pass


#: The state store that transcripts need.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def transcripts(stream: DataFrame) -> DataFrame:
    """Each session's text after each batch: session, text. ``stream(session, seq, prefix, piece)``: a null piece clears."""
    return stream.groupBy("session").transformWithState(_Transcript(), "session long, text string", "Update", "None")
