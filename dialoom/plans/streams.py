"""Replays of streams: admission, deduplication, windows, sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom import folders
from dialoom.plans.tables import table
from dialoom.streaming import streams


def _folder(spark: SparkSession) -> str:
    return folders.own(spark, "stream")


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_of(spark, sf_dir, "events")


def stream_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's rows as they would arrive: the table read as a stream of files."""
    path = f"{sf_dir}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(schema)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def rate_limit_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which requests of a user stay within limits over the hour before them."""
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", F.floor("value").cast("long").alias("tokens"))
    return streams.admitted(streams.usage(rows, ["user_id"], 36_000), 3, 60).select("event_id", "in_window", "tokens_in_window", "admitted")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of events of each user, once each, as a stream."""
    rows = _stream(spark, sf_dir).select("user_id", "event_type")
    return streams.to_table(streams.once(rows, ["user_id", "event_type"]), spark, _folder(spark))


def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each kind in tumbling days, as a stream that updates its result."""
    rows = _stream(spark, sf_dir).select("ts", "event_type", F.floor("value").cast("long").alias("tokens"))
    counted = rows.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens"))
    counted = counted.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n", "tokens")
    return streams.to_table(counted, spark, _folder(spark), "complete")


def stream_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each kind in tumbling hours that the watermark has closed, each given off once."""
    rows = _stream(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("ts"), "event_type", F.floor("value").cast("long").alias("tokens"))
    got = streams.to_table(streams.windowed(rows, ["event_type"]), spark, _folder(spark))
    return got.select(F.date_format("start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n", "tokens")


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends what isn't there yet, twice: the second time nothing is new."""
    folder = _folder(spark)
    for run in ("a", "b"):
        rows = _stream(spark, sf_dir).select("user_id", "event_type")
        streams.append_new(rows, f"{folder}/out", ["user_id", "event_type"], f"{folder}/{run}").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def session_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is known of each user after all events, kept as state."""
    rows = streams.sessions(_stream(spark, sf_dir).select("user_id", "event_id", "ts", "event_type", "value"))
    folder = _folder(spark)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("append").parquet(f"{folder}/out")

    rows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    last = spark.read.parquet(f"{folder}/out").groupBy("user_id").agg(F.max(F.struct("events", "total", "last_type")).alias("s"))
    return last.select("user_id", "s.events", F.round("s.total", 4).alias("total"), "s.last_type")


QUERIES = {f.__name__: f for f in (rate_limit_window, stream_dedup, stream_windows, stream_watermark, stream_resume, session_state)}

ORACLE_SQL = {
    "rate_limit_window": """
        WITH r AS (SELECT event_id, user_id, epoch_us(ts) AS t, CAST(floor(value) AS BIGINT) AS tokens FROM events),
        w AS (SELECT event_id, count(*) OVER h AS in_window, CAST(sum(tokens) OVER h AS BIGINT) AS tokens_in_window FROM r WINDOW h AS (PARTITION BY user_id ORDER BY t RANGE BETWEEN 36000000000 PRECEDING AND CURRENT ROW))
        SELECT *, in_window <= 3 AND tokens_in_window <= 60 AS admitted FROM w""",
    "stream_dedup": "SELECT DISTINCT user_id, event_type FROM events",
    "stream_windows": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS tokens FROM events GROUP BY ALL",
    "stream_watermark": """
        WITH r AS (SELECT date_trunc('hour', ts) AS h, event_type, count(*) AS n, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS tokens FROM events GROUP BY ALL)
        SELECT strftime(h, '%Y-%m-%d %H') AS hour, event_type, n, tokens FROM r WHERE h + INTERVAL 1 HOUR <= date_trunc('milliseconds', (SELECT max(ts) FROM events)) - INTERVAL 10 MINUTE""",
    "stream_resume": "SELECT DISTINCT user_id, event_type FROM events",
    "session_state": "SELECT user_id, count(*) AS events, round(sum(value), 4) AS total, arg_max(event_type, (ts, event_id)) AS last_type FROM events GROUP BY user_id",
}
