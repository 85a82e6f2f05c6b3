"""Corpus profiles: lengths, strata, distributions and percentiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions import fixed
from dialoom.functions.exact import tokens_estimate
from dialoom.operators import stats
from dialoom.plans.tables import table

LANGUAGES = ["de", "en", "es", "fr"]


def conv_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns per conversation and estimated tokens (characters // 4) of whole conversations, turns joined by a space."""
    turns = table(spark, sf_dir, "conversations")
    per = turns.groupBy("conv_id").agg(F.count("*").alias("turns"), F.floor((F.sum(F.length(F.coalesce("text", F.lit("")))) + F.count("*") - 1) / 4).alias("est"))
    sizes = per.agg(F.count("*").alias("conversations"), F.avg("turns").alias("avg_turns"))
    lengths = stats.length_summary(per, F.col("est"), [("median_tokens", 0.5)])
    return sizes.crossJoin(lengths).select("conversations", "avg_turns", F.col("least").alias("min_tokens"), F.col("largest").alias("max_tokens"), "median_tokens", F.col("mean").alias("avg_tokens"))


def user_turn_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimated tokens of user turns with content."""
    turns = table(spark, sf_dir, "conversations").where("role = 'user' AND text <> ''")
    rows = stats.length_summary(turns, tokens_estimate(F.col("text")), [("median_tokens", 0.5)])
    return rows.select("n", F.col("mean").alias("avg_tokens"), F.col("least").alias("min_tokens"), F.col("largest").alias("max_tokens"), "median_tokens")


def token_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length percentiles of documents and the percentage over a limit."""
    docs = table(spark, sf_dir, "documents")
    marks = [("p50", 0.5), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99), ("p999", 0.999)]
    return stats.length_summary(docs, tokens_estimate(F.col("text")), marks, 1024).withColumnRenamed("largest", "longest").drop("least")


def strata_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by source and language."""
    return stats.pivot(table(spark, sf_dir, "documents"), "source", "lang", LANGUAGES)


def strata_vs_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of scenarios (dealt by id) against their targets, scenarios without rows included."""
    names = F.array(*map(F.lit, fixed.SCENARIOS))
    rows = table(spark, sf_dir, "documents").select(F.element_at(names, (F.pmod("doc_id", F.lit(11)) + 1).cast("int")).alias("scenario"))
    per = rows.groupBy("scenario").agg(F.count("*").alias("n"))
    dim = spark.createDataFrame(list(fixed.SCENARIOS.items()), "scenario string, target double")
    both = dim.join(per, "scenario", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    total = per.agg(F.sum("n").alias("of"))
    return both.crossJoin(F.broadcast(total)).select("scenario", (F.col("target") * 100).alias("target_percent"), "n", (F.col("n") * 100.0 / F.col("of")).alias("percent"))


def corpus_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").agg(F.count("*").alias("documents"), F.count_distinct("lang").alias("languages"), F.count_distinct("source").alias("sources"))


def lang_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.shares(table(spark, sf_dir, "documents"), "lang")


QUERIES = {f.__name__: f for f in (conv_stats, user_turn_stats, token_percentiles, strata_pivot, strata_vs_target, corpus_counts, lang_distribution)}


def _at(q: float, values: str = "est") -> str:
    return f"list_sort(list({values}))[CAST(floor(count(*) * {q}::DOUBLE) AS BIGINT) + 1]"


_SCENARIOS = ", ".join(f"('{s}', {w}::DOUBLE)" for s, w in fixed.SCENARIOS.items())
_NAMES = ", ".join(f"'{s}'" for s in fixed.SCENARIOS)

ORACLE_SQL = {
    "conv_stats": f"""
        WITH per AS (SELECT conv_id, count(*) AS turns, CAST(floor((sum(length(coalesce(text, ''))) + count(*) - 1) / 4.0) AS BIGINT) AS est FROM conversations GROUP BY conv_id)
        SELECT count(*) AS conversations, avg(turns) AS avg_turns, min(est) AS min_tokens, max(est) AS max_tokens, {_at(0.5)} AS median_tokens, avg(est) AS avg_tokens FROM per""",
    "user_turn_stats": f"""
        WITH per AS (SELECT length(text) // 4 AS est FROM conversations WHERE role = 'user' AND text <> '')
        SELECT count(*) AS n, avg(est) AS avg_tokens, min(est) AS min_tokens, max(est) AS max_tokens, {_at(0.5)} AS median_tokens FROM per""",
    "token_percentiles": f"""
        WITH per AS (SELECT length(coalesce(text, '')) // 4 AS est FROM documents)
        SELECT count(*) AS n, avg(est) AS mean, max(est) AS longest, {_at(0.5)} AS p50, {_at(0.9)} AS p90, {_at(0.95)} AS p95, {_at(0.99)} AS p99, {_at(0.999)} AS p999,
               count(*) FILTER (est > 1024)::DOUBLE / count(*) * 100 AS percent_over FROM per""",
    "strata_pivot": "SELECT source, " + ", ".join(f"count(*) FILTER (lang = '{x}') AS {x}" for x in LANGUAGES) + ", count(*) AS total FROM documents GROUP BY source",
    "strata_vs_target": f"""
        WITH d(scenario, target) AS (VALUES {_SCENARIOS}), r AS (SELECT list_value({_NAMES})[CAST(doc_id % 11 AS BIGINT) + 1] AS scenario FROM documents), c AS (SELECT scenario, count(*) AS n FROM r GROUP BY scenario)
        SELECT d.scenario, target * 100 AS target_percent, coalesce(n, 0) AS n, coalesce(n, 0) * 100.0::DOUBLE / (SELECT count(*) FROM r) AS percent FROM d LEFT JOIN c USING (scenario)""",
    "corpus_counts": "SELECT count(*) AS documents, count(DISTINCT lang) AS languages, count(DISTINCT source) AS sources FROM documents",
    "lang_distribution": "SELECT lang, count(*) AS n, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM documents) AS percent FROM documents GROUP BY lang",
}
