"""Evaluation, settings audits and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions import fixed
from dialoom.operators import audit, logs, scoring
from dialoom.operators.harness import settings
from dialoom.plans.scalar import POOL_SQL
from dialoom.plans.tables import table


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels against a rule that predicts quality by length."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", (F.col("n_chars") > 600).cast("int").alias("said"))
    return table(spark, sf_dir, "labels").join(docs, "doc_id")


def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-averaged shares of right answers for each source, 0 where there is nothing to count."""
    rows = _scored(spark, sf_dir).groupBy("source").agg(
        F.count("*").alias("total"), F.count_if(F.col("quality") == F.col("said")).alias("right"), F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if((F.col("toxic") == 1) & (F.col("said") == 1)).alias("toxic_right")
    )
    return rows.select("source", scoring.ratio(F.col("right"), F.col("total")).alias("accuracy"), scoring.ratio(F.col("toxic_right"), F.col("toxic")).alias("toxic_recall"))


def weighted_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted scores of sources and whether they pass."""
    rows = eval_metrics(spark, sf_dir)
    total = scoring.weighted(F.col("accuracy"), F.col("toxic_recall"), F.lit(0.5))
    return rows.select("source", total.alias("score"), scoring.passes(total).alias("passes"))


def model_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best source, or the preferred one if it is nearly as good."""
    scores = weighted_score(spark, sf_dir).select(F.col("source").alias("model"), F.round(F.col("score") + 0.3, 6).alias("score"))
    return scoring.choose(scores, "src1")


def final_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results stated in texts, within a hundredth of those expected."""
    text = F.concat(F.lit('dose {"final_result" : '), F.format_string("%.1f", F.col("o_totalprice") / 100), F.lit('} or "final_result": 9'))
    got = scoring.final_result(F.when(F.col("o_orderkey") % 6 != 0, text).otherwise("none"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", got.alias("got"), (F.col("o_totalprice") / F.when(F.col("o_orderkey") % 4 == 0, 105).otherwise(100.5)).alias("want"))
    return rows.agg(F.count("got").alias("stated"), F.count_if(scoring.close(F.col("got"), F.col("want"))).alias("close"))


def settings_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by segment whose stated settings are verified, mismatched, unverifiable or inconsistent, with totals."""
    pool = settings(spark)
    idx = F.when((F.col("o_custkey") % 4 == 0) & (F.col("o_orderkey") % 3 == 0), F.col("o_orderkey") % 5).otherwise(F.col("o_custkey") % 5).cast("int")
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("conv_id"), idx.alias("idx")).join(F.broadcast(pool), "idx")
    results = rows.select("conv_id", "threshold", "baseline", "divisor", F.lit(None).cast("string").alias("meal_time"), F.lit(None).cast("int").alias("meal_divider"))
    inferred = audit.matching_settings(results, pool)
    stated = F.when(F.col("c_custkey") % 6 == 1, F.lit(None)).otherwise(F.col("c_custkey") % 5).cast("int")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("conv_id"), F.col("c_mktsegment").alias("file"), stated.alias("idx"))
    return audit.counts(audit.audit(customers, inferred))


#: Log lines made of events; Spark and the SQL twin read the same text.
LINE = """concat('12:00:0', CAST(event_id % 10 AS STRING), ' | ', CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'signup' THEN 'SUCCESS' ELSE 'WARNING' END, ' | gen:run:', CAST(event_id % 7 AS STRING), ' | [',
    CASE WHEN user_id % 3 = 0 THEN 'en' WHEN user_id % 3 = 1 THEN 'de' ELSE 'el' END, '] SCENARIO_', CAST(user_id % 4 AS STRING), ' -- ',
    CASE WHEN event_type = 'signup' THEN concat('Saved ', CAST(event_id % 50 AS STRING), '/800') WHEN event_type = 'error' THEN concat('FAIL: x -- Turn ', CAST(event_id % 9 AS STRING), ': number ', CAST(value AS STRING), ' in assistant text does not match any tool result or argument')
    WHEN event_type = 'click' THEN concat('retry ', CAST(event_id % 3 + 1 AS STRING), '/3: Validation errors: Too short: ~', CAST(event_id % 20 AS STRING), ' tokens; food_id ', CAST(user_id AS STRING), ' not in known IDs: {1, 2} (backoff 2s)')
    WHEN event_type = 'view' THEN concat('retry 1/3: Expecting value: line 1 column ', CAST(event_id % 30 AS STRING)) ELSE 'rate limit 429' END)"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(f"{LINE} AS value")


def error_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors by category and normalised text."""
    return logs.errors(logs.events(_lines(spark, sf_dir))).groupBy("category", "error").agg(F.count("*").alias("n"))


def most_common_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error classes and users' event kinds from the commonest on, of equally common ones that seen first."""
    rows = table(spark, sf_dir, "events").select((F.col("user_id") % 40).alias("u"), "event_type", "event_id")
    return logs.most_common(rows, ["u", "event_type"], "event_id")


def progress_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far events of each kind had come at every hundredth, their rate and the time that was left."""
    at = F.timestamp_diff("MICROSECOND", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts").cast("timestamp_ntz")) / 1e6
    done = table(spark, sf_dir, "events").select(F.col("event_type").alias("label"), at.alias("at"))
    totals = done.groupBy("label").agg((F.count("*") + 10).alias("total"))
    return logs.progress(done, totals, 100).withColumn("rate", F.round("rate", 6))


def retry_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retries and failures by scenario, language and depth."""
    return logs.counters(logs.events(_lines(spark, sf_dir)))


def saved_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many conversations were saved, and lines of each kind."""
    rows = _lines(spark, sf_dir)
    kinds = rows.agg(F.count_if(logs.is_success(F.col("value"))).alias("success"), F.count_if(logs.is_api_error(F.col("value"))).alias("api_errors"))
    return logs.saved(rows).crossJoin(kinds)


QUERIES = {f.__name__: f for f in (eval_metrics, weighted_score, model_choice, final_results, settings_audit, error_categories, most_common_errors, progress_rates, retry_counters, saved_total)}

_EVAL = """r AS (SELECT source, count(*) AS total, count(*) FILTER (quality = CAST(n_chars > 600 AS INTEGER)) AS good, count(*) FILTER (toxic = 1) AS toxic, count(*) FILTER (toxic = 1 AND n_chars > 600) AS tr
    FROM labels JOIN documents USING (doc_id) GROUP BY source), m AS (SELECT source, good::DOUBLE / total AS accuracy, coalesce(tr::DOUBLE / nullif(toxic, 0), 0) AS toxic_recall FROM r)"""
_W = {k: f"{v}::DOUBLE" for k, v in fixed.WEIGHTS.items()}
_SCORE = f"""s AS (SELECT source, accuracy * {_W["tool_calls"]} + toxic_recall * {_W["sequence"]} + 0.5::DOUBLE * {_W["clarification"]} + 3.5::DOUBLE / 5.0::DOUBLE * {_W["language"]}
    + 1.0::DOUBLE * {_W["latency"]} + 1.0::DOUBLE * {_W["memory"]} AS score FROM m)"""
_E = f"""e AS (SELECT {LINE} AS value, event_type AS kind, event_id, user_id, CAST(value AS STRING) AS v FROM events WHERE event_type IN ('error', 'click', 'view'))"""

ORACLE_SQL = {
    "eval_metrics": f"WITH {_EVAL} SELECT * FROM m",
    "weighted_score": f"WITH {_EVAL}, {_SCORE} SELECT source, score, score >= {fixed.PASS_SCORE}::DOUBLE AS passes FROM s",
    "model_choice": f"""
        WITH {_EVAL}, {_SCORE}, t AS (SELECT source, round(score + 0.3::DOUBLE, 6) AS score FROM s), b AS (SELECT max(score) AS top, arg_max(source, score) AS best, max(score) FILTER (source = 'src1') AS own FROM t)
        SELECT CASE WHEN own >= {fixed.PASS_SCORE}::DOUBLE AND top >= {fixed.PASS_SCORE}::DOUBLE AND top - own <= {fixed.TIE_MARGIN}::DOUBLE THEN 'src1' ELSE best END AS model FROM b""",
    "final_results": """
        WITH r AS (SELECT CASE WHEN o_orderkey % 6 <> 0 THEN CAST(printf('%.1f', o_totalprice / 100) AS DOUBLE) END AS got, o_totalprice / CASE WHEN o_orderkey % 4 = 0 THEN 105::DOUBLE ELSE 100.5::DOUBLE END AS want FROM orders)
        SELECT count(got) AS stated, count(*) FILTER (abs(got - want) <= 0.01::DOUBLE * greatest(abs(got), abs(want))) AS close FROM r""",
    "settings_audit": f"""
        WITH {POOL_SQL},
        o AS (SELECT o_custkey AS conv_id, CASE WHEN o_custkey % 4 = 0 AND o_orderkey % 3 = 0 THEN o_orderkey % 5 ELSE o_custkey % 5 END AS idx FROM orders),
        i AS (SELECT conv_id, count(*) AS n, CASE WHEN min(idx) = max(idx) THEN min(idx) END AS inferred FROM o GROUP BY 1),
        c AS (SELECT c_mktsegment AS file, CASE WHEN n IS NULL THEN 'unverifiable' WHEN inferred IS NULL THEN 'inconsistent' WHEN inferred = CASE WHEN c_custkey % 6 = 1 THEN 0 ELSE c_custkey % 5 END THEN 'verified' ELSE 'mismatched' END AS class
              FROM customer LEFT JOIN i ON conv_id = c_custkey)
        SELECT file, class, count(*) AS n FROM c GROUP BY ROLLUP (class, file) HAVING class IS NOT NULL""",
    "error_categories": f"""
        WITH {_E},
        x AS (SELECT 'Hallucinated numbers' AS category, 'number N in assistant text does not match any tool result or argument' AS error FROM e WHERE kind = 'error'
              UNION ALL SELECT unnest(['Conversation too short', 'Invalid food_id (not in DB)']), unnest(['Too short: ~N tokens', 'food_id N not in known IDs: {{...}}']) FROM e WHERE kind = 'click'
              UNION ALL SELECT 'JSON parse error', regexp_replace(value, 'line 1 column [0-9]+', 'line N column N') FROM e WHERE kind = 'view')
        SELECT category, error, count(*) AS n FROM x GROUP BY ALL""",
    "most_common_errors": """
        WITH c AS (SELECT user_id % 40 AS u, event_type, count(*) AS n, min(event_id) AS first_seen FROM events GROUP BY ALL)
        SELECT *, CAST(row_number() OVER (ORDER BY n DESC, first_seen) AS INTEGER) AS place FROM c""",
    "progress_rates": """
        WITH r AS (SELECT event_type AS label, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 1e6::DOUBLE AS "at" FROM events),
        d AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY "at") AS done, min("at") OVER (PARTITION BY label) AS b, count(*) OVER (PARTITION BY label) + 10 AS total FROM r),
        x AS (SELECT *, CAST(floor(greatest(0::DOUBLE, ("at" - b) / done * (total - done))) AS BIGINT) AS s FROM d WHERE done % 100 = 0)
        SELECT label, "at", done, total, round(done / ("at" - b) * 3600, 6) AS rate, CASE WHEN s >= 3600 THEN s // 3600 || 'h ' || s % 3600 // 60 || 'm ' || s % 60 || 's' WHEN s >= 60 THEN s // 60 || 'm ' || s % 60 || 's' ELSE s || 's' END AS eta FROM x""",
    "retry_counters": f"""
        WITH {_E}, k AS (SELECT unnest(['scenario', 'language', 'depth']) AS what, unnest(['SCENARIO_' || user_id % 4, CASE user_id % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'de' ELSE 'el' END,
            CASE kind WHEN 'error' THEN 'FAIL (all 3 exhausted)' WHEN 'view' THEN 'retry 1/3' ELSE 'retry ' || event_id % 3 + 1 || '/3' END]) AS key FROM e)
        SELECT what, key, count(*) AS n FROM k GROUP BY ALL""",
    "saved_total": f"""
        WITH l AS (SELECT {LINE} AS value, event_type, event_id FROM events)
        SELECT CAST(coalesce(sum(event_id % 50) FILTER (event_type = 'signup'), 0) AS BIGINT) AS saved, count(*) FILTER (event_type = 'signup') AS success,
               count(*) FILTER (regexp_matches(value, '429|500|503|ResourceExhausted') OR contains(lower(value), 'rate limit')) AS api_errors FROM l""",
}
