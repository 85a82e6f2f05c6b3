"""Deduplication, resumption, quotas, rotation, splits and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions import fixed
from dialoom.operators import assembly
from dialoom.plans.tables import table


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assembly.utterance_key(table(spark, sf_dir, "conversations"))


def user_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One conversation for each key of user utterances."""
    return assembly.first_of_each(_keys(spark, sf_dir), ["key"], "conv_id")


def resume_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations whose key isn't among those already done (every third id)."""
    keys = _keys(spark, sf_dir)
    return assembly.resume(keys.where("conv_id % 3 <> 0"), keys.where("conv_id % 3 = 0"), ["key"], "conv_id")


def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and eval documents of each language and source, 90 to 10."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return assembly.large_split(spark, docs, ["lang", "source"], "doc_id", cells=64)


def quota_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many conversations of each scenario are missing from 800."""
    names = F.array(*map(F.lit, fixed.SCENARIOS))
    have = table(spark, sf_dir, "conversations").where("turn = 0").select(F.element_at(names, (F.pmod("conv_id", F.lit(12)) + 1).cast("int")).alias("scenario"))
    return assembly.quota(spark, 800, have).select("scenario", "target", "existing", "to_make")


def quota_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``quota_distribution`` for a list of scenarios, in every nation."""
    some = list(fixed.SCENARIOS)[:5]
    names = F.array(*map(F.lit, fixed.SCENARIOS))
    have = table(spark, sf_dir, "conversations").where("turn = 0").select(F.element_at(names, (F.pmod("conv_id", F.lit(12)) + 1).cast("int")).alias("scenario"))
    quotas = assembly.quota(spark, 123, have, some)
    places = table(spark, sf_dir, "nation").select(F.col("n_name").alias("language"))
    return assembly.work(quotas, places).groupBy("language", "scenario").agg(F.count("*").alias("n"))


def settings_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings dealt in turn within each source."""
    return assembly.rotate(table(spark, sf_dir, "documents").select("doc_id", "source"), ["source"], "doc_id", len(fixed.SETTINGS), "user_settings_idx")


def length_bias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which length the next conversation of a source should have."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", (F.col("n_chars") % 10).alias("turns"))
    return assembly.length_bias(rows, ["source"], "doc_id", "turns").select("doc_id", "short_before", "seen_before", "bias")


def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """500 documents at random, the same ones each time."""
    return assembly.sample(table(spark, sf_dir, "documents").select("doc_id", "lang"), 500, "doc_id")


def usage_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of forty kinds of parts those that orders use most and least; a few kinds have nearly all uses, some none."""
    kind = F.when(F.col("l_partkey") % 2 == 0, F.col("l_partkey") % 7).otherwise(F.col("l_partkey") % 26)
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("conv_id"), kind.alias("id"))
    kinds = table(spark, sf_dir, "part").groupBy((F.col("p_partkey") % 40).alias("id")).agg(F.min("p_name").alias("name"))
    return assembly.usage_extremes(assembly.usage_counts(lines), kinds)


def first_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid and invalid conversations by number of turns, with up to five invalid ones each."""
    per = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("turns"), F.max(F.length("text")).alias("longest"))
    rows = per.withColumn("valid", F.col("longest") <= 1200)
    return assembly.with_samples(rows, ["turns"], "valid", "conv_id").withColumn("samples", F.array_join(F.col("samples").cast("array<string>"), ","))


QUERIES = {f.__name__: f for f in (user_hash_dedup, resume_anti_join, stratified_split, quota_distribution, quota_even, settings_rotation, length_bias, hash_sample, usage_extremes, first_samples)}

_KEYS = """keys AS (SELECT conv_id, substr(sha256(coalesce(string_agg(coalesce(text, ''), '|' ORDER BY turn) FILTER (role = 'user'), '')), 1, 16) AS key FROM conversations GROUP BY conv_id)"""
_NAMES = ", ".join(f"'{s}'" for s in fixed.SCENARIOS)
_DIM = ", ".join(f"({i}, '{s}', {w}::DOUBLE)" for i, (s, w) in enumerate(fixed.SCENARIOS.items()))

ORACLE_SQL = {
    "user_hash_dedup": f"WITH {_KEYS} SELECT min(conv_id) AS conv_id, key FROM keys GROUP BY key",
    "resume_anti_join": f"WITH {_KEYS} SELECT min(conv_id) AS conv_id, key FROM keys WHERE conv_id % 3 <> 0 AND key NOT IN (SELECT key FROM keys WHERE conv_id % 3 = 0) GROUP BY key",
    "stratified_split": """
        SELECT doc_id, lang, source, CASE WHEN row_number() OVER (PARTITION BY lang, source ORDER BY sha256('42|' || doc_id), doc_id)
               <= floor(count(*) OVER (PARTITION BY lang, source) * 0.9::DOUBLE) THEN 'train' ELSE 'eval' END AS split FROM documents""",
    "quota_distribution": f"""
        WITH d(i, scenario, w) AS (VALUES {_DIM}),
        h AS (SELECT list_value({_NAMES})[CAST(conv_id % 12 AS BIGINT) + 1] AS scenario, count(*) AS existing FROM conversations WHERE turn = 0 GROUP BY 1),
        r AS (SELECT *, CAST(round_even(800 * w, 0) AS BIGINT) AS rounded FROM d),
        t AS (SELECT scenario, CASE WHEN i = 11 THEN 800 - (SELECT sum(rounded) FROM r WHERE i < 11) ELSE rounded END AS target FROM r)
        SELECT scenario, CAST(target AS BIGINT) AS target, coalesce(existing, 0) AS existing, CAST(greatest(0, target - coalesce(existing, 0)) AS BIGINT) AS to_make FROM t LEFT JOIN h USING (scenario)""",
    "quota_even": f"""
        WITH d(i, scenario, w) AS (VALUES {_DIM}), h AS (SELECT conv_id % 12 AS i, count(*) AS n FROM conversations WHERE turn = 0 GROUP BY 1),
        m AS (SELECT scenario, 123 // 5 + CASE WHEN i < 123 % 5 THEN 1 ELSE 0 END - coalesce(h.n, 0) AS n FROM d LEFT JOIN h USING (i) WHERE i < 5)
        SELECT n_name AS language, scenario, CAST(n AS BIGINT) AS n FROM m, nation WHERE n > 0""",
    "settings_rotation": "SELECT doc_id, source, CAST((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) % 5 AS INTEGER) AS user_settings_idx FROM documents",
    "length_bias": """
        WITH r AS (SELECT doc_id, coalesce(sum(CASE WHEN n_chars % 10 <= 5 THEN 1 ELSE 0 END) OVER w, 0) AS s, count(*) OVER w AS n
                   FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        SELECT doc_id, CAST(s AS BIGINT) AS short_before, n AS seen_before,
               CASE WHEN n < 3 THEN 'none' WHEN s::DOUBLE / n > 0.6::DOUBLE THEN 'long' WHEN s::DOUBLE / n < 0.4::DOUBLE THEN 'short' ELSE 'balanced' END AS bias FROM r""",
    "hash_sample": "SELECT doc_id, lang FROM documents ORDER BY sha256('42|' || doc_id), doc_id LIMIT 500",
    "usage_extremes": """
        WITH c AS (SELECT CASE WHEN l_partkey % 2 = 0 THEN l_partkey % 7 ELSE l_partkey % 26 END AS id, count(DISTINCT l_orderkey) AS uses FROM lineitem GROUP BY 1),
        s AS (SELECT p_partkey % 40 AS id, min(p_name) AS name FROM part GROUP BY 1),
        r AS (SELECT s.id, name, coalesce(uses, 0) AS uses, greatest(1, CAST(floor(greatest(1, (SELECT sum(uses) FROM c)) * 0.04::DOUBLE) AS BIGINT)) AS t FROM s LEFT JOIN c USING (id)),
        o AS (SELECT 'avoid' AS kind, id, name, uses FROM r WHERE uses >= t ORDER BY uses DESC, id LIMIT 8),
        u AS (SELECT 'prefer' AS kind, id, name, uses FROM r WHERE uses <= 1 ORDER BY id LIMIT 12),
        b AS (SELECT *, count(*) OVER (PARTITION BY kind) AS k FROM (FROM o UNION ALL FROM u))
        SELECT kind, id, name, uses FROM b WHERE k >= 2""",
    "first_samples": """
        WITH per AS (SELECT conv_id, count(*) AS turns, max(length(text)) <= 1200 AS valid FROM conversations GROUP BY conv_id)
        SELECT turns, count(*) FILTER (valid) AS valid, count(*) FILTER (NOT valid) AS invalid,
               coalesce(array_to_string(list_sort(list(conv_id) FILTER (NOT valid))[1:5], ','), '') AS samples FROM per GROUP BY turns""",
}
