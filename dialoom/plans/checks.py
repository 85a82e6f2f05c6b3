"""Conversation rules on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.operators import rules, scoring
from dialoom.operators.render import without_bos
from dialoom.plans.tables import table

_BEFORE = (("purchase", "view", "purchase before view"), ("view", "signup", "view before signup"), ("error", "view", "error before view"))


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.col("text").alias("content"), F.when(F.col("role") == "assistant", "text").alias("action"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the turns of one conversation for each source, with some gaps."""
    text = F.when(F.col("doc_id") % 17 == 3, "").when(F.col("doc_id") % 19 != 4, F.col("text"))
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("conv_id"),
        F.col("doc_id").alias("turn"),
        F.when(F.col("doc_id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.when(F.col("doc_id") % 2 == 1, F.when(F.col("doc_id") % 3 == 0, "tool_call").otherwise("text")).alias("action"),
        text.alias("content"),
        F.when(F.col("doc_id") % 5 == 0, 1).otherwise(0).alias("n_calls"),
        F.when(F.col("doc_id") % 13 != 6, F.lit("[KNOWN: a(1)]")).alias("context_block"),
    )


def tool_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of a user that comes before the kind it needs."""
    calls = table(spark, sf_dir, "events").select(F.col("user_id").alias("conv_id"), F.col("ts").alias("turn"), F.col("event_id").alias("call"), F.col("event_type").alias("name"))
    return rules.tool_order(calls, _BEFORE).select("conv_id", F.col("call").alias("event_id"), "error")


def known_id_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines whose part no earlier line of the same supplier had shipped."""
    lines = table(spark, sf_dir, "lineitem")
    known = lines.where("l_returnflag = 'R'").select(F.col("l_suppkey").alias("conv_id"), F.col("l_shipdate").alias("turn"), F.col("l_partkey").alias("id"))
    used = lines.where("l_returnflag = 'A'").select(F.col("l_suppkey").alias("conv_id"), F.col("l_shipdate").alias("turn"), F.col("l_orderkey").alias("call"), F.col("l_linenumber").alias("item"), F.col("l_partkey").alias("id"))
    return rules.unknown_ids(used, known).groupBy("conv_id").agg(F.count("*").alias("unknown"), F.count_distinct("id").alias("ids"))


def unit_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in a unit their part isn't sold by."""
    foods = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), (F.col("p_partkey") % 3 != 0).alias("has_grams_mode"), (F.col("p_partkey") % 3 == 2).alias("has_pieces_mode"))
    unit = F.element_at(F.array(*map(F.lit, ("g", "ml", "pcs", "cup", "bunch"))), (F.col("l_orderkey") % 5 + 1).cast("int"))
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("id"), unit.alias("unit"))
    return rules.unit_errors(items, foods).select("l_orderkey", "l_linenumber", "id", "error")


def length_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations too short or too long, by bounds that suit the data; documents' languages decide what is counted."""
    per = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: F.coalesce(x["text"], F.lit(""))), " ").alias("text"))
    lang = F.when(F.col("conv_id") % 7 == 0, "zh").otherwise("en")
    return per.select("conv_id", rules.length_error(rules.estimated_length(F.col("text"), lang), 100, 900).alias("error")).where("error is not null")


def empty_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.empty_turns(_documents(spark, sf_dir))


def context_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.missing_context(_documents(spark, sf_dir))


def utterance_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns of more than 60 estimated tokens."""
    return rules.long_utterances(_turns(spark, sf_dir), 60)


def placeholders_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placeholders left in assistants' texts, which some events' names are made to be."""
    marked = F.concat(F.lit("It was {{"), F.col("event_type"), F.lit("}} and {{n_"), F.col("event_id") % 3, F.lit("}} {no}"))
    turns = table(spark, sf_dir, "events").select(F.col("user_id").alias("conv_id"), F.col("event_id").alias("turn"), F.when(F.col("event_type") != "error", "assistant").otherwise("user").alias("role"), marked.alias("content"))
    return rules.unreplaced(turns).select("conv_id", "turn", "placeholder", "error")


def role_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns by role, and whether the schema knows it."""
    rows = _turns(spark, sf_dir).withColumn("known", rules.known_kinds(F.col("role"), F.col("action")))
    return rows.groupBy("role", "known").agg(F.count("*").alias("n"))


def clarifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that ask back and don't call a tool, with question marks and calls put in by id."""
    text = F.concat(F.coalesce("text", F.lit("")), F.when(F.col("doc_id") % 3 == 0, "?").otherwise("."), F.when(F.col("doc_id") % 5 == 0, ' add({"a": 1})').when(F.col("doc_id") % 7 == 0, "<|tool_call_start|>add()<|tool_call_end|>").otherwise(""))
    return table(spark, sf_dir, "documents").select("doc_id", scoring.is_clarification(text).alias("asks"))


def bos_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with and without a leading marker, and their length without it."""
    text = F.concat(F.when(F.col("turn") % 2 == 0, "<bos>").otherwise(""), F.col("text"))
    rows = table(spark, sf_dir, "conversations").withColumn("t", text)
    return rows.groupBy("role").agg(F.count_if(F.startswith("t", F.lit("<bos>"))).alias("marked"), F.sum(F.length(without_bos(F.col("t"), "gemma"))).alias("chars"))


QUERIES = {f.__name__: f for f in (tool_order, known_id_check, unit_check, length_check, empty_turns, context_check, utterance_length, placeholders_left, role_check, clarifications, bos_check)}

_DOCS = """d AS (SELECT source AS conv_id, doc_id AS turn, CASE WHEN doc_id % 2 = 0 THEN 'user' ELSE 'assistant' END AS role,
    CASE WHEN doc_id % 2 = 1 THEN CASE WHEN doc_id % 3 = 0 THEN 'tool_call' ELSE 'text' END END AS action,
    CASE WHEN doc_id % 17 = 3 THEN '' WHEN doc_id % 19 <> 4 THEN text END AS content, doc_id % 5 = 0 AS called, doc_id % 13 <> 6 AS context FROM documents)"""
_FIRST = "SELECT conv_id, min(turn) AS turn, 'Turn ' || min(turn) || ': ' || arg_min(e, turn) AS error FROM e WHERE e IS NOT NULL GROUP BY conv_id"

ORACLE_SQL = {
    "tool_order": """
        WITH f AS (SELECT user_id, min((ts, event_id)) FILTER (event_type = 'view') AS v, min((ts, event_id)) FILTER (event_type = 'signup') AS s FROM events GROUP BY 1),
        b AS (SELECT e.user_id, ts, event_id, CASE WHEN event_type = 'purchase' AND (v IS NULL OR v >= (ts, event_id)) THEN 'purchase before view'
              WHEN event_type = 'view' AND (s IS NULL OR s >= (ts, event_id)) THEN 'view before signup' WHEN event_type = 'error' AND (v IS NULL OR v >= (ts, event_id)) THEN 'error before view' END AS error FROM events e JOIN f USING (user_id))
        SELECT user_id AS conv_id, arg_min(event_id, (ts, event_id)) AS event_id, arg_min(error, (ts, event_id)) AS error FROM b WHERE error IS NOT NULL GROUP BY 1""",
    "known_id_check": """
        SELECT l_suppkey AS conv_id, count(*) AS unknown, count(DISTINCT l_partkey) AS ids FROM lineitem u
        WHERE l_returnflag = 'A' AND NOT EXISTS (FROM lineitem k WHERE k.l_returnflag = 'R' AND k.l_suppkey = u.l_suppkey AND k.l_partkey = u.l_partkey AND k.l_shipdate <= u.l_shipdate) GROUP BY 1""",
    "unit_check": """
        WITH i AS (SELECT *, list_value('g', 'ml', 'pcs', 'cup', 'bunch')[CAST(l_orderkey % 5 AS BIGINT) + 1] AS unit FROM lineitem JOIN part ON l_partkey = p_partkey)
        SELECT l_orderkey, l_linenumber, l_partkey AS id, 'food_id ' || l_partkey || ' (' || p_name || '): unit ''' || unit || ''' used but food has no ' || CASE WHEN unit IN ('g', 'ml') THEN 'grams/ml' ELSE 'piece' END || ' mode' AS error
        FROM i WHERE p_partkey % 3 <> 0 AND unit IN ('pcs', 'cup') AND p_partkey % 3 <> 2""",
    "length_check": """
        WITH p AS (SELECT conv_id, sum(length(coalesce(text, ''))) + count(*) - 1 AS n FROM conversations GROUP BY 1),
        e AS (SELECT conv_id, CAST(CASE WHEN conv_id % 7 = 0 THEN n ELSE n // 4 END AS BIGINT) AS t FROM p)
        SELECT conv_id, CASE WHEN t < 100 THEN 'Too short: ~' ELSE 'Too long: ~' END || t || ' tokens' AS error FROM e WHERE t < 100 OR t > 900""",
    "empty_turns": f"""
        WITH {_DOCS}, e AS (SELECT conv_id, turn, CASE WHEN role = 'user' AND coalesce(content, '') = '' THEN 'empty user content' WHEN action = 'text' AND coalesce(content, '') = '' THEN 'empty assistant text'
        WHEN action = 'tool_call' AND NOT called THEN 'empty tool calls' END AS e FROM d) {_FIRST}""",
    "context_check": f"WITH {_DOCS}, e AS (SELECT conv_id, turn, CASE WHEN role = 'user' AND NOT context THEN 'missing context_block in user message' END AS e FROM d) {_FIRST}",
    "utterance_length": """
        SELECT conv_id, turn, length(text) // 4 AS tokens, 'Turn ' || turn || ': user utterance ~' || length(text) // 4 || ' tokens (max ~60)' AS error FROM conversations WHERE role = 'user' AND length(text) // 4 > 60""",
    "placeholders_left": """
        WITH p AS (SELECT user_id AS conv_id, event_id AS turn, unnest([event_type, 'n_' || event_id % 3]) AS placeholder FROM events WHERE event_type <> 'error')
        SELECT *, 'Turn ' || turn || ': unreplaced placeholder {{' || placeholder || '}}' AS error FROM p""",
    "role_check": "SELECT role, role IN ('user', 'assistant', 'tool') AS known, count(*) AS n FROM conversations GROUP BY ALL",
    "clarifications": r"""
        SELECT doc_id, (doc_id % 3 = 0 OR contains(coalesce(text, ''), '?')) AND doc_id % 5 <> 0 AND doc_id % 7 <> 0 AND NOT regexp_matches(coalesce(text, ''), '(?s)[\pL\pM\pN_]\(\{.*?\}\)')
               AND NOT regexp_matches(coalesce(text, ''), '(?s)<\|tool_call_start\|>.*?<\|tool_call_end\|>') AS asks FROM documents""",
    "bos_check": "SELECT role, count(*) FILTER (turn % 2 = 0) AS marked, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations GROUP BY role",
}
