"""Chat formats, parsed back, and loss masks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions import pyjson
from dialoom.operators import render, spans
from dialoom.plans.tables import table


def _rendered(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    return render.conversation(table(spark, sf_dir, "conversations"), model)


def render_chatml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rendered(spark, sf_dir, "chatml")


def render_gemma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.conversation(table(spark, sf_dir, "conversations"), "gemma", F.concat(F.lit("Conversation "), F.col("conv_id")))


def parse_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered texts parsed back: the turns that went in."""
    return render.parse(_rendered(spark, sf_dir, "chatml"), "chatml").select("conv_id", "turn", "role", "content")


def parse_gemma_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = render.parse(_rendered(spark, sf_dir, "gemma"), "gemma")
    return parsed.groupBy("conv_id", "role").agg(F.count("*").alias("turns"), F.sum(F.length("content")).alias("chars"))


def simple_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single turns as text."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", render.simple_turn("gemma", F.col("role"), F.col("text")).alias("text"))


def tool_call_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls made from events' payloads, written in one syntax and parsed again."""
    call = F.array(F.struct(F.col("event_type").alias("name"), F.col("props").alias("arguments")))
    rows = table(spark, sf_dir, "events").select("event_id", "props", pyjson.chatml_calls(call).alias("text"))
    parsed = rows.withColumn("call", pyjson.chatml_turn_call(F.concat(F.lit("<|tool_call_start|>"), F.col("text"), F.lit("<|tool_call_end|>"))))
    return parsed.select("event_id", "text", "call.name", F.get_json_object("call.arguments", "$.k").cast("long").alias("k"))


def assistant_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Character spans of assistants' texts on one line."""
    rows = _rendered(spark, sf_dir, "chatml").select("conv_id", F.posexplode(spans.spans(F.col("text"), "chatml")).alias("i", "p"))
    return rows.select("conv_id", "i", "p.s", "p.e")


def mask_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained tokens of each conversation, with a token for each character, over all lines."""
    rows = _rendered(spark, sf_dir, "gemma")
    ids, offsets = spans.char_tokens(F.col("text"))
    labels = spans.labels(ids, offsets, spans.spans(F.col("text"), "gemma", dotall=True))
    kept = F.filter(labels, lambda x: x != spans.IGNORED)
    digest = lambda k: F.struct(F.size(k).alias("trained"), F.aggregate(k, F.lit(0).cast("long"), lambda a, x: a + x).alias("sum_ids"))
    # a generator's input is evaluated once, where fields of a struct column may be taken from it anew
    return rows.select("conv_id", F.length("text").alias("tokens"), F.inline(F.transform(F.array(kept), digest)))


QUERIES = {f.__name__: f for f in (render_chatml, render_gemma, parse_turns, parse_gemma_turns, simple_turns, tool_call_parse, assistant_spans, mask_labels)}

_CHATML = "'<|im_start|>' || role || chr(10) || coalesce(text, '') || '<|im_end|>'"
_GEMMA = "'<|turn>' || CASE WHEN role = 'assistant' THEN 'model' ELSE role END || chr(10) || coalesce(text, '') || '<turn|>'"
# where each rendered turn begins: the lengths of the marker at the front and of the turns before
_AT = "coalesce(sum(length(piece)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"

ORACLE_SQL = {
    "render_chatml": f"SELECT conv_id, '<|startoftext|>' || string_agg({_CHATML}, '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id",
    "render_gemma": f"SELECT conv_id, '<bos><|turn>system' || chr(10) || 'Conversation ' || conv_id || '<turn|>' || string_agg({_GEMMA}, '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id",
    "parse_turns": "SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS turn, role, text AS content FROM conversations",
    "parse_gemma_turns": "SELECT conv_id, role, count(*) AS turns, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations GROUP BY ALL",
    "simple_turns": f"SELECT conv_id, turn, {_GEMMA} AS text FROM conversations",
    "tool_call_parse": """SELECT event_id, event_type || '(k=' || json_extract_string(props, '$.k') || ')' AS text, event_type AS name, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    "assistant_spans": f"""
        WITH p AS (SELECT *, {_CHATML} AS piece FROM conversations), a AS (SELECT *, 15 + {_AT} AS bgn FROM p),
        o AS (SELECT *, bgn + 22 AS s FROM a WHERE role = 'assistant' AND NOT contains(text, chr(10)))
        SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS i, CAST(s AS INTEGER) AS s, CAST(s + length(text) + 10 AS INTEGER) AS e FROM o""",
    "mask_labels": f"""
        WITH p AS (SELECT *, {_GEMMA} AS piece FROM conversations), a AS (SELECT *, 5 + {_AT} AS bgn FROM p),
        c AS (SELECT conv_id, 5 + sum(length(piece)) AS tokens FROM p GROUP BY 1),
        s AS (SELECT conv_id, bgn + 13 AS s, bgn + length(piece) AS e FROM a WHERE role = 'assistant'),
        t AS (SELECT conv_id, sum(e - s) AS trained, sum((e - s) * (s + 1 + e) / 2) AS ids FROM s GROUP BY 1)
        SELECT conv_id, CAST(tokens AS INTEGER) AS tokens, CAST(coalesce(trained, 0) AS INTEGER) AS trained, CAST(coalesce(ids, 0) AS BIGINT) AS sum_ids FROM c LEFT JOIN t USING (conv_id)""",
}
