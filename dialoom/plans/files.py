"""Scans and sinks: tables written in the formats that the readers take, and read back."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom import folders
from dialoom.functions import fixed
from dialoom.functions.exact import fixed_sql, py_round_sql
from dialoom.operators import assembly, generation, harness, logs, migration, prompts, render, stats
from dialoom.plans.rendering import _CHATML
from dialoom.plans.scalar import POOL_SQL
from dialoom.plans.scores import LINE, ORACLE_SQL as _SCORES
from dialoom.plans.tables import one_file, put, table
from dialoom.sources import config, readers, writers
from dialoom.sources.schemas import CONVERSATION


def food_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Food tables of two languages, with short lines that leave gaps in the ids."""
    names = [r["p_name"] for r in table(spark, sf_dir, "part").select("p_name").distinct().orderBy("p_name").collect()]  # a small dimension
    folder = folders.own(spark, "foods")
    for lang, unit, piece in (("en", "ml", "slice"), ("de", "g", "Stk")):
        lines = ["Food;Quantity(g/ml);Quantity(item);Carbohydrates(g)"]
        for i, name in enumerate(names):
            grams = "" if i % 5 == 0 else f"{i + 1}{',5' if i % 3 == 0 else ''} {unit}"
            lines.append("short;1" if i % 7 == 3 else f" {name};{grams};{'' if i % 4 == 1 else f'{i % 3 + 1} {piece}'};{i}g")
        put(spark, f"{folder}/{lang}.csv", "\n".join(lines) + "\n")
    return readers.cached_foods(spark, folder)


def _lines(spark: SparkSession, sf_dir: str, broken: bool) -> str:
    """Conversations as one file of JSON lines, some blank and some broken; returns its path."""
    said = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    per = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(said.alias("turns"))
    scenario = F.concat(F.lit("S"), F.col("conv_id") % 4)
    line = F.to_json(F.struct(scenario.alias("scenario_type"), F.lit("en").alias("language"), "turns", F.when(F.col("conv_id") % 2 == 0, F.col("conv_id") % 5).alias("user_settings_idx")))
    if broken:
        line = F.when(F.col("conv_id") % 11 == 4, F.lit("  ")).when(F.col("conv_id") % 7 == 2, F.lit("{broken")).otherwise(line)
    else:
        line = F.when(F.exists("turns", lambda t: t["role"] == "system"), F.lit("")).otherwise(line)
    return one_file(per.orderBy("conv_id").select(line.alias("value")), f"{folders.own(spark, 'lines')}/all.jsonl")


def line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of conversations by their numbers: how many turns each has, or what kind of error."""
    good, bad = readers.conversations(spark, _lines(spark, sf_dir, True))
    rows = good.select("file", "line_no", F.size("turns").alias("turns"), F.lit(None).cast("string").alias("error"))
    return rows.unionByName(bad.select("file", "line_no", F.lit(None).cast("int").alias("turns"), F.split("error", ":")[0].alias("error")))


def strict_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where every line is right."""
    rows = readers.strict_conversations(spark, _lines(spark, sf_dir, False))
    return rows.select("line_no", "scenario_type", F.size("turns").alias("turns"), "user_settings_idx")


def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are JSON, of two scenarios."""
    return readers.raw_json(spark, _lines(spark, sf_dir, True), ["S1", "S3"]).select("line_no", "scenario_type")


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as stored conversations: one readable line for each, files by market segment."""
    return table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("file"), F.col("c_custkey").alias("line_no"), F.col("c_name").alias("text"), F.lit(None).cast("int").alias("user_settings_idx"))


def rewritten_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored conversations copied with settings in turn, then rewritten in place with another column."""
    path = f"{folders.own(spark, 'copy')}/table"
    writers.migrated(migration.with_settings(_stored(spark, sf_dir)), path)
    writers.rewrite(spark, spark.read.json(path).withColumn("seen", F.lit(1)), path)
    return spark.read.json(path).select("file", "line_no", "user_settings_idx", "seen")


def appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations appended twice, in a folder for each language."""
    path = f"{folders.own(spark, 'append')}/raw"
    rows = table(spark, sf_dir, "documents").select(F.coalesce("lang", F.lit("xx")).alias("language"), "doc_id")
    for part in (0, 1):
        writers.append(rows.where(F.col("doc_id") % 2 == part), path)
    return spark.read.json(path).groupBy("language").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


def rendered_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered conversations written by model and split, and read back."""
    folder = folders.own(spark, "splits")
    rows = render.conversation(table(spark, sf_dir, "conversations"), "chatml")
    writers.splits(rows.select(F.lit("chatml").alias("model_type"), F.when(F.col("conv_id") % 10 == 0, "eval").otherwise("train").alias("split"), "text"), folder)
    return readers.rendered(spark, f"{folder}/model_type=chatml", name="split={}").select("split", F.sha2("text", 256).alias("text"))


def log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log written and read: errors by class and text."""
    path = f"{folders.own(spark, 'log')}/generation.log"
    table(spark, sf_dir, "events").selectExpr(f"{LINE} AS value").write.text(path)
    return logs.errors(logs.events(readers.log(spark, path))).groupBy("category", "error").agg(F.count("*").alias("n"))


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Markdown report of two small tables, line by line."""
    docs = table(spark, sf_dir, "documents")
    langs = stats.pivot(docs, "lang", "source", ["src1", "src2"])
    path = f"{folders.own(spark, 'report')}/report"
    writers.report([("Languages", writers.table(langs, ["lang"])), ("Total", writers.table(docs.agg(F.count("*").alias("n"))))], path, spark)
    return readers.numbered(spark, path).select("line_no", "value")


def template_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts of each setting from a template file and a schema of tools: placeholders are filled in order."""
    folder = folders.own(spark, "templates")
    template = readers.template(spark, put(spark, f"{folder}/system.txt", "A {{USER_SETTINGS}}\nB {{TOOLS}}\nC {{FIRST}} {{SECOND}}"))
    tools = readers.tool_schema(spark, put(spark, f"{folder}/tools.json", json.dumps({"tools": [{"name": "é"}], "definitions": 1})))
    rows = prompts.settings_text(harness.settings(spark))
    text = render.substitute(render.settings_prompt(F.lit(template), F.col("text"), F.lit(tools)), [("FIRST", F.lit("{{SECOND}}!")), ("SECOND", F.col("idx").cast("string"))])
    return rows.select("idx", text.alias("text"))


def settings_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' settings as the text of a training prompt."""
    texts = prompts.settings_text(harness.settings(spark), training=True)
    rows = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 5).cast("int").alias("idx"))
    return rows.join(F.broadcast(texts), "idx").select("c_custkey", "text")


def food_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of each brand as the lines of a prompt, with the units they may be given in."""
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("lang"), k.alias("id"), F.col("p_name").alias("name"), (k % 3 != 0).alias("has_grams_mode"), (k % 2 == 0).alias("has_pieces_mode"), F.col("p_size").cast("double").alias("standard_quantity_g"),
        F.when(k % 2 == 0, (k % 4).cast("double")).alias("standard_quantity_pcs"), F.when(k % 5 != 0, "ml").alias("gram_unit"), F.lit("cup").alias("piece_unit"), (k % 50 + F.lit(0.5)).alias("carbs"),
    )
    return prompts.food_list(rows.withColumn("gram_unit", F.coalesce("gram_unit", F.lit("g")))).select("lang", "text")


def hub_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 100 conversations of another collection, whose speakers become roles."""
    speaker = F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "gpt").when(F.col("conv_id") % 2 == 0, "system").otherwise("narrator")
    said = F.transform(F.array_sort(F.collect_list(F.struct("turn", speaker.alias("s"), "text"))), lambda t: F.struct(t["s"].alias("from"), t["text"].alias("value")))
    per = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(said.alias("conversations"))
    rows = readers.prefix(per, 100, "conv_id").select("conv_id", F.posexplode(readers.standardised(F.col("conversations"))).alias("i", "t"))
    return rows.select("conv_id", "i", "t.role", "t.content")


def environments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a job runs by the variables of its environment, and its folders there."""
    found = [config.environment({k: "1"}) for k in ("COLAB_GPU", "COLAB_RELEASE_TAG", "KAGGLE_KERNEL_RUN_TYPE", "HOME")]
    return spark.createDataFrame([(i, e, config.JobConfig.of(e, "/x").data) for i, e in enumerate(found)], "i int, env string, data string")


def _writer():
    """A model that makes a conversation of a request, sometimes only when asked again, sometimes never."""

    def answer(prompt: str) -> str:
        k = int(prompt.split("\n")[0])
        if k % 5 == 1 and "previous response" not in prompt or k % 5 == 2:
            return "nothing"
        turns = [{"role": "user", "content": f"u{k % 300}"}, {"role": "assistant", "action": "text", "content": f"a{k}"}]
        return json.dumps({"scenario_type": f"S{k % 2}", "language": "en", "turns": turns if k % 5 != 3 else None})

    return answer


def _wrong(answer: str) -> list[str]:
    return [] if answer.startswith("{") else ["no JSON"]


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    # as many ask at once as there are partitions
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_custkey").cast("string").alias("prompt")).repartition(4)


def generation_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scripted model asked for each customer, up to three times."""
    rows = generation.generate(_requests(spark, sf_dir), _writer, _wrong)
    return rows.select("id", "attempt", F.startswith("answer", F.lit("{")).alias("made"), F.array_join("errors", ",").alias("errors"))


def generation_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is right and new of it goes to the table of conversations."""
    key = lambda text: F.substring(F.sha2(text, 256), 1, 16)
    done = spark.range(100).select(F.lit("S0").alias("scenario_type"), key(F.concat(F.lit("u"), F.col("id"))).alias("key"))
    good, _ = generation.accepted(_requests(spark, sf_dir), _writer, _wrong, done)
    path = f"{folders.own(spark, 'made')}/raw"
    writers.append(writers.with_settings(good), path)
    return spark.read.schema(f"conv_id long, key string, {CONVERSATION}").json(path).select("conv_id", "key", "scenario_type", "language", "user_settings_idx", F.size("turns").alias("turns"))


QUERIES = {
    f.__name__: f
    for f in (
        food_scan, line_scan, strict_scan, raw_scan, rewritten_copy, appended, rendered_splits, log_scan, report_lines, template_prompts, settings_prompts, food_lines, hub_prefix, environments, generation_attempts, generation_run
    )
}


def _settings_sql(training: bool) -> str:
    n = lambda c: fixed_sql(c, 1 if training else 0)
    if training:
        hours = ", ".join(f"{p.capitalize()} ({a}:00-{b}:00)" for p, a, b in fixed.PERIODS)
        return (
            f"'CURRENT USER SETTINGS:' || chr(10) || '- Glucose: threshold=' || {n('threshold')} || ' mg/dL, baseline=' || {n('baseline')} || ' mg/dL, divisor=' || {n('divisor')} || ' mg/dL per unit' || chr(10) || '- Meal dividers: Morning=' || morning "
            f"|| ', Midday=' || midday || ', Evening=' || evening || chr(10) || '- Meal time ranges: {hours}'"
        )
    hours = ", ".join(f"{p.capitalize()} {a}:00-{b}:00" for p, a, b in fixed.PERIODS)
    return (
        f"'The current user has these settings:' || chr(10) || '- Glucose threshold: ' || {n('threshold')} || ' mg/dL (only correct BG above this)' || chr(10) || '- Glucose baseline: ' || {n('baseline')} || ' mg/dL' || chr(10) || '- Glucose divisor: ' "
        f"|| {n('divisor')} || ' mg/dL per insulin unit' || chr(10) || '- Meal dividers: Morning=' || morning || ', Midday=' || midday || ', Evening=' || evening || chr(10) || '- Meal time ranges: {hours}'"
    )


def _has(words) -> str:
    return "(" + " OR ".join("contains(lower(name), '" + w.replace("'", "''") + "')" for w in words) + ")"


_FILE = """l AS (SELECT conv_id, count(*) AS n, bool_or(role NOT IN ('user', 'assistant', 'tool')) AS odd FROM conversations GROUP BY 1), f AS (SELECT *, row_number() OVER (ORDER BY conv_id) - 1 AS line_no FROM l)"""
_PIVOT = "lang, count(*) FILTER (source = 'src1') AS src1, count(*) FILTER (source = 'src2') AS src2, count(*) AS total"

ORACLE_SQL = {
    "food_scan": f"""
        WITH n AS (SELECT p_name AS name, row_number() OVER (ORDER BY p_name) - 1 AS i FROM (SELECT DISTINCT p_name FROM part)),
        r AS (SELECT lang, name, i, CAST(i + 1 AS INTEGER) AS id, CASE WHEN i % 5 <> 0 THEN i + 1 + CASE WHEN i % 3 = 0 THEN 0.5 ELSE 0 END END::DOUBLE AS g, CASE WHEN i % 4 <> 1 THEN i % 3 + 1 END::DOUBLE AS p, i::DOUBLE AS carbs
              FROM n, (VALUES ('en'), ('de')) x(lang) WHERE i % 7 <> 3)
        SELECT lang, id, name, g AS standard_quantity_g, p AS standard_quantity_pcs, carbs, g IS NOT NULL AND lang = 'en' AS is_liquid, CASE WHEN g IS NOT NULL THEN CASE lang WHEN 'en' THEN 'ml' ELSE 'g' END END AS gram_unit,
               CASE WHEN p IS NOT NULL THEN CASE lang WHEN 'en' THEN 'slice' ELSE 'pcs' END END AS piece_unit, g IS NOT NULL AS has_grams_mode, p IS NOT NULL AS has_pieces_mode,
               CASE WHEN g > 0 THEN {py_round_sql("(carbs / g * 100)")} END AS carbs_per_100g, CASE WHEN p > 0 THEN {py_round_sql("(carbs / p)")} END AS carbs_per_piece,
               CASE WHEN {_has(fixed.DAIRY)} THEN 'dairy' WHEN {_has(fixed.LEGUMES)} THEN 'legumes' WHEN {_has(fixed.STARCHY)} AND g IS NULL THEN 'starchy_vegetables' WHEN carbs <= 5.5 THEN 'vegetables' WHEN carbs BETWEEN 12 AND 16 THEN 'fruits' ELSE 'other' END AS category FROM r""",
    "line_scan": f"""
        WITH {_FILE} SELECT 'all' AS file, line_no, CASE WHEN conv_id % 7 <> 2 AND NOT odd THEN CAST(n AS INTEGER) END AS turns, CASE WHEN conv_id % 7 = 2 THEN 'JSONDecodeError' WHEN odd THEN 'ValueError' END AS error FROM f WHERE conv_id % 11 <> 4""",
    "strict_scan": f"WITH {_FILE} SELECT line_no, 'S' || conv_id % 4 AS scenario_type, CAST(n AS INTEGER) AS turns, CASE WHEN conv_id % 2 = 0 THEN CAST(conv_id % 5 AS INTEGER) END AS user_settings_idx FROM f WHERE NOT odd",
    "raw_scan": f"WITH {_FILE} SELECT line_no, 'S' || conv_id % 4 AS scenario_type FROM f WHERE conv_id % 11 <> 4 AND conv_id % 7 <> 2 AND conv_id % 4 IN (1, 3)",
    "rewritten_copy": "SELECT c_mktsegment AS file, c_custkey AS line_no, (row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1) % 5 AS user_settings_idx, CAST(1 AS BIGINT) AS seen FROM customer",
    "appended": "SELECT coalesce(lang, 'xx') AS language, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM documents GROUP BY 1",
    "rendered_splits": f"SELECT CASE WHEN conv_id % 10 = 0 THEN 'eval' ELSE 'train' END AS split, sha256('<|startoftext|>' || string_agg({_CHATML}, '' ORDER BY turn)) AS text FROM conversations GROUP BY conv_id",
    "log_scan": _SCORES["error_categories"],
    "report_lines": f"""
        WITH p AS (SELECT {_PIVOT} FROM documents GROUP BY lang), k AS (SELECT count(*) AS n FROM p),
        x AS (SELECT unnest(range(9)) AS o, unnest(['# Dataset report', '', '## Languages', '', '| lang | src1 | src2 | total |', '|---|---|---|---|', '', '## Total', '']) AS v),
        l AS (SELECT o + CASE WHEN o >= 6 THEN (SELECT n FROM k) ELSE 0 END AS line_no, v AS value FROM x
              UNION ALL SELECT 5 + row_number() OVER (ORDER BY lang NULLS FIRST), '| ' || coalesce(lang, '') || ' | ' || src1 || ' | ' || src2 || ' | ' || total || ' |' FROM p
              UNION ALL SELECT 9 + n, '| n |' FROM k UNION ALL SELECT 10 + n, '|---|' FROM k UNION ALL SELECT 11 + n, '| ' || (SELECT count(*) FROM documents) || ' |' FROM k UNION ALL SELECT 12 + n, '' FROM k)
        SELECT CAST(line_no AS BIGINT) AS line_no, value FROM l""",
    "template_prompts": f"""
        WITH {POOL_SQL} SELECT CAST(idx AS INTEGER) AS idx, 'A ' || {_settings_sql(False)} || chr(10) || 'B [' || chr(10) || '  {{' || chr(10) || '    "name": "é"' || chr(10) || '  }}' || chr(10) || ']' || chr(10) || 'C ' || idx || '! ' || idx AS text FROM pool""",
    "settings_prompts": f"WITH {POOL_SQL} SELECT c_custkey, {_settings_sql(True)} AS text FROM customer JOIN pool ON idx = c_custkey % 5",
    "food_lines": """
        WITH r AS (SELECT *, p_partkey AS k, p_partkey % 3 <> 0 AS g, p_partkey % 2 = 0 AS p, CASE WHEN p_partkey % 5 <> 0 THEN 'ml' ELSE 'g' END AS u FROM part),
        l AS (SELECT p_brand, k, '  ' || k || ': ' || p_name || ' (' || CASE WHEN g AND p THEN p_size || '.0' || u || ' / ' || k % 4 || '.0cup' WHEN g THEN p_size || '.0' || u WHEN p THEN k % 4 || '.0cup' ELSE '?' END || ' = ' || k % 50 || '.5g carbs) '
              || CASE WHEN g AND p THEN '[USE: unit="' || u || '" or "cup"]' WHEN g THEN '[USE: unit="' || u || '" only]' WHEN p THEN '[USE: unit="cup" only]' ELSE '' END AS t FROM r)
        SELECT p_brand AS lang, string_agg(t, chr(10) ORDER BY k) AS text FROM l GROUP BY 1""",
    "hub_prefix": """
        WITH c AS (SELECT DISTINCT conv_id FROM conversations ORDER BY 1 LIMIT 100)
        SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS i, CASE WHEN role IN ('user', 'assistant') THEN role WHEN conv_id % 2 = 0 THEN 'system' ELSE 'narrator' END AS role, text AS content FROM conversations JOIN c USING (conv_id)""",
    "environments": "SELECT * FROM (VALUES (0, 'colab', '/content/data/output'), (1, 'colab', '/content/data/output'), (2, 'kaggle', '/kaggle/working/data/output'), (3, 'local', '/x/data/output')) t(i, env, data)",
    "generation_attempts": """
        WITH a AS (SELECT c_custkey AS id, unnest([1, 2, 3]) AS attempt FROM customer), x AS (SELECT *, CASE id % 5 WHEN 1 THEN attempt = 2 WHEN 2 THEN false ELSE attempt = 1 END AS made FROM a)
        SELECT id, attempt, made, CASE WHEN made THEN '' ELSE 'no JSON' END AS errors FROM x WHERE attempt <= CASE id % 5 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 1 END""",
    "generation_run": """
        WITH g AS (SELECT c_custkey AS k, c_custkey % 2 AS s, c_custkey % 300 AS u FROM customer WHERE c_custkey % 5 NOT IN (2, 3)),
        x AS (SELECT min(k) AS conv_id, s, u FROM g WHERE NOT (s = 0 AND u < 100) GROUP BY s, u)
        SELECT conv_id, substr(sha256('u' || u), 1, 16) AS key, 'S' || s AS scenario_type, 'en' AS language, 0 AS user_settings_idx, 2 AS turns FROM x""",
}
