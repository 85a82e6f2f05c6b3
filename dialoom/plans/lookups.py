"""Joins: dimensions, substrings, division, position, forward and backward in time, near numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions import foodtext
from dialoom.functions.exact import number_sql, py_round_sql
from dialoom.operators import asof, audit, rules, scoring
from dialoom.operators.harness import settings
from dialoom.plans.scalar import POOL_SQL
from dialoom.plans.tables import table


def food_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carbs of ordered parts: weighed parts by their size, counted ones by the piece; null where the unit doesn't suit."""
    foods = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_retailprice").alias("carbs"),
        F.when(F.col("p_partkey") % 3 != 0, F.col("p_size").cast("double")).alias("g"),
        F.when(F.col("p_partkey") % 3 != 1, F.lit(1.0)).alias("p"),
    )
    unit = F.when(F.col("l_orderkey") % 2 == 0, "g").otherwise("pcs")
    rows = table(spark, sf_dir, "lineitem").withColumn("unit", unit).join(foods, "l_partkey")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "unit", foodtext.item_carbs(F.col("l_quantity"), F.col("unit"), F.col("carbs"), F.col("g"), F.col("p")).alias("item_carbs"))


def settings_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by the settings they were dealt; a missing index means the first."""
    idx = F.when(F.col("o_orderkey") % 7 != 0, (F.col("o_orderkey") % 5).cast("int"))
    rows = table(spark, sf_dir, "orders").select(F.coalesce(idx, F.lit(0)).alias("idx"))
    return rows.join(F.broadcast(settings(spark)), "idx").groupBy("idx", "threshold", "divisor").agg(F.count("*").alias("n"))


def substring_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose name holds a query, for each query in order; one without a match has an empty list. Queries are few
    and distinct names are searched once."""
    queries = spark.createDataFrame([(i, q) for i, q in enumerate(["RING", "ed w", "", "zzz", "all"])], "i int, q string")
    parts = table(spark, sf_dir, "part").select(F.col("p_name").alias("name"), F.col("p_partkey").alias("id"))
    names = parts.select("name").distinct()
    hits = names.join(F.broadcast(queries), F.contains(F.lower("name"), F.lower("q")))
    found = hits.join(parts, "name").groupBy("i").agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    return queries.join(found, "i", "left").select("i", "q", F.coalesce("n", F.lit(0)).alias("n"), "first_id", "last_id")


def settings_division(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which settings all orders of a customer agree with: customers' orders mostly carry one setting's values."""
    idx = F.when((F.col("o_custkey") % 4 == 0) & (F.col("o_orderkey") % 3 == 0), (F.col("o_orderkey") % 5)).otherwise(F.col("o_custkey") % 5).cast("int")
    meal = F.element_at(F.array(*map(F.lit, ("morning", "midday", "evening"))), (F.col("o_orderkey") % 3 + 1).cast("int"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("conv_id"), idx.alias("idx"), F.when(F.col("o_orderkey") % 4 != 0, meal).alias("meal_time")).join(F.broadcast(settings(spark)), "idx")
    wrong = F.when(F.col("conv_id") % 11 == 0, 1).otherwise(0)
    results = rows.select("conv_id", "threshold", "baseline", "divisor", "meal_time", (F.col("dividers")[F.col("meal_time")] + wrong).alias("meal_divider"))
    return audit.matching_settings(results, settings(spark))


def zip_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The i-th line of an order by number beside the i-th by price: how many agree."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("conv_id"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("turn"),
        F.struct("l_extendedprice", "l_partkey", "l_suppkey", "l_linenumber").alias("by_price"),
        F.lit(0).alias("call"),
        F.col("l_returnflag").alias("name"),
        F.col("l_linestatus").alias("arguments"),
    )
    zipped = scoring.zip_calls(lines, lines.withColumn("turn", F.col("by_price")).where("name <> 'N' OR arguments = 'O'"))
    return zipped.groupBy("conv_id").agg(F.count("*").alias("calls"), F.count_if("correct").alias("correct"))


def forward_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of clicks and views given to a user's next purchase, the last of each kind winning."""
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("conv_id"), F.col("event_id").alias("turn"), F.col("event_type").alias("role"), "value")
    results = events.where("role IN ('click', 'view')").select("conv_id", "turn", F.col("role").alias("key"), "value")
    return asof.copy_forward(results, events, "purchase")


def placeholder_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts whose placeholders are filled with a user's last earlier values."""
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("conv_id"), F.col("event_id").alias("turn"), "event_type", "value")
    texts = events.where("event_type = 'purchase'").select("conv_id", "turn", F.concat(F.lit("{{click}} of {{view}}, {{none}} {{click}} #"), F.col("turn")).alias("text"))
    given = events.where("event_type IN ('click', 'view')").select("conv_id", "turn", F.col("event_type").alias("key"), "value")
    return asof.fill(texts, given).select("conv_id", "turn", "filled", F.array_join("left", ",").alias("left"))


def text_number_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of documents that stand for none of the document's own figures."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("conv_id"), "text", "n_chars")
    numbers = docs.select("conv_id", F.lit(0).alias("turn"), F.explode(F.array_distinct(F.filter(rules.text_numbers(F.col("text")), lambda x: x < 1e12))).alias("number"))
    values = docs.select("conv_id", F.array(F.col("conv_id").cast("double"), F.col("n_chars").cast("double"), F.lit(555.0), F.lit(2.04)).alias("values"))
    return rules.unmatched_numbers(numbers, values).select("conv_id", "number")


def latest_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each purchase the user's last earlier error value, rounded."""
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("conv_id"), F.col("event_id").alias("turn"), "event_type", "value")
    wanted = events.where("event_type = 'purchase'").select("conv_id", "turn", F.lit("error").alias("key"))
    given = events.where("event_type = 'error'").select("conv_id", "turn", F.lit("error").alias("key"), "value")
    return asof.latest(wanted, given).select("conv_id", "turn", F.expr(py_round_sql("value", 1)).alias("value"))


QUERIES = {f.__name__: f for f in (food_lookup, settings_lookup, substring_search, settings_division, zip_compare, forward_copy, placeholder_fill, text_number_match, latest_value)}

ORACLE_SQL = {
    "food_lookup": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_orderkey % 2 = 0 THEN 'g' ELSE 'pcs' END AS unit,
               CASE WHEN l_orderkey % 2 = 0 THEN CASE WHEN p_partkey % 3 <> 0 THEN l_quantity * p_retailprice / p_size::DOUBLE END WHEN p_partkey % 3 <> 1 THEN l_quantity * p_retailprice / 1.0::DOUBLE END AS item_carbs
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "settings_lookup": f"""
        WITH {POOL_SQL}, o AS (SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 5 ELSE 0 END AS idx FROM orders)
        SELECT CAST(idx AS INTEGER) AS idx, threshold, divisor, count(*) AS n FROM o JOIN pool USING (idx) GROUP BY ALL""",
    "substring_search": """
        WITH q(i, q) AS (VALUES (0, 'RING'), (1, 'ed w'), (2, ''), (3, 'zzz'), (4, 'all'))
        SELECT i, q, count(p_partkey) AS n, min(p_partkey) AS first_id, max(p_partkey) AS last_id FROM q LEFT JOIN part ON contains(lower(p_name), lower(q)) GROUP BY i, q""",
    "settings_division": f"""
        WITH {POOL_SQL},
        o AS (SELECT o_custkey AS conv_id, CASE WHEN o_custkey % 4 = 0 AND o_orderkey % 3 = 0 THEN o_orderkey % 5 ELSE o_custkey % 5 END AS idx,
                     CASE WHEN o_orderkey % 4 <> 0 THEN list_value('morning', 'midday', 'evening')[CAST(o_orderkey % 3 AS BIGINT) + 1] END AS meal FROM orders),
        r AS (SELECT conv_id, threshold, baseline, divisor, meal, CASE meal WHEN 'morning' THEN morning WHEN 'midday' THEN midday WHEN 'evening' THEN evening END + CASE WHEN conv_id % 11 = 0 THEN 1 ELSE 0 END AS divider FROM o JOIN pool USING (idx)),
        n AS (SELECT conv_id, count(*) AS n_results FROM r GROUP BY 1),
        f AS (SELECT r.conv_id, p.idx, count(*) AS k FROM r JOIN pool p ON r.threshold = p.threshold AND r.baseline = p.baseline AND r.divisor = p.divisor
              AND (meal IS NULL OR divider = CASE meal WHEN 'morning' THEN p.morning WHEN 'midday' THEN p.midday ELSE p.evening END) GROUP BY ALL),
        w AS (SELECT conv_id, count(*) AS ways, min(idx) AS idx FROM f JOIN n USING (conv_id) WHERE k = n_results GROUP BY 1)
        SELECT conv_id, n_results, CASE WHEN ways = 1 THEN CAST(idx AS INTEGER) END AS inferred FROM n LEFT JOIN w USING (conv_id)""",
    "zip_compare": """
        WITH g AS (SELECT l_orderkey AS conv_id, l_returnflag AS a, l_linestatus AS b, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS i FROM lineitem),
        p AS (SELECT l_orderkey AS conv_id, l_returnflag AS a, l_linestatus AS b, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice, l_partkey, l_suppkey, l_linenumber) AS i
              FROM lineitem WHERE l_returnflag <> 'N' OR l_linestatus = 'O')
        SELECT g.conv_id, count(*) AS calls, count(*) FILTER (g.a = p.a AND g.b = p.b) AS correct FROM g LEFT JOIN p ON g.conv_id = p.conv_id AND g.i = p.i GROUP BY 1""",
    "forward_copy": """
        WITH t AS (SELECT *, min(CASE WHEN event_type = 'purchase' THEN event_id END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS target FROM events)
        SELECT user_id AS conv_id, target, event_type AS key, arg_max(value, event_id) AS value FROM t WHERE event_type IN ('click', 'view') AND target IS NOT NULL GROUP BY ALL""",
    "placeholder_fill": f"""
        WITH e AS (SELECT *, last_value(CASE WHEN event_type = 'click' THEN value END IGNORE NULLS) OVER w AS c, last_value(CASE WHEN event_type = 'view' THEN value END IGNORE NULLS) OVER w AS v
                   FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        s AS (SELECT *, CASE WHEN c IS NULL THEN '{{{{click}}}}' ELSE {number_sql("c")} END AS cs, CASE WHEN v IS NULL THEN '{{{{view}}}}' ELSE {number_sql("v")} END AS vs FROM e WHERE event_type = 'purchase')
        SELECT user_id AS conv_id, event_id AS turn, cs || ' of ' || vs || ', {{{{none}}}} ' || cs || ' #' || event_id AS filled,
               CASE WHEN c IS NULL THEN 'click,' ELSE '' END || 'none' || CASE WHEN v IS NULL THEN ',view' ELSE '' END AS left FROM s""",
    "text_number_match": """
        WITH n AS (SELECT DISTINCT doc_id AS conv_id, n_chars, unnest(regexp_extract_all(text, '[0-9]+\\.[0-9]+|[0-9]+'))::DOUBLE AS number FROM documents),
        v AS (SELECT *, list_value(conv_id::DOUBLE, n_chars::DOUBLE, 555.0::DOUBLE, 2.04::DOUBLE) AS vs FROM n WHERE number >= 0.01 AND number < 1e12)
        SELECT DISTINCT conv_id, number FROM v WHERE NOT list_bool_or(list_transform(vs, lambda x: abs(number - x) < 0.05 OR (abs(number - x) < 1.0 AND round_even(number, 0) = round_even(x, 0))))""",
    "latest_value": f"""
        WITH e AS (SELECT *, last_value(CASE WHEN event_type = 'error' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM events)
        SELECT user_id AS conv_id, event_id AS turn, {py_round_sql("v", 1)} AS value FROM e WHERE event_type = 'purchase'""",
}
