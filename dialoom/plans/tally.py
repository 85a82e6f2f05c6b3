"""Tool replay on orders: an order is a conversation that searches its parts, adds its lines, sometimes removes one,
and asks for the dose."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions import fixed
from dialoom.functions.exact import fixed_sql, py_round_sql
from dialoom.operators import harness, rules
from dialoom.operators.harness import period_sql
from dialoom.plans.scalar import DIVIDER_SQL, POOL_SQL
from dialoom.plans.tables import table

_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls of each order, joined to their parts. A part is sold by weight, or by the piece if its key is divisible by
    three; every ninth order asks for a unit that doesn't suit, every eleventh forgets to search."""
    foods = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("food_name"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"))
    piece = F.col("l_partkey") % 3 == 0
    unit = F.when(F.col("l_orderkey") % 9 == 0, "g").otherwise(F.when(piece, "pcs").otherwise("g"))
    carbs = F.when(piece & (unit == "pcs"), F.col("l_quantity") * (F.col("price") % 20)).when(~piece, F.col("l_quantity") * (F.col("price") % 20) / F.col("size").cast("double"))
    lines = table(spark, sf_dir, "lineitem").join(foods, "l_partkey")
    item = F.struct(*_ORDER, F.struct(F.col("l_partkey").cast("int").alias("food_id"), "food_name", F.col("l_quantity").alias("quantity"), unit.alias("unit"), carbs.alias("carbs")).alias("item"))
    per = lines.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["item"]).alias("items"))
    orders = table(spark, sf_dir, "orders").join(per, F.col("o_orderkey") == F.col("l_orderkey"))
    null = {"found": "array()", "items": "NULL", "entry_ids": "NULL", "meal_time": "NULL", "meal_hour": "NULL", "blood_glucose": "NULL"}

    def call(seq: int, tool: str, **given: str) -> str:
        cells = ", ".join(f"'{k}', {v}" for k, v in (null | given).items())
        return f"CAST(named_struct('seq', {seq}L, 'name', '{tool}', {cells}) AS {harness.CALL})"

    calls = [
        call(0, fixed.SEARCH, found="if(o_orderkey % 11 = 0, array(), transform(items, x -> x.food_id))"),
        call(1, fixed.ADD, items="items"),
        call(2, fixed.REMOVE, entry_ids="if(o_orderkey % 4 = 0, array(1), array())"),
        call(3, fixed.ADD, items="slice(items, 1, 1)"),
        call(4, fixed.FINAL, meal_hour="CAST(o_orderkey % 24 AS INT)", blood_glucose="if(o_orderkey % 5 = 2, NULL, o_custkey % 150 + 40.5D)"),
    ]
    return orders.selectExpr("o_orderkey AS conv_id", "'en' AS lang", "CAST(o_orderkey % 5 AS INT) AS idx", f"array({', '.join(calls)}) AS calls")


def _replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harness.replay(prepared(spark, sf_dir), harness.settings(spark).withColumnRenamed("idx", "pool_idx"))


def tally_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each call of an order gave: errors, totals, entries."""
    rows = _replayed(spark, sf_dir).select("conv_id", F.explode("outputs").alias("o"))
    return rows.select("conv_id", "o.seq", "o.name", "o.error", F.size("o.entries").alias("entries"), "o.removed", "o.tally_total")


def final_dose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dose of each order and how it came about."""
    rows = _replayed(spark, sf_dir).select("conv_id", F.element_at("outputs", 5).alias("o"))
    return rows.select("conv_id", *(f"o.{c}" for c in ("error", "tally_total", "meal_time", "meal_divider", "food_insulin", "glucose_correction", "glucose_skipped", "final_result", "breakdown_food", "breakdown_glucose")))


def tally_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is told of an order's tally before and after all is cleared, and that entries are numbered anew then."""
    p = prepared(spark, sf_dir)
    call = lambda seq, tool, items="NULL": f"CAST(named_struct('seq', {seq}L, 'name', '{tool}', 'found', array(), 'items', {items}, 'entry_ids', NULL, 'meal_time', NULL, 'meal_hour', NULL, 'blood_glucose', NULL) AS {harness.CALL})"
    again = "transform(array(1), x -> calls[0])"
    more = ", ".join([call(2, fixed.SUMMARY), call(3, fixed.CLEAR), call(4, fixed.SUMMARY)])
    rows = p.withColumn("calls", F.expr(f"concat(slice(calls, 1, 2), array({more}), {again}, transform(array(1), x -> calls[3]))"))
    got = harness.replay(rows, harness.settings(spark).withColumnRenamed("idx", "pool_idx")).withColumn("o", F.col("outputs"))
    at = lambda i: F.element_at("o", i)
    return got.select(
        "conv_id", F.size(at(3)["entries"]).alias("entries"), at(3)["tally_total"].alias("total"), at(3)["food_insulin"].alias("insulin"), F.size(at(5)["entries"]).alias("cleared_entries"), at(5)["tally_total"].alias("cleared_total"),
        F.get(at(7)["entries"], 0)["entry_id"].alias("first_id"),
    )


def context_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The context that would be shown after each order's calls."""
    rows = _replayed(spark, sf_dir).withColumn("ids", F.transform("known", lambda k: F.struct(k.alias("id"), F.concat(F.lit("food"), k).alias("name"))))
    return rows.select("conv_id", F.expr(harness.context_block("tally", "ids")).alias("block"))


def math_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stated totals, some of them wrong, that differ from the replayed ones."""
    made = _replayed(spark, sf_dir).select("conv_id", F.explode("outputs").alias("o")).where("o.tally_total IS NOT NULL").select("conv_id", "o.seq", "o.name", F.lit("tally_total").alias("key"), F.col("o.tally_total").alias("value"))
    stated = made.withColumn("value", F.col("value") + F.when(F.col("conv_id") % 6 == 1, 0.01).when(F.col("conv_id") % 6 == 2, 0.5).otherwise(0.0))
    return rules.math_errors(made, stated).select("conv_id", "seq", "name", "key")


QUERIES = {f.__name__: f for f in (tally_replay, final_dose, tally_summary, context_blocks, math_check)}

# entries of an order: made by the first call (ids 1 to n), less the first if removed, then one more by the third call
_REPLAY = f"""
    {POOL_SQL},
    l AS (SELECT l_orderkey AS conv_id, l_partkey, p_name, l_quantity, l_partkey % 3 = 0 AS piece, CASE WHEN l_orderkey % 9 = 0 OR l_partkey % 3 <> 0 THEN 'g' ELSE 'pcs' END AS unit,
                 CASE WHEN l_partkey % 3 = 0 THEN CASE WHEN l_orderkey % 9 <> 0 THEN l_quantity * (p_retailprice % 20) END ELSE l_quantity * (p_retailprice % 20) / p_size::DOUBLE END AS carbs,
                 row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(_ORDER)}) AS i FROM lineitem JOIN part ON l_partkey = p_partkey),
    r AS (SELECT *, {py_round_sql("carbs")} AS c FROM l),
    o AS (SELECT conv_id, count(*) AS n, min(i) FILTER (carbs IS NULL) AS bad, list(struct_pack(i := i, c := c, name := p_name, q := l_quantity, u := unit) ORDER BY i) AS es, conv_id % 11 = 0 AS unsearched,
                 list_sort(list_distinct(list(l_partkey))) AS ids FROM r GROUP BY conv_id),
    s AS (SELECT *, CASE WHEN unsearched THEN 'Unknown food_id: ' || (SELECT l_partkey FROM r WHERE r.conv_id = o.conv_id AND i = 1) || '. Search first.' WHEN bad IS NOT NULL THEN 'execution failed' END AS err1,
                 CASE WHEN unsearched THEN 'x' WHEN bad = 1 THEN 'execution failed' END AS err3, CASE WHEN unsearched THEN 0 WHEN bad IS NULL THEN n ELSE bad - 1 END AS used FROM o),
    e AS (SELECT *, CASE WHEN err1 IS NULL THEN es ELSE [] END AS t1 FROM s),
    f AS (SELECT *, CASE WHEN conv_id % 4 = 0 THEN list_filter(t1, lambda x: x.i <> 1) ELSE t1 END AS t2 FROM e),
    g AS (SELECT *, CASE WHEN err3 IS NULL THEN list_append(t2, struct_pack(i := used + 1, c := es[1].c, name := es[1].name, q := es[1].q, u := es[1].u)) ELSE t2 END AS t3 FROM f),
    h AS (SELECT *, list_reduce(list_prepend(0::DOUBLE, list_transform(t1, lambda x: x.c)), lambda a, b: a + b) AS s1, list_reduce(list_prepend(0::DOUBLE, list_transform(t2, lambda x: x.c)), lambda a, b: a + b) AS s2,
                 list_reduce(list_prepend(0::DOUBLE, list_transform(t3, lambda x: x.c)), lambda a, b: a + b) AS s3 FROM g)"""
_CALLS = f"""
    c AS (SELECT conv_id, 0 AS seq, '{fixed.SEARCH}' AS name, NULL AS error, NULL AS entries, NULL AS removed, NULL AS tally_total FROM h
        UNION ALL SELECT conv_id, 1, '{fixed.ADD}', err1, CASE WHEN err1 IS NULL THEN n END, NULL, CASE WHEN err1 IS NULL THEN {py_round_sql("s1")} END FROM h
        UNION ALL SELECT conv_id, 2, '{fixed.REMOVE}', NULL, NULL, len(t1) - len(t2), {py_round_sql("s2")} FROM h
        UNION ALL SELECT conv_id, 3, '{fixed.ADD}', CASE WHEN unsearched THEN err1 ELSE err3 END, CASE WHEN err3 IS NULL THEN 1 END, NULL, CASE WHEN err3 IS NULL THEN {py_round_sql("es[1].c")} END FROM h
        UNION ALL SELECT conv_id, 4, '{fixed.FINAL}', CASE WHEN len(t3) = 0 THEN 'Add at least one food first.' END, NULL, NULL, CASE WHEN len(t3) > 0 THEN {py_round_sql("s3")} END FROM h)"""

ORACLE_SQL = {
    "tally_replay": f"WITH {_REPLAY}, {_CALLS} SELECT conv_id, CAST(seq AS BIGINT) AS seq, name, error, CAST(entries AS INTEGER) AS entries, CAST(removed AS INTEGER) AS removed, tally_total FROM c",
    "final_dose": f"""
        WITH {_REPLAY},
        m AS (SELECT h.*, p.*, conv_id % 24 AS hr, CASE WHEN conv_id % 5 <> 2 THEN o_custkey % 150 + 40.5::DOUBLE END AS bg FROM h JOIN orders ON o_orderkey = conv_id JOIN pool p ON p.idx = conv_id % 5),
        q AS (SELECT *, {period_sql("hr")} AS meal_time FROM m),
        d AS (SELECT *, {DIVIDER_SQL} AS divider, len(t3) > 0 AS ok FROM q),
        x AS (SELECT *, s3 / divider AS food, CASE WHEN bg >= threshold THEN greatest(0::DOUBLE, (bg - baseline) / divisor) ELSE 0::DOUBLE END AS corr FROM d)
        SELECT conv_id, CASE WHEN NOT ok THEN 'Add at least one food first.' END AS error, CASE WHEN ok THEN {py_round_sql("s3")} END AS tally_total, CASE WHEN ok THEN meal_time END AS meal_time, CASE WHEN ok THEN divider END AS meal_divider,
               CASE WHEN ok THEN {py_round_sql("food")} END AS food_insulin, CASE WHEN ok THEN {py_round_sql("corr")} END AS glucose_correction, CASE WHEN ok THEN NOT coalesce(bg >= threshold, false) END AS glucose_skipped,
               CASE WHEN ok THEN {py_round_sql("(food + corr)")} END AS final_result, CASE WHEN ok THEN {fixed_sql("s3")} || 'g / ' || divider || ' = ' || {fixed_sql("food")} || 'U' END AS breakdown_food,
               CASE WHEN ok THEN CASE WHEN bg >= threshold THEN '(' || bg || ' - ' || baseline || ') / ' || divisor || ' = ' || {fixed_sql("corr")} || 'U' WHEN bg IS NOT NULL THEN 'BG ' || bg || ' < ' || threshold || ' threshold, correction skipped' ELSE '' END END AS breakdown_glucose FROM x""",
    "tally_summary": f"""
        WITH {_REPLAY}
        SELECT conv_id, CAST(len(t1) AS INTEGER) AS entries, s1 AS total, 0::DOUBLE AS insulin, 0 AS cleared_entries, 0::DOUBLE AS cleared_total, CASE WHEN err3 IS NULL THEN 1 END AS first_id FROM h""",
    "context_blocks": f"""
        WITH {_REPLAY}
        SELECT conv_id, CASE WHEN len(t3) = 0 THEN '[CURRENT TALLY: empty]' || chr(10) || '[KNOWN FOOD IDS: none]' ELSE '[CURRENT TALLY: ' || len(t3) || ' items, ' || {fixed_sql("s3", 1)} || 'g total]' || chr(10)
               || array_to_string(list_transform(t3, lambda x: '  ' || x.name || ' ' || x.q::VARCHAR || x.u || ' = ' || x.c::VARCHAR || 'g (entry_id: ' || x.i || ')'), chr(10))
               || chr(10) || chr(10) || '[KNOWN FOOD IDS: ' || array_to_string(list_transform(ids, lambda k: 'food' || k || '(' || k || ')'), ', ') || ']' END AS block FROM h""",
    "math_check": f"WITH {_REPLAY}, {_CALLS} SELECT conv_id, CAST(seq AS BIGINT) AS seq, name, 'tally_total' AS key FROM c WHERE tally_total IS NOT NULL AND conv_id % 6 = 2",
}
