"""Row expressions: rounding, units, numbers, categories, doses, durations, costs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions import fixed, foodtext
from dialoom.functions.exact import fixed_sql, number_sql, py_round_sql
from dialoom.operators import generation
from dialoom.operators.harness import period_sql, settings
from dialoom.plans.tables import table

_PRODUCT = "l_extendedprice * l_discount / 7"
_UNITS = [*fixed.GRAM_UNITS, *fixed.COUNT_UNITS, "xíc", "bunch"]
_WORDS = [*fixed.DAIRY, *fixed.LEGUMES, *fixed.STARCHY, "plum", "rice"]


def py_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Python's rounding and formatting of products."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.expr(_PRODUCT).alias("x"))
    return rows.selectExpr("l_orderkey", "l_linenumber", "l_partkey", *(f"{py_round_sql('x', d)} AS r{d}" for d in (0, 1, 2)), f"{fixed_sql('x')} AS shown")


def number_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers for running text."""
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{number_sql('o_totalprice')} AS shown", f"{number_sql('floor(o_totalprice) / 4')} AS quarter")


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = F.element_at(F.array(*map(F.lit, _UNITS)), (F.col("p_partkey") % len(_UNITS) + 1).cast("int"))
    number = F.concat(F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 3 == 0, ",5").when(F.col("p_partkey") % 3 == 1, "/2").otherwise(""))
    raw = F.concat(F.lit("  "), number, F.lit(" "), F.when((F.col("p_partkey") % 2 == 0) & unit.rlike("^[a-z]+$"), F.upper(unit)).otherwise(unit), F.lit(" "))
    return table(spark, sf_dir, "part").select("p_partkey", raw.alias("raw"))


def unit_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units and numbers of quantities written in many ways."""
    raw = F.col("raw")
    return _cells(spark, sf_dir).select(
        "p_partkey",
        foodtext.leading_number(raw).alias("number"),
        foodtext.fraction(raw).alias("fraction"),
        foodtext.gram_unit(foodtext.unit_text(raw)).alias("gram_unit"),
        foodtext.count_unit(foodtext.unit_text(raw)).alias("count_unit"),
        foodtext.is_liquid(raw).alias("is_liquid"),
    )


def category_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories and rates of foods by name and carbs."""
    name = F.concat(F.col("p_name"), F.lit(" "), F.element_at(F.array(*map(F.lit, _WORDS)), (F.col("p_partkey") % len(_WORDS) + 1).cast("int")))
    rows = table(spark, sf_dir, "part").select("p_partkey", name.alias("name"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_size").cast("double")).alias("grams"), (F.col("p_retailprice") % 20).alias("carbs"))
    return rows.select("p_partkey", foodtext.category(F.col("name"), F.col("grams"), F.col("carbs")).alias("category"), foodtext.carbs_per_100g("grams", "carbs").alias("carbs_per_100g"))


def meal_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by the day's period, whose ranges go over midnight."""
    rows = table(spark, sf_dir, "events").withColumn("h", F.hour("ts"))
    return rows.groupBy(F.expr(period_sql("h")).alias("period")).agg(F.count("*").alias("n"), F.min("h").alias("least"), F.max("h").alias("largest"))


def dose_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doses from totals, glucose and settings dealt by order."""
    pool = settings(spark)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_orderkey") % 5).cast("int").alias("idx"), (F.col("o_totalprice") / 1000).alias("total"), (F.col("o_custkey") % 150 + F.lit(40.5)).alias("glucose"), (F.col("o_orderkey") % 24).cast("int").alias("h")
    )
    rows = orders.join(F.broadcast(pool), "idx").withColumn("meal_time", F.expr(period_sql("h"))).withColumn("divider", F.col("dividers")[F.col("meal_time")])
    return rows.select("o_orderkey", "meal_time", "divider", F.expr(generation.final_dose_sql("total", "divider", "glucose", "threshold", "baseline", "divisor")).alias("dose"), (F.col("glucose") < F.col("threshold")).alias("skipped"))


def duration_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values as hours, minutes and seconds."""
    return table(spark, sf_dir, "events").select("event_id", generation.duration(F.col("value") * 97 - 60).alias("shown"))


def token_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens asked and answered in each conversation, and what they cost."""
    turns = table(spark, sf_dir, "conversations").withColumn("t", F.floor(F.length("text") / 4))
    per = turns.groupBy("conv_id").agg(*(F.coalesce(F.sum(F.when(F.col("role") == r, F.col("t"))), F.lit(0)).alias(n) for r, n in (("user", "tokens_in"), ("assistant", "tokens_out"))))
    return per.withColumn("cost", generation.cost(F.col("tokens_in"), F.col("tokens_out")))


def step_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training steps of each source and steps between checkpoints."""
    per = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    steps, every = generation.training_steps(F.col("n"), F.lit(8), F.lit(3))
    return per.select("source", steps.cast("long").alias("steps"), every.cast("long").alias("save_every"))


QUERIES = {f.__name__: f for f in (py_rounding, number_format, unit_normalize, category_case, meal_period, dose_projection, duration_format, token_cost, step_arithmetic)}


def _map(values: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in values.items()) + "}"


def _list(values: list[str]) -> str:
    return "list_value(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _has(words: tuple[str, ...]) -> str:
    return "(" + " OR ".join("contains(lower(name), '" + w.replace("'", "''") + "')" for w in words) + ")"


_POOL = ", ".join(f"({i}, {t}::DOUBLE, {b}::DOUBLE, {d}::DOUBLE, {m}, {n}, {e})" for i, (t, b, d, m, n, e) in enumerate(fixed.SETTINGS))
POOL_SQL = f"pool(idx, threshold, baseline, divisor, morning, midday, evening) AS (VALUES {_POOL})"
DIVIDER_SQL = "CASE meal_time WHEN 'morning' THEN morning WHEN 'midday' THEN midday ELSE evening END"

ORACLE_SQL = {
    "py_rounding": f"""
        WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, {_PRODUCT} AS x FROM lineitem)
        SELECT l_orderkey, l_linenumber, l_partkey, {", ".join(f"{py_round_sql('x', d)} AS r{d}" for d in (0, 1, 2))}, {fixed_sql("x")} AS shown FROM r""",
    "number_format": f"SELECT o_orderkey, {number_sql('o_totalprice')} AS shown, {number_sql('(floor(o_totalprice) / 4)')} AS quarter FROM orders",
    "unit_normalize": f"""
        WITH u AS (SELECT p_partkey, {_list(_UNITS)}[CAST(p_partkey % {len(_UNITS)} AS BIGINT) + 1] AS unit, p_size || CASE p_partkey % 3 WHEN 0 THEN ',5' WHEN 1 THEN '/2' ELSE '' END AS n FROM part),
        r AS (SELECT p_partkey, '  ' || n || ' ' || CASE WHEN p_partkey % 2 = 0 AND regexp_full_match(unit, '[a-z]+') THEN upper(unit) ELSE unit END || ' ' AS raw FROM u),
        s AS (SELECT p_partkey, raw, trim(raw) AS t, nullif(trim(regexp_extract(trim(raw), '(?s)^[0-9.,/ ]+(.*)$', 1)), '') AS unit FROM r),
        f AS (SELECT *, TRY_CAST(replace(regexp_extract(t, '^[0-9]+([.,][0-9]+)?'), ',', '.') AS DOUBLE) AS number, TRY_CAST(regexp_extract(t, '^[0-9]+(?:[.,][0-9]+)?\\s*/\\s*([0-9]+)', 1) AS DOUBLE) AS below FROM s)
        SELECT p_partkey, number, CASE WHEN below > 0 THEN number / below ELSE number END AS fraction, coalesce({_map(fixed.GRAM_UNITS)}[lower(unit)], unit) AS gram_unit,
               coalesce({_map(fixed.COUNT_UNITS)}[lower(unit)], unit) AS count_unit, contains(lower(raw), 'ml') AS is_liquid FROM f""",
    "category_case": f"""
        WITH r AS (SELECT p_partkey, p_name || ' ' || {_list(_WORDS)}[CAST(p_partkey % {len(_WORDS)} AS BIGINT) + 1] AS name, CASE WHEN p_partkey % 2 = 0 THEN p_size::DOUBLE END AS grams, p_retailprice % 20 AS carbs FROM part)
        SELECT p_partkey, CASE WHEN {_has(fixed.DAIRY)} THEN 'dairy' WHEN {_has(fixed.LEGUMES)} THEN 'legumes' WHEN {_has(fixed.STARCHY)} AND grams IS NULL THEN 'starchy_vegetables'
               WHEN carbs <= 5.5 THEN 'vegetables' WHEN carbs BETWEEN 12 AND 16 THEN 'fruits' ELSE 'other' END AS category,
               CASE WHEN grams > 0 THEN {py_round_sql("(carbs / grams * 100)")} END AS carbs_per_100g FROM r""",
    "meal_period": f"WITH r AS (SELECT CAST(hour(ts) AS INTEGER) AS h FROM events) SELECT {period_sql('h')} AS period, count(*) AS n, min(h) AS least, max(h) AS largest FROM r GROUP BY 1",
    "dose_projection": f"""
        WITH {POOL_SQL},
        o AS (SELECT o_orderkey, o_orderkey % 5 AS idx, o_totalprice / 1000 AS total, o_custkey % 150 + 40.5::DOUBLE AS glucose, o_orderkey % 24 AS h FROM orders),
        m AS (SELECT *, {period_sql("h")} AS meal_time FROM o JOIN pool USING (idx)),
        d AS (SELECT *, {DIVIDER_SQL} AS divider FROM m)
        SELECT o_orderkey, meal_time, divider, {generation.final_dose_sql("total", "divider", "glucose", "threshold", "baseline", "divisor")} AS dose, glucose < threshold AS skipped FROM d""",
    "duration_format": """
        WITH r AS (SELECT event_id, greatest(0, CAST(floor(value * 97 - 60) AS BIGINT)) AS s FROM events)
        SELECT event_id, CASE WHEN s >= 3600 THEN s // 3600 || 'h ' || s % 3600 // 60 || 'm ' || s % 60 || 's' WHEN s >= 60 THEN s // 60 || 'm ' || s % 60 || 's' ELSE s || 's' END AS shown FROM r""",
    "token_cost": f"""
        WITH p AS (SELECT conv_id, CAST(coalesce(sum(length(text) // 4) FILTER (role = 'user'), 0) AS BIGINT) AS tokens_in, CAST(coalesce(sum(length(text) // 4) FILTER (role = 'assistant'), 0) AS BIGINT) AS tokens_out FROM conversations GROUP BY conv_id)
        SELECT *, tokens_in / 1e6::DOUBLE * {fixed.PRICE_IN}::DOUBLE + tokens_out / 1e6::DOUBLE * {fixed.PRICE_OUT}::DOUBLE AS cost FROM p""",
    "step_arithmetic": """
        WITH s AS (SELECT source, CAST(ceil(count(*) / 8.0) * 3 AS BIGINT) AS steps FROM documents GROUP BY source)
        SELECT source, steps, greatest(50, steps // 3) AS save_every FROM s""",
}
