"""All rules of a conversation together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions import fixed
from dialoom.operators import harness, rules

#: Numeric results that are compared with the replayed ones.
NUMERIC = ("tally_total", "removed", "final_result", "food_insulin", "glucose_correction", "meal_divider", "meal_hour", "blood_glucose")


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conversations(conv_id, scenario_type, language, user_settings_idx, turns)``, a row for each turn."""
    rows = conversations.select("conv_id", "scenario_type", "language", "user_settings_idx", F.posexplode("turns").alias("turn", "t"))
    return rows.select("conv_id", "scenario_type", "language", "user_settings_idx", "turn", "t.*").withColumn("n_calls", F.size("tool_calls"))


def calls_of(turns: DataFrame) -> DataFrame:
    """A row for each call of assistants' turns, with ``seq``, which orders a conversation's calls."""
    said = turns.where("role = 'assistant' AND action = 'tool_call'")
    calls = said.select("conv_id", "scenario_type", "language", "user_settings_idx", "turn", "tool_results", F.posexplode("tool_calls").alias("call", "c"))
    return calls.select("conv_id", "scenario_type", "language", "user_settings_idx", "turn", "call", "tool_results", "c.name", "c.arguments").withColumn("seq", (F.col("turn") * 1000 + F.col("call")).cast("long"))


def _number(payload: Column, name: Column, key: str) -> Column:
    return F.call_function("get_json_object", payload, F.concat(F.lit("$."), name, F.lit(f".{key}"))).try_cast("double")


def math(calls: DataFrame, foods: DataFrame, pool: DataFrame) -> DataFrame:
    """Stated results that differ from replayed ones: conv_id, seq, error."""
    asked = calls.select("conv_id", F.col("language").alias("lang"), F.col("user_settings_idx").alias("idx"), "seq", "name", "arguments")
    outputs = harness.run(asked, foods, pool).select("conv_id", F.explode("outputs").alias("o"))
    pairs = lambda get: F.array(*(F.struct(F.lit(k).alias("key"), get(k).alias("value")) for k in NUMERIC))
    expected = outputs.select("conv_id", "o.seq", "o.name", F.explode(pairs(lambda k: F.col(f"o.{k}").cast("double"))).alias("p")).select("conv_id", "seq", "name", "p.*").where("value IS NOT NULL")
    stated = calls.where("tool_results IS NOT NULL").select("conv_id", "seq", "name", F.explode(pairs(lambda k: _number(F.col("tool_results"), F.col("name"), k))).alias("p"))
    return rules.math_errors(expected, stated.select("conv_id", "seq", "name", "p.*").where("value IS NOT NULL"))


def values_of(turns: DataFrame) -> DataFrame:
    """Numbers that texts may repeat: those of tool results, arguments and users' texts: conv_id, values."""
    own = (
        F.when((F.col("role") == "tool") & F.col("tool_results").isNotNull(), rules.json_numbers(F.col("tool_results")))
        .when(F.col("role") == "user", rules.user_numbers(F.coalesce("content", F.lit(""))))
        .otherwise(F.array().cast("array<double>"))
    )
    arguments = F.when(F.col("action") == "tool_call", F.concat(F.lit("["), F.array_join(F.transform("tool_calls", lambda c: c["arguments"]), ","), F.lit("]")))
    rows = turns.withColumn("asked", rules.json_numbers(F.coalesce(arguments, F.lit("[]"))))
    return rows.select("conv_id", F.concat(own, "asked").alias("v")).groupBy("conv_id").agg(F.array_distinct(F.flatten(F.collect_list("v"))).alias("values"))


def errors(conversations: DataFrame, foods: DataFrame, pool: DataFrame) -> DataFrame:
    """What is wrong with each conversation, rule by rule: conv_id, errors (empty if it is valid)."""
    turns = turns_of(conversations)
    calls = calls_of(turns)
    exempt = F.col("scenario_type") == "GLUCOSE_ONLY_CHECK"
    row = lambda df, rule, error=None, at="turn": df.select("conv_id", F.lit(rule).alias("rule"), F.col(at).cast("long").alias("at"), (error if error is not None else F.col("error")).alias("error"))
    items = rules.added_ids(calls)
    unknown = rules.unknown_ids(items.drop("unit"), rules.context_ids(turns).unionByName(rules.searched_ids(turns)))
    dim = foods.select("lang", "id", "name", "has_grams_mode", "has_pieces_mode")
    langs = conversations.select("conv_id", F.col("language").alias("lang"))
    by_lang = items.join(langs, "conv_id").join(dim.withColumnRenamed("name", "food"), ["lang", "id"])
    weighed = F.col("unit").isin(*fixed.WEIGHED) & ~F.col("has_grams_mode")
    counted = F.col("unit").isin(*fixed.COUNTED) & ~F.col("has_pieces_mode")
    units = by_lang.where((F.col("has_grams_mode") | F.col("has_pieces_mode")) & (weighed | counted))
    unit_text = F.concat(F.lit("food_id "), F.col("id"), F.lit(" ("), F.col("food"), F.lit("): unit '"), F.col("unit"), F.when(weighed, "' used but food has no grams/ml mode").otherwise("' used but food has no piece mode"))
    numbers = turns.where("role = 'assistant' AND action = 'text'").select("conv_id", "turn", F.explode(rules.text_numbers(F.coalesce("content", F.lit("")))).alias("number"))
    unmatched = rules.unmatched_numbers(numbers, values_of(turns))
    number_text = F.concat(F.lit("Turn "), F.col("turn"), F.lit(": number "), F.col("number"), F.lit(" in assistant text does not match any tool result or argument"))
    whole = conversations.select("conv_id", "language", F.array_join(F.transform("turns", lambda t: F.coalesce(t["content"], F.lit(""))), " ").alias("text"))
    length = whole.select("conv_id", F.lit(0).alias("turn"), rules.length_error(rules.estimated_length(F.col("text"), F.col("language"))).alias("error")).where("error IS NOT NULL")
    parts = [
        row(rules.tool_order(calls, exempt=exempt), 0),
        row(unknown, 1, F.concat(F.lit("food_id "), F.col("id"), F.lit(" not in known IDs"))),
        row(units, 3, unit_text),
        row(math(calls, foods, pool), 4, at="seq"),
        row(unmatched, 5, number_text),
        row(length, 6),
        row(rules.empty_turns(turns), 7),
        row(rules.missing_context(turns), 8),
        row(rules.long_utterances(turns), 9),
    ]
    found = reduce(DataFrame.unionByName, parts).groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rule", "at", "error"))), lambda e: e["error"]).alias("errors"))
    return conversations.select("conv_id").join(found, "conv_id", "left").withColumn("errors", F.coalesce("errors", F.array().cast("array<string>")))
