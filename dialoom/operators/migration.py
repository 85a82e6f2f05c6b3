"""Rewriting stored conversations: settings dealt anew, tool results computed again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom import folders
from dialoom.functions import fixed
from dialoom.operators import asof, assembly, harness, render, validate


def with_settings(rows: DataFrame, by: str = "file", order: str = "line_no") -> DataFrame:
    """Readable conversations with the settings of their place in their file, in turn."""
    return assembly.rotate(rows.drop("user_settings_idx"), [by], order, len(fixed.SETTINGS), "user_settings_idx")


def searched(asked: DataFrame, foods: DataFrame) -> DataFrame:
    """What searches show, in JSON: conv_id, seq, results. ``asked(conv_id, lang, seq, name, arguments)``; each different
    (language, query) is searched once."""
    queries = asked.where(F.col("name") == fixed.SEARCH).select("conv_id", "lang", "seq", F.posexplode(F.from_json("arguments", harness.ARGUMENTS)["queries"]).alias("i", "query"))
    cells = ("id", "name", "carbs_per_100g", "carbs_per_piece", "has_grams_mode", "has_pieces_mode", "gram_unit", "piece_unit")
    shown = foods.select(F.col("lang").alias("food_lang"), "id", F.lower("name").alias("lower"), render.search_result({c: F.col(c) for c in cells}).alias("text"))
    kinds = queries.select("lang", "query").distinct()
    hits = kinds.join(shown, (F.col("lang") == F.col("food_lang")) & F.contains("lower", F.lower("query")))
    listed = lambda of, text: F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(of)), lambda x: x[text]), ", "), F.lit("]"))
    hits = hits.groupBy("lang", "query").agg(listed(F.struct("id", "text"), "text").alias("found"))
    rows = queries.join(hits, ["lang", "query"], "left").withColumn("found", F.coalesce("found", F.lit("[]")))
    return rows.groupBy("conv_id", "seq").agg(listed(F.struct("i", "found"), "found").alias("results"))


def _result(o: str) -> Column:
    """The result of one replayed call as its tool gives it, in JSON."""
    cell = lambda *names: [F.col(f"{o}.{n}").alias(n) for n in names]
    text = lambda *cells: F.to_json(F.struct(*cells), {"ignoreNullFields": "false"})
    settings = [F.col(c) for c in ("threshold", "baseline", "divisor")]
    dose = text(
        *cell("final_result", "food_insulin", "glucose_correction", "glucose_skipped", "tally_total", "meal_divider", "meal_time", "meal_hour", "blood_glucose"), *settings, *cell("breakdown_food", "breakdown_glucose")
    )
    summary = text(
        F.col(f"{o}.entries").alias("entries"), F.col(f"{o}.tally_total").alias("total_carbs"), *cell("food_insulin", "meal_time", "meal_hour", "blood_glucose"), F.col(f"{o}.blood_glucose").isNotNull().alias("glucose_enabled")
    )
    name = F.col(f"{o}.name")
    return (
        F.when(F.col(f"{o}.error").isNotNull(), text(*cell("error")))
        .when(name == fixed.SEARCH, F.concat(F.lit('{"results": '), F.coalesce("results", F.lit("[]")), F.lit("}")))
        .when(name == fixed.ADD, text(*cell("entries", "tally_total")))
        .when(name == fixed.REMOVE, text(*cell("removed", "tally_total")))
        .when(name == fixed.FINAL, dose)
        .when(name == fixed.SUMMARY, summary)
        .otherwise('{"success": true}')
    )


def recompute(conversations: DataFrame, foods: DataFrame, pool: DataFrame) -> DataFrame:
    """Conversations ``(conv_id, scenario_type, language, user_settings_idx, turns)`` whose tool results are those of a
    replay: on the assistant's turn by tool (the last call of a tool wins) and copied to the next tool turn. Results
    that no call gave stay. Keys are in order of their names; numbers are doubles."""
    turns = validate.turns_of(conversations)
    calls = validate.calls_of(turns)
    asked = calls.select("conv_id", F.col("language").alias("lang"), F.coalesce("user_settings_idx", F.lit(0)).alias("idx"), "seq", "name", "arguments")
    outputs = harness.run(asked, foods, pool).select("conv_id", "idx", F.explode("outputs").alias("o")).withColumn("seq", F.col("o.seq"))
    rows = outputs.join(pool.select("idx", "threshold", "baseline", "divisor"), "idx", "left").join(searched(asked, foods), ["conv_id", "seq"], "left")
    made = rows.select("conv_id", F.floor(F.col("seq") / 1000).cast("int").alias("turn"), F.col("seq"), F.col("o.name").alias("key"), _result("o").alias("value"))
    made = made.groupBy("conv_id", "turn", "key").agg(F.max(F.struct("seq", "value"))["value"].alias("value"))
    made = folders.saved(made, "recompute")  # read several times below, while the replay runs once
    there = turns.select("conv_id", "turn", F.explode(F.from_json("tool_results", "map<string,string>")).alias("key", "value"))
    # what an assistant's turn had besides goes along to the next tool turn
    own = there.join(turns.where("role = 'assistant'").select("conv_id", "turn"), ["conv_id", "turn"], "left_semi").join(made.select("conv_id", "turn", "key"), ["conv_id", "turn", "key"], "left_anti").unionByName(made)
    copied = asof.copy_forward(own, turns.select("conv_id", "turn", "role")).withColumnRenamed("target", "turn")
    new = made.unionByName(copied)
    every = new.unionByName(there.join(new.select("conv_id", "turn", "key"), ["conv_id", "turn", "key"], "left_anti"))
    pair = F.concat(F.to_json(F.struct(F.col("key").alias("k"))).substr(F.lit(6), F.length(F.to_json(F.struct(F.col("key").alias("k")))) - 6), F.lit(": "), "value")
    texts = every.groupBy("conv_id", "turn").agg(F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("key", pair.alias("t")))), lambda x: x["t"]), ", "), F.lit("}")).alias("new"))
    back = turns.join(texts, ["conv_id", "turn"], "left").withColumn("tool_results", F.coalesce("new", "tool_results"))
    turn = F.struct("role", "content", "action", "tool_calls", "tool_results", "context_block")
    whole = back.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", turn.alias("t")))), lambda x: x["t"]).alias("turns"))
    return conversations.drop("turns").join(whole, "conv_id", "left").select(conversations.columns)
