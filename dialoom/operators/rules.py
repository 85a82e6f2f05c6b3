"""Conversation rules. Each takes exploded turns or calls and gives a row for each violation; a conversation is
valid if no rule has a row for it. Positions order turns and calls: ``turn`` and ``call`` count from 0.

Expected columns: calls(conv_id, turn, call, name, arguments), turns(conv_id, turn, role, action, content,
context_block, tool_results), foods as read by ``sources.readers.foods``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from dialoom.functions import fixed
from dialoom.functions.exact import tokens_estimate
from dialoom.operators.harness import ARGUMENTS
from dialoom.sources.schemas import ACTIONS, ROLES

# A tool, the tool that must come before it, and what is said if it doesn't.
BEFORE = (
    (fixed.FINAL, fixed.ADD, "calculate_final called before add_foods_to_tally"),
    (fixed.ADD, fixed.SEARCH, "add_foods_to_tally called before search_foods"),
    (fixed.REMOVE, fixed.ADD, "remove_foods_to_tally called before add_foods_to_tally"),
)


def tool_order(calls: DataFrame, before: tuple[tuple[str, str, str], ...] = BEFORE, exempt: Column | None = None) -> DataFrame:
    """The first call of each conversation that comes before the tool it needs: conv_id, turn, call, error.

    The first positions of needed tools are aggregated (small, combined before the shuffle), so that no window
    over whole conversations is needed. ``exempt`` frees conversations' final calculation from its rule.
    """
    at = F.struct("turn", "call")
    needed = sorted({b for _, b, _ in before})
    firsts = calls.where(F.col("name").isin(needed)).groupBy("conv_id").agg(*(F.min(F.when(F.col("name") == n, at)).alias(f"first_{n}") for n in needed))
    error = F.lit(None).cast("string")
    for tool, need, text in reversed(before):
        late = (F.col("name") == tool) & (F.col(f"first_{need}").isNull() | (F.col(f"first_{need}") >= at))
        if exempt is not None and tool == fixed.FINAL:
            late = late & ~exempt
        error = F.when(late, text).otherwise(error)
    bad = calls.where(F.col("name").isin([t for t, _, _ in before])).join(firsts, "conv_id", "left").withColumn("error", error).where("error is not null")
    first = bad.groupBy("conv_id").agg(F.min(F.struct("turn", "call", "error")).alias("v"))
    return first.select("conv_id", "v.turn", "v.call", "v.error")


def unknown_ids(used: DataFrame, known: DataFrame) -> DataFrame:
    """``used(conv_id, turn, call, item, id)`` that ``known(conv_id, turn, id)`` doesn't have at an earlier turn (or in the same).

    Only the first turn at which an id is known matters, so the join is one to one on (conversation, id).
    """
    first = known.groupBy("conv_id", "id").agg(F.min("turn").alias("since"))
    return used.join(first, ["conv_id", "id"], "left").where(F.col("since").isNull() | (F.col("since") > F.col("turn"))).select("conv_id", "turn", "call", "item", "id")


def context_ids(turns: DataFrame) -> DataFrame:
    """Ids in parentheses of user turns' context: conv_id, turn, id."""
    found = F.regexp_extract_all("context_block", F.lit(r"(?U)\((\d+)\)"), F.lit(1))
    return turns.where("role = 'user'").select("conv_id", "turn", F.explode(found).alias("id")).withColumn("id", F.col("id").cast("int"))


def searched_ids(turns: DataFrame) -> DataFrame:
    """Ids that tool turns' search results show: conv_id, turn, id."""
    ids = F.from_json(F.get_json_object("tool_results", f"$.{fixed.SEARCH}.results"), "array<array<struct<id int>>>")
    return turns.where("role = 'tool'").select("conv_id", "turn", F.explode(F.flatten(ids)).alias("f")).select("conv_id", "turn", F.col("f.id").alias("id")).where("id is not null")


def added_ids(calls: DataFrame) -> DataFrame:
    """Items that calls add: conv_id, turn, call, item, id, unit."""
    items = calls.where(F.col("name") == fixed.ADD).select("conv_id", "turn", "call", F.posexplode(F.from_json("arguments", ARGUMENTS)["items"]).alias("item", "i"))
    return items.select("conv_id", "turn", "call", "item", F.col("i.food_id").alias("id"), F.col("i.unit").alias("unit"))


def food_ids(calls: DataFrame, corrected: bool = False) -> DataFrame:
    """Foods that conversations name, each once: conv_id, id (text). By default what calls search for, and a ``food_id``
    that an addition itself has; ``corrected`` takes the ids of the added items instead of that."""
    searched = F.when(F.col("name") == fixed.SEARCH, F.from_json("arguments", ARGUMENTS)["queries"])
    if corrected:
        added = F.transform(F.from_json("arguments", ARGUMENTS)["items"], lambda i: i["food_id"].cast("string"))
    else:
        own = F.get_json_object("arguments", "$.food_id")
        added = F.when(~F.coalesce(own.isin("", "0", "false"), F.lit(True)), F.array(own))
    found = F.coalesce(searched, F.when(F.col("name") == fixed.ADD, added))
    return calls.select("conv_id", F.explode(found).alias("id")).where("id IS NOT NULL").distinct()


def unit_errors(items: DataFrame, foods: DataFrame) -> DataFrame:
    """Items ``(…, id, unit)`` whose unit the food has no quantity for; unknown foods and units are passed over."""
    dim = foods.select("id", F.col("name").alias("food"), "has_grams_mode", "has_pieces_mode")
    weighed = F.col("unit").isin(*fixed.WEIGHED) & ~F.col("has_grams_mode")
    counted = F.col("unit").isin(*fixed.COUNTED) & ~F.col("has_pieces_mode")
    rows = items.join(dim, "id").where((F.col("has_grams_mode") | F.col("has_pieces_mode")) & (weighed | counted))
    text = F.concat(F.lit("food_id "), F.col("id"), F.lit(" ("), F.col("food"), F.lit("): unit '"), F.col("unit"), F.when(weighed, "' used but food has no grams/ml mode").otherwise("' used but food has no piece mode"))
    return rows.withColumn("error", text)


def matches_number(number: Column, value: Column) -> Column:
    """Whether a number in a text stands for a value: nearly equal, or equal when rounded half to even."""
    near = F.abs(number - value)
    return (near < 0.05) | ((near < 1.0) & (F.rint(number) == F.rint(value)))


def unmatched_numbers(numbers: DataFrame, values: DataFrame) -> DataFrame:
    """``numbers(conv_id, turn, number)`` of at least 0.01 that stand for no value of ``values(conv_id, values array)``."""
    rows = numbers.where("number >= 0.01").join(values, "conv_id", "left")
    found = F.exists(F.coalesce("values", F.array().cast("array<double>")), lambda v: matches_number(F.col("number"), v))
    return rows.where(~found).select("conv_id", "turn", "number")


def text_numbers(content: Column) -> Column:
    """Numbers of an assistant's text."""
    return F.transform(F.regexp_extract_all(content, F.lit(r"(?U)\d+\.\d+|\d+"), F.lit(0)), lambda x: x.cast("double"))


def user_numbers(content: Column) -> Column:
    """Numbers of a user's text; a trailing point belongs to the number."""
    return F.transform(F.regexp_extract_all(content, F.lit(r"(?U)\d+\.?\d*"), F.lit(0)), lambda x: x.cast("double"))


def _json_numbers(payloads: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """All numbers of a JSON value at any depth; true and false count as 1 and 0."""
    def walk(x, out):
        if isinstance(x, (bool, int, float)):
            out.append(float(x))
        elif isinstance(x, dict):
            for v in x.values():
                walk(v, out)
        elif isinstance(x, list):
            for v in x:
                walk(v, out)
        return out

    def one(text):
        try:
            return walk(json.loads(text), []) if text else []
        except ValueError:
            return []

    for part in payloads:
        yield pd.Series([one(x) for x in part])


json_numbers = F.pandas_udf(_json_numbers, T.ArrayType(T.DoubleType()))


def length_error(tokens: Column, least: int = 20, most: int = 2560) -> Column:
    """What is wrong with a conversation's estimated length; null if nothing."""
    return F.when(tokens < least, F.concat(F.lit("Too short: ~"), tokens.cast("string"), F.lit(" tokens"))).when(tokens > most, F.concat(F.lit("Too long: ~"), tokens.cast("string"), F.lit(" tokens")))


def estimated_length(text: Column, language: Column) -> Column:
    """Characters for Chinese, Japanese and Hindi, a quarter of them for others."""
    return F.when(language.isin("zh", "ja", "hi"), F.length(text).cast("long")).otherwise(F.floor(F.length(text) / 4))


def first_violation(turns: DataFrame, wrong: Column, text: Column) -> DataFrame:
    """The first turn of each conversation for which ``wrong`` holds: conv_id, turn, error."""
    bad = turns.where(F.coalesce(wrong, F.lit(False))).select("conv_id", F.struct("turn", F.concat(F.lit("Turn "), F.col("turn"), F.lit(": "), text).alias("error")).alias("v"))
    return bad.groupBy("conv_id").agg(F.min("v").alias("v")).select("conv_id", "v.turn", "v.error")


def blank(x: Column) -> Column:
    return F.coalesce(x, F.lit("")) == ""


def empty_turns(turns: DataFrame) -> DataFrame:
    """First turn without content (or without calls, given ``n_calls``)."""
    user = (F.col("role") == "user") & blank(F.col("content"))
    text = (F.col("role") == "assistant") & (F.col("action") == "text") & blank(F.col("content"))
    calls = (F.col("role") == "assistant") & (F.col("action") == "tool_call") & (F.coalesce("n_calls", F.lit(0)) == 0)
    return first_violation(turns, user | text | calls, F.when(user, "empty user content").when(text, "empty assistant text").otherwise("empty tool calls"))


def missing_context(turns: DataFrame) -> DataFrame:
    return first_violation(turns, (F.col("role") == "user") & blank(F.col("context_block")), F.lit("missing context_block in user message"))


def long_utterances(turns: DataFrame, most: int = 100) -> DataFrame:
    """User turns of more than about ``most`` tokens: conv_id, turn, tokens, error."""
    rows = turns.where("role = 'user'").withColumn("tokens", tokens_estimate(F.col("content"))).where(F.col("tokens") > most)
    text = F.concat(F.lit("Turn "), F.col("turn"), F.lit(": user utterance ~"), F.col("tokens"), F.lit(f" tokens (max ~{most})"))
    return rows.select("conv_id", "turn", "tokens", text.alias("error"))


def unreplaced(turns: DataFrame) -> DataFrame:
    """Placeholders left in assistants' texts: conv_id, turn, placeholder, error."""
    found = F.regexp_extract_all("content", F.lit(r"(?U)\{\{(\w+)\}\}"), F.lit(1))
    rows = turns.where("role = 'assistant'").select("conv_id", "turn", F.explode(found).alias("placeholder"))
    return rows.withColumn("error", F.concat(F.lit("Turn "), F.col("turn"), F.lit(": unreplaced placeholder {{"), F.col("placeholder"), F.lit("}}")))


def known_kinds(role: Column, action: Column) -> Column:
    """Whether role and action are of the schema."""
    return F.coalesce(role.isin(*ROLES), F.lit(False)) & (action.isNull() | action.isin(*ACTIONS))


def math_errors(expected: DataFrame, actual: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """Numeric results ``(conv_id, seq, name, key, value)`` that differ from the replayed ones by more than the tolerance."""
    a = actual.select("conv_id", "seq", "name", "key", F.col("value").alias("got"))
    rows = expected.join(a, ["conv_id", "seq", "name", "key"]).where(F.abs(F.col("value") - F.col("got")) > tolerance)
    return rows.withColumn("error", F.concat(F.lit("Math mismatch for "), F.col("name"), F.lit("."), F.col("key"), F.lit(": expected "), F.col("value"), F.lit(", got "), F.col("got")))


def entry_ids(calls: DataFrame, outputs: DataFrame, strict: bool = False) -> DataFrame:
    """Removed entries that no earlier call made. By default nothing is reported, as the rule is only declared;
    ``strict`` applies it. ``outputs(conv_id, seq, entry_id)`` has made entries, ``calls`` has seq."""
    removed = calls.where(F.col("name") == fixed.REMOVE).select("conv_id", "seq", F.explode(F.from_json("arguments", ARGUMENTS)["entry_ids"]).alias("entry_id"))
    made = outputs.groupBy("conv_id", "entry_id").agg(F.min("seq").alias("since"))
    bad = removed.join(made, ["conv_id", "entry_id"], "left").where(F.col("since").isNull() | (F.col("since") >= F.col("seq")))
    return (bad if strict else bad.limit(0)).select("conv_id", "seq", "entry_id")


def unexpected_sequences(calls: DataFrame, expected: dict[str, list[list[str]]]) -> DataFrame:
    """Conversations ``(conv_id, scenario, turn, call, name)`` whose order of tools isn't one expected of their scenario."""
    seen = calls.groupBy("conv_id", "scenario").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "call", "name"))), lambda x: x["name"]).alias("tools"))
    ok = F.lit(False)
    for scenario, ways in expected.items():
        ok = ok | ((F.col("scenario") == scenario) & F.array_join("tools", ",").isin([",".join(w) for w in ways]))
    return seen.where(~ok)


def running_seen(calls: DataFrame, name: str) -> DataFrame:
    """Whether a tool was called earlier in the conversation, as a running flag."""
    w = Window.partitionBy("conv_id").orderBy("turn", "call").rowsBetween(Window.unboundedPreceding, -1)
    return calls.withColumn("seen", F.coalesce(F.max(F.col("name") == name).over(w), F.lit(False)))
