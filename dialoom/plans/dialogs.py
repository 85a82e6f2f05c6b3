"""Conversations of the full schema, made of orders: rendered with calls and results, parsed, evaluated, computed again."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom import folders
from dialoom.functions import fixed, pyjson
from dialoom.functions.exact import py_round_sql
from dialoom.operators import asof, audit, evaluation, generation, harness, migration, render, rules, scoring, spans
from dialoom.plans.scalar import POOL_SQL
from dialoom.plans.tables import table
from dialoom.sources.schemas import TURN
from dialoom.streaming import streams

_K = "CAST(o_orderkey % {} AS STRING)"


def _turn(**cells: str) -> str:
    kinds = ("role", "content", "action", "tool_calls", "tool_results", "context_block")
    return f"CAST(named_struct({', '.join(f'{k!r}, {cells.get(k, 'NULL')}' for k in kinds)}) AS {TURN})"


# raw payloads of an order; their spacing isn't that of the rendered text
_SEARCH = f"""concat('{{"queries":["a', {_K.format(7)}, '",  "b, c"], "n":', {_K.format(5)}, ', "x": 1.50, "flag":true, "none": null}}')"""
_ADD = f"""concat('{{"items": [{{"food_id":', {_K.format(9)}, ', "unit": "g"}}], "empty":[ ]}}')"""
_TOOL = f"""concat('{{"search":{{"total":', {_K.format(11)}, ', "rows": [[1,{{"id":', {_K.format(9)}, '}}]], "s":"é\\\\"x"}}}}')"""


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = [
        _turn(role="'user'", content="concat('order ', CAST(o_orderkey AS STRING))", context_block="if(o_orderkey % 3 = 0, NULL, '[CURRENT TALLY: empty]')"),
        _turn(role="'assistant'", action="'tool_call'", tool_calls=f"array(named_struct('name', 'search', 'arguments', {_SEARCH}), named_struct('name', 'add', 'arguments', {_ADD}))"),
        _turn(role="'tool'", tool_results=_TOOL),
        _turn(role="'tool'", tool_results="'{}'"),
        _turn(role="'assistant'", action="'text'", content="if(o_orderkey % 4 = 0, NULL, concat('done ', CAST(o_orderkey AS STRING)))"),
    ]
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey AS conv_id", "o_custkey % 3 AS c", f"array({', '.join(turns)}) AS turns")


def _full(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    return render.full_conversation(_conversations(spark, sf_dir), model, F.concat(F.lit("Prompt "), F.col("c")))


def full_chatml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as conversations with two calls in a turn, results and context, in the one format."""
    return _full(spark, sf_dir, "chatml")


def full_gemma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in the other format, results indented."""
    return _full(spark, sf_dir, "gemma")


def parsed_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls read back from rendered texts: strings, lists, numbers and the rest, and the other format's JSON."""
    own = evaluation.parsed(full_chatml(spark, sf_dir), "chatml").where("name IS NOT NULL").select("conv_id", "name", F.get_json_object("arguments", "$.queries[1]").alias("second"), F.get_json_object("arguments", "$.n").cast("long").alias("n"), F.get_json_object("arguments", "$.flag").alias("flag"))
    events = table(spark, sf_dir, "events").select("event_id", pyjson.gemma_turn_call(F.concat(F.lit("I call f("), F.when(F.col("event_id") % 5 == 0, "{bad}").otherwise(F.col("props")), F.lit(") now"))).alias("c"))
    other = events.select(F.col("event_id").alias("conv_id"), "c.name", F.lit(None).cast("string").alias("second"), F.get_json_object("c.arguments", "$.k").cast("long").alias("n"), F.lit(None).cast("string").alias("flag"))
    return own.withColumn("kind", F.lit("chatml")).unionByName(other.withColumn("kind", F.lit("gemma")))


def argument_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists in calls: of numbers, of texts, and of what is no JSON but has quoted parts."""
    e = F.col("event_id")
    inner = F.when(e % 3 == 0, F.concat(e, F.lit(", 2.5"))).when(e % 3 == 1, F.concat(F.lit('"a, '), e, F.lit('", "b"'))).otherwise(F.concat(F.lit('x "q'), e, F.lit('" y "z"')))
    text = F.concat(F.lit("<|tool_call_start|>f(xs=["), inner, F.lit("], word, n="), F.col("value").cast("decimal(9,2)"), F.lit(', s="t u")<|tool_call_end|>'))
    got = table(spark, sf_dir, "events").select("event_id", pyjson.chatml_turn_call(text)["arguments"].alias("a"))
    return got.select("event_id", F.get_json_object("a", "$.xs[0]").alias("x0"), F.get_json_object("a", "$.xs[1]").alias("x1"), F.round(F.get_json_object("a", "$.n").cast("double"), 2).alias("n"), F.get_json_object("a", "$.s").alias("s"), F.get_json_object("a", "$.word").alias("word"))


def arguments_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether two objects of arguments are equal: key order and 1 against 1.0 don't matter, keys and values do."""
    k = F.col("o_orderkey")
    a = F.concat(F.lit('{"a": '), k, F.lit(', "b": [1, {"c": true}]}'))
    b = F.concat(F.lit('{"b": [1.0, {"c": '), F.when(k % 3 == 0, "1").otherwise("true"), F.lit('}], "a": '), k + F.when(k % 4 == 0, 1).otherwise(0), F.when(k % 5 == 0, F.lit(', "d": 0}')).otherwise(".0}"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", (pyjson.canonical(a) == pyjson.canonical(b)).alias("equal"))
    return rows.groupBy((F.col("o_orderkey") % 20).alias("k"), "equal").agg(F.count("*").alias("n"))


def payload_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All numbers of nested payloads, true and false among them."""
    e = F.col("event_id")
    payload = F.concat(F.lit('{"a": '), e, F.lit(', "b": [{"c": '), F.when(e % 2 == 0, "true").otherwise("false"), F.lit('}, "7", [2.5, null]], "d": {"e": '), e % 9, F.lit("}}"))
    got = rules.json_numbers(F.when(e % 7 == 3, F.lit("no json")).otherwise(payload))
    return table(spark, sf_dir, "events").select("event_id", got.alias("xs")).select("event_id", F.size("xs").alias("n"), F.aggregate("xs", F.lit(0.0), lambda s, x: s + x).alias("total"))


def food_uses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Foods that orders' calls name, as told by searches and items, and how many orders name them."""
    k = "l_orderkey"
    lines = table(spark, sf_dir, "lineitem").select(
        F.col(k).alias("conv_id"),
        F.when(F.col("l_linenumber") % 2 == 0, fixed.SEARCH).otherwise(fixed.ADD).alias("name"),
        F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit('{"queries": ["q'), F.col("l_partkey") % 30, F.lit('", "all"]}')))
        .otherwise(F.concat(F.lit('{"food_id": '), F.col("l_partkey") % 20, F.lit(', "items": [{"food_id": '), F.col("l_partkey") % 40, F.lit("}]}")))
        .alias("arguments"),
    )
    from dialoom.operators import assembly

    plain = assembly.usage_counts(rules.food_ids(lines)).withColumn("kind", F.lit("plain"))
    return plain.unionByName(assembly.usage_counts(rules.food_ids(lines, corrected=True)).withColumn("kind", F.lit("corrected")))


def replayed_trackers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many orders are short and long, as told by what was made before, and how many different foods they name."""
    from dialoom.operators import assembly

    calls = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("conv_id"), F.lit(fixed.SEARCH).alias("name"), F.concat(F.lit('{"queries": ["'), F.col("l_partkey"), F.lit('"]}')).alias("arguments"))
    uses, lengths = assembly.trackers(calls, calls.select("conv_id"), short=4)
    return lengths.crossJoin(uses.agg(F.count("*").alias("foods"), F.sum("uses").alias("uses")))


def tool_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a user had signed up before each event, as a running flag."""
    calls = table(spark, sf_dir, "events").select(F.col("user_id").alias("conv_id"), F.col("event_id").alias("turn"), F.lit(0).alias("call"), F.col("event_type").alias("name"))
    return rules.running_seen(calls, "signup").select("conv_id", F.col("turn").alias("event_id"), "seen")


def numbered_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of an order's lines, keyed by their places."""
    per = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_extendedprice")).alias("v"))
    return per.select("l_orderkey", F.explode(asof.numbered(F.col("v"), "carbs")).alias("key", "value"))


def entry_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries that orders take away but haven't made, which the strict rule tells."""
    k = F.col("o_orderkey")
    calls = table(spark, sf_dir, "orders").select(k.alias("conv_id"), F.lit(3).cast("long").alias("seq"), F.lit(fixed.REMOVE).alias("name"), F.concat(F.lit('{"entry_ids": ['), k % 5 + 1, F.lit(", 1]}")).alias("arguments"))
    made = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("conv_id"), F.col("l_linenumber").cast("long").alias("seq"), F.col("l_linenumber").cast("int").alias("entry_id"))
    assert not rules.entry_ids(calls, made).take(1)  # the rule is only declared unless it is strict
    return rules.entry_ids(calls, made, strict=True).groupBy("conv_id").agg(F.count("*").alias("n"), F.max("entry_id").alias("largest"))


def sanitised_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns whose missing or broken results become empty objects."""
    e = F.col("event_id")
    results = F.when(e % 4 == 0, F.lit('{"a": 1}')).when(e % 4 == 1, "[1]").when(e % 4 == 2, "text")
    turn = lambda role, action: F.struct(F.lit(role).alias("role"), F.lit(action).alias("action"), results.alias("tool_results"))
    turns = F.array(turn("tool", None), turn("assistant", "tool_call"), turn("assistant", "text"), turn("user", None))
    rows = table(spark, sf_dir, "events").select("event_id", F.posexplode(generation.sanitized(turns)).alias("i", "t"))
    return rows.select("event_id", "i", "t.tool_results")


def usable_doses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results that are objects without an error."""
    e = F.col("event_id")
    payload = F.when(e % 4 == 0, F.lit('{"error": "x"}')).when(e % 4 == 1, "[1]").when(e % 4 == 2, F.concat(F.lit('{"v": '), e, F.lit("}")))
    return audit.usable_results(table(spark, sf_dir, "events").select("event_id", payload.alias("payload")))


def retry_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feedback by the kind of failure, with what the tools gave."""
    e = F.col("event_id")
    kind = F.element_at(F.array(*map(F.lit, ("json", "validation", "schema", "other"))), (e % 4 + 1).cast("int"))
    errors = F.transform(F.sequence(F.lit(1), (e % 6 + 1).cast("int")), lambda i: F.concat(F.lit("e"), i, F.repeat(F.lit("x"), (e % 130).cast("int"))))
    results = F.when(e % 3 == 0, generation.excerpt(F.concat(F.col("props"), F.repeat(F.lit("y"), (e % 450).cast("int"))), e % 8))
    return table(spark, sf_dir, "events").select("event_id", generation.retry_message(kind, errors, results).alias("text"))


# ---- evaluation ----------------------------------------------------------------------------------------------------
_MARK = {role: f"<|im_start|>{role}\n" for role in ("user", "assistant", "tool")}


def _exam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order asks for its dose: answered by a question, or by one or two calls and a text; a few have no answer."""
    k = F.col("o_orderkey")
    say = lambda role, *parts: F.concat(F.lit(_MARK[role]), *(p if isinstance(p, Column) else F.lit(p) for p in parts), F.lit("<|im_end|>"))
    call = say("assistant", "<|tool_call_start|>dose(k=", k, ", xs=[1, 2])<|tool_call_end|>")
    result = say("tool", '{"final_result": 1}')
    head = F.concat(F.lit("<|startoftext|><|im_start|>system\nS<|im_end|>"), say("user", "k=", k, "."))
    once = F.concat(call, result, say("assistant", 'It is "final_result": ', k % 97 + 1, ".0 units"))
    rest = F.when(k % 50 == 7, "").when(k % 5 == 0, say("assistant", "Which one?")).when(k % 5 == 4, F.concat(call, result, call, result, say("assistant", "Done."))).otherwise(once)
    return table(spark, sf_dir, "orders").select(k.alias("conv_id"), F.concat(head, rest).alias("text"))


def scripted():
    """A model that is right most of the time."""

    def answer(text: str) -> str:
        k, had = int(re.search(r"k=(\d+)\.", text)[1]), text.count(_MARK["tool"])
        if k % 5 == 0:
            return _MARK["assistant"] + ("Which?" if k % 2 == 0 else "No idea.") + "<|im_end|>"
        if had < (2 if k % 5 == 4 else 1):
            return f"{_MARK['assistant']}<|tool_call_start|>dose(xs=[1, 2.0], k={k + (k % 3 == 0)})<|tool_call_end|><|im_end|>"
        return f'{_MARK["assistant"]}I say "final_result": {(k % 97 + 1) * (1.05 if k % 4 == 0 else 1.005):.3f} units<|im_end|>'

    return answer


def replay_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scripted model's calls, results and questions against those of each conversation."""
    return evaluation.evaluate(_exam(spark, sf_dir), "chatml", scripted)


def replay_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over all conversations, with the weighted score and the report."""
    rows = evaluation.metrics(replay_evaluation(spark, sf_dir))
    rows = rows.withColumns({"language": F.lit(0.7), "latency": F.lit(1.0), "memory": F.lit(1.0)})
    rows = rows.withColumn("score", scoring.weighted(F.col("tool_calls"), F.col("sequence"), F.col("clarification")))
    return scoring.report(rows).select("conversations", "tool_calls", "sequence", "clarification", "score", "report")


def gold_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What conversations say: calls, whether they ask back, the last text, how many results."""
    got = scoring.gold(evaluation.parsed(_exam(spark, sf_dir), "chatml"))
    return got.select("conv_id", "calls", "asks", "final_text", F.size("results").alias("results"))


# ---- results computed again ----------------------------------------------------------------------------------------
def _foods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Foods by the names of parts, numbered in order."""
    from pyspark.sql.window import Window

    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("name")).distinct()
    rows = names.withColumn("id", F.row_number().over(Window.orderBy("name")))  # a small dimension
    grams, pieces = F.col("id") % 3 != 0, F.col("id") % 2 == 0
    rows = rows.select(
        F.lit("en").alias("lang"), "id", "name", (F.col("id") % 20 + F.lit(0.5)).alias("carbs"), grams.alias("has_grams_mode"), pieces.alias("has_pieces_mode"),
        F.when(grams, 50.0).alias("standard_quantity_g"), F.when(pieces, 2.0).alias("standard_quantity_pcs"), F.when(grams, "g").alias("gram_unit"), F.when(pieces, "pcs").alias("piece_unit"),
    )
    return rows.selectExpr("*", f"CASE WHEN has_grams_mode THEN {py_round_sql('(carbs / 50 * 100)')} END AS carbs_per_100g", f"CASE WHEN has_pieces_mode THEN {py_round_sql('(carbs / 2)')} END AS carbs_per_piece")


def recomputed_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers search a food, add it and ask for the dose; what the tools give is computed again and copied on."""
    foods = _foods(spark, sf_dir)
    kinds = foods.count()  # of a small dimension
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("conv_id"), (F.col("c_custkey") % kinds + 1).cast("int").alias("id")).join(foods.select("id", "name"), "id")
    q = "CAST(conv_id % 9 + 1 AS STRING)"
    say = lambda tool, arguments: _turn(role="'assistant'", action="'tool_call'", tool_calls=f"array(named_struct('name', '{tool}', 'arguments', {arguments}))")
    turns = [
        say(fixed.SEARCH, "concat('{\"queries\": [\"', name, '\"]}')"),
        _turn(role="'tool'", tool_results="'{\"kept\": {\"a\": 1}}'"),
        say(fixed.ADD, f"concat('{{\"items\": [{{\"food_id\": ', CAST(id AS STRING), ', \"quantity\": ', {q}, ', \"unit\": \"g\"}}]}}')"),
        _turn(role="'tool'"),
        say(fixed.FINAL, "'{\"meal_hour\": 13}'"),
        _turn(role="'tool'", tool_results="'{\"calculate_final\": {\"final_result\": -1}}'"),
    ]
    convs = rows.selectExpr("conv_id", "'SIMPLE_SINGLE_FOOD' AS scenario_type", "'en' AS language", "CAST(conv_id % 5 AS INT) AS user_settings_idx", f"array({', '.join(turns)}) AS turns")
    got = migration.recompute(convs, foods, harness.settings(spark))
    at = lambda i, path: F.get_json_object(F.element_at("turns", i)["tool_results"], f"$.{path}")
    return got.select(
        "conv_id", at(2, "kept.a").alias("kept"), at(2, f"{fixed.SEARCH}.results[0][0].id").cast("int").alias("found"), at(2, f"{fixed.SEARCH}.results[0][0].gram_unit").alias("unit"), at(4, f"{fixed.ADD}.tally_total").cast("double").alias("total"),
        at(4, f"{fixed.ADD}.error").alias("failed"), at(6, f"{fixed.FINAL}.final_result").cast("double").alias("dose"), at(6, f"{fixed.FINAL}.error").alias("refused"), at(6, f"{fixed.FINAL}.divisor").cast("double").alias("divisor"),
    )


def search_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Foods as a search shows them."""
    foods = _foods(spark, sf_dir)
    return foods.select("id", render.search_result({c: F.col(c) for c in foods.columns}).alias("shown"))


def chat_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as chats whose text is kept as state, message by message; some are cleared on the way."""
    from dialoom.plans.streams import stream_of

    said = F.coalesce("text", F.lit(""))
    other = F.concat(F.lit(render.chat_assistant("chatml")), said, F.lit("<|im_end|>"))
    piece = F.when(F.col("role") == "user", render.chat_user("chatml", said, F.lit("[CURRENT TALLY: empty]"))).when(F.col("role") == "assistant", other).otherwise(render.chat_result("chatml", said))
    rows = stream_of(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("session"), F.col("turn").alias("seq"), render.chat_prefix("chatml", F.lit("S")).alias("prefix"), F.when((F.col("conv_id") % 3 != 0) | (F.col("turn") != 2), piece).alias("piece")
    )
    folder = folders.own(spark, "stream")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("append").parquet(f"{folder}/out")

    key, before = "spark.sql.streaming.stateStore.providerClass", spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set(key, streams.ROCKSDB)
    try:
        streams.transcripts(rows).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(key, before)
    return spark.read.parquet(f"{folder}/out").groupBy("session").agg(F.max_by("text", F.length("text")).alias("text"))


def masked_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows by a tokenizer that is handed in: nothing but ids and labels is left."""
    rows = render.conversation(table(spark, sf_dir, "conversations"), "gemma")

    def load():
        return lambda t: (list(range(1, len(t) + 1)), [(i, i + 1) for i in range(len(t))])

    got = spans.masked(spans.tokenized(rows, load), "gemma", dotall=True)
    kept = F.filter("labels", lambda x: x != spans.IGNORED)
    per = got.select(F.size("input_ids").alias("tokens"), F.inline(F.transform(F.array(kept), lambda k: F.struct(F.size(k).alias("trained"), F.aggregate(k, F.lit(0).cast("long"), lambda a, x: a + x).alias("ids")))))
    return per.agg(F.count("*").alias("rows"), F.sum("tokens").alias("tokens"), F.sum("trained").alias("trained"), F.sum("ids").alias("sum_ids"))


QUERIES = {
    f.__name__: f
    for f in (
        full_chatml, full_gemma, parsed_calls, argument_lists, arguments_equal, payload_numbers, food_uses, replayed_trackers, tool_seen, numbered_values, entry_check, sanitised_turns, usable_doses, retry_messages, replay_evaluation,
        replay_metrics, gold_turns, recomputed_results, search_results, chat_transcripts, masked_rows,
    )
}

_NL = "chr(10)"
_Q = "CAST(o_orderkey % {} AS VARCHAR)"
_CHAT_TOOL = f"""'{{"search": {{"total": ' || {_Q.format(11)} || ', "rows": [[1, {{"id": ' || {_Q.format(9)} || '}}]], "s": "é\\"x"}}}}'"""
_GEMMA_LINES = ["Tool results:", "search -> {", '  "total": @11,', '  "rows": [', "    [", "      1,", "      {", '        "id": @9', "      }", "    ]", "  ],", '  "s": "é\\"x"', "}"]
_GEMMA_TOOL = " || chr(10) || ".join("'" + re.sub(r"@(\d+)", lambda m: f"' || {_Q.format(m[1])} || '", line) + "'" for line in _GEMMA_LINES)
_USER = "'order ' || o_orderkey || CASE WHEN o_orderkey % 3 <> 0 THEN chr(10) || chr(10) || '[CURRENT TALLY: empty]' ELSE '' END"
_SAID = "CASE WHEN o_orderkey % 4 = 0 THEN 'None' ELSE 'done ' || o_orderkey END"
_EXAM = """x AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 50 <> 7),
    g AS (SELECT k, CASE WHEN k % 5 = 0 THEN 0 WHEN k % 5 = 4 THEN 2 ELSE 1 END AS calls, k % 5 = 0 AS asks, k % 5 IN (1, 2, 3) AS compared FROM x),
    e AS (SELECT k AS conv_id, CAST(calls AS BIGINT) AS calls, CAST(CASE WHEN k % 3 <> 0 THEN calls ELSE 0 END AS BIGINT) AS right, compared, compared AND k % 4 <> 0 AS close, asks, asks AND k % 2 = 0 AS asked FROM g)"""
_R = lambda *c: "coalesce(sum(CAST({} AS BIGINT))::DOUBLE / nullif(sum(CAST({} AS BIGINT)), 0)::DOUBLE, 0)".format(*c)
_WEIGHTED = " + ".join(f"{x} * {fixed.WEIGHTS[k]}::DOUBLE" for k, x in (("tool_calls", "tool_calls"), ("sequence", "sequence"), ("clarification", "clarification"), ("language", "(3.5::DOUBLE / 5.0::DOUBLE)"), ("latency", "1.0::DOUBLE"), ("memory", "1.0::DOUBLE")))


def _report_sql() -> str:
    from dialoom.functions.exact import fixed_sql

    shown = [f"'{k}: ' || {fixed_sql(k, 3)} || ' (weight {w:.0%})'" for k, w in fixed.WEIGHTS.items()]
    return " || chr(10) || ".join([*shown, f"'weighted score: ' || {fixed_sql('score', 4)}"])


_FOODS = f"""n AS (SELECT p_name AS name, CAST(row_number() OVER (ORDER BY p_name) AS INTEGER) AS id FROM (SELECT DISTINCT p_name FROM part)),
    f AS (SELECT id, name, id % 20 + 0.5::DOUBLE AS carbs, id % 3 <> 0 AS g, id % 2 = 0 AS p FROM n)"""
_PIECE = "CASE role WHEN 'user' THEN '<|im_start|>user' || chr(10) || coalesce(text, '') || chr(10) || chr(10) || '[CURRENT TALLY: empty]<|im_end|>' WHEN 'assistant' THEN '<|im_start|>assistant' || chr(10) || coalesce(text, '') || '<|im_end|>' ELSE '<|im_start|>tool' || chr(10) || coalesce(text, '') || '<|im_end|>' END"
_G = "'<|turn>' || CASE WHEN role = 'assistant' THEN 'model' ELSE role END || chr(10) || coalesce(text, '') || '<turn|>'"

ORACLE_SQL = {
    "full_chatml": f"""
        SELECT o_orderkey AS conv_id, '<|startoftext|><|im_start|>system' || {_NL} || 'Prompt ' || o_custkey % 3 || '<|im_end|><|im_start|>user' || {_NL} || {_USER} || '<|im_end|><|im_start|>assistant' || {_NL}
               || '<|tool_call_start|>search(queries=["a' || {_Q.format(7)} || '", "b, c"], n=' || {_Q.format(5)} || ', x=1.5, flag=True, none=None), add(items=[{{"food_id": ' || {_Q.format(9)} || ', "unit": "g"}}], empty=[])<|tool_call_end|><|im_end|>'
               || '<|im_start|>tool' || {_NL} || {_CHAT_TOOL} || '<|im_end|><|im_start|>assistant' || {_NL} || {_SAID} || '<|im_end|>' AS text FROM orders""",
    "full_gemma": f"""
        SELECT o_orderkey AS conv_id, '<bos><|turn>system' || {_NL} || 'Prompt ' || o_custkey % 3 || '<turn|><|turn>user' || {_NL} || {_USER} || '<turn|><|turn>model' || {_NL}
               || 'search({{"queries": ["a' || {_Q.format(7)} || '", "b, c"], "n": ' || {_Q.format(5)} || ', "x": 1.5, "flag": true, "none": null}})' || {_NL} || 'add({{"items": [{{"food_id": ' || {_Q.format(9)} || ', "unit": "g"}}], "empty": []}})<turn|>'
               || '<|turn>model' || {_NL} || {_GEMMA_TOOL} || '<turn|><|turn>model' || {_NL} || {_SAID} || '<turn|>' AS text FROM orders""",
    "parsed_calls": """
        SELECT o_orderkey AS conv_id, 'search' AS name, 'b, c' AS second, CAST(o_orderkey % 5 AS BIGINT) AS n, 'True' AS flag, 'chatml' AS kind FROM orders
        UNION ALL SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN 'f' END, NULL, CASE WHEN event_id % 5 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END, NULL, 'gemma' FROM events""",
    "argument_lists": """
        SELECT event_id, CASE event_id % 3 WHEN 0 THEN event_id::VARCHAR WHEN 1 THEN 'a, ' || event_id ELSE 'q' || event_id END AS x0, CASE event_id % 3 WHEN 0 THEN '2.5' WHEN 1 THEN 'b' ELSE 'z' END AS x1, round(value, 2) AS n, 't u' AS s, NULL AS word FROM events""",
    "arguments_equal": "SELECT o_orderkey % 20 AS k, o_orderkey % 4 <> 0 AND o_orderkey % 5 <> 0 AS equal, count(*) AS n FROM orders GROUP BY ALL",
    "payload_numbers": "SELECT event_id, CAST(CASE WHEN event_id % 7 = 3 THEN 0 ELSE 4 END AS INTEGER) AS n, CASE WHEN event_id % 7 = 3 THEN 0::DOUBLE ELSE event_id + CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END + 2.5::DOUBLE + event_id % 9 END AS total FROM events",
    "food_uses": """
        WITH s AS (SELECT l_orderkey AS k, unnest(['q' || l_partkey % 30, 'all']) AS id FROM lineitem WHERE l_linenumber % 2 = 0),
        u AS (SELECT 'plain' AS kind, * FROM s UNION SELECT 'corrected', * FROM s UNION SELECT 'plain', l_orderkey, CAST(l_partkey % 20 AS VARCHAR) FROM lineitem WHERE l_linenumber % 2 = 1 AND l_partkey % 20 <> 0
              UNION SELECT 'corrected', l_orderkey, CAST(l_partkey % 40 AS VARCHAR) FROM lineitem WHERE l_linenumber % 2 = 1)
        SELECT id, count(*) AS uses, kind FROM u GROUP BY ALL""",
    "replayed_trackers": """
        WITH c AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1), u AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)
        SELECT count(*) AS conversations, count(*) FILTER (n <= 4) AS short, count(*) FILTER (n > 4) AS long, (SELECT count(DISTINCT l_partkey) FROM u) AS foods, (SELECT count(*) FROM u) AS uses FROM c""",
    "tool_seen": "SELECT user_id AS conv_id, event_id, coalesce(bool_or(event_type = 'signup') OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS seen FROM events",
    "numbered_values": "SELECT l_orderkey, 'carbs_' || row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice) AS key, l_extendedprice AS value FROM lineitem",
    "entry_check": """
        WITH r AS (SELECT o_orderkey AS k, unnest([o_orderkey % 5 + 1, 1]) AS e FROM orders), m AS (SELECT l_orderkey AS k, l_linenumber AS e, min(l_linenumber) AS since FROM lineitem GROUP BY ALL)
        SELECT r.k AS conv_id, count(*) AS n, CAST(max(r.e) AS INTEGER) AS largest FROM r LEFT JOIN m ON m.k = r.k AND m.e = r.e WHERE since IS NULL OR since >= 3 GROUP BY 1""",
    "sanitised_turns": """
        WITH r AS (SELECT event_id, unnest([0, 1, 2, 3]) AS i, CASE event_id % 4 WHEN 0 THEN '{"a": 1}' WHEN 1 THEN '[1]' WHEN 2 THEN 'text' END AS t FROM events)
        SELECT event_id, i, CASE WHEN i = 0 AND (event_id % 4 <> 0) THEN '{}' WHEN i = 1 AND t IS NULL THEN '{}' ELSE t END AS tool_results FROM r""",
    "usable_doses": """SELECT event_id, '{"v": ' || event_id || '}' AS payload FROM events WHERE event_id % 4 = 2""",
    "retry_messages": f"""
        WITH r AS (SELECT event_id AS e, list_transform(range(1, event_id % 6 + 2), lambda i: 'e' || i || repeat('x', CAST(event_id % 130 AS INTEGER))) AS es, props || repeat('y', CAST(event_id % 450 AS INTEGER)) AS p FROM events),
        j AS (SELECT *, array_to_string(es, '; ') AS s, CASE WHEN e % 3 = 0 THEN 'Turn ' || e % 8 || ': ' || CASE WHEN length(p) > 400 THEN substr(p, 1, 400) || '...' ELSE p END END AS res FROM r),
        b AS (SELECT *, CASE e % 4 WHEN 0 THEN '- Output was NOT valid JSON. Generate ONLY valid JSON, nothing else.' WHEN 1 THEN '- ' || CASE WHEN length(s) > 500 THEN substr(s, 1, 500) || '...' ELSE s END
              WHEN 2 THEN array_to_string(list_transform(es[1:3], lambda x: '- ' || x), chr(10)) || CASE WHEN len(es) > 3 THEN chr(10) || '- ... and ' || (len(es) - 3) || ' more structural issues' ELSE '' END
              ELSE '- ' || CASE WHEN length(s) > 300 THEN substr(s, 1, 300) || chr(10) || '- ... (truncated)' ELSE s END END AS body FROM j)
        SELECT e AS event_id, '{generation.HEAD.strip()}' || chr(10) || chr(10) || body || CASE WHEN e % 4 <> 0 AND res IS NOT NULL THEN chr(10) || chr(10) || 'Tool results from your previous attempt (reference these numbers when writing assistant text):' || chr(10) || res ELSE '' END AS text FROM b""",
    "replay_evaluation": f"WITH {_EXAM} SELECT * FROM e",
    "replay_metrics": f"""
        WITH {_EXAM}, m AS (SELECT count(*) AS conversations, {_R("e.right", "calls")} AS tool_calls, {_R("e.close", "compared")} AS sequence, {_R("asked", "asks")} AS clarification, 0.7::DOUBLE AS language, 1::DOUBLE AS latency, 1::DOUBLE AS memory FROM e),
        s AS (SELECT *, {_WEIGHTED} AS score FROM m) SELECT conversations, tool_calls, sequence, clarification, score, {_report_sql()} AS report FROM s""",
    "gold_turns": """
        WITH x AS (SELECT o_orderkey AS k, o_orderkey % 50 = 7 AS none FROM orders)
        SELECT k AS conv_id, CAST(CASE WHEN none OR k % 5 = 0 THEN 0 WHEN k % 5 = 4 THEN 2 ELSE 1 END AS BIGINT) AS calls, NOT none AND k % 5 = 0 AS asks,
               CASE WHEN none OR k % 5 = 0 THEN NULL WHEN k % 5 = 4 THEN 'Done.' ELSE 'It is "final_result": ' || (k % 97 + 1) || '.0 units' END AS final_text, CAST(CASE WHEN none OR k % 5 = 0 THEN 0 WHEN k % 5 = 4 THEN 2 ELSE 1 END AS INTEGER) AS results FROM x""",
    "recomputed_results": f"""
        WITH {POOL_SQL}, {_FOODS}, c AS (SELECT c_custkey AS k, f.*, pool.* FROM customer JOIN f ON f.id = c_custkey % (SELECT count(*) FROM f) + 1 JOIN pool ON idx = c_custkey % 5),
        t AS (SELECT *, CASE WHEN g THEN {py_round_sql("((k % 9 + 1)::DOUBLE * carbs / 50::DOUBLE)")} END AS total FROM c)
        SELECT k AS conv_id, '1' AS kept, h.found, CASE WHEN h.found % 3 <> 0 THEN 'g' END AS unit, total, CASE WHEN NOT g THEN 'execution failed' END AS failed, CASE WHEN g THEN {py_round_sql("(total / midday)")} END AS dose,
               CASE WHEN NOT g THEN 'Add at least one food first.' END AS refused, CASE WHEN g THEN divisor END AS divisor
        FROM t JOIN (SELECT a.id, min(b.id) AS found FROM f a JOIN f b ON contains(lower(b.name), lower(a.name)) GROUP BY 1) h USING (id)""",
    "search_results": f"""
        WITH {_FOODS}, r AS (SELECT *, {py_round_sql("(carbs / 50 * 100)")} AS a, {py_round_sql("(carbs / 2)")} AS b FROM f)
        SELECT id, '{{"id": ' || id || ', "name": "' || name || '", "carbs_per_100g": ' || CASE WHEN g THEN a::VARCHAR ELSE 'null' END || ', "carbs_per_piece": ' || CASE WHEN p THEN b::VARCHAR ELSE 'null' END
               || ', "has_grams_mode": ' || g::VARCHAR || ', "has_pieces_mode": ' || p::VARCHAR || CASE WHEN g THEN ', "gram_unit": "g"' ELSE '' END || CASE WHEN p THEN ', "piece_unit": "pcs"' ELSE '' END || '}}' AS shown FROM r""",
    "chat_transcripts": f"""
        WITH m AS (SELECT *, conv_id % 3 = 0 AND turn = 2 AS clears, bool_or(conv_id % 3 = 0 AND turn = 2) OVER (PARTITION BY conv_id) AS cleared FROM conversations)
        SELECT conv_id AS session, '<|startoftext|><|im_start|>system' || chr(10) || 'S<|im_end|>' || coalesce(string_agg({_PIECE}, '' ORDER BY turn) FILTER (NOT clears AND (NOT cleared OR turn > 2)), '') AS text FROM m GROUP BY conv_id""",
    "masked_rows": f"""
        WITH p AS (SELECT *, {_G} AS piece FROM conversations), a AS (SELECT *, 5 + coalesce(sum(length(piece)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bgn FROM p),
        s AS (SELECT bgn + 13 AS s, bgn + length(piece) AS e FROM a WHERE role = 'assistant')
        SELECT (SELECT count(DISTINCT conv_id) FROM p) AS rows, CAST((SELECT 5 * count(DISTINCT conv_id) + sum(length(piece)) FROM p) AS BIGINT) AS tokens, CAST(sum(e - s) AS BIGINT) AS trained, CAST(sum((e - s) * (s + 1 + e) / 2) AS BIGINT) AS sum_ids FROM s""",
}
