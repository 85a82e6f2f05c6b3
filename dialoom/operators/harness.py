"""Deterministic tool replay: each conversation's calls are folded in order over its state.

One row holds a conversation's calls, already joined to the foods they name; ``aggregate`` folds them inside
the JVM. State: known food ids, the tally, the next entry id, remembered meal and glucose, outputs so far.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions import fixed
from dialoom.functions.exact import fixed_sql, py_round_sql
from dialoom.functions.foodtext import item_carbs
from dialoom.sources.schemas import TALLY_ENTRY

ARGUMENTS = "queries array<string>, items array<struct<food_id int, quantity double, unit string>>, entry_ids array<int>, meal_time string, meal_hour int, blood_glucose double"
#: What can be added: name and carbs are null if there is no such food, carbs also if the unit doesn't suit it.
ITEM = "struct<food_id int, food_name string, quantity double, unit string, carbs double>"
CALL = f"struct<seq long, name string, found array<int>, items array<{ITEM}>, entry_ids array<int>, meal_time string, meal_hour int, blood_glucose double>"
OUTPUT = (
    f"struct<seq long, name string, error string, entries array<{TALLY_ENTRY}>, removed int, tally_total double, final_result double, food_insulin double, "
    "glucose_correction double, glucose_skipped boolean, meal_divider int, meal_time string, meal_hour int, blood_glucose double, breakdown_food string, breakdown_glucose string>"
)
FAILED = "execution failed"


def settings(spark: SparkSession) -> DataFrame:
    """The pool of user settings: idx, threshold, baseline, divisor, dividers."""
    rows = [(i, t, b, d, {"morning": m, "midday": n, "evening": e}) for i, (t, b, d, m, n, e) in enumerate(fixed.SETTINGS)]
    return spark.createDataFrame(rows, "idx int, threshold double, baseline double, divisor double, dividers map<string, int>")


def period_sql(hour: str) -> str:
    """The period of an hour (its range may go over midnight); midday without an hour."""
    inside = " ".join(f"WHEN {hour} >= {a} {'AND' if b > a else 'OR'} {hour} < {b} THEN '{p}'" for p, a, b in fixed.PERIODS)
    return f"CASE WHEN {hour} IS NULL THEN 'midday' {inside} ELSE 'midday' END"


def prepare(calls: DataFrame, foods: DataFrame) -> DataFrame:
    """``calls(conv_id, lang, idx, seq, name, arguments)`` with JSON arguments, joined to ``foods``: a row for each
    conversation with its calls in order.

    Distinct (language, query) pairs are searched once: substrings need a nested loop, over the small food table.
    """
    parsed = calls.withColumn("a", F.from_json("arguments", ARGUMENTS))
    asked = parsed.select("conv_id", "lang", "seq", F.explode("a.queries").alias("query"))
    kinds = asked.select("lang", "query").distinct()
    names = foods.select(F.col("lang").alias("food_lang"), "id", F.lower("name").alias("food_name"))
    hits = kinds.join(names, (F.col("lang") == F.col("food_lang")) & F.contains("food_name", F.lower("query")))
    hits = hits.groupBy("lang", "query").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    found = asked.join(hits, ["lang", "query"]).groupBy("conv_id", "seq").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("found"))
    items = parsed.select("conv_id", "lang", "seq", F.posexplode("a.items").alias("pos", "item")).select("conv_id", "lang", "seq", "pos", "item.*")
    dim = foods.select(
        "lang",
        F.col("id").alias("food_id"),
        F.col("name").alias("food_name"),
        F.col("carbs").alias("food_carbs"),
        F.when(F.col("has_grams_mode"), F.col("standard_quantity_g")).alias("g"),
        F.when(F.col("has_pieces_mode"), F.col("standard_quantity_pcs")).alias("p"),
    )
    carbs = item_carbs(F.col("quantity"), F.col("unit"), F.col("food_carbs"), F.col("g"), F.col("p"))
    priced = items.join(dim, ["lang", "food_id"], "left").withColumn("carbs", carbs)
    priced = priced.groupBy("conv_id", "seq").agg(F.array_sort(F.collect_list(F.struct("pos", "food_id", "food_name", "quantity", "unit", "carbs"))).alias("items"))
    priced = priced.withColumn("items", F.transform("items", lambda x: F.struct(*(x[c].alias(c) for c in ("food_id", "food_name", "quantity", "unit", "carbs")))))
    full = parsed.join(found, ["conv_id", "seq"], "left").join(priced, ["conv_id", "seq"], "left")
    call = F.struct(
        F.col("seq").cast("long").alias("seq"), "name", F.when(F.col("a.queries").isNotNull(), F.coalesce("found", F.array().cast("array<int>"))).alias("found"), F.when(F.col("a.items").isNotNull(), F.coalesce("items", F.array().cast(f"array<{ITEM}>"))).alias("items"), F.col("a.entry_ids").alias("entry_ids"), "a.meal_time", "a.meal_hour", "a.blood_glucose"
    ).cast(CALL)
    return full.groupBy("conv_id", "lang", "idx").agg(F.array_sort(F.collect_list(call)).alias("calls"))


def _let(name: str, value: str, body: str) -> str:
    """SQL of ``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _total(entries: str) -> str:
    return f"aggregate({entries}, 0D, (t, e) -> t + e.carbs)"


def _step() -> str:
    is_ = lambda tool: f"c.name = '{tool}'"
    # the first item that can't be added (0: none), and the entries made before it
    bad = "coalesce(array_position(transform(c.items, x -> NOT array_contains(s.known, x.food_id) OR x.carbs IS NULL), true), 0)"
    made = f"transform(slice(coalesce(c.items, array()), 1, CAST(if(bad = 0, size(c.items), bad - 1) AS INT)), (x, i) -> named_struct('entry_id', s.next + i, 'food_name', x.food_name, 'quantity', x.quantity, 'unit', x.unit, 'carbs', {py_round_sql('greatest(x.carbs, 0D)')}))"
    unknown = "NOT array_contains(s.known, element_at(c.items, CAST(bad AS INT)).food_id)"
    add_error = f"CASE WHEN c.items IS NULL THEN '{FAILED}' WHEN bad = 0 THEN NULL WHEN {unknown} THEN concat('Unknown food_id: ', element_at(c.items, CAST(bad AS INT)).food_id, '. Search first.') ELSE '{FAILED}' END"
    left = "filter(s.tally, e -> NOT array_contains(c.entry_ids, e.entry_id))"
    meal = f"coalesce(nullif(c.meal_time, ''), {period_sql('c.meal_hour')})"
    high = "coalesce(c.blood_glucose >= threshold, false)"
    correction = f"if({high}, greatest(0D, (c.blood_glucose - baseline) / divisor), 0D)"
    empty = {"error": "CAST(NULL AS STRING)", "entries": f"CAST(NULL AS array<{TALLY_ENTRY}>)", "removed": "CAST(NULL AS INT)", "glucose_skipped": "CAST(NULL AS BOOLEAN)", "meal_divider": "CAST(NULL AS INT)", "meal_time": "CAST(NULL AS STRING)", "meal_hour": "CAST(NULL AS INT)", "breakdown_food": "CAST(NULL AS STRING)", "breakdown_glucose": "CAST(NULL AS STRING)"}
    order = ["error", "entries", "removed", "tally_total", "final_result", "food_insulin", "glucose_correction", "glucose_skipped", "meal_divider", "meal_time", "meal_hour", "blood_glucose", "breakdown_food", "breakdown_glucose"]

    def out(**values: str) -> str:
        cells = ", ".join(f"'{k}', {values.get(k, empty.get(k, 'CAST(NULL AS DOUBLE)'))}" for k in order)
        return f"CAST(named_struct('seq', c.seq, 'name', c.name, {cells}) AS {OUTPUT})"

    def state(output: str, **values: str) -> str:
        cells = {k: values.get(k, f"s.{k}") for k in ("known", "tally", "next", "meal_time", "meal_hour", "blood_glucose")}
        return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in cells.items()) + f", 'outputs', array_append(s.outputs, {output}))"

    add = state(
        out(error="err", entries="if(err IS NULL, made, NULL)", tally_total=f"if(err IS NULL, {py_round_sql('total')}, NULL)"),
        tally="if(err IS NULL, concat(s.tally, made), s.tally)",
        next="CAST(s.next + size(made) AS INT)",
    )
    add = _let("bad", bad, _let("made", made, _let("err", add_error, _let("total", _total("made"), add))))
    remove = _let("rest", left, _let("total", _total("rest"), state(out(removed="size(s.tally) - size(rest)", tally_total=py_round_sql("total")), tally="rest")))
    remove = f"CASE WHEN c.entry_ids IS NULL THEN {state(out(error=repr(FAILED)))} ELSE {remove} END"
    text_food = f"concat({fixed_sql('total')}, 'g / ', divider, ' = ', {fixed_sql('food')}, 'U')"
    text_glucose = f"CASE WHEN {high} THEN concat('(', c.blood_glucose, ' - ', baseline, ') / ', divisor, ' = ', {fixed_sql('correction')}, 'U') WHEN c.blood_glucose IS NOT NULL THEN concat('BG ', c.blood_glucose, ' < ', threshold, ' threshold, correction skipped') ELSE '' END"
    final = state(
        out(
            tally_total=py_round_sql("total"), final_result=py_round_sql("(food + correction)"), food_insulin=py_round_sql("food"), glucose_correction=py_round_sql("correction"), glucose_skipped=f"NOT {high}",
            meal_divider="divider", meal_time="meal", meal_hour="coalesce(nullif(c.meal_hour, 0), c.meal_hour, s.meal_hour)", blood_glucose="c.blood_glucose", breakdown_food=text_food, breakdown_glucose=text_glucose,
        ),
        meal_time="meal", meal_hour="coalesce(c.meal_hour, s.meal_hour)", blood_glucose="coalesce(c.blood_glucose, s.blood_glucose)",
    )
    final = _let("meal", meal, _let("divider", f"coalesce(dividers[meal], {fixed.DEFAULT_DIVIDER})", _let("total", _total("s.tally"), _let("food", "total / divider", _let("correction", correction, final)))))
    final = f"CASE WHEN size(s.tally) = 0 THEN {state(out(error=repr('Add at least one food first.')))} ELSE {final} END"
    summary = state(out(entries="s.tally", tally_total=_total("s.tally"), food_insulin="0D", meal_time="s.meal_time", meal_hour="s.meal_hour", blood_glucose="s.blood_glucose"))
    clear = state(out(), known="CAST(array() AS array<int>)", tally=f"CAST(array() AS array<{TALLY_ENTRY}>)", next="1", meal_time="CAST(NULL AS STRING)", meal_hour="CAST(NULL AS INT)", blood_glucose="CAST(NULL AS DOUBLE)")
    search = f"CASE WHEN c.found IS NULL THEN {state(out(error=repr(FAILED)))} ELSE {state(out(), known='array_union(s.known, c.found)')} END"
    cases = ((fixed.SEARCH, search), (fixed.ADD, add), (fixed.REMOVE, remove), (fixed.FINAL, final), (fixed.SUMMARY, summary), (fixed.CLEAR, clear))
    kind = f"struct<known array<int>, tally array<{TALLY_ENTRY}>, next int, meal_time string, meal_hour int, blood_glucose double, outputs array<{OUTPUT}>>"
    whens = " ".join(f"WHEN {is_(tool)} THEN CAST({body} AS {kind})" for tool, body in cases)
    return f"CASE {whens} ELSE CAST({state(out(error=repr(FAILED)))} AS {kind}) END"


def replay(prepared: DataFrame, pool: DataFrame) -> DataFrame:
    """Fold each conversation's calls: adds ``known``, ``tally`` (what is left at the end) and ``outputs``, one for each call."""
    rows = prepared.join(F.broadcast(pool), F.coalesce(F.col("idx"), F.lit(0)) == F.col("pool_idx") if "pool_idx" in pool.columns else prepared["idx"].eqNullSafe(pool["idx"]), "left")
    start = f"named_struct('known', CAST(array() AS array<int>), 'tally', CAST(array() AS array<{TALLY_ENTRY}>), 'next', 1, 'meal_time', CAST(NULL AS STRING), 'meal_hour', CAST(NULL AS INT), 'blood_glucose', CAST(NULL AS DOUBLE), 'outputs', CAST(array() AS array<{OUTPUT}>))"
    folded = rows.withColumn("end", F.expr(f"aggregate(calls, {start}, (s, c) -> {_step()})"))
    return folded.select("conv_id", "lang", prepared["idx"], "end.known", "end.tally", "end.outputs")


def run(calls: DataFrame, foods: DataFrame, pool: DataFrame) -> DataFrame:
    """Replay ``calls(conv_id, lang, idx, seq, name, arguments)``; a null idx means the first settings."""
    known = calls.withColumn("idx", F.coalesce(F.col("idx"), F.lit(0)).cast("int"))
    return replay(prepare(known, foods), pool.withColumnRenamed("idx", "pool_idx"))


def context_block(tally: str, known: str) -> str:
    """SQL of the context shown to the model: ``known`` is an array of (id, name); hidden while the tally is empty."""
    number = lambda x: f"CASE WHEN {x} = floor({x}) THEN concat(CAST({x} AS BIGINT), '.0') ELSE CAST({x} AS STRING) END"
    line = f"concat('  ', e.food_name, ' ', {number('e.quantity')}, e.unit, ' = ', {number('e.carbs')}, 'g (entry_id: ', e.entry_id, ')')"
    ids = f"array_join(transform(array_sort({known}), k -> concat(k.name, '(', k.id, ')')), ', ')"
    total = _let("total", _total(tally), fixed_sql("total", 1))
    return (
        f"CASE WHEN size({tally}) = 0 THEN '[CURRENT TALLY: empty]\\n[KNOWN FOOD IDS: none]' ELSE concat('[CURRENT TALLY: ', size({tally}), ' items, ', {total}, 'g total]\\n', "
        f"array_join(transform({tally}, e -> {line}), '\\n'), '\\n\\n[KNOWN FOOD IDS: ', {ids}, ']') END"
    )
