"""Rendering conversations in two chat formats, and parsing them back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions import fixed, pyjson

MODELS = ("chatml", "gemma")


def _turn(model: str, role: Column, content: Column) -> Column:
    f = fixed.CHATML if model == "chatml" else fixed.GEMMA
    shown = role if model == "chatml" else F.when(role.isin("assistant", "tool"), "model").otherwise(role)
    return F.concat(F.lit(f["open"]), shown, F.lit("\n"), content, F.lit(f["close"]))


def simple_turn(model: str, role: Column, content: Column) -> Column:
    """A parsed turn as text again."""
    return _turn(model, role, content)


def conversation(turns: DataFrame, model: str, prompt: Column | None = None) -> DataFrame:
    """Plain turns ``(conv_id, turn, role, text)`` as one text each: conv_id, text. ``prompt`` is a system turn put first."""
    f = fixed.CHATML if model == "chatml" else fixed.GEMMA
    piece = _turn(model, F.col("role"), F.coalesce("text", F.lit("")))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", piece.alias("s")))), lambda x: x["s"]), "")
    head = F.lit(f["bos"]) if prompt is None else F.concat(F.lit(f["bos"]), _turn(model, F.lit("system"), prompt))
    return turns.groupBy("conv_id").agg(joined.alias("body")).select("conv_id", F.concat(head, F.col("body")).alias("text"))


def full_conversation(conversations: DataFrame, model: str, prompt: Column) -> DataFrame:
    """Conversations of the full schema with calls, results and context: conv_id, text."""
    f = fixed.CHATML if model == "chatml" else fixed.GEMMA
    rows = conversations.select("conv_id", prompt.alias("prompt"), F.posexplode_outer("turns").alias("turn", "t")).select("conv_id", "prompt", "turn", "t.*")
    called = (F.col("role") == "assistant") & (F.col("action") == "tool_call") & (F.size("tool_calls") > 0)
    results = F.when((F.col("role") == "tool") & (F.coalesce("tool_results", F.lit("{}")) != "{}"), F.col("tool_results"))
    rows = rows.withColumns(
        {
            "call_text": (pyjson.chatml_calls if model == "chatml" else pyjson.gemma_calls)(F.when(called, F.col("tool_calls"))),
            "result_text": (pyjson.compact if model == "chatml" else pyjson.gemma_results)(results),
        }
    )
    user = F.concat(F.coalesce("content", F.lit("")), F.when(F.coalesce("context_block", F.lit("")) != "", F.concat(F.lit("\n\n"), F.col("context_block"))).otherwise(""))
    call = F.concat(F.lit(f["call_open"]), F.col("call_text"), F.lit(f["call_close"])) if model == "chatml" else F.col("call_text")
    content = (
        F.when(F.col("role") == "user", user)
        .when(called, call)
        .when((F.col("role") == "assistant") & (F.col("action") == "text"), F.coalesce("content", F.lit("None")))
        .when(results.isNotNull(), F.col("result_text"))
    )
    piece = _turn(model, F.col("role"), content)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(content.isNotNull(), F.struct("turn", piece.alias("s"))))), lambda x: x["s"]), "")
    head = F.concat(F.lit(f["bos"]), _turn(model, F.lit("system"), F.col("prompt")))
    return rows.groupBy("conv_id", "prompt").agg(joined.alias("body")).select("conv_id", F.concat(head, F.col("body")).alias("text"))


def without_bos(text: Column, model: str) -> Column:
    bos = (fixed.CHATML if model == "chatml" else fixed.GEMMA)["bos"]
    return F.when(F.startswith(text, F.lit(bos)), F.substring(text, len(bos) + 1, 1 << 30)).otherwise(text)


def parse(rows: DataFrame, model: str, text: str = "text") -> DataFrame:
    """Turns of rendered texts: adds turn (from 0), role, content; turns of unknown roles are left out."""
    if model == "chatml":
        pattern, roles = r"(?sU)<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>", ("system", "user", "assistant", "tool")
        source = F.col(text)
    else:
        pattern, roles = r"(?sU)<\|turn>(\w+)\n(.*?)<turn\|>", ("system", "user", "model")
        source = without_bos(F.col(text), model)
    found = F.arrays_zip(F.regexp_extract_all(source, F.lit(pattern), F.lit(1)).alias("role"), F.regexp_extract_all(source, F.lit(pattern), F.lit(2)).alias("content"))
    known = F.filter(found, lambda x: x["role"].isin(*roles))
    rest = [c for c in rows.columns if c != text]
    out = rows.select(*rest, F.posexplode(known).alias("turn", "t"))
    return out.select(*rest, "turn", F.when(F.col("t.role") == "model", "assistant").otherwise(F.col("t.role")).alias("role"), F.col("t.content").alias("content"))


def settings_prompt(template: Column, settings_text: Column, tools: Column) -> Column:
    """A training prompt: two placeholders of a template, one after the other."""
    return F.replace(F.replace(template, F.lit("{{USER_SETTINGS}}"), settings_text), F.lit("{{TOOLS}}"), tools)


def substitute(template: Column, values: list[tuple[str, Column]]) -> Column:
    """Placeholders replaced in the order given, so that a value may hold a later one's placeholder."""
    for name, value in values:
        template = F.replace(template, F.lit("{{" + name + "}}"), value)
    return template


def unit_tag(grams: Column, pieces: Column, gram_unit: Column, piece_unit: Column) -> Column:
    """Which units a food may be given in."""
    g, p = F.coalesce(gram_unit, F.lit("g")), F.coalesce(piece_unit, F.lit("pcs"))
    both = F.concat(F.lit('[USE: unit="'), g, F.lit('" or "'), p, F.lit('"]'))
    one = lambda u: F.concat(F.lit('[USE: unit="'), u, F.lit('" only]'))
    return F.when(grams & pieces, both).when(grams, one(g)).when(pieces, one(p)).otherwise("")


def food_line(row: dict[str, Column]) -> Column:
    """``  id: name (quantities = carbs) tag`` for a prompt's list of foods."""
    amount = lambda q, u: F.concat(q.cast("string"), u)
    modes = F.array_join(
        F.array_compact(F.array(F.when(row["grams"], amount(row["quantity_g"], row["gram_unit"])), F.when(row["pieces"], amount(row["quantity_pcs"], row["piece_unit"])))), " / "
    )
    tag = unit_tag(row["grams"], row["pieces"], row["gram_unit"], row["piece_unit"])
    return F.concat(F.lit("  "), row["id"].cast("string"), F.lit(": "), row["name"], F.lit(" ("), F.when(modes == "", "?").otherwise(modes), F.lit(" = "), row["carbs"].cast("string"), F.lit("g carbs) "), tag)


def search_result(food: dict[str, Column]) -> Column:
    """A food as a search shows it, in JSON; a unit's key is there only if the food has it and its mode."""
    flag = lambda c: F.when(c, "true").otherwise("false")
    number = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    text = lambda c: F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)
    key = lambda name, value: F.concat(F.lit(f'"{name}": '), value)
    unit = lambda name, mode: F.when(food[mode] & (F.coalesce(food[name], F.lit("")) != ""), key(name, text(food[name])))
    cells = [key("id", food["id"].cast("string")), key("name", text(food["name"]))]
    cells += [key(k, number(food[k])) for k in ("carbs_per_100g", "carbs_per_piece")]
    cells += [key(k, flag(food[k])) for k in ("has_grams_mode", "has_pieces_mode")]
    cells += [unit("gram_unit", "has_grams_mode"), unit("piece_unit", "has_pieces_mode")]
    return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*cells)), ", "), F.lit("}"))


def chat_prefix(model: str, prompt: Column) -> Column:
    """How a chat begins: the marker and the system turn."""
    f = fixed.CHATML if model == "chatml" else fixed.GEMMA
    return F.concat(F.lit(f["bos"]), _turn(model, F.lit("system"), prompt))


def chat_user(model: str, said: Column, context: Column) -> Column:
    """A user's turn with the context that goes with it."""
    return _turn(model, F.lit("user"), F.concat(said, F.lit("\n\n"), context))


def chat_assistant(model: str) -> str:
    """What the model is to go on from."""
    f = fixed.CHATML if model == "chatml" else fixed.GEMMA
    return f"{f['open']}{'assistant' if model == 'chatml' else 'model'}\n"


def chat_result(model: str, result: Column) -> Column:
    """A tool's result, in the format that rendered conversations have."""
    shown = result if model == "chatml" else F.concat(F.lit(fixed.GEMMA["results"] + "\n"), result)
    return _turn(model, F.lit("tool"), shown)
