"""Tool-call linking for chat data.

Calls and results are joined by identifier (a hash join on conversation and id, so a long conversation is
spread over all tasks), ordered topologically, validated against their tools' schemas and serialised as
canonical JSON: keys sorted, no white space, characters unescaped where JSON allows.

A call may name the calls it depends on. Its depth is the length of the longest chain of calls before it, so that
calls in order of their depths are in a topological order. Calls with one dependency form chains, which pointer
doubling settles in log2(n) rounds; what depends on several is settled level by level, once all it depends on is, with
the chains between taken as one step. A round reads and rewrites only what isn't settled, and rounds end when nothing
more can be: what is left is on a cycle, or after one, and has no depth.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm.shared import Scratch


@dataclass(frozen=True)
class Parameter:
    """type: one of string, integer, number, boolean, array, object."""

    type: str
    required: bool = True


Schemas = dict[str, dict[str, Parameter]]

_KINDS = {
    "string": ("STRING",),
    "integer": ("BIGINT",),
    "number": ("BIGINT", "DOUBLE", "DECIMAL"),
    "boolean": ("BOOLEAN",),
    "array": ("ARRAY",),
    "object": ("OBJECT",),
}

#: The tool that the turns of a plain conversation are calls of.
REPLY: Schemas = {"reply": {"message": Parameter("string"), "turn": Parameter("integer")}}


def errors(tool: Column, arguments: Column, schemas: Schemas) -> Column:
    """What is wrong with a call, in a fixed order: an array of strings, empty if it is valid."""
    parsed = F.try_parse_json(arguments)
    keys = F.json_object_keys(F.to_json(parsed))
    found = F.lit(None).cast("array<string>")
    for name, params in sorted(schemas.items()):
        wrong = []
        for p, rule in sorted(params.items()):
            kind = F.schema_of_variant(F.try_variant_get(parsed, f"$.{p}", "variant"))
            fits = F.lit(False)
            for k in _KINDS[rule.type]:
                fits = fits | F.startswith(kind, F.lit(k))
            missing = F.lit(f"missing {p}" if rule.required else None).cast("string")
            wrong.append(F.when(kind.isNull() | (kind == "VOID"), missing).when(~fits, F.lit(f"{p} is no {rule.type}")))
        extra = F.transform(F.array_sort(F.array_except(keys, F.array(*map(F.lit, params)))), lambda k: F.concat(F.lit("unknown "), k))
        here = F.concat(F.array_compact(F.array(*wrong)) if wrong else F.array().cast("array<string>"), F.coalesce(extra, F.array().cast("array<string>")))
        found = F.when(tool == name, here).otherwise(found)
    bad = F.when(parsed.isNull() | keys.isNull(), F.array(F.lit("arguments are no object")))
    return F.coalesce(F.when(~F.coalesce(tool.isin(list(schemas)), F.lit(False)), F.array(F.lit("unknown tool"))), bad, found, F.array().cast("array<string>"))


_KEY = ["conv_id", "call_id"]


def _chains(scratch: Scratch, nodes: DataFrame) -> DataFrame:
    """Calls with one dependency: conv_id, call_id, stop (the first call up the chain that has none or several; null
    if there is none, on a cycle), steps."""
    singles = nodes.where("n = 1").select(*_KEY, "up")
    stops = nodes.where("n <> 1").select("conv_id", F.col("call_id").alias("up"), F.lit(True).alias("end"))
    state = scratch.save(singles.join(stops, ["conv_id", "up"], "left").select(*_KEY, "up", F.lit(1).cast("long").alias("steps"), "end"), "chain0")
    settled = [state.where("end")]
    going = state.where("end IS NULL")
    left = going.count()
    r = 0
    while left and (1 << r) <= 2 * left:  # after as many doublings every chain without a cycle has met its end
        r += 1
        now = functools.reduce(DataFrame.unionByName, [*settled, going])
        target = now.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"), "end")
        # what goes on is joined; each call has one row as a target
        further = going.drop("end").join(target, ["conv_id", "up"]).select(*_KEY, F.col("next").alias("up"), (F.col("steps") + F.col("more")).alias("steps"), "end")
        state = scratch.save(further, f"chain{r}")
        settled.append(state.where("end"))
        going = state.where("end IS NULL")
        if going.isEmpty():
            break
    out = functools.reduce(DataFrame.unionByName, settled).select(*_KEY, F.col("up").alias("stop"), "steps")
    return out.unionByName(going.select(*_KEY, F.lit(None).cast("string").alias("stop"), F.lit(None).cast("long").alias("steps")))


def order(scratch: Scratch, calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth): the longest chain of calls before each; null on a cycle and after one.
    ``calls(conv_id, call_id, after array<string>)`` has each id once; what isn't a call of the conversation is no
    dependency."""
    ids = calls.select(*_KEY)
    deps = calls.select(*_KEY, F.explode(F.array_distinct("after")).alias("up")).join(ids.withColumnRenamed("call_id", "up"), ["conv_id", "up"], "left_semi")
    deps = scratch.save(deps.select(*_KEY, "up"), "deps")
    per = deps.groupBy(*_KEY).agg(F.count("*").alias("n"), F.min("up").alias("up"))
    nodes = scratch.save(ids.join(per, _KEY, "left").select(*_KEY, F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("n") == 1, F.col("up")).alias("up")), "nodes")
    chains = scratch.save(_chains(scratch, nodes), "chains")
    settled = [nodes.where("n = 0").select(*_KEY, F.lit(0).cast("long").alias("depth"))]
    several = nodes.where("n > 1").select(*_KEY)
    if not several.isEmpty():
        # edges from what depends on several calls to the ends of the chains they stand on
        own = chains.select("conv_id", F.col("call_id").alias("up"), "stop", "steps", F.lit(True).alias("chained"))
        edges = deps.join(several, _KEY, "left_semi").join(own, ["conv_id", "up"], "left")
        edges = edges.select(*_KEY, F.when(F.col("chained"), F.col("stop")).otherwise(F.col("up")).alias("stop"), (F.coalesce("steps", F.lit(0)) + 1).alias("steps"))
        edges = scratch.save(edges, "edges0")
        open_ = scratch.save(edges.groupBy(*_KEY).agg(F.count("*").alias("left"), F.lit(0).cast("long").alias("depth")), "open0")
        new, r = settled[0], 0
        while True:
            r += 1
            met = edges.join(new.select("conv_id", F.col("call_id").alias("stop"), F.col("depth").alias("at")), ["conv_id", "stop"])
            gained = met.groupBy(*_KEY).agg(F.count("*").alias("had"), F.max(F.col("at") + F.col("steps")).alias("reach"))
            now = open_.join(gained, _KEY, "left").select(*_KEY, (F.col("left") - F.coalesce("had", F.lit(0))).alias("left"), F.greatest("depth", F.coalesce("reach", F.lit(0))).alias("depth"))
            now = scratch.save(now, f"open{r}")
            new = now.where("left = 0").select(*_KEY, "depth")
            if new.isEmpty():
                break
            settled.append(new)
            open_ = now.where("left > 0")
            edges = scratch.save(edges.join(open_.select(*_KEY), _KEY, "left_semi"), f"edges{r}")
    known = functools.reduce(DataFrame.unionByName, settled)
    along = chains.join(known.select("conv_id", F.col("call_id").alias("stop"), "depth"), ["conv_id", "stop"]).select(*_KEY, (F.col("depth") + F.col("steps")).alias("depth"))
    return ids.join(known.unionByName(along), _KEY, "left")


def link(spark: SparkSession, calls: DataFrame, results: DataFrame, schemas: Schemas, context: DataFrame | None = None) -> DataFrame:
    """Joins ``calls(conv_id, call_id, after, name, arguments, position)`` and
    ``results(conv_id, call_id, content, position)``; ``after`` is an id, or an array of ids.

    One row for each id of a conversation: conv_id, call_id, status (linked, unanswered, orphan), depth,
    call_position, result_position, n_calls, n_results, valid, errors (joined by ``; ``), canonical.

    Rows with a null conv_id or call_id can't be linked: each is a row of status ``unidentified``. So is each row of
    ``context(conv_id, position, role, content)``, turns that are neither call nor result, of status ``context``. An id
    given several times is one call (or result), that of the least position (then least text); how often it came is
    returned. Arguments that aren't a JSON object are invalid, and canonical JSON then has them as a string. Empty inputs
    give no rows.
    """
    scratch = Scratch(spark, "toolcalls")
    if dict(calls.dtypes)["after"] == "string":
        calls = calls.withColumn("after", F.when(F.col("after").isNotNull(), F.array("after")))
    known = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    first = F.min(F.struct("position", "name", "arguments", "after"))
    c = calls.where(known).groupBy("conv_id", "call_id").agg(first.alias("c"), F.count("*").alias("n_calls"))
    c = scratch.save(c.select("conv_id", "call_id", "c.*", "n_calls"), "calls")
    r = results.where(known).groupBy("conv_id", "call_id").agg(F.min(F.struct("position", "content")).alias("r"), F.count("*").alias("n_results"))
    r = r.select("conv_id", "call_id", F.col("r.position").alias("result_position"), "r.content", "n_results")
    depths = order(scratch, c)
    # an outer join can't be split where keys are skewed, but (conversation, id) is unique on both sides
    rows = c.withColumnRenamed("position", "call_position").join(r, ["conv_id", "call_id"], "full").join(depths, ["conv_id", "call_id"], "left")
    null = lambda kind: F.lit(None).cast(kind)
    alone = calls.where(~known).select(*_KEY, F.col("position").alias("call_position"), "name", "arguments", "after", F.lit(1).cast("long").alias("n_calls"))
    alone = alone.unionByName(results.where(~known).select(*_KEY, F.col("position").alias("result_position"), "content", F.lit(1).cast("long").alias("n_results")), allowMissingColumns=True)
    rows = rows.withColumn("alone", F.lit(False)).unionByName(alone.withColumn("alone", F.lit(True)), allowMissingColumns=True)
    wrong = errors(F.col("name"), F.col("arguments"), schemas)
    rows = rows.withColumn("wrong", F.when(F.col("n_calls").isNotNull(), wrong))
    status = F.when(F.col("alone"), "unidentified").when(F.col("n_calls").isNull(), "orphan").when(F.col("n_results").isNull(), "unanswered").otherwise("linked")
    quoted = lambda s: F.coalesce(F.regexp_extract(F.to_json(F.struct(s.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1), F.lit(""))
    value = lambda s: F.when(s.isNull(), "null").otherwise(quoted(s))
    # arguments that are an object are put with sorted keys
    arguments = F.when(F.json_object_keys(F.to_json(F.try_parse_json("arguments"))).isNotNull(), F.to_json(F.try_parse_json("arguments"))).otherwise(value(F.col("arguments")))
    call = F.when(F.col("n_calls").isNull(), "null").otherwise(F.concat(F.lit('{"arguments":'), arguments, F.lit(',"name":'), value(F.col("name")), F.lit("}")))
    result = F.when(F.col("n_results").isNull(), "null").otherwise(value(F.col("content")))
    canonical = F.concat(F.lit('{"call":'), call, F.lit(',"id":'), value(F.col("call_id")), F.lit(',"result":'), result, F.lit("}"))
    out = rows.select(
        "conv_id",
        "call_id",
        status.alias("status"),
        "depth",
        "call_position",
        "result_position",
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"),
        F.coalesce(F.size("wrong") == 0, F.lit(False)).alias("valid"),
        F.coalesce(F.array_join("wrong", "; "), F.lit("")).alias("errors"),
        canonical.alias("canonical"),
    )
    if context is None:
        return out
    body = F.concat(F.lit('{"content":'), value(F.col("content")), F.lit(',"position":'), F.coalesce(F.col("position").cast("string"), F.lit("null")), F.lit(',"role":'), value(F.col("role")), F.lit("}"))
    kinds = dict(out.dtypes)
    cells = {"conv_id": F.col("conv_id"), "status": F.lit("context"), "call_position": F.col("position"), "n_calls": F.lit(0).cast("long"), "n_results": F.lit(0).cast("long"), "valid": F.lit(True), "errors": F.lit(""), "canonical": body}
    return out.unionByName(context.select(*(cells.get(c, null(kinds[c])).cast(kinds[c]).alias(c) for c in out.columns)))


def from_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and context of plain conversations ``turns(conv_id, turn, role, text)``: a user's turn n calls
    ``reply`` with id ``c<n>``, following the call of turn n - 2; the assistant's turn n is the result of
    ``c<n - 1>``; turns of other roles, such as system prompts, are context. Rows with a null conv_id or turn have no id."""
    ident = lambda back: F.concat(F.lit("c"), (F.col("turn") - back).cast("string"))
    calls = turns.where("role = 'user'").select(
        "conv_id",
        ident(0).alias("call_id"),
        ident(2).alias("after"),
        F.lit("reply").alias("name"),
        F.to_json(F.struct(F.col("text").alias("message"), "turn")).alias("arguments"),
        F.col("turn").cast("long").alias("position"),
    )
    results = turns.where("role = 'assistant'").select("conv_id", ident(1).alias("call_id"), F.col("text").alias("content"), F.col("turn").cast("long").alias("position"))
    other = turns.where("role IS NULL OR role NOT IN ('user', 'assistant')")
    context = other.select("conv_id", F.col("turn").cast("long").alias("position"), "role", F.col("text").alias("content"))
    return calls, results, context
