"""Scans: food tables, conversations as JSON lines (tolerant, strict, raw, replayed), rendered splits, logs, templates."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dialoom.functions import foodtext
from dialoom.functions.exact import strip
from dialoom.sources.schemas import ACTIONS, CONVERSATION, ROLES


def foods(spark: SparkSession, folder: str, languages: list[str] | None = None) -> DataFrame:
    """Food tables ``<lang>.csv`` of a folder (``;`` between fields, the first line skipped).

    A food's id is its line's number, so that lines with fewer than four fields leave gaps. A missing file is
    an error. The tables are small dimensions, read as whole files to keep line numbers.
    """
    paths = [f"{folder}/{x}.csv" for x in languages] if languages else f"{folder}/*.csv"
    text = spark.read.text(paths, wholetext=True)
    lang = F.regexp_extract(F.input_file_name(), r"([^/]+)\.csv$", 1)
    lines = text.select(lang.alias("lang"), F.posexplode(F.split(strip(F.col("value")), "\n")).alias("id", "line"))
    cells = lines.where("id > 0").select("lang", "id", F.split("line", ";").alias("c")).where(F.size("c") >= 4)
    return describe(cells.select("lang", "id", *(strip(F.col("c")[k]).alias(n) for k, n in enumerate(("name", "grams_text", "pieces_text", "carbs_text")))))


def describe(cells: DataFrame) -> DataFrame:
    """Quantities, units, modes, rates and category from the texts of ``lang, id, name, grams_text, pieces_text, carbs_text``."""
    rows = cells.select(
        "lang",
        F.col("id").cast("int").alias("id"),
        "name",
        foodtext.leading_number(F.col("grams_text")).alias("standard_quantity_g"),
        foodtext.leading_number(F.col("pieces_text")).alias("standard_quantity_pcs"),
        F.coalesce(foodtext.leading_number(F.col("carbs_text")), F.lit(0.0)).alias("carbs"),
        foodtext.is_liquid(F.col("grams_text")).alias("is_liquid"),
        foodtext.gram_unit(foodtext.unit_text(F.col("grams_text"))).alias("gram_unit"),
        foodtext.count_unit(foodtext.unit_text(F.col("pieces_text"))).alias("piece_unit"),
    )
    rows = rows.withColumns(
        {
            "has_grams_mode": F.col("standard_quantity_g").isNotNull() & F.col("gram_unit").isNotNull(),
            "has_pieces_mode": F.col("standard_quantity_pcs").isNotNull() & F.col("piece_unit").isNotNull(),
        }
    )
    return rows.withColumns(
        {
            "carbs_per_100g": F.when(F.col("has_grams_mode"), foodtext.carbs_per_100g("standard_quantity_g", "carbs")),
            "carbs_per_piece": F.when(F.col("has_pieces_mode"), foodtext.carbs_per_piece("standard_quantity_pcs", "carbs")),
            "category": foodtext.category(F.col("name"), F.col("standard_quantity_g"), F.col("carbs")),
        }
    )


def _read_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """JSON lines to conversations; payloads are kept as JSON text with their keys in order."""
    dump = lambda x: None if x is None else json.dumps(x, ensure_ascii=False)
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("conv", "error")}
        for line in batch.column("line").to_pylist():
            conv, error = None, None
            try:
                raw = json.loads(line)
                turns = []
                for t in raw["turns"]:
                    if t["role"] not in ROLES or t.get("action") not in (None, *ACTIONS):
                        raise ValueError("unknown role or action")
                    calls = t.get("tool_calls")
                    if not isinstance(t.get("tool_results"), (dict, type(None))) or not isinstance(t.get("content"), (str, type(None))):
                        raise ValueError("unexpected type")
                    calls = None if calls is None else [{"name": c["name"], "arguments": dump(_object(c["arguments"]))} for c in calls]
                    turns.append({"role": t["role"], "content": t.get("content"), "action": t.get("action"), "tool_calls": calls, "tool_results": dump(t.get("tool_results")), "context_block": t.get("context_block")})
                if not isinstance(raw["scenario_type"], str) or not isinstance(raw["language"], str):
                    raise ValueError("unexpected type")
                conv = {"scenario_type": raw["scenario_type"], "language": raw["language"], "turns": turns, "user_settings_idx": raw.get("user_settings_idx")}
            except (ValueError, KeyError, TypeError, AttributeError) as e:
                error = f"{type(e).__name__}: {e}"
            out["conv"].append(conv)
            out["error"].append(error)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("file", "line_no", "line")), pa.array(out["conv"], _CONV), pa.array(out["error"], pa.string())], names=["file", "line_no", "line", "conv", "error"])


def _object(x) -> dict:
    if not isinstance(x, dict):
        raise ValueError("arguments are no object")
    return x


_CALL = pa.struct([("name", pa.string()), ("arguments", pa.string())])
_TURN = pa.struct([("role", pa.string()), ("content", pa.string()), ("action", pa.string()), ("tool_calls", pa.list_(_CALL)), ("tool_results", pa.string()), ("context_block", pa.string())])
_CONV = pa.struct([("scenario_type", pa.string()), ("language", pa.string()), ("turns", pa.list_(_TURN)), ("user_settings_idx", pa.int32())])


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """All lines with their file's path and their number in it, from 0: path, line_no, value.

    A file is read in splits. Lines of a split are numbered by their place in it; the lines of the splits before are
    counted in a pass of their own, which reads no text into rows, and added.
    """
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("m"), "value")
    per = raw.groupBy("path", "split").agg(F.min("m").alias("first"), F.count("*").alias("n"))
    over = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("path", "split", "first", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before"))  # a row for each split
    return raw.join(per, ["path", "split"]).select("path", (F.col("before") + F.col("m") - F.col("first")).alias("line_no"), "value")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that aren't blank, with the name of their file (without its ending) and their number in it, from 0."""
    name = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    return numbered(spark, path).where(strip(F.col("value")) != "").select(name.alias("file"), "line_no", strip(F.col("value")).alias("line"))


def parse_lines(rows: DataFrame) -> DataFrame:
    """Lines ``(file, line_no, line)`` with the conversation each holds, or what is wrong with it: adds conv, error."""
    kind = dict(rows.dtypes)["line_no"]
    return rows.select("file", "line_no", "line").mapInArrow(_read_turns, f"file string, line_no {kind}, line string, conv struct<{CONVERSATION}>, error string")


def conversations(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Tolerant scan: conversations, and broken lines with what is wrong with them."""
    read = parse_lines(lines(spark, path))
    good = read.where("conv is not null").select("file", "line_no", "conv.*")
    return good, read.where("conv is null").select("file", "line_no", "line", "error")


def strict_conversations(spark: SparkSession, path: str) -> DataFrame:
    """As ``conversations``, but a broken line is an error when it is read."""
    read = parse_lines(lines(spark, path))
    checked = F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.col("file"), F.lit(": "), F.col("error"))).cast("string"))
    return read.where(checked.isNull()).select("file", "line_no", "conv.*")


def raw_json(spark: SparkSession, path: str, scenarios: list[str] | None = None) -> DataFrame:
    """Lines that are JSON objects, unvalidated: file, line_no, line, scenario_type; others are left out."""
    rows = lines(spark, path).withColumn("scenario_type", F.get_json_object("line", "$.scenario_type"))
    rows = rows.where(F.json_object_keys("line").isNotNull())
    return rows.where(F.col("scenario_type").isin(scenarios)) if scenarios else rows


def rendered(spark: SparkSession, folder: str, splits: tuple[str, ...] = ("train", "eval"), name: str = "{}.jsonl") -> DataFrame:
    """Rendered examples of all splits: split, text. ``name`` makes a split's file or folder, such as ``split={}``."""
    parts = [spark.read.schema("text string").json(f"{folder}/{name.format(s)}").select(F.lit(s).alias("split"), "text") for s in splits]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def prefix(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows by the given columns, as a dataset slice takes them."""
    return df.orderBy(*order).limit(n)


# Speakers of other collections, and their roles here.
SPEAKERS = {"human": "user", "gpt": "assistant", "system": "system"}


def standardised(said: Column) -> Column:
    """An array of turns ``(from, value)`` as turns ``(role, content)``; a speaker that isn't known keeps its name."""
    role = lambda t: F.coalesce(F.create_map(*(F.lit(x) for pair in SPEAKERS.items() for x in pair))[t["from"]], t["from"])
    return F.transform(said, lambda t: F.struct(role(t).alias("role"), t["value"].alias("content")))


_foods: dict[tuple, DataFrame] = {}


def cached_foods(spark: SparkSession, folder: str, languages: list[str] | None = None, most: int = 32) -> DataFrame:
    """As ``foods``, kept in memory by the executors; of the last ``most`` folders and languages asked for."""
    key = (spark.sparkContext.applicationId, folder, tuple(languages or ()))
    if key not in _foods:
        while len(_foods) >= most:
            _foods.pop(next(iter(_foods))).unpersist()
        _foods[key] = foods(spark, folder, languages).cache()
    return _foods[key]


def log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def template(spark: SparkSession, path: str) -> str:
    """A prompt template's text, read by Spark so that any store serves."""
    return spark.read.text(path, wholetext=True).first()["value"]


def tool_schema(spark: SparkSession, path: str) -> str:
    """The ``tools`` part of a schema file, indented."""
    return json.dumps(json.loads(template(spark, path))["tools"], ensure_ascii=False, indent=2)
