"""Analytics of generation logs, whose lines read ``time | LEVEL | place | [xx] SCENARIO -- message``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dialoom.operators import assembly, generation


def is_retry(line: Column) -> Column:
    return F.contains(line, F.lit("retry ")) & F.contains(line, F.lit("/3:"))


def is_failure(line: Column) -> Column:
    return F.contains(line, F.lit("| ERROR")) & F.contains(line, F.lit("FAIL:"))


def is_success(line: Column) -> Column:
    return F.contains(line, F.lit("| SUCCESS")) | (F.contains(line, F.lit("OK:")) & F.contains(line, F.lit("| INFO")))


def is_api_error(line: Column) -> Column:
    return line.rlike("429|500|503|ResourceExhausted") | F.contains(F.lower(line), F.lit("rate limit"))


def events(lines: DataFrame, text: str = "value") -> DataFrame:
    """Retry and failure lines, those both counted twice: kind, value."""
    kinds = F.array_compact(F.array(F.when(is_retry(F.col(text)), "retry"), F.when(is_failure(F.col(text)), "fail")))
    return lines.select(F.explode(kinds).alias("kind"), F.col(text).alias("value"))


# Where a line tells its errors, the first that does.
MESSAGES = (r"(?d)Validation errors: (.+?)(?:\s*\(backoff|\s*$)", r"(?d)FAIL:.*?-- (.+?)$")


def message(line: Column) -> Column:
    """The errors that a line tells, or the line."""
    found = [F.nullif(F.regexp_extract(line, p, 1), F.lit("")) for p in MESSAGES]
    return F.trim(F.coalesce(*found, line))


# Texts that vary from line to line, and what stands for them, in order.
NORMAL = (
    (r"Turn \d+: ", ""),
    (r"number [\d.]+", "number N"),
    (r"food_id \d+", "food_id N"),
    (r"\([^)]*\)", "(...)"),
    (r"IDs: \{[^}]+\}", "IDs: {...}"),
    (r"~\d+ tokens", "~N tokens"),
    (r"line \d+ column \d+", "line N column N"),
)


def pattern(error: Column) -> Column:
    for what, by in NORMAL:
        error = F.regexp_replace(error, what, by)
    return F.replace(F.trim(error), F.lit("Validation errors: "), F.lit(""))


# Classes of errors, and the texts that tell them, the first that is there; one of any case.
CATEGORIES = (
    ("Hallucinated numbers", "does not match any tool result"),
    ("Invalid food_id (not in DB)", "not in known IDs"),
    ("Unit mismatch: 'pcs' on non-piece food", "unit 'pcs' used but food has no piece mode"),
    ("Unit mismatch: 'g' on non-grams food", "unit 'g' used but food has no grams/ml mode"),
    ("Conversation too short", "Too short"),
    ("Network error", "WinError"),
    ("Network error", "(?i)connection"),
    ("JSON parse error", "delimiter"),
    ("JSON parse error", "Expecting"),
    ("Missing context_block", "missing context_block"),
)


def category(error: Column) -> Column:
    """The class of a normalised error."""
    has = lambda text: error.rlike(text) if text.startswith("(?i)") else F.contains(error, F.lit(text))
    told = [F.when(has(text), label) for label, text in CATEGORIES]
    return F.coalesce(*told, F.concat(F.lit("Other: "), error))


def errors(found: DataFrame) -> DataFrame:
    """One row for each error of an event: kind, error (normalised), category."""
    each = found.select("kind", F.explode(F.split(message(F.col("value")), "; ")).alias("raw"))
    return each.select("kind", pattern(F.trim("raw")).alias("error")).withColumn("category", category(F.col("error")))


def counters(found: DataFrame) -> DataFrame:
    """Events by scenario, language and depth: what, key, n."""
    scenario = F.nullif(F.regexp_extract("value", r"\] (\w+) --", 1), F.lit(""))
    language = F.nullif(F.regexp_extract("value", r"\[(\w{2})\]", 1), F.lit(""))
    tries = F.nullif(F.regexp_extract("value", r"retry (\d+)/3", 1), F.lit(""))
    depth = F.when(F.col("kind") == "fail", "FAIL (all 3 exhausted)").when(tries.isNotNull(), F.concat(F.lit("retry "), tries, F.lit("/3")))
    pairs = F.array(*(F.struct(F.lit(n).alias("what"), v.alias("key")) for n, v in (("scenario", scenario), ("language", language), ("depth", depth))))
    return found.select(F.explode(pairs).alias("p")).select("p.*").where("key is not null").groupBy("what", "key").agg(F.count("*").alias("n"))


def saved(lines: DataFrame, text: str = "value") -> DataFrame:
    """The sum of all ``Saved n/``."""
    found = lines.select(F.explode(F.regexp_extract_all(text, F.lit(r"Saved (\d+)/"), F.lit(1))).alias("n"))
    return found.agg(F.coalesce(F.sum(F.col("n").cast("long")), F.lit(0)).alias("saved"))


def most_common(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    """Counts of each value, the commonest first, of equally common ones that seen first by ``order``: by, n, first_seen, place."""
    per = rows.groupBy(*by).agg(F.count("*").alias("n"), F.min(order).alias("first_seen"))
    # a row for each value, of which there are few
    return per.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "first_seen", *by)))


def progress(done: DataFrame, totals: DataFrame, every: int = 5) -> DataFrame:
    """How far items ``(label, at)`` had come, with ``at`` in seconds, at every so many of them: label, at, done, total,
    rate (an hour), eta (of the rest, as text; null in the first second). ``totals(label, total)``."""
    begun = done.groupBy("label").agg(F.min("at").alias("began"))
    seen = assembly.before(done, ["label"], "at", {"seen": F.lit(1)}).withColumn("done", F.col("seen") + 1).where(F.col("done") % every == 0)
    rows = seen.join(begun, "label").join(totals, "label")
    took = F.col("at") - F.col("began")
    rest = F.greatest(F.lit(0.0), took / F.col("done") * (F.col("total") - F.col("done")))
    return rows.select("label", "at", "done", "total", F.when(took > 0, F.col("done") / took * 3600).otherwise(0.0).alias("rate"), F.when(took > 1, generation.duration(rest)).alias("eta"))
