"""Parsing of food descriptions: units, leading numbers, categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialoom.functions import fixed
from dialoom.functions.exact import strip

DIGITS = "०१२३४५६७८९٠١٢٣٤٥٦٧٨٩"


def _lookup(values: dict[str, str], raw: Column) -> Column:
    found = F.create_map(*(F.lit(x) for pair in values.items() for x in pair))[F.lower(strip(raw))]
    return F.coalesce(found, strip(raw))


def gram_unit(raw: Column) -> Column:
    """Code of a weight or volume unit; an unknown one stays, without white space around it."""
    return _lookup(fixed.GRAM_UNITS, raw)


def count_unit(raw: Column) -> Column:
    """Code of a counting unit; an unknown one stays, without white space around it."""
    return _lookup(fixed.COUNT_UNITS, raw)


def leading_number(raw: Column) -> Column:
    """The number that the text begins with (comma or point); null if none. ``1/2`` gives 1.0."""
    found = F.regexp_extract(strip(raw), r"(?U)^(\d+(?:[.,]\d+)?)", 1)
    return F.translate(F.replace(found, F.lit(","), F.lit(".")), DIGITS, "01234567890123456789").try_cast("double")


def fraction(raw: Column) -> Column:
    """As ``leading_number``, but ``1/2`` gives 0.5."""
    below = F.regexp_extract(strip(raw), r"^\d+(?:[.,]\d+)?\s*/\s*(\d+)", 1).try_cast("double")
    return F.when(below > 0, leading_number(raw) / below).otherwise(leading_number(raw))


def unit_text(raw: Column) -> Column:
    """What follows a leading number; null if the text has none or nothing follows."""
    return F.nullif(strip(F.regexp_extract(strip(raw), r"(?Us)^[\d.,/ ]+(.*)$", 1)), F.lit(""))


def is_liquid(raw: Column) -> Column:
    return F.contains(F.lower(raw), F.lit("ml"))


def category(name: Column, grams: Column, carbs: Column) -> Column:
    """Keywords first, in order, then ranges of carbs."""
    has = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(F.lower(name), w))
    return (
        F.when(has(fixed.DAIRY), "dairy")
        .when(has(fixed.LEGUMES), "legumes")
        .when(has(fixed.STARCHY) & grams.isNull(), "starchy_vegetables")
        .when(carbs <= 5.5, "vegetables")
        .when(carbs.between(12, 16), "fruits")
        .otherwise("other")
    )


def carbs_per_100g(grams: str, carbs: str) -> Column:
    from dialoom.functions.exact import py_round_sql

    return F.when(F.col(grams) > 0, F.expr(py_round_sql(f"({carbs} / {grams} * 100)")))


def carbs_per_piece(pieces: str, carbs: str) -> Column:
    from dialoom.functions.exact import py_round_sql

    return F.when(F.col(pieces) > 0, F.expr(py_round_sql(f"({carbs} / {pieces})")))


def item_carbs(quantity: Column, unit: Column, carbs: Column, grams: Column, pieces: Column) -> Column:
    """Carbs of an item; null where the food has no quantity for that kind of unit."""
    return F.when(unit.isin(*fixed.WEIGHED) & grams.isNotNull(), quantity * carbs / grams).when(unit.isin(*fixed.COUNTED) & pieces.isNotNull(), quantity * carbs / pieces)
