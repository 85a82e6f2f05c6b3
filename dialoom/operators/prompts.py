"""Parts of prompts: settings, foods, personas and length hints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions import fixed
from dialoom.functions.exact import fixed_sql
from dialoom.operators.render import food_line

# Personas, dealt in turn.
PERSONAS = ("terse", "verbose", "confused", "slang", "formal")


def settings_text(pool: DataFrame, training: bool = False) -> DataFrame:
    """Each of ``pool(idx, threshold, baseline, divisor, dividers)`` as a prompt's text: idx, text."""
    whole, one = (lambda c: F.expr(fixed_sql(c, 0))), (lambda c: F.expr(fixed_sql(c, 1)))
    divider = lambda p: F.col("dividers")[p].cast("string")
    if training:
        hours = ", ".join(f"{p.capitalize()} ({a}:00-{b}:00)" for p, a, b in fixed.PERIODS)
        parts = [
            "CURRENT USER SETTINGS:\n- Glucose: threshold=", one("threshold"), " mg/dL, baseline=", one("baseline"), " mg/dL, divisor=", one("divisor"), " mg/dL per unit\n- Meal dividers: Morning=",
            divider("morning"), ", Midday=", divider("midday"), ", Evening=", divider("evening"), f"\n- Meal time ranges: {hours}",
        ]
    else:
        hours = ", ".join(f"{p.capitalize()} {a}:00-{b}:00" for p, a, b in fixed.PERIODS)
        parts = [
            "The current user has these settings:\n- Glucose threshold: ", whole("threshold"), " mg/dL (only correct BG above this)\n- Glucose baseline: ", whole("baseline"), " mg/dL\n- Glucose divisor: ", whole("divisor"),
            " mg/dL per insulin unit\n- Meal dividers: Morning=", divider("morning"), ", Midday=", divider("midday"), ", Evening=", divider("evening"), f"\n- Meal time ranges: {hours}",
        ]
    return pool.select("idx", F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts)).alias("text"))


def food_list(foods: DataFrame) -> DataFrame:
    """Foods as the lines of a prompt, by language and id: lang, text."""
    cells = {"id": "id", "name": "name", "grams": "has_grams_mode", "pieces": "has_pieces_mode", "quantity_g": "standard_quantity_g", "quantity_pcs": "standard_quantity_pcs", "gram_unit": "gram_unit", "piece_unit": "piece_unit", "carbs": "carbs"}
    line = food_line({k: F.col(c) for k, c in cells.items()})
    lines = F.transform(F.array_sort(F.collect_list(F.struct("id", line.alias("line")))), lambda x: x["line"])
    return foods.groupBy("lang").agg(F.array_join(lines, "\n").alias("text"))


def usage_lines(extremes: DataFrame) -> DataFrame:
    """``usage_extremes`` as a prompt's lines, in order: kind, text."""
    line = F.when(F.col("kind") == "avoid", F.concat(F.lit("  AVOID "), "name", F.lit(" ("), F.col("id"), F.lit(") - used "), F.col("uses"), F.lit("x already"))).otherwise(
        F.concat(F.lit("  PREFER "), "name", F.lit(" ("), F.col("id"), F.lit(") - used only "), F.col("uses"), F.lit("x"))
    )
    rank = F.when(F.col("kind") == "avoid", -F.col("uses")).otherwise(F.lit(0))
    return extremes.groupBy("kind").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(rank.alias("r"), "id", line.alias("t")))), lambda x: x["t"]), "\n").alias("text"))


def persona(total: Column) -> Column:
    """The persona of the next conversation, by how many there are."""
    return F.element_at(F.array(*map(F.lit, PERSONAS)), (F.pmod(total, F.lit(len(PERSONAS))) + 1).cast("int"))
