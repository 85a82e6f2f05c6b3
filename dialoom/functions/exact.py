"""Expressions whose results must agree to the last bit with IEEE arithmetic, Python's formatting or rank definitions.

Those named ``*_sql`` give text that Spark SQL and other dialects read alike.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once a row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def cuts_below(cuts: list, value: Column) -> Column:
    """How many of the ascending cuts aren't above the value: looked up among every s-th, then among the s that follow it."""
    if not cuts:
        return F.lit(0)
    s = math.isqrt(len(cuts) - 1) + 1
    count = lambda a: F.size(F.filter(a, lambda c: c <= value))
    first = (count(F.array(*map(F.lit, cuts[::s]))) - 1) * s
    return F.when(first < 0, 0).otherwise(first + count(F.slice(F.array(*map(F.lit, cuts)), F.greatest(first, F.lit(0)) + 1, s)))


def py_round_sql(x: str, digits: int = 2) -> str:
    """Python's ``round(x, digits)`` of a double: correctly rounded from the binary value, ties to even.

    Exact product by splitting x in halves (Dekker): the product's rounding error decides near ties.
    """
    k = f"CAST({10**digits} AS DOUBLE)"
    a, half = f"abs({x})", "CAST(0.5 AS DOUBLE)"
    s = f"({a} * CAST(134217729 AS DOUBLE))"
    hi = f"({s} - ({s} - {a}))"
    p = f"({a} * {k})"
    err = f"(({hi} * {k} - {p}) + ({a} - {hi}) * {k})"
    part = f"({p} - floor({p}))"
    up = f"CASE WHEN {part} > {half} OR ({part} = {half} AND ({err} > 0 OR ({err} = 0 AND floor({p}) % 2 = 1))) THEN 1 ELSE 0 END"
    return f"(sign({x}) * (floor({p}) + {up}) / {k})"


def fixed_sql(x: str, digits: int = 2) -> str:
    """Python's ``f"{x:.<digits>f}"`` of a double."""
    k = 10**digits
    n = f"CAST(round(abs({py_round_sql(x, digits)}) * {k}) AS BIGINT)"
    whole = f"CAST(CAST(floor({n} / {k}) AS BIGINT) AS STRING)"
    sign = f"CASE WHEN {x} < 0 THEN '-' ELSE '' END"
    if not digits:
        return f"concat({sign}, CAST({n} AS STRING))"
    return f"concat({sign}, {whole}, '.', lpad(CAST({n} % {k} AS STRING), {digits}, '0'))"


def number_sql(x: str) -> str:
    """A double for running text: whole numbers without decimals, others with at most two."""
    fixed = fixed_sql(x)
    return f"CASE WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS STRING) ELSE regexp_replace({fixed}, '[.]?0+$', '') END"


def py_round(x: str, digits: int = 2) -> Column:
    return F.expr(py_round_sql(x, digits))


def strip(x: Column) -> Column:
    """Python's ``str.strip``: all Unicode white space."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def tokens_estimate(x: Column) -> Column:
    """Characters // 4; null is empty."""
    return F.floor(F.length(F.coalesce(x, F.lit(""))) / 4)


def percentile_at(column: str, q: float) -> Column:
    """The element of rank floor(n * q) (from 0) of the sorted values: for q = 0.5 the upper median.

    For groups that fit a task, such as strata; ``percentiles`` serves whole tables.
    """
    values = F.sort_array(F.collect_list(column))
    return F.element_at(values, F.least(F.size(values), F.floor(F.size(values) * F.lit(q)).cast("int") + 1))


def percentiles(counts: str, shares: list[tuple[str, float]]) -> list[Column]:
    """Elements of rank floor(n * q) from a column of (value, n) structs that lists each distinct value once.

    ``counts`` comes from a group by value, so that a whole table's percentiles need one row for each distinct
    value rather than one for each row.
    """
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("v"))

    def at(pairs: Column, rank: Column) -> Column:
        def step(a: Column, p: Column) -> Column:
            seen = a["seen"] + p["n"]
            return F.struct(seen.alias("seen"), F.when(a["v"].isNull() & (seen > rank), p["value"].cast("long")).otherwise(a["v"]).alias("v"))

        return F.aggregate(pairs, start, step)["v"]

    def of(q: float) -> Column:
        total = lambda pairs: F.aggregate(pairs, F.lit(0).cast("long"), lambda a, p: a + p["n"])
        rank = lambda n: F.least(n - 1, F.floor(n * F.lit(q)))
        return let(F.sort_array(F.col(counts)), lambda pairs: let(rank(total(pairs)), lambda r: at(pairs, r)))

    return [of(q).alias(name) for name, q in shares]
