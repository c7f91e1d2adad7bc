"""Numeric expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hours(seconds: Column) -> Column:
    return seconds / 3600


def safe_integer(text: Column) -> Column:
    """The number in a text, NULL for any other text.

    Only what looks like a number is cast: a cast that fails costs far more than a pattern.
    """
    return F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), text.try_cast("bigint"))


def geomean(values: Column) -> Column:
    """Geometric mean: 0 if there is a zero among the values, NULL if one is below zero or there is none."""
    mean = F.exp(F.avg(F.ln(F.when(values > 0, values))))
    return F.when(F.min(values) > 0, mean).when(F.min(values) == 0, F.lit(0.0))


def ratio_or_one(part: Column, whole: Column) -> Column:
    """part / whole, 1.0 where there is no whole to compare with."""
    return F.when(whole == 0, F.lit(1.0)).otherwise(part / whole)


def rate(delta: Column, elapsed: Column) -> Column:
    """delta / elapsed, NULL over an empty interval."""
    return F.try_divide(delta, elapsed)


def busy_cpu_time(uptime: Column, idle: Column, cpus: Column | int) -> Column:
    """CPU seconds in use since boot, per core; ``idle`` is summed over the cores."""
    cpus = F.lit(cpus) if isinstance(cpus, int) else cpus
    return (uptime * cpus - idle) / cpus


def relative_error(left: Column, right: Column) -> Column:
    """abs(left - right) / abs(left) of two texts; NULL if one is no number or left is zero."""
    a, b = left.try_cast("double"), right.try_cast("double")
    return F.try_divide(F.abs(a - b), F.abs(a))


def double_text(value: str) -> str:
    """SQL for a double as plain digits, never with an exponent: ``12345678.5``, ``0.00027``."""
    digits = f"rtrim('0', CAST(CAST(CAST({value} AS STRING) AS DECIMAL(38, 21)) AS STRING))"
    return f"CASE WHEN {value} = 0 THEN '0.0' ELSE regexp_replace({digits}, '[.]$', '.0') END"


# Types of texts, from the narrowest on.
TYPES = ("INT", "BIGINT", "DOUBLE", "STRING")


def type_rank(text: Column) -> Column:
    """1 to 4 for the narrowest of TYPES that takes a text, 0 for none or an empty one."""
    whole, number = text.rlike("^[+-]?[0-9]+$"), text.rlike(r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$")
    return (
        F.when(text.isNull() | (text == ""), 0)
        .when(whole & text.try_cast("int").isNotNull(), 1)
        .when(whole & text.try_cast("bigint").isNotNull(), 2)
        .when(number, 3)
        .otherwise(4)
    )


def type_of_rank(rank: Column) -> Column:
    return F.when(rank > 0, F.element_at(F.array(*map(F.lit, TYPES)), F.greatest(rank, F.lit(1))))


def rank_of_type(kind: Column) -> Column:
    return F.coalesce(F.array_position(F.array(*map(F.lit, TYPES)), kind).cast("int"), F.lit(0))
