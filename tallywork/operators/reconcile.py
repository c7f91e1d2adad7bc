"""Compare two key/value results, allowing for rounding in numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.functions import numbers

# Fixed value: the relative error of a number that still counts as the same result.
TOLERANCE = 0.001


def _verdict(
    in_left: Column, in_right: Column, several: Column, left: Column, right: Column, tol: float
) -> Column:
    error = numbers.relative_error(left, right)
    return (
        F.when(several, "duplicate")
        .when(~in_right, "missing")
        .when(~in_left, "extra")
        .when(left.eqNullSafe(right), "equal")
        .when(error <= tol, "within tolerance")
        .otherwise("changed")
    )


def reconcile(
    left: DataFrame, right: DataFrame, keys: Sequence[str] = ("key",), tolerance: float = TOLERANCE
) -> DataFrame:
    """Keys with both values, the relative error and one of six verdicts.

    missing (only left has the key), extra (only right), duplicate (a side has different values
    under the key), equal, within tolerance, changed. A text that differs is changed, and so is a
    number whose left side is zero.

    Both sides go through one aggregate by key, combined before the shuffle, instead of a join:
    keys are not multiplied with one another, whatever is in the data. The same value several times
    is one value; of different ones the largest is shown.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.lit(name).alias("side"), F.col("value").cast("string"))

    both = side(left, "left").unionByName(side(right, "right"))
    is_left = F.col("side") == "left"

    def differ(own: Column) -> Column:
        value = F.when(own, F.col("value"))
        unlike = F.coalesce(F.min(value) != F.max(value), F.lit(False))
        return unlike | F.count(value).between(F.lit(1), F.count_if(own) - 1)

    found = both.groupBy(*keys).agg(
        F.bool_or(is_left).alias("in_left"),
        F.bool_or(~is_left).alias("in_right"),
        (differ(is_left) | differ(~is_left)).alias("several"),
        F.max(F.when(is_left, F.col("value"))).alias("left_value"),
        F.max(F.when(~is_left, F.col("value"))).alias("right_value"),
    )
    left_value, right_value = F.col("left_value"), F.col("right_value")
    verdict = _verdict(
        F.col("in_left"), F.col("in_right"), F.col("several"), left_value, right_value, tolerance
    )
    return found.select(
        *keys,
        "left_value",
        "right_value",
        numbers.relative_error(left_value, right_value).alias("relative_error"),
        verdict.alias("verdict"),
    )


def acceptable(compared: DataFrame) -> DataFrame:
    """One row: how many keys of each verdict, and whether all are equal or within tolerance."""
    verdicts = ("equal", "within tolerance", "changed", "missing", "extra", "duplicate")
    counts = [F.count_if(F.col("verdict") == v).alias(v.replace(" ", "_")) for v in verdicts]
    bad = F.col("changed") + F.col("missing") + F.col("extra") + F.col("duplicate")
    return compared.agg(*counts).withColumn("acceptable", bad == 0)
