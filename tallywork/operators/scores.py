"""Totals of evaluator marks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOTAL, OTHER = "Total", "Other"


def score_totals(scores: DataFrame, dimensions: Sequence[str], value: str = "score") -> DataFrame:
    """Sums for every combination of the dimensions, ``Total`` where one is summed over.

    Marks are added up by all dimensions first: the cube then multiplies those sums and not the
    marks.
    """
    sums = scores.groupBy(*dimensions).agg(F.sum(value).alias("_sum"))
    totals = sums.cube(*dimensions).agg(
        F.sum("_sum").cast("bigint").alias("total"),
        *[F.grouping(d).alias(f"_all_{d}") for d in dimensions],
    )
    return totals.select(
        *[
            F.when(F.col(f"_all_{d}") == 1, TOTAL).otherwise(F.col(d).cast("string")).alias(d)
            for d in dimensions
        ],
        "total",
    )


def score_table(
    scores: DataFrame, row: str, column: str, columns: Sequence[str], value: str = "score"
) -> DataFrame:
    """One row per value of ``row`` and one for all; a column for each of ``columns`` and a total.

    ``Other`` adds up the marks of whatever is not among the columns, so that they are the total.
    """
    sums = scores.groupBy(row, column).agg(F.sum(value).alias("_sum"))
    shown = [
        F.coalesce(F.sum(F.when(F.col(column) == c, F.col("_sum"))), F.lit(0))
        .cast("bigint")
        .alias(c)
        for c in columns
    ]
    named = F.coalesce(F.col(column).isin(*columns), F.lit(False))
    other = F.coalesce(F.sum(F.when(~named, F.col("_sum"))), F.lit(0)).cast("bigint")
    table = sums.rollup(row).agg(
        F.grouping(row).alias("_all"),
        *shown,
        other.alias(OTHER),
        F.sum("_sum").cast("bigint").alias(TOTAL),
    )
    name = F.when(F.col("_all") == 1, TOTAL).otherwise(F.col(row).cast("string")).alias(row)
    return table.select(name, *columns, OTHER, TOTAL)
