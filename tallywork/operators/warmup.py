"""Warm-up detection: the error of the mean after dropping the first w runs.

For every w the variance over the remaining runs is divided by their number (MSER). That is a
frame from the current run to the last one, which Spark would compute again from each row on, and
for which it would bring all runs of a configuration into one task. Here the runs are taken from
the last to the first, so the frame only grows, and in blocks of consecutive runs (see ``scan``):
count, mean and squared deviations of what lies behind a block are merged into those of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions import numbers
from tallywork.operators.scan import BITS, LEVELS, in_blocks, scan_before
from tallywork.sources.shared_folder import written


def trailing_error(
    measurements: DataFrame,
    keys: Sequence[str],
    metric: str = "ttft",
    run: str = "run",
    numbered: bool = True,
    bits: int = BITS,
) -> DataFrame:
    """(keys, warmup_runs, mse, previous_mse) of every run that at least one run follows.

    ``mse`` is the variance of this and all later runs over their number; ``previous_mse`` the
    same with one run more in front, NULL for the first run. Runs without a value count in the
    number only.

    ``run`` is an integer that comes once per configuration. With ``numbered`` it counts from 1;
    without, it only gives the order, and the runs before each one are counted in the same pass.

    What lies behind a block is found with a scan over block rows, in blocks of its own, so sparse
    order numbers, with a block for every row, do not bring a configuration into one task either. The
    block rows are written to the shared folder: the measurements are read twice, once for the blocks and once
    for the runs, whatever the scan over the blocks takes.
    """
    named = measurements.selectExpr(*keys, f"{run} AS _run", f"CAST({metric} AS DOUBLE) AS _x")
    rows, at = in_blocks(named, keys, "_run", bits, LEVELS + 1)
    group, block = at

    blocks = written(rows.groupBy(at).agg(
        F.expr("count(*) AS b_rows"),
        F.expr("count(_x) AS b_n"),
        F.expr("coalesce(avg(_x), 0D) AS b_mean"),
        F.expr("coalesce(var_pop(_x) * count(_x), 0D) AS b_m2"),
        F.expr("max_by(_x, _run) AS b_last"),
    ), "run-blocks")
    # Means are added up as differences to the mean of the last block, where a series has settled.
    whole = blocks.groupBy(group).agg(
        F.expr("sum(b_rows) AS all_rows"), F.expr(f"max_by(b_mean, {block}) AS centre")
    )
    centred = blocks.join(whole, group).selectExpr(
        "*", "b_mean - centre AS off", f"-{block} AS from_last"
    )
    off = F.col("off")
    # In the order from the last block on, the block before one is the one that follows it.
    behind = scan_before(
        centred,
        [group],
        "from_last",
        {
            "c_rows": F.col("b_rows"),
            "c_n": F.col("b_n"),
            "c_off": F.col("b_n") * off,
            "c_sq": F.col("b_m2") + F.col("b_n") * off * off,
        },
        bits,
        following={"c_last": F.col("b_last")},
    )
    carry = behind.withColumn("c_mean_off", F.expr("coalesce(try_divide(c_off, c_n), 0D)")).selectExpr(
        *at,
        "b_rows",
        "all_rows",
        "c_rows",
        "c_n",
        "centre + c_mean_off AS c_mean",
        "greatest(c_sq - c_off * c_mean_off, 0D) AS c_m2",
        "c_last",
    )

    from_end = f"PARTITION BY {', '.join(at)} ORDER BY _run DESC"
    so_far = f"({from_end} ROWS UNBOUNDED PRECEDING)"
    local = rows.join(carry, at).selectExpr(
        "*",
        f"count(*) OVER {so_far} AS l_rows",
        f"count(_x) OVER {so_far} AS l_n",
        f"coalesce(avg(_x) OVER {so_far}, 0D) AS l_mean",
        f"coalesce(var_pop(_x) OVER {so_far}, 0D) AS l_var",
        f"lead(_x) OVER ({from_end}) AS l_earlier",
    )
    merged = local.selectExpr(
        *keys,
        f"{'_run - 1' if numbered else 'all_rows - c_rows - l_rows'} AS warmup_runs",
        "l_rows + c_rows AS rows",
        "l_n + c_n AS n",
        "try_divide(l_n * l_mean + c_n * c_mean, l_n + c_n) AS mean",
        """l_var * l_n + c_m2
           + coalesce(try_divide(pow(l_mean - c_mean, 2) * l_n * c_n, l_n + c_n), 0D) AS m2""",
        "l_rows + c_rows < all_rows AS has_earlier",
        # The run before this one: in the block, or the last one of the block before.
        "CASE WHEN l_rows < b_rows THEN l_earlier ELSE c_last END AS x",
    )
    with_earlier = """
        CASE WHEN x IS NULL THEN m2 / (n - 1)
             ELSE (m2 + pow(x - mean, 2) * n / (n + 1)) / n END / (rows + 1)"""
    return merged.filter("n > 1").selectExpr(
        *keys,
        "warmup_runs",
        "m2 / (n - 1) / rows AS mse",
        f"CASE WHEN has_earlier THEN {with_earlier} END AS previous_mse",
    )


def error_quotients(errors: DataFrame) -> DataFrame:
    """By number of dropped runs, the geometric mean of how much dropping one more has gained.

    An error of zero leaves nothing to gain: ``left_out`` counts the configurations where that is so.
    """
    later = errors.filter(F.col("previous_mse").isNotNull())
    quotient = F.try_divide(F.col("previous_mse"), F.col("mse"))
    return (
        later.groupBy("warmup_runs")
        .agg(
            numbers.geomean(quotient).alias("mse_quotient_geomean"),
            F.count_if(quotient.isNull()).alias("left_out"),
        )
        .orderBy("warmup_runs")
    )
