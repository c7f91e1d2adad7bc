"""Statistics over repeated measurements.

A measurement is one row per configuration and run. ``run`` counts from 1 within a configuration.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.functions import numbers
from tallywork.functions.student import two_sided_p


def measured_runs(measurements: DataFrame, warmup: int, count: int) -> DataFrame:
    """Drop the first ``warmup`` runs of each configuration and keep the next ``count``."""
    run = F.col("run")
    return measurements.filter((run > warmup) & (run <= warmup + count))


def configuration(measurements: DataFrame, **wanted: str) -> DataFrame:
    """Rows of the given configuration, for example ``seeding="static"``."""
    tests = [F.col(name) == value for name, value in wanted.items()]
    return measurements.filter(reduce(Column.__and__, tests)) if tests else measurements


def config_means(
    measurements: DataFrame, keys: Sequence[str], metrics: Sequence[str]
) -> DataFrame:
    return measurements.groupBy(*keys).agg(*[F.avg(m).alias(f"{m}_mean") for m in metrics])


def config_stats(
    measurements: DataFrame, keys: Sequence[str], metrics: Sequence[str], prefix: str = ""
) -> DataFrame:
    """Mean and sample deviation of every metric by configuration."""
    columns = []
    for metric in metrics:
        columns.append(F.avg(metric).alias(f"{prefix}{metric}_mean"))
        columns.append(F.stddev_samp(metric).alias(f"{prefix}{metric}_stdev"))
    return measurements.groupBy(*keys).agg(*columns)


def rank_means(
    means: DataFrame,
    option: str,
    by: Sequence[str],
    metrics: Sequence[str],
    mean: str = "{}_mean",
) -> DataFrame:
    """Options by the geometric mean of their ratio to the best option, best first.

    ``means`` has one row per option and setting (``by``), so the window holds one row per option.
    Nothing can be compared with a best mean that is not above zero, and a setting without a mean
    has no ratio: ``left_out`` of a metric tells how many settings of the option these are.
    """
    setting = Window.partitionBy(*by)
    ratios = []
    for m in metrics:
        own, best = F.col(mean.format(m)), F.min(mean.format(m)).over(setting)
        ratios.append(F.when(best > 0, F.try_divide(own, best)).alias(f"{m}_ratio"))
    columns = []
    for m in metrics:
        ratio = F.col(f"{m}_ratio")
        columns.append(numbers.geomean(ratio).alias(f"{m}_geomean"))
        columns.append(F.count_if(ratio.isNull()).alias(f"{m}_left_out"))
    ranked = means.select(option, *ratios).groupBy(option).agg(*columns)
    return ranked.orderBy(F.col(f"{metrics[-1]}_geomean").asc_nulls_last(), option)


def rank_options(
    measurements: DataFrame, option: str, by: Sequence[str], metrics: Sequence[str]
) -> DataFrame:
    """Means by configuration, then ``rank_means``; the last metric decides the order."""
    return rank_means(config_means(measurements, [option, *by], metrics), option, by, metrics)


def rank_cold_runs(
    measurements: DataFrame, option: str, by: Sequence[str], metric: str
) -> DataFrame:
    """The same ranking over first runs, every one of them a value of its own.

    The ratio of a value to the best is a difference of logarithms, so rows are first added up by
    option and setting, and only those sums meet the best value of their setting. ``left_out``
    counts the values of settings whose best value is not above zero, and missing values.
    """
    cold = measurements.filter(F.col("run") == 1)
    sums = cold.groupBy(option, *by).agg(
        F.count(F.lit(1)).alias("values"),
        F.count(metric).alias("n"),
        F.sum(F.ln(F.when(F.col(metric) > 0, F.col(metric)))).alias("sum_ln"),
        F.min(metric).alias("least"),
    )
    best = F.min("least").over(Window.partitionBy(*by))
    usable = F.when(best > 0, F.col("n")).otherwise(0)
    above = F.when(best > 0, F.col("sum_ln") - F.col("n") * F.ln(best))
    compared = sums.select(option, "values", usable.alias("n"), above.alias("above"))
    ranked = compared.groupBy(option).agg(
        F.exp(F.try_divide(F.sum("above"), F.sum("n"))).alias(f"{metric}_geomean"),
        (F.sum("values") - F.sum("n")).alias(f"{metric}_left_out"),
    )
    return ranked.orderBy(F.col(f"{metric}_geomean").asc_nulls_last(), option)


def best_option(ranked: DataFrame, option: str, metric: str) -> DataFrame:
    """One row: the option with the lowest value, by name where two are equal."""
    value = F.col(f"{metric}_geomean")
    least = F.min(F.when(value.isNotNull(), F.struct(value, F.col(option)))).alias("least")
    return ranked.agg(least).select(f"least.{option}", f"least.{metric}_geomean")


def paired_compare(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    names: tuple[str, str],
) -> DataFrame:
    """Statistics of two variants side by side, for the configurations that both have."""
    a = config_stats(left, keys, metrics, f"{names[0]}_")
    b = config_stats(right, keys, metrics, f"{names[1]}_")
    return a.join(b, list(keys))


def t_test(pairs: DataFrame, samples: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Two-sided two-sample t-test with pooled variance, one row per name in ``samples``.

    All tests come out of one aggregate; only its one row meets the p-value function.
    """
    aggregates = [
        call(F.col(column)).alias(f"{name}_{side}_{stat}")
        for name, columns in samples.items()
        for side, column in zip("ab", columns, strict=True)
        for stat, call in (("n", F.count), ("mean", F.avg), ("var", F.var_samp))
    ]
    tests = F.array(
        *[
            F.struct(
                F.lit(name).alias("metric"),
                *[
                    F.col(f"{name}_{side}_{stat}").alias(f"{stat}_{side}")
                    for side in "ab"
                    for stat in ("n", "mean", "var")
                ],
            )
            for name in samples
        ]
    )
    rows = pairs.agg(*aggregates).select(F.explode(tests).alias("x")).select("x.*")
    df = F.col("n_a") + F.col("n_b") - 2
    squares = (F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b")
    width = F.sqrt(
        F.try_divide(squares, F.col("df"))
        * (F.try_divide(F.lit(1.0), F.col("n_a")) + F.try_divide(F.lit(1.0), F.col("n_b")))
    )
    tested = rows.withColumn("df", df).withColumn(
        "t", F.try_divide(F.col("mean_a") - F.col("mean_b"), width)
    )
    p = two_sided_p(F.col("t"), F.col("df").cast("double"))
    return tested.select("metric", "n_a", "n_b", "mean_a", "mean_b", "t", "df", p.alias("p_value"))


def labelled_stats(
    measurements: DataFrame,
    label: Column,
    keys: Sequence[str],
    metrics: Sequence[str],
    name: str = "threads",
) -> DataFrame:
    """Statistics by configuration, with a column that names the variant."""
    # A number column of the same name gives way to the label made of it.
    named = measurements.withColumn(name, label)
    return config_stats(named, [*keys, name], metrics)


def variant_union(*variants: DataFrame) -> DataFrame:
    """All variants in one table, equal rows once."""
    return reduce(DataFrame.unionByName, variants).distinct()


def in_order(df: DataFrame) -> DataFrame:
    """Sorted by every column, for a table that is going to be read and not worked on."""
    return df.orderBy(*df.columns)


def property_check(
    measurements: DataFrame, first: DataFrame, first_rule: Column, rule: Column, by: str = "model"
) -> DataFrame:
    """How many rows there are and how many keep the rule; first runs have a rule of their own.

    ``first`` has the first run of every configuration again. All rows are counted by the common
    rule in one aggregate, which the few first runs then correct: no row has to be numbered.
    """
    counted = measurements.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(rule).alias("kept")
    )
    change = F.count_if(first_rule) - F.count_if(rule)
    corrected = first.groupBy(by).agg(F.lit(0).cast("bigint").alias("rows"), change.alias("kept"))
    return (
        counted.unionByName(corrected)
        .groupBy(by)
        .agg(
            F.sum("rows").alias("measurement_count"), F.sum("kept").alias("property_applies")
        )
        .orderBy(by)
    )


def cache_rules(value: Column, limit: float = 1) -> tuple[Column, Column]:
    """A first run works on more than ``limit``; every later run on no more than that."""
    return value > limit, value <= limit
