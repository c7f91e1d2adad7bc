"""Roll-ups of Spark's own task records, and statistics over repeated runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.functions import numbers, spark_time

SHUFFLE = (
    "shuffle_write_bytes",
    "shuffle_write_records",
    "shuffle_read_bytes",
    "shuffle_read_records",
)
SKIPPED = "SKIPPED"


def _working_ratio(threads: int) -> Column:
    """Share of the threads' time that tasks were running, 1 for what took no time."""
    return numbers.ratio_or_one(F.col("working_time"), F.col("execution_time") * threads)


def stage_rollup(stages: DataFrame, tasks: DataFrame, threads: int) -> DataFrame:
    """One row per stage with what its tasks add up to.

    Tasks are added up by stage before they meet the stages, so the join has one row per stage on
    either side however many tasks a stage has. Where both know the attempt, tasks of other attempts
    do not count.
    """
    attempt = [c for c in ("attempt_id",) if c in stages.columns and c in tasks.columns]
    worked = tasks.groupBy("stage_id", *attempt).agg(
        F.expr("count(*) AS ran"), F.expr("sum(duration_ms) / 1000D AS worked")
    )
    start, end = spark_time.moment("submitted"), spark_time.moment("completed")
    rolled = stages.join(worked, ["stage_id", *attempt], "left").selectExpr(
        "stage_id",
        f"status = '{SKIPPED}' AS skipped",
        f"CASE WHEN status = '{SKIPPED}' THEN 0D ELSE {spark_time.span_seconds(start, end)} END"
        " AS execution_time",
        "CAST(num_tasks AS BIGINT) AS num_tasks",
        "coalesce(ran, 0L) AS num_nonskipped_tasks",
        "coalesce(worked, 0D) AS working_time",
        *SHUFFLE,
    )
    return rolled.withColumn("working_time_ratio", _working_ratio(threads))


def job_rollup(
    jobs: DataFrame, job_stages: DataFrame, stages: DataFrame, threads: int
) -> DataFrame:
    """One row per job from the rows of ``stage_rollup``; a stage counts in each job that has it.

    Spark forgets old stages: those that a job lists and that have no record count among its stages
    and in ``num_unknown_stages``; the sums are those of the others.
    """
    executed = "CASE WHEN NOT skipped THEN num_nonskipped_tasks END"
    known = stages.withColumn("known", F.lit(True))
    added = job_stages.join(known, "stage_id", "left").groupBy("job_id").agg(
        F.expr("count(*) AS num_stages"),
        F.expr("count(*) - count(known) AS num_unknown_stages"),
        F.expr("count_if(NOT skipped) AS num_nonskipped_stages"),
        F.expr("sum(num_nonskipped_tasks) AS num_nonskipped_tasks"),
        F.expr("sum(working_time) AS working_time"),
        *[F.expr(f"sum({c}) AS {c}") for c in SHUFFLE],
        F.expr(f"min({executed}) AS min_tasks"),
        F.expr(f"max({executed}) AS max_tasks"),
    )
    counts = (
        "num_stages",
        "num_unknown_stages",
        "num_nonskipped_stages",
        "num_nonskipped_tasks",
        *SHUFFLE,
    )
    timed = jobs.selectExpr(
        "job_id",
        "name",
        f"{spark_time.moment('submitted')} AS started",
        f"{spark_time.moment('completed')} AS ended",
        "CAST(num_tasks AS BIGINT) AS num_tasks",
    )
    rolled = timed.join(added, "job_id", "left").selectExpr(
        "job_id",
        "name",
        "started",
        "ended",
        f"{spark_time.span_seconds('started', 'ended')} AS execution_time",
        "num_tasks",
        "coalesce(working_time, 0D) AS working_time",
        *[f"coalesce({c}, 0L) AS {c}" for c in counts],
        "min_tasks AS min_nonskipped_tasks_per_stage",
        "max_tasks AS max_nonskipped_tasks_per_stage",
    )
    return rolled.withColumn("working_time_ratio", _working_ratio(threads))


def query_rollup(jobs: DataFrame, threads: int) -> DataFrame:
    """One row from the rows of ``job_rollup``.

    The time of a query runs from its first submission to its last completion.
    """
    sums = (
        "num_stages",
        "num_unknown_stages",
        "num_nonskipped_stages",
        "num_tasks",
        "num_nonskipped_tasks",
        "working_time",
        *SHUFFLE,
    )
    fewest, most = "min_nonskipped_tasks_per_stage", "max_nonskipped_tasks_per_stage"
    rolled = jobs.agg(
        F.expr("count(*) AS num_jobs"),
        *[F.expr(f"sum({c}) AS {c}") for c in sums],
        F.expr(f"{spark_time.span_seconds('min(started)', 'max(ended)')} AS execution_time"),
        F.expr(f"min({fewest}) AS {fewest}"),
        F.expr(f"max({most}) AS {most}"),
    )
    return rolled.withColumn("working_time_ratio", _working_ratio(threads))


def without_warmup(runs: DataFrame, warmup: int, run: str = "run") -> DataFrame:
    """Drop the warm-up runs and number the others from 1."""
    return runs.filter(F.col(run) > warmup).withColumn(run, F.col(run) - warmup)


def run_statistics(runs: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """(keys, metric, mean, stdev) over the runs; one run alone has no deviation.

    Metrics are aggregated side by side and turned into rows afterwards, so the input is not
    multiplied by their number.
    """
    stats = runs.groupBy(*keys).agg(
        *[F.expr(f"struct(avg({m}) AS mean, stddev_samp({m}) AS stdev) AS {m}") for m in metrics]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.col(f"{m}.mean").alias("mean"),
                F.col(f"{m}.stdev").alias("stdev"),
            )
            for m in metrics
        ]
    )
    return stats.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")


def run_statistics_without(
    runs: DataFrame, dropped: DataFrame, keys: Sequence[str], metrics: Sequence[str]
) -> DataFrame:
    """``run_statistics`` of the runs without some of them, which ``dropped`` has again.

    Count, mean and squared deviations of all runs come from one aggregate, and those of the few
    dropped ones are taken out of them: no run has to be numbered, sorted or joined. A configuration
    of which all runs are dropped has no row.
    """

    def moments(df: DataFrame, sign: int) -> DataFrame:
        own = [
            F.expr(
                f"struct({sign} AS sign, count({m}) AS n, coalesce(avg({m}), 0D) AS mean,"
                f" coalesce(var_pop({m}) * count({m}), 0D) AS m2) AS {m}"
            )
            for m in metrics
        ]
        return df.groupBy(*keys).agg(F.expr(f"{sign} * count(*) AS _rows"), *own)

    def left(m: str) -> Column:
        part = lambda sign, field: F.coalesce(
            F.max(F.when(F.col(f"{m}.sign") == sign, F.col(f"{m}.{field}"))), F.lit(0)
        )
        fields = [
            part(sign, field).alias(f"{side}_{field}")
            for sign, side in ((1, "all"), (-1, "gone"))
            for field in ("n", "mean", "m2")
        ]
        return F.struct(*fields).alias(m)

    both = moments(runs, 1).unionByName(moments(dropped, -1))
    merged = both.groupBy(*keys).agg(F.sum("_rows").alias("_rows"), *[left(m) for m in metrics])
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("x")) for m in metrics])
    return (
        merged.filter("_rows > 0")
        .select(*keys, F.explode(rows).alias("r"))
        .select(*keys, "r.metric", "r.x.*")
        .withColumn("n", F.expr("all_n - gone_n"))
        .withColumn("mean", F.expr("try_divide(all_n * all_mean - gone_n * gone_mean, n)"))
        .withColumn(
            "m2",
            F.expr("all_m2 - gone_m2 - pow(gone_mean - mean, 2) * n * gone_n / all_n"),
        )
        .selectExpr(
            *keys,
            "metric",
            "mean",
            "CASE WHEN n > 1 THEN sqrt(greatest(m2, 0D) / (n - 1)) END AS stdev",
        )
    )


def first_run(
    runs: DataFrame, keys: Sequence[str], metrics: Sequence[str], run: str = "run"
) -> DataFrame:
    """Metrics that do not change between runs, copied from the first one."""
    return runs.groupBy(*keys).agg(*[F.min_by(m, run).alias(m) for m in metrics])


def statistics_document(
    runs: DataFrame, keys: Sequence[str], groups: dict[str, list[str]]
) -> DataFrame:
    """The statistics as nested structs, one per group of metrics, ready to be written as JSON."""
    structs = []
    for group, metrics in groups.items():
        fields = []
        for m in metrics:
            fields += [F.avg(m).alias(f"{m}Mean"), F.stddev_samp(m).alias(f"{m}Stdev")]
        structs.append(F.struct(*fields).alias(group))
    return runs.groupBy(*keys).agg(*structs)


def job_documents(jobs: DataFrame, job_stages: DataFrame, stages: DataFrame) -> DataFrame:
    """One nested record per job: its own fields and ``stages``, an array of structs in the order of their numbers.

    ``jobs`` are rows of ``job_rollup``, ``stages`` of ``stage_rollup``. A record is as large as the job's list of stages, however many
    tasks these have; a job without stages has an empty array, and a stage without a record has its number only.
    """
    fields = [F.col(name) for name in stages.columns if name != "stage_id"]
    known = stages.select("stage_id", F.struct(*fields).alias("record"))
    listed = job_stages.join(known, "stage_id", "left").groupBy("job_id").agg(F.sort_array(F.collect_list(F.struct("stage_id", "record"))).alias("stages"))
    none = F.array().cast(listed.schema["stages"].dataType)
    return jobs.join(listed, "job_id", "left").withColumn("stages", F.coalesce("stages", none))


def counter_phases(
    samples: DataFrame, keys: Sequence[str], counters: Sequence[str], phase: str = "phase"
) -> DataFrame:
    """Growth of every counter while loading, while processing and in total.

    Samples are taken before loading (phase 0), after it (1) and after processing (2).
    """
    at = {
        (c, p): F.max(F.when(F.col(phase) == p, F.col(c))) for c in counters for p in range(3)
    }
    columns = []
    for c in counters:
        columns += [
            (at[c, 1] - at[c, 0]).alias(f"load_{c}"),
            (at[c, 2] - at[c, 1]).alias(f"process_{c}"),
            (at[c, 2] - at[c, 0]).alias(f"total_{c}"),
        ]
    return samples.groupBy(*keys).agg(*columns)


def phase_rates(phases: DataFrame, counter: str, clock: str) -> DataFrame:
    """Growth of a counter per unit of the clock, phase by phase: CPU usage from CPU time."""
    return phases.select(
        "*",
        *[
            numbers.rate(F.col(f"{part}_{counter}"), F.col(f"{part}_{clock}")).alias(
                f"{part}_{counter}_rate"
            )
            for part in ("load", "process", "total")
        ],
    )


def scaling_table(
    runs: DataFrame, variant: str, threads: str, time: str, working_ratio: str | None = None
) -> DataFrame:
    """Mean time by number of threads, speed-up over the fewest threads, and idle share in percent.

    The window sees one row per variant and number of threads. A mean time of zero has no speed-up.
    """
    means = [F.avg(time).alias("mean_time"), F.stddev_samp(time).alias("stdev_time")]
    if working_ratio:
        means.append(F.avg(working_ratio).alias("working_time_ratio"))
    table = runs.groupBy(variant, threads).agg(*means)
    base = F.first("mean_time").over(Window.partitionBy(variant).orderBy(threads))
    table = table.withColumn("speedup", F.try_divide(base, F.col("mean_time")))
    if working_ratio:
        table = table.withColumn("idle", 100 * (1 - F.col("working_time_ratio")))
    return table
