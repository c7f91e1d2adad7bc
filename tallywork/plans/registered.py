"""Every operator as a query over the tables of a test data directory."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.functions import classify, names, numbers, periods, spark_time
from tallywork.operators import (
    cost_model,
    measure,
    profile,
    reconcile,
    responses,
    scores,
    usage,
    warmup,
)
from tallywork.plans import driver_tables as data
from tallywork.plans import usage_report as report
from tallywork.sources import event_log, measurements, spark_metrics, tables
from tallywork.sources import jobs as extracts
from tallywork.sources.shared_folder import new_folder
from tallywork.sources.spark_metrics import new_since

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

METRICS = ("ttft", "tpot", "mem")
WARMUP, MEASURED = 1, 5


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Engines add doubles up in different orders; the last digits are not compared.

    Values such as 0.0000005 lie half-way between two results. A nudge of a thousandth of the last
    digit lets both engines round them the same way. Bytes of memory have nine digits in front of
    the point already.
    """
    places = {c: 2 if "mem_" in c and "geomean" not in c else digits for c in columns}
    return df.withColumns({c: F.round(F.col(c) + 10 ** -(n + 3), n) for c, n in places.items()})


# Usage reports


@query
def usage_cube(spark: SparkSession, sf: str) -> DataFrame:
    return usage.usage_cube(data.jobs(spark, sf))


def _tag_report(spark: SparkSession, sf: str, tag: str) -> DataFrame:
    rows = report.usage_report(usage.usage_cube(data.jobs(spark, sf))).filter(F.col("tag") == tag)
    return rounded(rows.drop("tag"), "value")


@query
def usage_report_month(spark: SparkSession, sf: str) -> DataFrame:
    return _tag_report(spark, sf, periods.MONTH_TAG)


@query
def usage_report_trimester(spark: SparkSession, sf: str) -> DataFrame:
    return _tag_report(spark, sf, periods.TRIMESTER_TAG)


@query
def usage_report_year(spark: SparkSession, sf: str) -> DataFrame:
    return _tag_report(spark, sf, periods.YEAR_TAG)


def _params(spark: SparkSession, sf: str) -> DataFrame:
    return report.usage_params(usage.usage_cube(data.jobs(spark, sf))).drop("position")


def _months(jobs: DataFrame) -> DataFrame:
    return jobs.select(F.col("period").alias("report")).distinct()


def _listed_months(jobs: DataFrame) -> DataFrame:
    """The same as literal rows, a few for each year, for plans that name the reports many times."""
    found = _months(jobs).filter("report IS NOT NULL").collect()
    return report.report_months(jobs.sparkSession, [(r.report.year, r.report.month) for r in found])


@query
def usage_report_params(spark: SparkSession, sf: str) -> DataFrame:
    return _params(spark, sf)


@query
def usage_report_multipass(spark: SparkSession, sf: str) -> DataFrame:
    jobs = data.jobs(spark, sf)
    return report.usage_params_multipass(jobs, _listed_months(jobs)).drop("position")


@query
def usage_report_direct(spark: SparkSession, sf: str) -> DataFrame:
    jobs = data.jobs(spark, sf)
    return report.usage_params_direct(jobs, _listed_months(jobs)).drop("position")


@query
def report_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Every report line as it is written, and what is read back from it."""
    line = names.report_line(F.col("key"), F.col("value"))
    lines = _params(spark, sf).select("report", line.alias("line"))
    return lines.select(
        "report",
        "line",
        F.regexp_extract("line", names.REPORT_LINE, 1).alias("key"),
        F.regexp_extract("line", names.REPORT_LINE, 2).alias("value"),
    )


@query
def reconcile_reports(spark: SparkSession, sf: str) -> DataFrame:
    left = _params(spark, sf)
    compared = report.compare_reports(left, data.perturbed_report(left))
    return rounded(compared, "relative_error", digits=9)


@query
def reconcile_variants(spark: SparkSession, sf: str) -> DataFrame:
    """All reports by way of one pass against separate queries: nothing may differ."""
    jobs = data.jobs(spark, sf)
    direct = report.usage_params_direct(jobs, _listed_months(jobs))
    return reconcile.acceptable(report.compare_reports(direct, _params(spark, sf)))


@query
def reporting_periods(spark: SparkSession, sf: str) -> DataFrame:
    return report.calendar(_months(data.jobs(spark, sf)))


@query
def period_months(spark: SparkSession, sf: str) -> DataFrame:
    return report.period_map(_months(data.jobs(spark, sf)))


@query
def completed_by_cluster(spark: SparkSession, sf: str) -> DataFrame:
    return usage.jobs_by_outcome(data.jobs(spark, sf))


@query
def nonlocal_hours_by_cluster(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(usage.nonlocal_hours(data.jobs(spark, sf)), "used_hours")


@query
def nonlocal_jobs_by_cluster(spark: SparkSession, sf: str) -> DataFrame:
    return usage.nonlocal_jobs(data.jobs(spark, sf))


@query
def ehpc_jobs(spark: SparkSession, sf: str) -> DataFrame:
    return usage.agency_jobs(data.jobs(spark, sf), "EHPC")


@query
def ehpc_sums(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["JobIDRaw", "ElapsedRaw", "NNodes", "AllocCPUS", "vnodes", "job_seconds"]
    return usage.agency_sums(data.jobs(spark, sf), "EHPC", columns)


@query
def jobs_by_normalised_state(spark: SparkSession, sf: str) -> DataFrame:
    return usage.jobs_by_state(data.jobs(spark, sf))


@query
def gpu_share_nodes(spark: SparkSession, sf: str) -> DataFrame:
    nodes = classify.gpu_share_nodes(F.col("Partition"), F.col("AllocCPUS"), F.col("NNodes"))
    return data.jobs(spark, sf).select(F.col("JobIDRaw").alias("job_id"), nodes.alias("nodes"))


@query
def virtual_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return usage.classified(data.jobs(spark, sf)).select(
        F.col("JobIDRaw").alias("job_id"), "cluster", "agency", "outcome", "vnodes", "job_seconds"
    )


@query
def safe_cast_nodes(spark: SparkSession, sf: str) -> DataFrame:
    number = numbers.safe_integer(F.expr("substring(Account, 2)"))
    return data.jobs(spark, sf).select(F.col("JobIDRaw").alias("job_id"), number.alias("number"))


@query
def new_since_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    jobs = data.jobs(spark, sf).withColumnRenamed("JobIDRaw", "job_id")
    seen = jobs.filter(F.col("period") < F.lit(dt.date(2000, 1, 1)))
    return new_since(jobs, seen).select("job_id", "period")


@query
def file_periods(spark: SparkSession, sf: str) -> DataFrame:
    period = F.expr(periods.period_of_file("file_name", 1996))
    return data.job_file_names(spark, sf).withColumn("period", period)


# Files: what is written to the shared folder and read back


def _extracts(spark: SparkSession, sf: str) -> str:
    path = new_folder(spark, "extracts")
    extracts.write_jobs(data.job_extract(spark, sf), path)
    return path


@query
def extract_usage_cube(spark: SparkSession, sf: str) -> DataFrame:
    """The cube of monthly extract files of all years, read in one scan."""
    return usage.usage_cube(extracts.read_jobs(spark, _extracts(spark, sf)))


@query
def extract_period_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """The jobs of one month: the files of other months stay closed."""
    jobs = extracts.of_period(extracts.read_jobs(spark, _extracts(spark, sf)), dt.date(1996, 2, 1))
    return jobs.select("JobID", "JobIDRaw", "CPUTimeRAW", "TotalCPU", "ExitCode", "Reservation", "AllocTRES", "period")


@query
def inferred_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Types of the columns as found in the extract files, by month, and merged over all of them."""
    texts = extracts.read_texts(spark, _extracts(spark, sf))
    by_month = extracts.inferred_types(texts, [field.name for field in extracts.JOB_SCHEMA], ["period"])
    return by_month.unionByName(extracts.merged_types(by_month), allowMissingColumns=True)


@query
def inferred_usage_cube(spark: SparkSession, sf: str) -> DataFrame:
    """The cube of the same extracts read with inferred types, to hold against the declared ones."""
    return usage.usage_cube(extracts.read_jobs_inferred(spark, _extracts(spark, sf)))


REPLACED, EMPTIED, AGAIN = dt.date(1995, 3, 1), dt.date(1996, 5, 1), (dt.date(1997, 1, 1), dt.date(1997, 2, 1))


@query
def refreshed_usage(spark: SparkSession, sf: str) -> DataFrame:
    """The stored table after a month was replaced, a month lost all its jobs, and two months came again in one write."""
    path, jobs = new_folder(spark, "usage"), data.jobs(spark, sf)
    tables.write_periods(usage.narrow(jobs), path)
    report.refresh_period(jobs.filter("State = 'COMPLETED'"), REPLACED, path)
    report.refresh_period(jobs.filter(F.col("period") != F.lit(EMPTIED)), EMPTIED, path)
    longer = jobs.filter(F.col("period").isin(*AGAIN)).withColumn("ElapsedRaw", F.col("ElapsedRaw") + 1)
    tables.write_periods(usage.narrow(longer), path)
    return usage.cube_of(tables.read_periods(spark, path))


@query
def report_files(spark: SparkSession, sf: str) -> DataFrame:
    """All reports as files of their lines, and what is read back from them."""
    path = new_folder(spark, "reports")
    tables.write_reports(report.usage_params(usage.usage_cube(data.jobs(spark, sf))), path)
    return tables.read_reports(spark, path)


@query
def measurement_files(spark: SparkSession, sf: str) -> DataFrame:
    """Measurements as one directory of files for each compiler, model and quantization, read back with their header checked."""
    path = new_folder(spark, "measurements")
    measurements.write_measurements(data.file_measurements(spark, sf), path)
    return measurements.read_written_measurements(spark, path)


@query
def prompt_files(spark: SparkSession, sf: str) -> DataFrame:
    """Prompts as files of whole texts; type and id come from the path."""
    path = new_folder(spark, "prompts")
    measurements.write_prompts(data.spoken(spark, sf), path)
    text = names.without_last_feed(F.col("text"))
    return measurements.read_prompts(spark, path).withColumn("text", text)


@query
def response_files(spark: SparkSession, sf: str) -> DataFrame:
    """Responses as text files by model, prompt type and prompt id, read back."""
    path = new_folder(spark, "responses")
    said = data.spoken(spark, sf).withColumnRenamed("text", "content")
    measurements.write_response_files(said.withColumn("model", F.concat(F.lit("m"), F.length("prompt_id").cast("string"))), path)
    return measurements.read_response_files(spark, path)


@query
def default_report(spark: SparkSession, sf: str) -> DataFrame:
    """The report of the month before a given day; in January that is the last December."""
    month = periods.default_report(dt.date(1997, 1, 15))
    return report.month_report(data.jobs(spark, sf), month.year, month.month).drop("position")


# Measurements


@query
def config_stats(spark: SparkSession, sf: str) -> DataFrame:
    early = data.early_measurements(spark, sf, WARMUP + MEASURED)
    runs = measure.measured_runs(early, WARMUP, MEASURED)
    stats = measure.config_stats(runs, data.CONFIGURATION, METRICS)
    return rounded(stats, *[f"{m}_{s}" for m in METRICS for s in ("mean", "stdev")])


@query
def rank_options(spark: SparkSession, sf: str) -> DataFrame:
    runs = data.unnumbered_measurements(spark, sf)
    by = ("model", "quantization", "prompt")
    ranked = measure.rank_options(runs, "compiler", by, ("ttft", "tpot"))
    return rounded(ranked, "ttft_geomean", "tpot_geomean")


@query
def rank_quantizations(spark: SparkSession, sf: str) -> DataFrame:
    runs = data.unnumbered_measurements(spark, sf)
    by = ("compiler", "model", "prompt")
    ranked = measure.rank_options(runs, "quantization", by, METRICS)
    return rounded(ranked, *[f"{m}_geomean" for m in METRICS])


@query
def cold_run_rank(spark: SparkSession, sf: str) -> DataFrame:
    runs = data.early_measurements(spark, sf, 1)
    by = ("model", "quantization", "prompt")
    return rounded(measure.rank_cold_runs(runs, "compiler", by, "ttft"), "ttft_geomean")


@query
def best_option(spark: SparkSession, sf: str) -> DataFrame:
    return measure.best_option(rank_options(spark, sf), "compiler", "tpot")


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    runs = data.unnumbered_measurements(spark, sf)
    left = measure.configuration(runs, quantization="q0")
    right = measure.configuration(runs, quantization="q1")
    keys = ("compiler", "model", "prompt")
    return measure.paired_compare(left, right, keys, METRICS, ("q0", "q1"))


@query
def paired_compare(spark: SparkSession, sf: str) -> DataFrame:
    values = [f"{q}_{m}_{s}" for q in ("q0", "q1") for m in METRICS for s in ("mean", "stdev")]
    return rounded(_pairs(spark, sf), *values)


@query
def t_test_stat(spark: SparkSession, sf: str) -> DataFrame:
    samples = {m: (f"q0_{m}_mean", f"q1_{m}_mean") for m in ("ttft", "tpot")}
    tests = measure.t_test(_pairs(spark, sf), samples)
    return rounded(tests, "mean_a", "mean_b", "t", "p_value")


def _variants(spark: SparkSession, sf: str) -> DataFrame:
    early = data.early_measurements(spark, sf, WARMUP + MEASURED)
    runs = measure.measured_runs(early, WARMUP, MEASURED)
    fixed = measure.configuration(runs, quantization="q0")
    varied = measure.configuration(runs, quantization="q1")
    keys = ("compiler", "model", "prompt")
    return measure.variant_union(
        measure.labelled_stats(fixed, F.lit("8T FIXED"), keys, METRICS),
        measure.labelled_stats(
            varied, names.variant_label(data.thread_count(), "T VARIED"), keys, METRICS
        ),
    )


@query
def variant_union(spark: SparkSession, sf: str) -> DataFrame:
    values = [f"{m}_{s}" for m in METRICS for s in ("mean", "stdev")]
    return measure.in_order(rounded(_variants(spark, sf), *values))


@query
def variant_rank(spark: SparkSession, sf: str) -> DataFrame:
    by, metrics = ("model", "prompt"), ("ttft", "tpot")
    ranked = measure.rank_means(_variants(spark, sf), "threads", by, metrics)
    return rounded(ranked, "ttft_geomean", "tpot_geomean")


@query
def property_check(spark: SparkSession, sf: str) -> DataFrame:
    runs, first = data.unnumbered_measurements(spark, sf), data.early_measurements(spark, sf, 1)
    return measure.property_check(runs, first, *measure.cache_rules(F.col("tpot"), 50))


def _errors(spark: SparkSession, sf: str) -> DataFrame:
    runs = data.unnumbered_measurements(spark, sf)
    return warmup.trailing_error(runs, data.CONFIGURATION, run="event_id", numbered=False)


@query
def trailing_mse(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_errors(spark, sf), "mse", "previous_mse")


@query
def mser_quotient(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(warmup.error_quotients(_errors(spark, sf)), "mse_quotient_geomean")


# Run profiles


def _written_records(texts: DataFrame, name: str) -> str:
    """Records as files of lines, as they are saved; read through the schema, each is parsed once."""
    path = new_folder(texts.sparkSession, name)
    texts.select("record").write.text(path)
    return path


@query
def job_records(spark: SparkSession, sf: str) -> DataFrame:
    """Jobs with each of their stages. A record that is broken off has a row of its own, without a job."""
    jobs = spark_metrics.read_jobs(spark, _written_records(data.job_texts(spark, sf), "job-records"))
    return jobs.select("job_id", "name", "submitted", "completed", "num_tasks", F.explode_outer("stage_ids").alias("stage_id"))


@query
def stage_records(spark: SparkSession, sf: str) -> DataFrame:
    stages = spark_metrics.read_stages(spark, _written_records(data.stage_texts(spark, sf), "stage-records"))
    last = spark_metrics.last_attempts(stages)
    return last.select("stage_id", "attempt_id", "status", "num_tasks", "shuffle_write_bytes")


@query
def task_records(spark: SparkSession, sf: str) -> DataFrame:
    return spark_metrics.tasks_of(spark_metrics.read_stages(spark, _written_records(data.stage_texts(spark, sf), "stage-records")))


def _events(spark: SparkSession, sf: str) -> DataFrame:
    """The log as compressed text files in the shared folder, read back as events."""
    path = new_folder(spark, "event-log")
    event_log.write_events(data.event_lines(spark, sf), path)
    # Spark names the files itself: all of them are one log here.
    return event_log.read_events(spark, path).withColumn("log", F.lit("application"))


def _in_millis(records: DataFrame, **moments: str) -> DataFrame:
    return records.withColumns({name: F.unix_millis(F.expr(spark_time.moment(text))) for name, text in moments.items()}).drop("log", *moments.values())


@query
def event_log_jobs(spark: SparkSession, sf: str) -> DataFrame:
    jobs = event_log.jobs_of(_events(spark, sf))
    return _in_millis(jobs, started="submitted", ended="completed").withColumn("stage_ids", F.array_join(F.col("stage_ids").cast("array<string>"), " "))


@query
def event_log_stages(spark: SparkSession, sf: str) -> DataFrame:
    return _in_millis(event_log.stages_of(_events(spark, sf)), started="submitted", ended="completed")


@query
def event_log_tasks(spark: SparkSession, sf: str) -> DataFrame:
    return _in_millis(event_log.tasks_of(_events(spark, sf)), started="launched", ended="finished")


@query
def event_log_records(spark: SparkSession, sf: str) -> DataFrame:
    """What a log holds: lines and events by kind, broken lines among them, and jobs, stages and tasks by status."""
    events = _events(spark, sf)
    counts = event_log.counts(events)
    lines = F.explode(F.array(*[F.struct(F.lit("line").alias("kind"), F.lit(name).alias("status"), F.col(name).alias("n")) for name in counts.columns[1:]]))
    jobs = event_log.jobs_of(events)
    states = event_log.statuses(jobs, event_log.stages_of(events, jobs), event_log.tasks_of(events))
    return counts.select(lines.alias("row")).select("row.*").unionByName(states.drop("log"))


def _stages(spark: SparkSession, sf: str) -> DataFrame:
    return profile.stage_rollup(data.stages(spark, sf), data.tasks(spark, sf), data.THREADS)


def _jobs(spark: SparkSession, sf: str) -> DataFrame:
    links = data.job_stages(spark, sf)
    return profile.job_rollup(data.spark_jobs(spark, sf), links, _stages(spark, sf), data.THREADS)


@query
def stage_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_stages(spark, sf), "execution_time", "working_time", "working_time_ratio")


@query
def job_rollup(spark: SparkSession, sf: str) -> DataFrame:
    # Moments as numbers, which no session's time zone changes.
    moments = {c: F.unix_millis(c) for c in ("started", "ended")}
    return rounded(_jobs(spark, sf).withColumns(moments), "execution_time", "working_time", "working_time_ratio")


@query
def query_rollup(spark: SparkSession, sf: str) -> DataFrame:
    total = profile.query_rollup(_jobs(spark, sf), data.THREADS)
    return rounded(total, "execution_time", "working_time", "working_time_ratio")


@query
def job_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Jobs as nested JSON records with their stages, written and read back with a schema: one row per job and stage."""
    path = new_folder(spark, "job-documents")
    documents = profile.job_documents(_jobs(spark, sf), data.job_stages(spark, sf), _stages(spark, sf)).drop("started", "ended")
    tables.write_json(documents, path)
    read = tables.read_json(spark, path, documents.schema)
    flat = read.select("job_id", "name", "num_stages", F.explode_outer("stages").alias("stage"))
    rows = flat.select("job_id", "name", "num_stages", "stage.stage_id", *[f"stage.record.{name}" for name in ("skipped", "num_tasks", "num_nonskipped_tasks", "working_time", "shuffle_read_bytes")])
    return rounded(rows, "working_time")


@query
def run_statistics(spark: SparkSession, sf: str) -> DataFrame:
    runs, early = data.unnumbered_measurements(spark, sf), data.early_measurements(spark, sf, WARMUP)
    stats = profile.run_statistics_without(runs, early, data.CONFIGURATION, METRICS)
    # Bytes of memory have nine digits in front of the point already.
    by_metric = lambda c, n: F.round(F.col(c) + 10 ** -(n + 3), n)
    return stats.withColumns(
        {
            c: F.when(F.col("metric") == "mem", by_metric(c, 2)).otherwise(by_metric(c, 6))
            for c in ("mean", "stdev")
        }
    )


@query
def first_run(spark: SparkSession, sf: str) -> DataFrame:
    early = data.early_measurements(spark, sf, WARMUP + 1)
    runs = profile.without_warmup(early, WARMUP)
    return profile.first_run(runs, data.CONFIGURATION, ("mem", "tpot"))


@query
def counter_phases(spark: SparkSession, sf: str) -> DataFrame:
    samples = data.counter_samples(spark, sf)
    phases = profile.counter_phases(samples, ["user_id", "run"], ["cpu", "clock"])
    rates = profile.phase_rates(phases, "cpu", "clock")
    parts = ("load", "process", "total")
    return rounded(rates, *[f"{p}_{c}" for p in parts for c in ("cpu", "clock", "cpu_rate")])


@query
def scaling_table(spark: SparkSession, sf: str) -> DataFrame:
    runs = data.scaling_runs(spark, sf)
    table = profile.scaling_table(runs, "variant", "threads", "time", "working_ratio")
    return rounded(table, "mean_time", "stdev_time", "working_time_ratio", "speedup", "idle")


# Cost model, scores, requests and responses


def _fit(spark: SparkSession, sf: str, fit: str) -> DataFrame:
    return rounded(cost_model.fit_error(data.model_sizes(spark, sf), fit), "k", "mse")


@query
def fit_none(spark: SparkSession, sf: str) -> DataFrame:
    return _fit(spark, sf, "none")


@query
def fit_mse(spark: SparkSession, sf: str) -> DataFrame:
    return _fit(spark, sf, "mse")


@query
def fit_geomean(spark: SparkSession, sf: str) -> DataFrame:
    return _fit(spark, sf, "geomean")


@query
def model_report(spark: SparkSession, sf: str) -> DataFrame:
    rows = cost_model.model_report(data.model_sizes(spark, sf), "mse")
    return rounded(
        rows, "memory_gib", "k", "predicted_ms", "observed_ms", "ratio", "error_percent"
    )


@query
def score_totals(spark: SparkSession, sf: str) -> DataFrame:
    return scores.score_totals(data.scores(spark, sf), ("size", "prompt", "evaluator"))


@query
def score_table(spark: SparkSession, sf: str) -> DataFrame:
    return scores.score_table(data.scores(spark, sf), "size", "evaluator", data.EVALUATORS)


@query
def response_timings(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(responses.response_timings(data.responses(spark, sf)), "ttft", "tpot")


@query
def response_content(spark: SparkSession, sf: str) -> DataFrame:
    return responses.response_content(data.responses(spark, sf))


@query
def request_bodies(spark: SparkSession, sf: str) -> DataFrame:
    return responses.build_requests(data.prompts(spark, sf)).drop("text")


@query
def model_name_parts(spark: SparkSession, sf: str) -> DataFrame:
    return responses.with_model_parts(data.model_files(spark, sf)).select(
        "event_id",
        "model",
        "quantization",
        names.base_name(F.col("model_file")).alias("file"),
        names.parent_name(F.col("model_file")).alias("directory"),
    )


@query
def busy_cpu_time(spark: SparkSession, sf: str) -> DataFrame:
    """CPU time in use, from uptime and idle time of a number of cores."""
    uptime, idle = F.col("ttft") * 10, F.col("tpot")
    busy = numbers.busy_cpu_time(uptime, idle, data.thread_count())
    rows = data.unnumbered_measurements(spark, sf).select("event_id", busy.alias("busy"))
    return rounded(rows, "busy")
