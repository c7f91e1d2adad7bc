"""The operators' inputs, derived from the TPC-H-like tables of a test data directory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.functions import numbers, periods, spark_time
from tallywork.operators.scan import first_rows, scan_before
from tallywork.sources.jobs import JOB_SCHEMA

CONFIGURATION = ("compiler", "model", "quantization", "prompt")
THREADS = 8


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def jobs(spark: SparkSession, directory: str) -> DataFrame:
    """Orders as job-accounting records, with the month of the order as period."""
    return table(spark, directory, "orders").selectExpr(
        "o_orderkey AS JobIDRaw",
        "CAST(floor(o_totalprice) AS BIGINT) % 86400 AS ElapsedRaw",
        "1 + o_custkey % 8 AS NNodes",
        "1 + o_custkey % 128 AS AllocCPUS",
        """CASE o_orderpriority WHEN '1-URGENT' THEN 'normal-arm'
           WHEN '2-HIGH' THEN 'normal-a100-40' WHEN '3-MEDIUM' THEN 'dev-a100-80'
           ELSE 'normal-x86' END AS Partition""",
        """CASE o_custkey % 3 WHEN 0 THEN concat('f', o_custkey) WHEN 1 THEN concat('ee', o_custkey)
           ELSE concat('x', o_custkey) END AS Account""",
        """CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'FAILED'
           ELSE concat('CANCELLED by ', o_custkey) END AS State""",
        """CASE o_orderkey % 4 WHEN 1 THEN '' WHEN 3 THEN 'billing=1'
           WHEN 2 THEN concat('billing=1,gres/gpu=', 1 + o_orderkey % 5) END AS AllocTRES""",
        "CAST(trunc(o_orderdate, 'month') AS DATE) AS period",
    )


def job_extract(spark: SparkSession, directory: str) -> DataFrame:
    """The same jobs with all columns of an extract. Reservations are missing, numbers or texts, by month."""
    made = {
        "JobID": "concat(JobIDRaw, '_1')",
        "CPUTimeRAW": "ElapsedRaw * AllocCPUS * 1000",
        "AllocNodes": "CAST(NNodes AS STRING)",
        "NCPUS": "AllocCPUS",
        "TotalCPU": "'1-02:03:04'",
        "User": "concat('user.', Account)",
        "ExitCode": "'0:0'",
        "Reservation": "CASE month(period) % 4 WHEN 1 THEN CAST(NNodes AS STRING) WHEN 2 THEN concat(NNodes, '.5') WHEN 3 THEN concat('r', NNodes) END",
        "ReservationId": "CASE WHEN month(period) < 7 THEN CAST(NNodes AS STRING) ELSE CAST(NNodes * 10000000000 AS STRING) END",
    }
    columns = [made.get(field.name, field.name) + f" AS {field.name}" for field in JOB_SCHEMA]
    return jobs(spark, directory).selectExpr(*columns, "period")


def unnumbered_measurements(spark: SparkSession, directory: str) -> DataFrame:
    """Events as measurements; ``event_id`` gives the order of the runs."""
    return table(spark, directory, "events").selectExpr(
        "event_id",
        "concat('c', user_id % 4) AS compiler",
        "event_type AS model",
        "concat('q', event_id % 2) AS quantization",
        "concat('p', event_id % 3) AS prompt",
        "value AS ttft",
        "CAST(get_json_object(props, '$.k') AS DOUBLE) + 1 AS tpot",
        "user_id * 1000000 + event_id AS mem",
    )


def early_measurements(spark: SparkSession, directory: str, runs: int) -> DataFrame:
    """The same for operators that look at the first runs only."""
    plain = unnumbered_measurements(spark, directory)
    return first_rows(plain, CONFIGURATION, "event_id", runs)


def thread_count() -> Column:
    """1, 2, 4 or 8 threads for c0 to c3."""
    number = F.substring("compiler", 2, 1).cast("int")
    return F.element_at(F.array(*map(F.lit, (1, 2, 4, 8))), number + 1)


def _spark_text(moment: str) -> str:
    # Not date_format, which goes through the session's time zone and its missing hours.
    return f"replace(CAST({moment} AS STRING), ' ', 'T') || 'GMT'"


def stages(spark: SparkSession, directory: str) -> DataFrame:
    """Orders as stages of a Spark application."""
    ended = "timestampadd(MILLISECOND, CAST(floor(o_totalprice * 10) AS BIGINT), o_orderdate)"
    return table(spark, directory, "orders").selectExpr(
        "o_orderkey AS stage_id",
        "CASE WHEN o_orderstatus = 'P' THEN 'SKIPPED' ELSE 'COMPLETE' END AS status",
        f"{_spark_text('o_orderdate')} AS submitted",
        f"{_spark_text(ended)} AS completed",
        "1 + o_custkey % 8 AS num_tasks",
        "o_custkey * 7 AS shuffle_write_bytes",
        "o_custkey AS shuffle_write_records",
        "CAST(floor(o_totalprice) AS BIGINT) AS shuffle_read_bytes",
        "o_orderkey % 1000 AS shuffle_read_records",
    )


def job_stages(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "orders").select(
        F.col("o_custkey").alias("job_id"), F.col("o_orderkey").alias("stage_id")
    )


def tasks(spark: SparkSession, directory: str) -> DataFrame:
    """Line items as tasks."""
    return table(spark, directory, "lineitem").select(
        F.col("l_orderkey").alias("stage_id"),
        (F.col("l_quantity") * 1000).cast("bigint").alias("duration_ms"),
    )


def spark_jobs(spark: SparkSession, directory: str) -> DataFrame:
    """Customers as jobs."""
    start = "timestampadd(SECOND, c_custkey, TIMESTAMP_NTZ'1995-01-01 00:00:00')"
    end = f"timestampadd(SECOND, CAST(floor(abs(c_acctbal)) AS BIGINT), {start})"
    return table(spark, directory, "customer").selectExpr(
        "c_custkey AS job_id",
        "c_name AS name",
        f"{_spark_text(start)} AS submitted",
        f"{_spark_text(end)} AS completed",
        "c_nationkey AS num_tasks",
    )


def counter_samples(spark: SparkSession, directory: str) -> DataFrame:
    """Each user's events in threes as the samples of a run, the running sum of value as counter."""
    start, now = spark_time.moment("'2024-01-01 00:00:00'"), spark_time.moment("CAST(ts AS STRING)")
    clock = f"{spark_time.span_seconds(start, now)} AS clock"
    events = table(spark, directory, "events").selectExpr("user_id", "event_id", "value", clock)
    before = scan_before(
        events, ["user_id"], "event_id", {"earlier": F.lit(1), "cpu_before": F.col("value")}
    )
    return before.select(
        "user_id",
        F.floor(F.col("earlier") / 3).cast("bigint").alias("run"),
        (F.col("earlier") % 3).alias("phase"),
        (F.col("cpu_before") + F.col("value")).alias("cpu"),
        "clock",
    )


def scaling_runs(spark: SparkSession, directory: str) -> DataFrame:
    return unnumbered_measurements(spark, directory).select(
        F.col("model").alias("variant"),
        thread_count().alias("threads"),
        F.col("ttft").alias("time"),
        (F.col("tpot") / 100).alias("working_ratio"),
    )


def model_sizes(spark: SparkSession, directory: str) -> DataFrame:
    """Parts as quantized models with one observation each."""
    kind = F.col("p_partkey") % 3
    return table(spark, directory, "part").select(
        F.concat(F.col("p_name"), F.lit(" "), F.col("p_partkey").cast("string")).alias("name"),
        (F.col("p_size").cast("bigint") * 100000000).alias("n_params"),
        F.when(kind == 0, 3.0).when(kind == 1, 4.0).otherwise(8.0).alias("bpw"),
        (F.col("p_retailprice") / 10).alias("observed_tpot_ms"),
    )


def scores(spark: SparkSession, directory: str) -> DataFrame:
    """Labels as marks; the language is the prompt and the source the evaluator."""
    chars = F.col("n_chars")
    size = F.when(chars < 1000, "small").when(chars < 5000, "medium").otherwise("large")
    documents = table(spark, directory, "documents").select(
        "doc_id",
        F.col("lang").alias("prompt"),
        F.col("source").alias("evaluator"),
        size.alias("size"),
    )
    marks = table(spark, directory, "labels").select(
        "doc_id", (F.col("quality") + F.col("toxic")).alias("score")
    )
    return marks.join(documents, "doc_id")


EVALUATORS = tuple(f"src{n}" for n in range(20))


def responses(spark: SparkSession, directory: str) -> DataFrame:
    """Turns of conversations as the JSON that a chat server would send back."""
    length, turn = F.length("text"), F.col("turn")
    timings = F.struct(
        length.alias("prompt_n"),
        turn.alias("predicted_n"),
        (F.col("conv_id") % 7).alias("cache_n"),
        (length * 0.5).alias("prompt_ms"),
        (1 + turn * 0.25).alias("predicted_per_token_ms"),
    )
    message = F.struct(F.col("role"), F.col("text").alias("content"))
    choices = F.array(F.struct(message.alias("message")))
    body = F.to_json(F.struct(timings.alias("timings"), choices.alias("choices")))
    return table(spark, directory, "conversations").select("conv_id", "turn", body.alias("body"))


def prompts(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "conversations").select("conv_id", "turn", "text")


def file_measurements(spark: SparkSession, directory: str) -> DataFrame:
    """Events as the rows of measurement files, in the order of their columns."""
    return unnumbered_measurements(spark, directory).selectExpr(
        "compiler", "model", "quantization", "'static' AS seeding", "prompt", "CAST(event_id AS INT) AS run",
        "CAST(event_id % 97 AS INT) AS prompt_n", "CAST(event_id % 7 AS INT) AS predicted_n", "0 AS cache_n", "ttft", "tpot", "mem",
    )


def spoken(spark: SparkSession, directory: str) -> DataFrame:
    """What each role says in a conversation, as one prompt."""
    said = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda turn: turn["text"]), "\n")
    spoken = table(spark, directory, "conversations").groupBy(F.col("role").alias("prompt_type"), F.col("conv_id").cast("string").alias("prompt_id"))
    return spoken.agg(said.alias("text"))


def model_files(spark: SparkSession, directory: str) -> DataFrame:
    """Events as model files, named as a benchmark finds them."""
    kind = F.col("event_id") % 3
    quantization = F.when(kind == 0, "Q3_K_M").when(kind == 1, "Q4_K_M").otherwise("Q8_0")
    size = (1 + F.col("user_id") % 8).cast("string")
    path = F.concat(
        F.lit("../models/"), "event_type", F.lit("-"), size, F.lit("B-Instruct-"), quantization,
        F.lit(".gguf"),
    )
    return table(spark, directory, "events").select("event_id", path.alias("model_file"))


def perturbed_report(params: DataFrame) -> DataFrame:
    """A copy of report parameters with one difference of every kind that can be told apart."""
    key, value = F.col("key"), F.col("value")
    grown = [F.expr(numbers.double_text(f"(TRY_CAST(value AS DOUBLE) * {by}D)")) for by in (1.0005, 1.01)]
    changed = (
        F.when(key.startswith("armusedhours"), grown[0])
        .when(key.startswith("gpuusedhours"), grown[1])
        .when(key == "reportMonth", F.upper(value))
        .otherwise(value)
    )
    kept = params.filter(~key.endswith("FailedJobsTrimester"))
    # A key that comes twice with two values, and a key that only the copy has.
    own = F.struct(key.alias("key"), changed.alias("value"))
    racks = F.struct(F.lit("armracks").alias("key"), value.alias("value"))
    other = F.struct(key.alias("key"), F.lit("31").alias("value"))
    rows = (
        F.when(key == "armnodes", F.array(own, racks))
        .when(key == "amdnodes", F.array(own, other))
        .otherwise(F.array(own))
    )
    return kept.select("report", F.explode(rows).alias("row")).select("report", "row.*")


def job_file_names(spark: SparkSession, directory: str) -> DataFrame:
    """Orders as rows of monthly job files; every seventh is in a file of another name."""
    named = f"concat('{periods.JOB_FILE_PREFIX}', date_format(o_orderdate, 'MMM'), '.v2.txt')"
    other = "concat('other_', date_format(o_orderdate, 'MMM'), '.txt')"
    return table(spark, directory, "orders").selectExpr(
        "o_orderkey AS job_id",
        f"CASE WHEN o_orderkey % 7 = 0 THEN {other} ELSE {named} END AS file_name",
    )


def job_texts(spark: SparkSession, directory: str) -> DataFrame:
    """Orders as JSON job records with a few stages each; every eleventh is broken off."""
    record = (
        "to_json(named_struct('jobId', o_orderkey, 'name', o_orderpriority, 'submissionTime',"
        " CAST(o_orderdate AS STRING), 'stageIds',"
        " transform(sequence(1, 1 + o_custkey % 4), n -> o_orderkey * 10 + n),"
        " 'numTasks', o_custkey % 9))"
    )
    text = f"CASE WHEN o_orderkey % 11 = 0 THEN substring({record}, 1, 9) ELSE {record} END"
    return table(spark, directory, "orders").selectExpr(f"{text} AS record")


def stage_texts(spark: SparkSession, directory: str) -> DataFrame:
    """Orders as JSON stage records: one or two attempts of up to four tasks."""
    shuffled = (
        "named_struct('shuffleWriteMetrics', named_struct('bytesWritten', o_custkey * n,"
        " 'recordsWritten', n), 'shuffleReadMetrics', named_struct('localBytesRead', o_orderkey,"
        " 'remoteBytesRead', CASE WHEN n > 1 THEN n END, 'recordsRead', 2 * n))"
    )
    task = (
        "named_struct('taskId', o_orderkey * 10 + n, 'duration', o_custkey * n,"
        f" 'taskMetrics', {shuffled})"
    )
    tasks = (
        "map_from_entries(transform(sequence(1, 1 + (o_custkey + attempt) % 4),"
        f" n -> struct(CAST(n AS STRING), {task})))"
    )
    record = (
        "to_json(named_struct('stageId', o_orderkey, 'attemptId', nullif(attempt, 0), 'status',"
        " CASE WHEN attempt = 0 AND o_orderkey % 3 = 0 THEN 'FAILED' ELSE 'COMPLETE' END,"
        f" 'numTasks', 4, 'shuffleWriteBytes', o_custkey * 100 + attempt, 'tasks', {tasks}))"
    )
    attempts = "explode(sequence(0, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END)) AS attempt"
    orders = table(spark, directory, "orders").selectExpr("o_orderkey", "o_custkey", attempts)
    return orders.selectExpr(f"{record} AS record")


def event_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Orders and line items as the event log of an application.

    An order is a job of two stages, its line items are tasks of the first one. A job ends unless its order is pending; every
    eleventh end is broken off. The second stage runs only for every third order, the first runs again for every seventh, and
    the last task of every fifth has not ended.
    """
    orders = table(spark, directory, "orders").selectExpr("o_orderkey AS k", "o_custkey AS c", "o_orderstatus AS state", "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(o_orderdate AS TIMESTAMP_NTZ)) AS at")
    items = table(spark, directory, "lineitem").selectExpr("l_orderkey AS k", "l_linenumber AS n", "CAST(l_quantity AS BIGINT) AS q")
    info = "named_struct('Stage ID', {id}, 'Stage Attempt ID', {attempt}, 'Stage Name', concat('stage ', {id}), 'Number of Tasks', c % 9"
    listed = ", ".join(info.format(id=f"2 * k + {i}", attempt="0") + ")" for i in (0, 1))
    job_start = (
        "to_json(named_struct('Event', 'SparkListenerJobStart', 'Job ID', k, 'Submission Time', at,"
        f" 'Stage Infos', array({listed}), 'Stage IDs', array(2 * k, 2 * k + 1), 'Properties', map('k', 'v')))"
    )
    result = "CASE WHEN state = 'F' THEN named_struct('Result', 'JobSucceeded') ELSE named_struct('Result', 'JobFailed') END"
    job_end = f"to_json(named_struct('Event', 'SparkListenerJobEnd', 'Job ID', k, 'Completion Time', at + c, 'Job Result', {result}))"
    job_end = f"CASE WHEN state = 'P' THEN NULL WHEN k % 11 = 0 THEN substring({job_end}, 1, 40) ELSE {job_end} END"
    ran = "explode(filter(array((0, 0), (0, CASE WHEN k % 7 = 0 THEN 1 END), (CASE WHEN k % 3 = 0 THEN 1 END, 0)), x -> x.col1 IS NOT NULL AND x.col2 IS NOT NULL)) AS run"
    stages = orders.selectExpr("*", ran).selectExpr("*", "2 * k + run.col1 AS id", "run.col2 AS attempt")
    began = info.format(id="id", attempt="attempt") + ", 'Submission Time', at + 10 + attempt)"
    ended = info.format(id="id", attempt="attempt") + ", 'Submission Time', at + 10 + attempt, 'Completion Time', at + 500 + c, 'Failure Reason', CASE WHEN k % 7 = 0 AND attempt = 0 THEN 'lost' END)"
    stage_start = f"to_json(named_struct('Event', 'SparkListenerStageSubmitted', 'Stage Info', {began}))"
    stage_end = f"CASE WHEN state <> 'P' THEN to_json(named_struct('Event', 'SparkListenerStageCompleted', 'Stage Info', {ended})) END"
    # The tasks belong to the stage's last attempt.
    placed = "'Stage ID', 2 * k, 'Stage Attempt ID', CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END"
    launched = "'Task ID', k * 10 + n, 'Launch Time', 1000 * n"
    task_start = f"to_json(named_struct('Event', 'SparkListenerTaskStart', {placed}, 'Task Info', named_struct({launched})))"
    metrics = (
        "named_struct('Executor Run Time', q * 1000, 'Shuffle Write Metrics', named_struct('Shuffle Bytes Written', q, 'Shuffle Records Written', n),"
        " 'Shuffle Read Metrics', named_struct('Remote Bytes Read', CASE WHEN n > 1 THEN n END, 'Local Bytes Read', k, 'Total Records Read', 2 * n))"
    )
    task_end = (
        f"CASE WHEN k % 5 > 0 OR n > 1 THEN to_json(named_struct('Event', 'SparkListenerTaskEnd', {placed}, 'Task Info',"
        f" named_struct({launched}, 'Finish Time', 1000 * n + q, 'Failed', q = 13, 'Killed', false), 'Task Metrics', {metrics})) END"
    )
    other = "CASE WHEN k % 9 = 0 THEN to_json(named_struct('Event', 'SparkListenerEnvironmentUpdate', 'Job ID', k)) END"
    parts = [orders.selectExpr(f"explode(array({job_start}, {job_end}, {other})) AS line"), stages.selectExpr(f"explode(array({stage_start}, {stage_end})) AS line"), items.selectExpr(f"explode(array({task_start}, {task_end})) AS line")]
    return parts[0].union(parts[1]).union(parts[2]).where("line IS NOT NULL")
