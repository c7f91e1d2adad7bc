"""Jobs, stages and tasks from Spark event logs: one JSON event per line, a start and an end for each.

A log is read once and parsed once. The two events of a thing meet in an aggregate by its number, not in a join, so
neither has to be there: what has no end yet is kept with the status of something unfinished, and what has lost its start is
kept, too. A log may hold millions of tasks of one stage; they are added up in every task of the read before the
shuffle. Broken lines and events of other kinds are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The names of the events and of those of their fields that are read.
JOB_START, JOB_END = "SparkListenerJobStart", "SparkListenerJobEnd"
STAGE_START, STAGE_END = "SparkListenerStageSubmitted", "SparkListenerStageCompleted"
TASK_START, TASK_END = "SparkListenerTaskStart", "SparkListenerTaskEnd"
EVENTS = (JOB_START, JOB_END, STAGE_START, STAGE_END, TASK_START, TASK_END)
_STAGE_INFO = (
    "STRUCT<`Stage ID`: BIGINT, `Stage Attempt ID`: INT, `Stage Name`: STRING, `Number of Tasks`: BIGINT,"
    " `Submission Time`: BIGINT, `Completion Time`: BIGINT, `Failure Reason`: STRING>"
)
_TASK_INFO = "STRUCT<`Task ID`: BIGINT, `Launch Time`: BIGINT, `Finish Time`: BIGINT, `Failed`: BOOLEAN, `Killed`: BOOLEAN>"
_METRICS = (
    "STRUCT<`Executor Run Time`: BIGINT,"
    " `Shuffle Write Metrics`: STRUCT<`Shuffle Bytes Written`: BIGINT, `Shuffle Records Written`: BIGINT>,"
    " `Shuffle Read Metrics`: STRUCT<`Remote Bytes Read`: BIGINT, `Local Bytes Read`: BIGINT, `Total Records Read`: BIGINT>>"
)
BROKEN = "broken_line"
# A compressed file is read by one task, so it has so many events at most; they take about 4 MB.
EVENTS_PER_FILE = 1 << 18
EVENT_SCHEMA = (
    "`Event` STRING, `Job ID` BIGINT, `Submission Time` BIGINT, `Completion Time` BIGINT, `Stage IDs` ARRAY<BIGINT>,"
    f" `Stage Infos` ARRAY<{_STAGE_INFO}>, `Job Result` STRUCT<`Result`: STRING>, `Stage Info` {_STAGE_INFO},"
    f" `Stage ID` BIGINT, `Stage Attempt ID` INT, `Task Info` {_TASK_INFO}, `Task Metrics` {_METRICS}, `{BROKEN}` STRING"
)

FIELDS = ("Event", "Job ID", "Submission Time", "Completion Time", "Stage IDs", "Stage Infos", "Job Result", "Stage Info", "Stage ID", "Stage Attempt ID", "Task Info", "Task Metrics")

SUCCEEDED, FAILED, RUNNING, NO_START = "SUCCEEDED", "FAILED", "RUNNING", "NO_START"
COMPLETE, ACTIVE, SKIPPED, PENDING = "COMPLETE", "ACTIVE", "SKIPPED", "PENDING"


def write_events(lines: DataFrame, path: str, line: str = "line") -> None:
    """Lines of a log as compressed text files, as Spark itself keeps logs: their names and times repeat, so they take a small part of the space."""
    (
        lines.select(F.col(line).alias("value"))
        .write.option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .option("maxRecordsPerFile", EVENTS_PER_FILE)
        .text(path)
    )


def read_events(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The events of all logs under a path, plain or with gzip (``.gz``), with the name of the log's file. Lines that are no JSON object have BROKEN set.

    Read through the schema: a line is parsed once, and only for the fields that a query uses.
    """
    raw = spark.read.schema(EVENT_SCHEMA).option("columnNameOfCorruptRecord", BROKEN).option("recursiveFileLookup", True).json(path)
    return raw.select("*", F.col("_metadata.file_name").alias("log"))


def events_of(lines: DataFrame, line: str = "line", log: str = "log") -> DataFrame:
    """The same from a column with an event in each row."""
    event = F.from_json(line, EVENT_SCHEMA, {"columnNameOfCorruptRecord": BROKEN})
    return lines.select(F.col(log).alias("log"), event.alias("event"), F.col(line).alias("line")).select(
        "log", *[F.col(f"event.{name}").alias(name) for name in FIELDS], F.coalesce(f"event.{BROKEN}", F.when(F.col("event").isNull(), F.coalesce("line", F.lit("")))).alias(BROKEN)
    )


def _when(name: str, value: Column) -> Column:
    return F.when(F.col("Event") == name, value)


def _text(milliseconds: str) -> str:
    """SQL for a time as the monitoring interface writes it, in no session's time zone."""
    moment = f"timestampadd(MILLISECOND, {milliseconds}, TIMESTAMP_NTZ'1970-01-01 00:00:00')"
    return f"replace(CAST({moment} AS STRING), ' ', 'T') || 'GMT'"


def counts(events: DataFrame) -> DataFrame:
    """One row per log: lines, broken lines, events of other kinds, and events by kind."""
    kind, broken = F.col("Event"), F.col(BROKEN).isNotNull()
    other = ~broken & ~F.coalesce(kind.isin(*EVENTS), F.lit(False))
    named = {"job_starts": JOB_START, "job_ends": JOB_END, "stage_starts": STAGE_START, "stage_ends": STAGE_END, "task_starts": TASK_START, "task_ends": TASK_END}
    return events.groupBy("log").agg(
        F.count("*").alias("lines"),
        F.count_if(broken).alias("broken_lines"),
        F.count_if(other).alias("other_events"),
        *[F.count_if(~broken & (kind == event)).alias(name) for name, event in named.items()],
    )


def _whole(events: DataFrame, *kinds: str) -> DataFrame:
    """The events of some kinds, without broken lines: those have what stood before the break."""
    return events.where(F.col("Event").isin(*kinds) & F.col(BROKEN).isNull())


def jobs_of(events: DataFrame) -> DataFrame:
    """One row per job, under the names of ``spark_metrics.jobs_of``, with its status.

    A job without an end is RUNNING, one without a start NO_START. Of repeated events of one kind the latest counts.
    """
    infos = F.col("Stage Infos")
    start = F.struct(
        F.col("Submission Time").alias("at"),
        F.col("Stage IDs").alias("stage_ids"),
        F.aggregate(infos, F.lit(0).cast("bigint"), lambda n, info: n + F.coalesce(info["Number of Tasks"], F.lit(0))).alias("num_tasks"),
        # A job is named after its last stage.
        F.array_max(F.transform(infos, lambda info: F.struct(info["Stage ID"].alias("id"), info["Stage Name"].alias("name"))))["name"].alias("name"),
    )
    end = F.struct(F.col("Completion Time").alias("at"), F.col("Job Result.Result").alias("result"))
    found = _whole(events, JOB_START, JOB_END).groupBy("log", F.col("Job ID").alias("job_id")).agg(
        F.max_by(_when(JOB_START, start), _when(JOB_START, start["at"])).alias("s"), F.max(_when(JOB_END, end)).alias("e")
    )
    return found.selectExpr(
        "log",
        "job_id",
        "s.name AS name",
        f"CASE WHEN e IS NULL THEN '{RUNNING}' WHEN s IS NULL THEN '{NO_START}'"
        f" WHEN e.result = 'JobSucceeded' THEN '{SUCCEEDED}' ELSE '{FAILED}' END AS status",
        f"{_text('s.at')} AS submitted",
        f"{_text('e.at')} AS completed",
        "s.stage_ids AS stage_ids",
        "s.num_tasks AS num_tasks",
    )


def tasks_of(events: DataFrame) -> DataFrame:
    """One row per task of any attempt, under the names of ``spark_metrics.tasks_of``, with its status."""
    info, metrics = F.col("Task Info"), F.col("Task Metrics")
    written, read = metrics["Shuffle Write Metrics"], metrics["Shuffle Read Metrics"]
    end = F.struct(
        info["Finish Time"].alias("at"),
        info["Launch Time"].alias("launched"),
        (F.coalesce(info["Failed"], F.lit(False)) | F.coalesce(info["Killed"], F.lit(False))).alias("failed"),
        metrics["Executor Run Time"].alias("duration_ms"),
        written["Shuffle Bytes Written"].alias("shuffle_write_bytes"),
        written["Shuffle Records Written"].alias("shuffle_write_records"),
        F.when(read.isNotNull(), F.coalesce(read["Local Bytes Read"], F.lit(0)) + F.coalesce(read["Remote Bytes Read"], F.lit(0))).alias("shuffle_read_bytes"),
        read["Total Records Read"].alias("shuffle_read_records"),
    )
    keys = [F.col("Stage ID").alias("stage_id"), F.coalesce("Stage Attempt ID", F.lit(0)).alias("attempt_id"), info["Task ID"].alias("task_id")]
    found = _whole(events, TASK_START, TASK_END).groupBy("log", *keys).agg(
        F.max(_when(TASK_START, info["Launch Time"])).alias("started"), F.max(_when(TASK_END, end)).alias("e")
    )
    return found.selectExpr(
        "log",
        "stage_id",
        "attempt_id",
        "task_id",
        f"CASE WHEN e IS NULL THEN '{RUNNING}' WHEN e.failed THEN '{FAILED}' ELSE '{SUCCEEDED}' END AS status",
        f"{_text('coalesce(started, e.launched)')} AS launched",
        f"{_text('e.at')} AS finished",
        *[f"e.{name} AS {name}" for name in ("duration_ms", "shuffle_write_bytes", "shuffle_write_records", "shuffle_read_bytes", "shuffle_read_records")],
    )


def stages_of(events: DataFrame, jobs: DataFrame | None = None) -> DataFrame:
    """The last attempt of each stage, under the names of ``spark_metrics.stages_of`` without its tasks, with what its finished tasks shuffled.

    Stages that a job lists and that never began are SKIPPED once all of their jobs have ended, and PENDING before; a stage without an
    end is ACTIVE. ``num_attempts`` counts the attempts that the log knows. ``jobs`` are ``jobs_of`` the events, unless given.
    """
    jobs = jobs_of(events) if jobs is None else jobs
    info, metrics = F.col("Stage Info"), F.col("Task Metrics")
    written, read = metrics["Shuffle Write Metrics"], metrics["Shuffle Read Metrics"]
    both = {STAGE_START: info, STAGE_END: info}
    own = F.coalesce(*[_when(name, value["Stage ID"]) for name, value in both.items()], F.col("Stage ID"))
    attempt = F.coalesce(*[_when(name, value["Stage Attempt ID"]) for name, value in both.items()], F.col("Stage Attempt ID"), F.lit(0))
    start = F.struct(info["Submission Time"].alias("at"), info["Number of Tasks"].alias("num_tasks"))
    end = F.struct(info["Completion Time"].alias("at"), info["Submission Time"].alias("submitted"), info["Number of Tasks"].alias("num_tasks"), info["Failure Reason"].isNotNull().alias("failed"))
    sums = {
        "shuffle_write_bytes": written["Shuffle Bytes Written"],
        "shuffle_write_records": written["Shuffle Records Written"],
        "shuffle_read_bytes": F.coalesce(read["Local Bytes Read"], F.lit(0)) + F.coalesce(read["Remote Bytes Read"], F.lit(0)),
        "shuffle_read_records": read["Total Records Read"],
    }
    attempts = _whole(events, STAGE_START, STAGE_END, TASK_END).groupBy("log", own.alias("stage_id"), attempt.alias("attempt_id")).agg(
        F.max(_when(STAGE_START, start)).alias("s"),
        F.max(_when(STAGE_END, end)).alias("e"),
        *[F.coalesce(F.sum(_when(TASK_END, value)), F.lit(0)).alias(name) for name, value in sums.items()],
    )
    known = attempts.selectExpr(
        "log",
        "stage_id",
        "attempt_id",
        f"CASE WHEN e IS NULL THEN '{ACTIVE}' WHEN e.failed THEN '{FAILED}' ELSE '{COMPLETE}' END AS status",
        "coalesce(s.at, e.submitted) AS submitted",
        "e.at AS completed",
        "coalesce(e.num_tasks, s.num_tasks) AS num_tasks",
        *sums,
    )
    last = F.max_by(F.struct(*[name for name in known.columns if name not in ("log", "stage_id")]), "attempt_id")
    # A stage that jobs only list meets what is known of it in one aggregate; several jobs may list it.
    listed = jobs.select("log", F.explode("stage_ids").alias("stage_id"), (F.col("status") == RUNNING).alias("waits")).groupBy("log", "stage_id").agg(F.max("waits").alias("waits"))
    seen = known.groupBy("log", "stage_id").agg(last.alias("last"), F.count("*").alias("num_attempts"))
    found = seen.unionByName(listed, allowMissingColumns=True).groupBy("log", "stage_id").agg(
        F.max("last").alias("last"), F.coalesce(F.max("num_attempts"), F.lit(0)).alias("num_attempts"), F.max("waits").alias("waits")
    )
    return found.selectExpr(
        "log",
        "stage_id",
        "last.attempt_id AS attempt_id",
        "num_attempts",
        f"coalesce(last.status, CASE WHEN waits THEN '{PENDING}' ELSE '{SKIPPED}' END) AS status",
        f"{_text('last.submitted')} AS submitted",
        f"{_text('last.completed')} AS completed",
        "coalesce(last.num_tasks, 0) AS num_tasks",
        *[f"coalesce(last.{name}, 0) AS {name}" for name in sums],
    )


def statuses(jobs: DataFrame, stages: DataFrame, tasks: DataFrame) -> DataFrame:
    """How many things of each kind have each status, by log."""
    kinds = (("job", jobs), ("stage", stages), ("task", tasks))
    rows = [rows.select("log", F.lit(kind).alias("kind"), "status") for kind, rows in kinds]
    return rows[0].union(rows[1]).union(rows[2]).groupBy("log", "kind", "status").agg(F.count("*").alias("n"))
