"""Saved output of Spark's monitoring interface, one JSON job or stage per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The fields that are read, under the names the monitoring interface gives them.
JOB_SCHEMA = (
    "jobId BIGINT, name STRING, submissionTime STRING, completionTime STRING,"
    " stageIds ARRAY<BIGINT>, numTasks BIGINT"
)
TASK = (
    "STRUCT<taskId: BIGINT, duration: BIGINT, taskMetrics: STRUCT<"
    "shuffleWriteMetrics: STRUCT<bytesWritten: BIGINT, recordsWritten: BIGINT>,"
    "shuffleReadMetrics: STRUCT<localBytesRead: BIGINT, remoteBytesRead: BIGINT,"
    " recordsRead: BIGINT>>>"
)
STAGE_SCHEMA = (
    "stageId BIGINT, attemptId INT, status STRING, submissionTime STRING, completionTime STRING,"
    " numTasks BIGINT, shuffleWriteBytes BIGINT, shuffleWriteRecords BIGINT,"
    f" shuffleReadBytes BIGINT, shuffleReadRecords BIGINT, tasks MAP<STRING, {TASK}>"
)


def _read(spark: SparkSession, path: str, schema: str, whole_file: bool) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", whole_file).json(path)


def _parsed(texts: DataFrame, text: str, schema: str) -> DataFrame:
    """The fields of a JSON text column; a text that is no JSON has NULLs."""
    return texts.select(F.from_json(text, schema).alias("record")).select("record.*")


def jobs_of(records: DataFrame) -> DataFrame:
    """Job records under the names that the operators use."""
    return records.select(
        F.col("jobId").alias("job_id"),
        "name",
        F.col("submissionTime").alias("submitted"),
        F.col("completionTime").alias("completed"),
        F.col("stageIds").alias("stage_ids"),
        F.col("numTasks").alias("num_tasks"),
    )


def stages_of(records: DataFrame) -> DataFrame:
    """Stage records with their tasks, a row for each attempt."""
    return records.select(
        F.col("stageId").alias("stage_id"),
        F.coalesce("attemptId", F.lit(0)).alias("attempt_id"),
        "status",
        F.col("submissionTime").alias("submitted"),
        F.col("completionTime").alias("completed"),
        F.col("numTasks").alias("num_tasks"),
        F.col("shuffleWriteBytes").alias("shuffle_write_bytes"),
        F.col("shuffleWriteRecords").alias("shuffle_write_records"),
        F.col("shuffleReadBytes").alias("shuffle_read_bytes"),
        F.col("shuffleReadRecords").alias("shuffle_read_records"),
        "tasks",
    )


def read_jobs(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """``whole_file`` reads files that hold one JSON array; such a file is not split."""
    return jobs_of(_read(spark, path, JOB_SCHEMA, whole_file))


def read_stages(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """All attempts of all stages with their tasks."""
    return stages_of(_read(spark, path, STAGE_SCHEMA, whole_file))


def parse_jobs(texts: DataFrame, text: str) -> DataFrame:
    """The same from a column with a JSON record in each row."""
    return jobs_of(_parsed(texts, text, JOB_SCHEMA))


def parse_stages(texts: DataFrame, text: str) -> DataFrame:
    return stages_of(_parsed(texts, text, STAGE_SCHEMA))


def last_attempts(stages: DataFrame) -> DataFrame:
    """Of a stage that was tried again, the last attempt, without its tasks.

    One aggregate over the narrow columns: the maps of tasks are not read for it.
    """
    narrow = [c for c in stages.columns if c not in ("stage_id", "tasks")]
    last = F.max_by(F.struct(*narrow), "attempt_id").alias("last")
    return stages.groupBy("stage_id").agg(last).select("stage_id", "last.*")


def job_stages(jobs: DataFrame) -> DataFrame:
    """One row per job and stage of it."""
    return jobs.select("job_id", F.explode("stage_ids").alias("stage_id"))


def tasks_of(stages: DataFrame) -> DataFrame:
    """One row per task that ran, of all attempts."""
    task = F.col("task")
    written, read = (
        task["taskMetrics"]["shuffleWriteMetrics"],
        task["taskMetrics"]["shuffleReadMetrics"],
    )
    each = stages.select("stage_id", "attempt_id", F.explode("tasks").alias("task_key", "task"))
    return each.select(
        "stage_id",
        "attempt_id",
        task["taskId"].alias("task_id"),
        task["duration"].alias("duration_ms"),
        written["bytesWritten"].alias("shuffle_write_bytes"),
        written["recordsWritten"].alias("shuffle_write_records"),
        # Local and remote reads: on one machine the second part is zero.
        (
            F.coalesce(read["localBytesRead"], F.lit(0))
            + F.coalesce(read["remoteBytesRead"], F.lit(0))
        ).alias("shuffle_read_bytes"),
        read["recordsRead"].alias("shuffle_read_records"),
    )


def new_since(jobs: DataFrame, seen: DataFrame, key: str = "job_id") -> DataFrame:
    """Rows of a later snapshot that an earlier one did not have."""
    return jobs.join(seen.select(key).distinct(), key, "left_anti")
