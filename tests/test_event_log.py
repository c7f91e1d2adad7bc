"""Event logs: events written by hand, and a log that Spark has written itself."""

import json
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from helpers import plan_of
from tallywork.operators import profile
from tallywork.plans import driver_tables, registered
from tallywork.sources import event_log
from tallywork.sources.shared_folder import new_folder


def job_start(job, stages, at=1000, tasks=2):
    infos = [{"Stage ID": s, "Stage Attempt ID": 0, "Stage Name": f"name of {s}", "Number of Tasks": tasks} for s in stages]
    return {"Event": event_log.JOB_START, "Job ID": job, "Submission Time": at, "Stage Infos": infos, "Stage IDs": stages}


def job_end(job, at=9000, result="JobSucceeded"):
    return {"Event": event_log.JOB_END, "Job ID": job, "Completion Time": at, "Job Result": {"Result": result}}


def stage(event, stage_id, attempt=0, at=2000, end=None, why=None, tasks=2):
    info = {"Stage ID": stage_id, "Stage Attempt ID": attempt, "Stage Name": "s", "Number of Tasks": tasks, "Submission Time": at}
    return {"Event": event, "Stage Info": info | ({"Completion Time": end} if end else {}) | ({"Failure Reason": why} if why else {})}


def task(event, stage_id, task_id, attempt=0, start=2100, end=2200, written=0, read=(0, 0), failed=False):
    own = {"Event": event, "Stage ID": stage_id, "Stage Attempt ID": attempt, "Task Info": {"Task ID": task_id, "Launch Time": start, "Failed": failed, "Killed": False}}
    if event == event_log.TASK_END:
        own["Task Info"]["Finish Time"] = end
        own["Task Metrics"] = {
            "Executor Run Time": end - start,
            "Shuffle Write Metrics": {"Shuffle Bytes Written": written, "Shuffle Records Written": 1},
            "Shuffle Read Metrics": {"Local Bytes Read": read[0], "Remote Bytes Read": read[1], "Total Records Read": 2},
        }
    return own


LINES = [
    {"Event": "SparkListenerLogStart", "Spark Version": "4.1.2"},
    job_start(1, [10, 11, 12]),
    stage(event_log.STAGE_START, 10),
    task(event_log.TASK_START, 10, 100),
    task(event_log.TASK_END, 10, 100, written=7, read=(1, 2)),
    task(event_log.TASK_START, 10, 101),
    task(event_log.TASK_END, 10, 101, failed=True),
    stage(event_log.STAGE_END, 10, end=2500, why="fetch failed"),
    stage(event_log.STAGE_START, 10, attempt=1, at=2600),
    task(event_log.TASK_START, 10, 102, attempt=1, start=2600),
    task(event_log.TASK_END, 10, 102, attempt=1, start=2600, end=2900, written=70),
    stage(event_log.STAGE_END, 10, attempt=1, at=2600, end=3000),
    stage(event_log.STAGE_START, 11, at=3100),
    stage(event_log.STAGE_END, 11, at=3100, end=3200),
    job_end(1),
    job_start(2, [12, 13, 14]),
    stage(event_log.STAGE_START, 13, at=4000),
    task(event_log.TASK_START, 13, 103, start=4000),
    job_end(3, result="JobFailed"),
    task(event_log.TASK_END, 15, 104, start=1, end=3),
]


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("logs")
    lines = [json.dumps(line) for line in LINES]
    (folder / "app-1").write_text("\n".join([*lines, '{"Event":"SparkListenerJobEnd","Job ID":2,"Compl', "no json", ""]))
    (folder / "app-2").write_text("\n".join(lines[1:3]))
    return event_log.read_events(spark, str(folder))


def records(df, log="app-1"):
    return {tuple(row)[1]: row.asDict() for row in df.where(F.col("log") == log).collect()}


def test_lines_are_counted_and_broken_ones_too(events):
    row = records(event_log.counts(events).select("log", F.lit(0), "*"))[0]
    assert row["lines"] == len(LINES) + 2 and row["broken_lines"] == 2 and row["other_events"] == 1
    assert (row["job_starts"], row["job_ends"], row["stage_starts"], row["stage_ends"], row["task_starts"], row["task_ends"]) == (2, 2, 4, 3, 4, 4)


def test_jobs_are_kept_without_one_of_their_events(events):
    jobs = records(event_log.jobs_of(events))
    assert {job: row["status"] for job, row in jobs.items()} == {1: "SUCCEEDED", 2: "RUNNING", 3: "NO_START"}
    assert jobs[1]["name"] == "name of 12" and jobs[1]["num_tasks"] == 6 and jobs[1]["stage_ids"] == [10, 11, 12]
    assert (jobs[1]["submitted"], jobs[1]["completed"]) == ("1970-01-01T00:00:01GMT", "1970-01-01T00:00:09GMT")
    assert jobs[2]["completed"] is None and jobs[3]["submitted"] is None


def test_of_a_stage_the_last_attempt_counts(events):
    stages = records(event_log.stages_of(events))
    assert {name: row["status"] for name, row in stages.items()} == {10: "COMPLETE", 11: "COMPLETE", 12: "PENDING", 13: "ACTIVE", 14: "PENDING", 15: "ACTIVE"}
    assert (stages[10]["attempt_id"], stages[10]["num_attempts"], stages[10]["shuffle_write_bytes"], stages[10]["shuffle_read_bytes"]) == (1, 2, 70, 0)
    assert stages[12]["num_attempts"] == 0
    # Job 1 has ended, but job 2, which lists stage 12 as well, has not: the second log has the first job alone, unfinished.
    assert {row["status"] for row in records(event_log.stages_of(events), "app-2").values()} == {"ACTIVE", "PENDING"}
    alone = event_log.stages_of(events.where("`Job ID` IS NULL OR `Job ID` = 1"))
    assert records(alone)[12]["status"] == "SKIPPED"


def test_tasks(events):
    tasks = {row["task_id"]: row for row in event_log.tasks_of(events).where("log = 'app-1'").collect()}
    assert {name: row["status"] for name, row in tasks.items()} == {100: "SUCCEEDED", 101: "FAILED", 102: "SUCCEEDED", 103: "RUNNING", 104: "SUCCEEDED"}
    assert (tasks[100]["duration_ms"], tasks[100]["shuffle_read_bytes"], tasks[100]["attempt_id"]) == (100, 3, 0)
    assert tasks[104]["launched"] == "1970-01-01T00:00:00.001GMT" and tasks[103]["finished"] is None


def test_statuses(events):
    jobs = event_log.jobs_of(events)
    found = event_log.statuses(jobs, event_log.stages_of(events, jobs), event_log.tasks_of(events)).where("log = 'app-1'")
    assert {(row["kind"], row["status"]): row["n"] for row in found.collect()}[("task", "RUNNING")] == 1


def test_a_column_of_lines_gives_the_same(spark, events):
    lines = spark.createDataFrame([("app-1", json.dumps(line)) for line in LINES] + [("app-1", "no json"), ("app-1", "{\"Event\":"), ("app-3", ""), ("app-3", None)], "log string, line string")
    own = event_log.events_of(lines)
    assert records(event_log.jobs_of(own)) == records(event_log.jobs_of(events))
    assert records(event_log.stages_of(own)) == records(event_log.stages_of(events))
    counted = {row["log"]: (row["lines"], row["broken_lines"]) for row in event_log.counts(own).collect()}
    assert counted == {"app-1": (len(LINES) + 2, 2), "app-3": (2, 2)}


def test_a_written_log_is_small_and_no_file_is_large(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(event_log, "EVENTS_PER_FILE", 1000)
    event = '{"Event":"SparkListenerTaskStart","Stage ID":7,"Stage Attempt ID":0,"Task Info":{"Task ID":%d,"Launch Time":1700000000000}}'
    lines = spark.range(0, 5000, 1, 2).select(F.format_string(event, "id").alias("line")).union(spark.createDataFrame([('{"Event":"Spark',)], "line string"))
    event_log.write_events(lines, str(tmp_path / "log"))
    files = list((tmp_path / "log").glob("part-*.gz"))
    assert len(files) >= 6 and sum(f.stat().st_size for f in files) < 5000 * len(event) / 8
    read = event_log.read_events(spark, str(tmp_path / "log")).withColumn("log", F.lit("one"))
    assert event_log.counts(read).select("lines", "broken_lines", "task_starts").first() == (5001, 1, 5000)
    tasks = event_log.tasks_of(read).select("task_id").collect()
    assert sorted(task["task_id"] for task in tasks) == list(range(5000))


def test_the_registered_log_is_compressed(spark, monkeypatch):
    made = []
    monkeypatch.setattr(registered, "new_folder", lambda session, name: made.append(new_folder(session, name)) or made[-1])
    events = registered._events(spark, "/root/testdata/sf0.001")
    assert events.count() == driver_tables.event_lines(spark, "/root/testdata/sf0.001").count()
    assert {row.name.endswith(".gz") for row in spark.read.format("binaryFile").load(made[0]).select(F.col("path").alias("name")).collect()} == {True}


def test_an_empty_log(spark):
    own = event_log.events_of(spark.createDataFrame([], "log string, line string"))
    assert event_log.jobs_of(own).count() == event_log.stages_of(own).count() == event_log.tasks_of(own).count() == event_log.counts(own).count() == 0


def test_lines_are_read_once_without_a_join(events):
    plan = plan_of(event_log.tasks_of(events))
    assert plan.count("FileScan") == 1 and "Join" not in plan
    assert "Stage Infos" not in plan and "Job Result" not in plan
    assert "Join" not in plan_of(event_log.stages_of(events))


APPLICATION = """
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.dir", "file://" + sys.argv[1]).config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false").getOrCreate())
spark.range(1000).repartition(3).groupBy("id").count().selectExpr("sum(count)").collect()
try:
    spark.range(10).selectExpr("raise_error('on purpose')").collect()
except Exception:
    pass
spark.stop()
"""


def test_a_log_of_sparks_own(spark, tmp_path):
    folder = tmp_path / "own"
    folder.mkdir()
    subprocess.run([sys.executable, "-c", APPLICATION, str(folder)], check=True, capture_output=True)
    events = event_log.read_events(spark, str(folder))
    counted = event_log.counts(events).collect()
    assert len(counted) == 1 and counted[0]["broken_lines"] == 0 and counted[0]["other_events"] > 0
    jobs, stages, tasks = event_log.jobs_of(events), event_log.stages_of(events), event_log.tasks_of(events)
    assert {row["status"] for row in jobs.collect()} == {"SUCCEEDED", "FAILED"}
    done = stages.where("status = 'COMPLETE'").collect()
    assert done and sum(row["shuffle_write_bytes"] for row in done) > 0
    rolled = profile.stage_rollup(stages, tasks.where("status <> 'RUNNING'"), threads=2)
    links = jobs.select("job_id", F.explode("stage_ids").alias("stage_id"))
    total = profile.query_rollup(profile.job_rollup(jobs, links, rolled, 2), 2).first()
    assert total["num_jobs"] == jobs.count() and total["num_unknown_stages"] == 0
    assert total["num_nonskipped_tasks"] > 0 and total["execution_time"] > 0
