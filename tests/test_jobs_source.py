import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tallywork.functions import periods
from tallywork.operators import usage
from tallywork.plans import usage_report as report
from tallywork.sources import jobs as source
from tallywork.sources import tables

from helpers import plan_of, rows_of

HEADER = "|".join(field.name for field in source.JOB_SCHEMA)


def record(n, elapsed=3600, account="f1", nodes=1, partition="normal-arm", state="COMPLETED", tres=""):
    fields = [
        f"{n}_1", n, elapsed, account, 32, elapsed * 32, nodes, nodes, 32, partition,
        "1-00:01:00", "someone", "0:0", state, "", "", tres,
    ]
    return "|".join(map(str, fields))


@pytest.fixture
def extract(tmp_path):
    directory = tmp_path / "extract"
    directory.mkdir()

    def write(name, *records):
        (directory / name).write_text("\n".join([HEADER, *records]) + "\n")

    write("jobs_Jan.txt", record(1), record(2, state="FAILED", account="ee7", nodes=2))
    write("jobs_Feb.txt", record(3, partition="x-a100", tres="gres/gpu=3"), record(4, account="x"))
    write("jobs_Mar.txt", record(5, partition="x-a100", tres="billing=1", account="ee1"))
    (directory / "README.txt").write_text("not a job file\n")
    (directory / "other_Jan.txt").write_text("nor this\n")
    return str(directory)


def test_bulk_read(spark, extract):
    jobs = source.read_jobs(spark, extract, 2025)
    got = rows_of(jobs, "JobIDRaw", "period", "file_name", "TotalCPU", "ExitCode", "AllocTRES")
    assert got[0] == (1, dt.date(2025, 1, 1), "jobs_Jan.txt", "1-00:01:00", "0:0", None)
    assert [row[0] for row in got] == [1, 2, 3, 4, 5]


def test_all_columns_are_read_as_written(spark, extract):
    jobs = source.read_jobs(spark, extract, 2025)
    row = jobs.filter("JobIDRaw = 3").first()
    names = [field.name for field in source.JOB_SCHEMA]
    texts = record(3, partition="x-a100", tres="gres/gpu=3").split("|")
    assert [("" if row[n] is None else str(row[n])) for n in names] == texts
    assert (row.period, row.file_name) == (dt.date(2025, 2, 1), "jobs_Feb.txt")
    assert len(jobs.columns) == 19


def test_a_file_without_a_known_month_stops_the_job(spark, extract):
    with open(f"{extract}/jobs_Ago.txt", "w") as file:
        file.write("\n".join([HEADER, record(6)]) + "\n")
    with pytest.raises(Exception, match="no known month in the name of the job file jobs_Ago.txt"):
        report.month_report(source.read_jobs(spark, extract, 2025), 2025, 12).collect()
    skipped = source.read_jobs(spark, extract, 2025, skip_unknown=True)
    assert skipped.count() == 5
    named = source.read_jobs(spark, extract, 2025, aliases={"Ago": "Aug"})
    assert rows_of(named.filter("JobIDRaw = 6"), "period") == [(dt.date(2025, 8, 1),)]


def test_only_used_columns_and_the_months_asked_for_are_read(spark, extract):
    jobs = source.of_period(source.read_jobs(spark, extract, 2025), dt.date(2025, 2, 1))
    cube = usage.usage_cube(jobs)
    cube.collect()
    plan = cube._jdf.queryExecution().executedPlan()
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan.toString()).group(1)
    assert "JobID" not in schema and "ElapsedRaw" in schema
    scans = []

    def visit(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return visit(node.plan())
        if name == "FileSourceScanExec":
            scans.append(node.metrics().apply("numFiles").value())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(plan)
    assert scans == [1]


def test_checked_read_stops_at_a_missing_value(spark, tmp_path):
    (tmp_path / "jobs_Jan.txt").write_text("\n".join([HEADER, record(1, elapsed="")]) + "\n")
    path = str(tmp_path)
    assert source.read_jobs(spark, path, 2025, checked=False).select("ElapsedRaw").count() == 1
    checked = source.read_jobs(spark, path, 2025)
    assert [r[0] for r in checked.select("State").collect()] == ["COMPLETED"]
    with pytest.raises(Exception, match="job record without ElapsedRaw"):
        checked.select("ElapsedRaw").collect()


def test_report_through_files(spark, extract, tmp_path):
    jobs = source.read_jobs(spark, extract, 2025)
    out = str(tmp_path / "report")
    tables.write_report(report.month_report(jobs, 2025, 3), out)
    lines = [r.value for r in spark.read.text(out).collect()]
    assert len(lines) == 70
    assert lines[0] == r"\def\reportPeriod{01/03/2025 - 31/03/2025}"
    assert r"\def\monthhours{{\inteval{\ndays * 24}}}" in lines
    values = {r.key: r.value for r in tables.read_report(spark, out).collect()}
    assert values == {r.key: r.value for r in report.month_report(jobs, 2025, 3).collect()}
    assert len(values) == 70 and values["hoursYear"] == r"{\inteval{\ndaysYear * 24}}"
    assert values["armJobsYear"] == "2"
    assert values["armusedhoursYear"] == "3.0"
    assert values["gpuusedhours"] == "4.0"
    assert values["gpuusedhoursTrimester"] == "7.0"
    assert values["gpuusedhoursEuroHPCYear"] == "4.0"
    assert values["amdusedhours"] == "0.0" and values["amdusedhoursEuroHPC"] == "0"
    assert values["percentaviail"] == "0.8"


def test_one_file_holds_one_report(spark, extract, tmp_path):
    params = report.usage_params(usage.usage_cube(source.read_jobs(spark, extract, 2025)))
    with pytest.raises(Exception, match="more than one report"):
        tables.write_report(params, str(tmp_path / "mixed"))


def test_reports_of_all_months(spark, extract, tmp_path):
    jobs = source.read_jobs(spark, extract, 2025)
    out = tmp_path / "reports"
    tables.write_reports(report.usage_params(usage.usage_cube(jobs)), str(out))
    for month in (1, 2, 3):
        [file] = (out / f"report=2025-{month:02}-01").glob("part-*")
        single = str(tmp_path / f"single-{month}")
        tables.write_report(report.month_report(jobs, 2025, month), single)
        assert file.read_text().splitlines() == [r.value for r in spark.read.text(single).collect()]


def test_refresh_replaces_one_month(spark, extract, tmp_path):
    stored = str(tmp_path / "stored")
    jobs = source.read_jobs(spark, extract, 2025)
    tables.write_periods(usage.narrow(jobs), stored)
    before = rows_of(usage.usage_cube(jobs))
    assert rows_of(usage.cube_of(tables.read_periods(spark, stored))) == before

    changed = jobs.withColumn("ElapsedRaw", F.lit(7200))
    report.refresh_period(changed, dt.date(2025, 2, 1), stored)
    after = usage.cube_of(tables.read_periods(spark, stored))
    kept = [row for row in before if row[0] != dt.date(2025, 2, 1)]
    assert [row for row in rows_of(after) if row[0] != dt.date(2025, 2, 1)] == kept
    february = after.filter("period = DATE'2025-02-01'").agg(F.sum("total_secs")).first()[0]
    assert february == 7200 * 4

    report.refresh_period(jobs.filter("period <> DATE'2025-03-01'"), dt.date(2025, 3, 1), stored)
    left = tables.read_periods(spark, stored)
    assert left.filter("period = DATE'2025-03-01'").count() == 0 and left.count() == 4

    one = tables.read_periods(spark, stored).filter(F.col("period") == dt.date(2025, 2, 1))
    assert "PartitionFilters: [isnotnull(period" in plan_of(one)


def test_views(spark, extract):
    jobs = source.read_jobs(spark, extract, 2025)
    tables.register_views({"all_jobs": jobs, "other": jobs.filter("JobIDRaw > 1")})
    spark.catalog.cacheTable("other")
    assert spark.sql("SELECT count(*) FROM all_jobs GROUP BY ALL").first()[0] == 5
    tables.drop_views(spark, ["all_jobs"])
    assert not spark.catalog.tableExists("all_jobs")
    assert spark.catalog.isCached("other")
    tables.drop_views(spark, ["other", "never_there"])
    assert not spark.catalog.tableExists("other")


def test_month_texts():
    assert len(periods.MONTHS) == 12
