import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallywork.operators import usage
from tallywork.operators.reconcile import acceptable
from tallywork.plans import usage_report as report

from helpers import plan_of, rows_of

SCHEMA = (
    "Partition STRING, Account STRING, State STRING, AllocTRES STRING, NNodes INT,"
    " AllocCPUS INT, ElapsedRaw INT, period DATE"
)


@pytest.fixture(scope="module")
def jobs(spark):
    pick = random.Random(5)
    rows = [
        (
            pick.choice(["normal-arm", "a100-40", "x86"]),
            pick.choice(["f1", "ee2", "local"]),
            pick.choice(["COMPLETED", "FAILED", "CANCELLED by 3", None]),
            pick.choice([None, "", "gres/gpu=2", "billing=3"]),
            pick.randint(1, 9),
            64,
            pick.randint(0, 90000),
            # No jobs in May and none in 2023 before October.
            pick.choice([dt.date(2024, m, 1) for m in range(1, 13) if m != 5]
                        + [dt.date(2023, m, 1) for m in (10, 11, 12)]),
        )
        for _ in range(400)
    ]
    return spark.createDataFrame(rows, SCHEMA).cache()


def by_hand(jobs, year, month):
    """The figures of a report with plain loops."""
    tags = {"": [month], "Trimester": list(range(max(1, month - 2), month + 1)),
            "Year": list(range(1, month + 1))}
    result = {}
    rows = usage.classified(jobs).collect()
    for tag, months in tags.items():
        inside = [r for r in rows if r.period.year == year and r.period.month in months]
        for cluster in ("arm", "amd", "gpu"):
            own = [r for r in inside if r.cluster == cluster]
            work = [r for r in own if r.agency != "LOCAL"]
            ehpc = [r for r in own if r.agency == "EHPC"]
            done = sum(r.outcome == "COMPLETED" for r in own)
            result[f"{cluster}CompletedJobs{tag}"] = str(done)
            result[f"{cluster}FailedJobs{tag}"] = str(len(own) - done)
            result[f"{cluster}Jobs{tag}"] = str(len(work))
            result[f"{cluster}JobsEuroHPC{tag}"] = str(len(ehpc))
            hours = sum(r.job_seconds for r in work) / 3600
            result[f"{cluster}usedhours{tag}"] = str(hours) if inside else "0"
            result[f"{cluster}usedhoursEuroHPC{tag}"] = (
                str(sum(r.job_seconds for r in ehpc) / 3600) if ehpc else "0"
            )
    return result


@pytest.mark.parametrize(("year", "month"), [(2024, 1), (2024, 2), (2024, 5), (2024, 12), (2023, 9)])
def test_one_report_by_hand(jobs, year, month):
    params = report.month_report(jobs, year, month).collect()
    assert len(params) == len({p.key for p in params}) == 70
    got = {p.key: p.value for p in params}
    expected = by_hand(jobs, year, month)
    assert len(expected) == 54
    assert {k: got[k] for k in expected} == expected


def test_report_of_last_month(jobs):
    last = (dt.date.today().replace(day=1) - dt.timedelta(days=1)).replace(day=1)
    assert {r.report for r in report.month_report(jobs).collect()} == {last}


def test_all_reports_at_once(jobs):
    cube = usage.usage_cube(jobs)
    together = report.usage_params(cube)
    assert together.select("report").distinct().count() == 14
    december = together.filter("report = DATE'2024-12-01'")
    single = report.month_report(jobs, 2024, 12)
    assert rows_of(december) == rows_of(single)
    positions = [r.position for r in december.collect()]
    assert sorted(positions)[:16] == list(range(16))


def test_variants_agree_for_every_month(spark, jobs):
    reports = report.report_months(spark, [(2024, m) for m in range(1, 13)])
    fast = report.usage_params(usage.usage_cube(jobs), reports)
    for slow in (report.usage_params_multipass, report.usage_params_direct):
        verdict = acceptable(report.compare_reports(slow(jobs, reports), fast)).first()
        assert verdict.acceptable and verdict.equal == 12 * 70


def test_long_form(jobs):
    rows = report.usage_report(usage.usage_cube(jobs)).filter("report = DATE'2024-03-01'").collect()
    assert len(rows) == 54
    expected = by_hand(jobs, 2024, 3)
    for row in rows:
        assert row.value == pytest.approx(float(expected[row.cluster + row.metric + row.tag]))


def test_rows_without_a_period_stay_in_the_cube_and_out_of_reports(spark, jobs):
    odd = jobs.limit(3).withColumn("period", F.lit(None).cast("date"))
    both = jobs.unionByName(odd)
    assert usage.usage_cube(both).agg(F.sum("job_count")).first()[0] == 403
    assert rows_of(report.usage_params(usage.usage_cube(both))) == rows_of(
        report.usage_params(usage.usage_cube(jobs))
    )


def test_reports_read_the_jobs_once(spark, tmp_path, jobs):
    path = str(tmp_path / "jobs")
    jobs.write.parquet(path)
    params = report.usage_params(usage.usage_cube(spark.read.parquet(path)))
    plan = plan_of(params)
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange") == 2
    assert "Join" not in plan


def test_empty_input(spark, jobs):
    nothing = jobs.filter("false")
    params = {p.key: p.value for p in report.month_report(nothing, 2024, 4).collect()}
    assert len(params) == 70
    assert params["armusedhours"] == "0" and params["ndays"] == "30"
    assert report.usage_params(usage.usage_cube(nothing)).count() == 0
