"""Monthly usage reports.

A report belongs to a month. It has the figures of that month, of the quarter that ends with it
and of the year up to it. All reports come from the same cube, which is the only thing that reads
the jobs. Where an operator takes ``reports``, that is a DataFrame with one DATE column ``report``,
the first day of the month: one row for one report, or as many as are wanted.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.functions import classify, numbers, periods
from tallywork.operators import usage
from tallywork.operators.reconcile import reconcile
from tallywork.sources import tables
from tallywork.sources.jobs import of_period

JOBS, SECONDS = "job_count", "total_secs"
EUROHPC = "EHPC"

# The figures of a report and the part of the cube that each one adds up.
FIGURES = {
    "CompletedJobs": (JOBS, "outcome = 'COMPLETED'"),
    "FailedJobs": (JOBS, "outcome <> 'COMPLETED'"),
    "Jobs": (JOBS, f"agency <> '{classify.OTHER_AGENCY}'"),
    "JobsEuroHPC": (JOBS, f"agency = '{EUROHPC}'"),
    "usedhours": (SECONDS, f"agency <> '{classify.OTHER_AGENCY}'"),
    "usedhoursEuroHPC": (SECONDS, f"agency = '{EUROHPC}'"),
}

# Parameters of every report. The second percentage and the hour macros are written
# as the documents that read a report expect them.
CAPACITY = {
    "armnodes": "1632",
    "amdnodes": "500",
    "gpunodes": "132",
    "percentaviail": "0.8",
    "eurohpcavail": "0.35",
}
HOUR_MACROS = {
    "monthhours": r"{\inteval{\ndays * 24}}",
    "hoursTrimester": r"{\inteval{\ndaysTrimester * 24}}",
    "hoursYear": r"{\inteval{\ndaysYear * 24}}",
}


def report_months(spark: SparkSession, months: Iterable[tuple[int, int]]) -> DataFrame:
    """Reports for the given (year, month) pairs."""
    days = ", ".join(f"(DATE'{dt.date(year, month, 1)}')" for year, month in months)
    return spark.sql(f"SELECT report FROM VALUES {days} AS months (report)")


def period_map(reports: DataFrame) -> DataFrame:
    """The months that each tag of each report covers: at most 1 + 3 + 12 rows per report."""
    covered = periods.tagged_months(periods.FIRST_PERIOD, dict.fromkeys(periods.TAGS, "report"))
    tagged = reports.selectExpr("report", f"inline({covered})")
    return tagged.selectExpr("report", "tag", "explode(months) AS period")


_CLUSTERS = ", ".join(f"'{cluster}'" for cluster in classify.CLUSTERS)
_TAGS = ", ".join(f"'{tag}'" for tag in periods.TAGS)


def _with_reports(cube: DataFrame) -> DataFrame:
    """Each row of the cube once for every report, tag and cluster that it can go into.

    The rows of ``period_map`` the other way round: no join, and at most 48 copies of a row of
    the cube, never of a job. A row also comes under the clusters that are not its own, so that
    every cluster has its figures in every report.
    """
    fed = periods.tagged_months(dict.fromkeys(periods.TAGS, "period"), periods.LAST_REPORT)
    tagged = cube.filter("period IS NOT NULL").selectExpr(
        "*", f"explode(array({_CLUSTERS})) AS of_cluster"
    )
    return tagged.selectExpr("*", f"inline({fed})").selectExpr("*", "explode(months) AS report")


def _date_columns(year_start: dt.date | None) -> dict[str, str]:
    quarter = periods.FIRST_PERIOD[periods.TRIMESTER_TAG]
    year = f"DATE'{year_start}'" if year_start else periods.FIRST_PERIOD[periods.YEAR_TAG]
    return {
        "month_range": periods.date_range_text("report", "last_day(report)"),
        "quarter_range": periods.date_range_text(quarter, "last_day(report)"),
        "year_range": periods.date_range_text(year, "last_day(report)"),
        "month_name": "date_format(report, 'MMMM')",
        "month_abbreviation": "date_format(report, 'MMM')",
        "year": "year(report)",
        "days": periods.days_to_end("report"),
        "quarter_days": periods.days_to_end(quarter),
        "year_days": periods.days_to_end(year),
        "available_hours": f"{periods.days_to_end('report')} * 24",
        "quarter_available_hours": f"{periods.days_to_end(quarter)} * 24",
        "year_available_hours": f"{periods.days_to_end(year)} * 24",
    }


def calendar(reports: DataFrame, year_start: dt.date | None = None) -> DataFrame:
    """Date texts, days and available hours of every report.

    ``year_start`` moves the first day of the year to date, for a service that began later.
    """
    columns = [f"{sql} AS {name}" for name, sql in _date_columns(year_start).items()]
    return reports.selectExpr("report", *columns)


def _add_up(rows: DataFrame, figures: dict[str, str], reports: DataFrame | None) -> DataFrame:
    """Sum the figures by report, tag and cluster.

    Without ``reports`` there is one report for every month that has jobs. With it there are just
    those, and one for a month without jobs as well.
    """
    keys = ["report", "tag", "of_cluster"]
    if reports is None:
        # A month goes into its own report under every tag.
        wanted = "bool_or(period = report)"
    else:
        # An empty row for each figure that is asked for, instead of a join with the totals.
        asked = reports.selectExpr("report", f"explode(array({_TAGS})) AS tag").selectExpr(
            "*", f"explode(array({_CLUSTERS})) AS of_cluster", "true AS asked"
        )
        rows = rows.unionByName(asked, allowMissingColumns=True)
        wanted = "bool_or(asked)"
    totals = rows.groupBy(*keys).agg(
        F.expr(f"{wanted} AS wanted"),
        F.expr("count(period) > 0 AS any_jobs"),
        *[F.expr(f"sum({part}) AS {name}") for name, part in figures.items()],
    )
    return totals.filter("wanted").drop("wanted")


def usage_totals(cube: DataFrame, reports: DataFrame | None = None) -> DataFrame:
    """One row per report, tag and cluster, one column per figure.

    NULL means that no group of the cube went into the figure. ``any_jobs`` tells if the tag's
    months had jobs at all.
    """
    figures = {
        figure: f"CASE WHEN cluster = of_cluster AND {part} THEN {measure} END"
        for figure, (measure, part) in FIGURES.items()
    }
    return _add_up(_with_reports(cube), figures, reports)


def _number(column: str, measure: str) -> str:
    known = f"coalesce({column}, 0L)"
    return f"{known} / 3600" if measure == SECONDS else f"CAST({known} AS DOUBLE)"


def usage_report(cube: DataFrame, reports: DataFrame | None = None) -> DataFrame:
    """(report, tag, cluster, metric, value); hours as hours, absent figures as 0."""
    rows = ", ".join(
        f"('{figure}', {_number(figure, measure)})" for figure, (measure, _) in FIGURES.items()
    )
    return usage_totals(cube, reports).selectExpr(
        "report", "tag", "of_cluster AS cluster", f"inline(array({rows})) AS (metric, value)"
    )


def _text(figure: str, measure: str) -> str:
    """Counts as integers, hours as plain decimals.

    An hour figure that nothing went into reads 0; the general one reads 0.0 when the tag's
    months had jobs of other groups.
    """
    if measure == JOBS:
        return f"CAST(coalesce({figure}, 0L) AS STRING)"
    text = numbers.double_text(f"({figure} / 3600)")
    if figure == "usedhours":
        return f"coalesce({text}, CASE WHEN any_jobs THEN '0.0' END, '0')"
    return f"coalesce({text}, '0')"


def _header(year_start: dt.date | None) -> dict[str, str]:
    dates = _date_columns(year_start)
    return {
        "reportPeriod": dates["month_range"],
        "reportPeriodTrimester": dates["quarter_range"],
        "reportPeriodYear": dates["year_range"],
        "reportMonth": dates["month_name"],
        "reportYear": dates["year"],
        **{key: f"'{value}'" for key, value in CAPACITY.items()},
        "ndays": dates["days"],
        "ndaysTrimester": dates["quarter_days"],
        "ndaysYear": dates["year_days"],
        **{key: f"r'{value}'" for key, value in HOUR_MACROS.items()},
    }


def as_params(totals: DataFrame, year_start: dt.date | None = None) -> DataFrame:
    """Totals as the 70 texts of every report; the header comes with one row of the month."""
    head = [
        f"({n}, '{key}', CAST({sql} AS STRING))"
        for n, (key, sql) in enumerate(_header(year_start).items())
    ]
    # Figures stand behind the header, tag by tag.
    behind = f"100 * CAST(array_position(array({_TAGS}), tag) AS INT)"
    figures = [
        f"({behind} + {n}, of_cluster || '{figure}' || tag, {_text(figure, measure)})"
        for n, (figure, (measure, _)) in enumerate(FIGURES.items())
    ]
    first = f"tag = '{periods.MONTH_TAG}' AND of_cluster = '{classify.CLUSTERS[0]}'"
    rows = (
        f"CASE WHEN {first} THEN array({', '.join(head + figures)})"
        f" ELSE array({', '.join(figures)}) END"
    )
    return totals.selectExpr("report", f"inline({rows}) AS (position, key, value)")


def usage_params(
    cube: DataFrame, reports: DataFrame | None = None, year_start: dt.date | None = None
) -> DataFrame:
    """The 70 parameters of every report as text: (report, position, key, value)."""
    return as_params(usage_totals(cube, reports), year_start)


def month_report(
    jobs: DataFrame,
    year: int | None = None,
    month: int | None = None,
    year_start: dt.date | None = None,
) -> DataFrame:
    """One report straight from the jobs; months that no tag covers are not read.

    Without a year or month those of last month are taken.
    """
    spark, last_month = jobs.sparkSession, periods.default_report()
    year, month = year or last_month.year, month or last_month.month
    reports = report_months(spark, [(year, month)])
    needed = F.col("period").between(F.lit(dt.date(year, 1, 1)), F.lit(dt.date(year, month, 1)))
    return usage_params(usage.usage_cube(jobs.filter(needed)), reports, year_start)


# The slower ways to the same report, to check the fast one against.


def usage_totals_multipass(jobs: DataFrame, reports: DataFrame) -> DataFrame:
    """One pass over the jobs for each tag instead of one for all."""
    covered = period_map(reports)

    def one(tag: str) -> DataFrame:
        months = covered.filter(f"tag = '{tag}'").select("period").distinct()
        cube = usage.usage_cube(jobs.join(months, "period", "left_semi"))
        return usage_totals(cube, reports).filter(f"tag = '{tag}'")

    return reduce(DataFrame.unionByName, map(one, periods.TAGS))


def usage_totals_direct(jobs: DataFrame, reports: DataFrame) -> DataFrame:
    """A separate query for each figure, each with its own pass and its own filter."""
    by_outcome = "CASE WHEN outcome = 'COMPLETED' THEN 'CompletedJobs' ELSE 'FailedJobs' END"
    ehpc_sums = usage.agency_sums(jobs, EUROHPC, ["job_seconds"], "period")
    answers = [
        _answer(usage.jobs_by_outcome(jobs, "period"), by_outcome, JOBS),
        _answer(usage.nonlocal_seconds(jobs, "period"), "'usedhours'", SECONDS),
        _answer(usage.nonlocal_jobs(jobs, "period"), "'Jobs'", JOBS),
        _answer(usage.agency_jobs(jobs, EUROHPC, "period"), "'JobsEuroHPC'", JOBS),
        _answer(ehpc_sums, "'usedhoursEuroHPC'", "sum_job_seconds"),
    ]
    figures = {
        figure: f"CASE WHEN cluster = of_cluster AND metric = '{figure}' THEN amount END"
        for figure in FIGURES
    }
    found = period_map(reports).join(reduce(DataFrame.unionByName, answers), "period")
    rows = found.selectExpr("*", f"explode(array({_CLUSTERS})) AS of_cluster")
    return _add_up(rows, figures, reports)


def _answer(grouped: DataFrame, metric: str, amount: str) -> DataFrame:
    return grouped.selectExpr("period", "cluster", f"{metric} AS metric", f"{amount} AS amount")


def usage_params_multipass(
    jobs: DataFrame, reports: DataFrame, year_start: dt.date | None = None
) -> DataFrame:
    return as_params(usage_totals_multipass(jobs, reports), year_start)


def usage_params_direct(
    jobs: DataFrame, reports: DataFrame, year_start: dt.date | None = None
) -> DataFrame:
    return as_params(usage_totals_direct(jobs, reports), year_start)


def compare_reports(left: DataFrame, right: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """Every parameter of every report of two variants, with a verdict."""
    columns = ("report", "key", "value")
    return reconcile(left.select(*columns), right.select(*columns), ["report", "key"], tolerance)


def refresh_period(jobs: DataFrame, period: dt.date, path: str) -> None:
    """Classify one month and put it in the place of that month's part of the stored table.

    A month without jobs is stored as a month without rows.
    """
    tables.write_period(usage.narrow(of_period(jobs, period)), path, period)
