import datetime as dt

from tallywork.functions import numbers, periods
from tallywork.plans import usage_report as report

from helpers import rows_of


def expected_map(year: int, month: int):
    tags = {"": [month], "Trimester": range(max(1, month - 2), month + 1), "Year": range(1, month + 1)}
    return [(tag, dt.date(year, m, 1)) for tag, months in tags.items() for m in months]


def test_period_map_of_every_month(spark):
    months = [(2024, m) for m in range(1, 13)]
    got = rows_of(report.period_map(report.report_months(spark, months)))
    expected = [
        (dt.date(y, m, 1), tag, period) for y, m in months for tag, period in expected_map(y, m)
    ]
    assert got == sorted(expected, key=repr)


def test_months_find_the_reports_that_cover_them(spark):
    """The map read the other way round holds the same pairs."""
    reports = report.report_months(spark, [(2024, m) for m in range(1, 13)])
    cube = reports.selectExpr("report AS period", "'arm' AS cluster")
    fed = report._with_reports(cube).filter("of_cluster = 'arm'")
    assert rows_of(fed, "report", "tag", "period") == rows_of(report.period_map(reports))


def test_calendar(spark):
    dates = report.calendar(report.report_months(spark, [(2024, 2), (2025, 12)]))
    feb, dec = dates.orderBy("report").collect()
    assert feb.month_range == "01/02/2024 - 29/02/2024"
    assert feb.quarter_range == "01/01/2024 - 29/02/2024"
    assert (feb.days, feb.quarter_days, feb.year_days, feb.available_hours) == (29, 60, 60, 696)
    assert (feb.month_name, feb.month_abbreviation, feb.year) == ("February", "Feb", 2024)
    assert dec.quarter_range == "01/10/2025 - 31/12/2025"
    assert (dec.days, dec.quarter_days, dec.year_days) == (31, 92, 365)


def test_year_may_start_later(spark):
    reports = report.report_months(spark, [(2024, 12)])
    row = report.calendar(reports, dt.date(2024, 3, 15)).first()
    assert row.year_range == "15/03/2024 - 31/12/2024"
    assert row.year_days == (dt.date(2025, 1, 1) - dt.date(2024, 3, 15)).days


def test_period_of_file_name(spark):
    names = ["jobs_Jan.txt", "jobs_Dec.2024.csv", "jobs_Ago.txt", "jobs_Foo.txt", "other_Jan.txt"]
    df = spark.createDataFrame([(n,) for n in names], "f STRING")
    got = df.selectExpr(periods.period_of_file("f", 2025, {"Ago": "Aug"})).collect()
    assert [r[0] for r in got] == [
        dt.date(2025, 1, 1), dt.date(2025, 12, 1), dt.date(2025, 8, 1), None, None,
    ]


def test_default_report():
    assert periods.default_report(dt.date(2025, 1, 31)) == dt.date(2024, 12, 1)
    assert periods.default_report(dt.date(2025, 3, 1)) == dt.date(2025, 2, 1)


def test_double_text_has_no_exponent(spark):
    values = [0.0, 1 / 3600, 12345678.5, 2.0, 0.1, 1e15, 100.0, -2.5, 10 / 3]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    got = [r[0] for r in df.selectExpr(numbers.double_text("v")).collect()]
    plain = [f"{v:f}" if "e" in repr(v) else repr(v) for v in values]
    assert got == plain[:1] + ["0.0002777777777777778"] + plain[2:]
