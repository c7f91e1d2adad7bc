"""Reporting periods. A period is a DATE, the first day of its month."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

# The month texts of the input file names, and the file name itself.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
JOB_FILE_PREFIX = "jobs_"
JOB_FILE_GLOB = "jobs_*.*"

# The tags of a report, month, quarter and year to date.
MONTH_TAG, TRIMESTER_TAG, YEAR_TAG = "", "Trimester", "Year"
TAGS = (MONTH_TAG, TRIMESTER_TAG, YEAR_TAG)

DATE_TEXT = "dd/MM/yyyy"

# First month that a report's tag covers. The quarter is the last three months up to the report's
# own, cut at January.
FIRST_PERIOD = {
    MONTH_TAG: "report",
    TRIMESTER_TAG: "greatest(trunc(report, 'year'), add_months(report, -2))",
    YEAR_TAG: "trunc(report, 'year')",
}

# Last report whose tag covers a month: the same the other way round.
LAST_REPORT = {
    MONTH_TAG: "period",
    TRIMESTER_TAG: "least(add_months(trunc(period, 'year'), 11), add_months(period, 2))",
    YEAR_TAG: "add_months(trunc(period, 'year'), 11)",
}


def month_text(file_name: str) -> str:
    """SQL: ``jobs_Mar.txt`` -> ``Mar``, up to the first dot; NULL for any other name.

    Evaluated for every row, so by position and not by a regular expression.
    """
    behind = f"substring({file_name}, {len(JOB_FILE_PREFIX) + 1})"
    named = f"startswith({file_name}, '{JOB_FILE_PREFIX}')"
    return f"CASE WHEN {named} THEN substring_index({behind}, '.', 1) END"


def month_number(month: str, aliases: Mapping[str, str] | None = None) -> str:
    """SQL for 1..12 of an English abbreviation, NULL for anything else."""
    if aliases:
        other = " ".join(f"WHEN '{alias}' THEN '{name}'" for alias, name in aliases.items())
        month = f"CASE {month} {other} ELSE {month} END"
    known = ", ".join(f"'{name}'" for name in MONTHS)
    return f"CAST(nullif(array_position(array({known}), {month}), 0) AS INT)"


def period_of_file(file_name: str, year: int | str, aliases: Mapping[str, str] | None = None) -> str:
    """SQL for the period that a job file belongs to; the year is a number or SQL for one."""
    return f"make_date({year if isinstance(year, str) else int(year)}, {month_number(month_text(file_name), aliases)}, 1)"


def year_of_folder(path: str) -> str:
    """SQL for the year in the name of the folder that holds a file, NULL where the name is no year."""
    folder = f"element_at(split({path}, '/'), -2)"
    return f"CASE WHEN {folder} RLIKE '^[0-9]{{4}}$' THEN CAST({folder} AS INT) END"


def tagged_months(first: dict[str, str], last: dict[str, str]) -> str:
    """SQL for an array of (tag, months) with all months between two expressions per tag."""
    rows = [
        f"struct('{tag}' AS tag, sequence({first[tag]}, {last[tag]}, INTERVAL 1 MONTH) AS months)"
        for tag in TAGS
    ]
    return f"array({', '.join(rows)})"


def date_range_text(first: str, last: str) -> str:
    return f"date_format({first}, '{DATE_TEXT}') || ' - ' || date_format({last}, '{DATE_TEXT}')"


def days_to_end(first: str, report: str = "report") -> str:
    """SQL for the days from ``first`` to the last day of the report's month, both counted."""
    return f"datediff(add_months({report}, 1), {first})"


def default_report(today: dt.date | None = None) -> dt.date:
    """The month before today's; in January that is last December."""
    today = today or dt.date.today()
    return (today.replace(day=1) - dt.timedelta(days=1)).replace(day=1)
