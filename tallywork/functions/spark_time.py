"""Times as the monitoring interface of Spark writes them: ``2025-01-31T10:20:30.456GMT``."""

from __future__ import annotations


def moment(text: str) -> str:
    """SQL for the time. Its zone letters are dropped and it is taken as GMT, which it always is.

    A time without a zone would be put into the session's, where an hour a year is missing.
    """
    return f"to_timestamp(regexp_replace({text}, '[A-Z]+$', '') || 'Z')"


def span_seconds(start: str, end: str) -> str:
    """SQL for the seconds between two times, with fractions."""
    return f"(unix_micros({end}) - unix_micros({start})) / 1e6D"
