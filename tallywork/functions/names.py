"""Pieces of paths, model file names and report lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The quantization in a model file name, and a line of a report file.
MODEL_SUFFIX = r"-Q[0-9_KM]+\.gguf$"
QUANTIZATION = r"(Q[0-9_KM]+)"
REPORT_LINE = r"^\\def\\(\w*)\{(.*)\}"
REPORT_FORMAT = r"\def\%s{%s}"


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent_name(path: Column) -> Column:
    """Name of the directory that holds the file; NULL for a bare name."""
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def model_name(path: Column) -> Column:
    return F.regexp_replace(base_name(path), MODEL_SUFFIX, "")


def quantization(path: Column) -> Column:
    return F.regexp_extract(base_name(path), QUANTIZATION, 1)


def report_line(key: Column, value: Column) -> Column:
    return F.format_string(REPORT_FORMAT, key, value)


def variant_label(threads: Column, suffix: str) -> Column:
    return F.concat(threads.cast("string"), F.lit(suffix))


def without_last_feed(text: Column) -> Column:
    """A file's text without the line feed that ends it."""
    return F.when(text.endswith("\n"), F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(text)
