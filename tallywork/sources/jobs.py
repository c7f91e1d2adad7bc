"""Job-accounting extracts: one ``|``-separated file per month, named ``jobs_<Mon>.<ext>``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.functions import numbers, periods
from tallywork.sources.files import move_parts

# The columns of an extract, in file order. TotalCPU is a duration such as
# 1-00:01:00, so it stays text; so do the job id (7_1) and the exit code (0:0).
JOB_SCHEMA = T.StructType(
    [
        T.StructField("JobID", T.StringType(), False),
        T.StructField("JobIDRaw", T.IntegerType(), False),
        T.StructField("ElapsedRaw", T.IntegerType(), False),
        T.StructField("Account", T.StringType(), False),
        T.StructField("AllocCPUS", T.IntegerType(), False),
        T.StructField("CPUTimeRAW", T.LongType(), False),
        T.StructField("NNodes", T.IntegerType(), False),
        T.StructField("AllocNodes", T.StringType(), False),
        T.StructField("NCPUS", T.IntegerType(), False),
        T.StructField("Partition", T.StringType(), False),
        T.StructField("TotalCPU", T.StringType(), False),
        T.StructField("User", T.StringType(), False),
        T.StructField("ExitCode", T.StringType(), False),
        T.StructField("State", T.StringType(), False),
        T.StructField("Reservation", T.StringType(), True),
        T.StructField("ReservationId", T.StringType(), True),
        T.StructField("AllocTRES", T.StringType(), True),
    ]
)


def _required(field: T.StructField) -> Column:
    """The column itself; the task fails when it reads a row without the value."""
    problem = F.raise_error(F.lit(f"job record without {field.name}")).cast(field.dataType)
    return F.coalesce(F.col(field.name), problem).alias(field.name)


def read_jobs(
    spark: SparkSession,
    path: str | Sequence[str],
    year: int | None = None,
    aliases: Mapping[str, str] | None = None,
    checked: bool = True,
    skip_unknown: bool = False,
    schema: T.StructType = JOB_SCHEMA,
) -> DataFrame:
    """All months of a directory in one scan, with the period and the file name of each row.

    Without a year, it is that in the name of the folder that holds a file, so the folders of many years are
    one scan, too.

    The period comes from ``_metadata``, so a filter on it leaves the other months' files unread. A
    file whose name has no known month stops the job, unless ``aliases`` knows the month or
    ``skip_unknown`` leaves such files out. ``checked`` stops the job at a row that lacks a required
    value; only columns that the query uses are looked at.
    """
    raw = (
        spark.read.schema(schema)
        .option("sep", "|")
        .option("header", True)
        .option("pathGlobFilter", periods.JOB_FILE_GLOB)
        .option("recursiveFileLookup", year is None)
        .csv(path)
    )
    name = "_metadata.file_name"
    columns = [field.name if field.nullable else _required(field) for field in schema]
    of_year = year if year is not None else periods.year_of_folder("_metadata.file_path")
    period = periods.period_of_file(name, of_year, aliases)
    if skip_unknown:
        raw = raw.filter(F.expr(f"{period} IS NOT NULL"))
    else:
        problem = f"raise_error(concat('no known month in the name of the job file ', {name}))"
        period = f"coalesce({period}, CAST({problem} AS DATE))"
    return raw.select(
        *(columns if checked else ["*"]),
        F.expr(f"{period} AS period"),
        F.expr(f"{name} AS file_name"),
    )


def of_period(jobs: DataFrame, period: dt.date) -> DataFrame:
    return jobs.filter(F.col("period") == F.lit(period))


def write_jobs(jobs: DataFrame, path: str) -> None:
    """Write records with a period as extracts: ``<path>/<year>/jobs_<Mon>.<part>.txt``.

    The rebalance hint gives a month files of an even size, and more of them where it is a busy one. NULL and the empty text are
    written alike.
    """
    month = F.element_at(F.array(*map(F.lit, periods.MONTHS)), F.month("period"))
    columns = [F.col(field.name).cast(field.dataType) for field in JOB_SCHEMA]
    staged = f"{path}/_staged"
    (
        jobs.hint("rebalance", "period")
        .select(*columns, F.year("period").alias("year"), month.alias("mon"))
        .write.partitionBy("year", "mon")
        .option("sep", "|")
        .option("header", True)
        .option("emptyValue", "")
        .csv(staged)
    )
    named = lambda values, part: f"{values['year']}/{periods.JOB_FILE_PREFIX}{values['mon']}.{part}.txt"
    move_parts(jobs.sparkSession, staged, path, named)


def inferred_types(texts: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by, name, type): the narrowest type that takes all values of each column, for every file or whatever ``by`` says.

    One pass over all files, and one row for each file from a task, where inferring by reader takes two passes and two
    jobs a file. A column without a value has the type NULL.
    """
    widest = [F.max(numbers.type_rank(F.col(name))).alias(name) for name in columns]
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.col(name).alias("rank")) for name in columns]))
    ranks = texts.groupBy(*by).agg(*widest).select(*by, each.alias("column"))
    return ranks.select(*by, "column.name", numbers.type_of_rank(F.col("column.rank")).alias("type"))


def merged_types(types: DataFrame) -> DataFrame:
    """(name, type): numbers are widened until they take all files; what is a number in some files only is a text."""
    rank = numbers.rank_of_type(F.col("type"))
    return types.groupBy("name").agg(numbers.type_of_rank(F.max(rank)).alias("type"))


def read_texts(spark: SparkSession, path: str | Sequence[str], year: int | None = None) -> DataFrame:
    """The extracts with all columns as they are written."""
    texts = T.StructType([T.StructField(field.name, T.StringType()) for field in JOB_SCHEMA])
    return read_jobs(spark, path, year, checked=False, schema=texts)


def read_jobs_inferred(spark: SparkSession, path: str | Sequence[str], year: int | None = None) -> DataFrame:
    """The extracts with types found in the files themselves, merged over all months, as a check on ``JOB_SCHEMA``.

    The driver sees one type for each column. A column without any value is a text.
    """
    names = [field.name for field in JOB_SCHEMA]
    found = inferred_types(read_texts(spark, path, year), names, ["file_name"])
    types = {row["name"]: row["type"] for row in merged_types(found).collect()}
    known = {"INT": T.IntegerType(), "BIGINT": T.LongType(), "DOUBLE": T.DoubleType()}
    schema = T.StructType([T.StructField(field.name, known.get(types.get(field.name), T.StringType()), field.nullable) for field in JOB_SCHEMA])
    return read_jobs(spark, path, year, schema=schema)
