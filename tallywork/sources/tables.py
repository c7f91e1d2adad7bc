"""Stored usage tables, named views, and writers that several operators share."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.functions import names


def write_periods(table: DataFrame, path: str) -> None:
    """Write Parquet by period; a period that comes again replaces the stored one.

    The rebalance hint gives every period files of an even size and splits a period that is
    larger than the others, so one busy month does not end in one task.
    """
    (
        table.hint("rebalance", "period")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("period")
        .parquet(path)
    )


def write_period(table: DataFrame, path: str, period: dt.date) -> None:
    """Put the rows of one period in the place of the stored ones, also when there are none."""
    rows = table.drop("period").hint("rebalance")
    rows.write.mode("overwrite").parquet(f"{path}/period={period.isoformat()}")


def read_periods(spark: SparkSession, path: str) -> DataFrame:
    """The stored table; a filter on ``period`` prunes directories."""
    return spark.read.parquet(path).withColumn("period", F.col("period").cast("date"))


def write_report(params: DataFrame, path: str) -> None:
    r"""Write the ``\def\key{value}`` lines of one report as one text file.

    A report has 70 lines; it is moved into one task only after it has been computed. Rows of more
    than one report are an error: ``write_reports`` keeps them apart.
    """
    together = Window.partitionBy(F.lit(0))
    several = F.min("report").over(together) != F.max("report").over(together)
    problem = F.raise_error(F.lit("more than one report for one file")).cast("string")
    (
        params.select("position", "key", F.when(several, problem).otherwise(F.col("value")).alias("value"))
        .coalesce(1)
        .sortWithinPartitions("position", "key")
        .select(names.report_line(F.col("key"), F.col("value")).alias("value"))
        .write.mode("overwrite")
        .text(path)
    )


def write_reports(params: DataFrame, path: str) -> None:
    """Write many reports at once, one directory and file for each."""
    (
        params.repartition("report")
        .sortWithinPartitions("report", "position", "key")
        .select("report", names.report_line(F.col("key"), F.col("value")).alias("value"))
        .write.mode("overwrite")
        .partitionBy("report")
        .text(path)
    )


def read_report(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Key and value of every line of a written report; other lines are left out."""
    line = F.col("value")
    return (
        spark.read.text(path)
        .filter(line.rlike(names.REPORT_LINE))
        .select(
            F.regexp_extract(line, names.REPORT_LINE, 1).alias("key"),
            F.regexp_extract(line, names.REPORT_LINE, 2).alias("value"),
        )
    )


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_reports`` wrote: report (from the directory's name), key and value of every line."""
    line = F.col("value")
    return (
        spark.read.schema("value STRING, report DATE")
        .text(path)
        .filter(line.rlike(names.REPORT_LINE))
        .select(
            "report",
            F.regexp_extract(line, names.REPORT_LINE, 1).alias("key"),
            F.regexp_extract(line, names.REPORT_LINE, 2).alias("value"),
        )
    )


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_json(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").json(path)


def register_views(views: Mapping[str, DataFrame]) -> None:
    for name, table in views.items():
        table.createOrReplaceTempView(name)


def drop_views(spark: SparkSession, views: Iterable[str]) -> None:
    """Forget the named views and what was cached under their names."""
    for name in views:
        if spark.catalog.tableExists(name) and spark.catalog.isCached(name):
            spark.catalog.uncacheTable(name)
        spark.catalog.dropTempView(name)
