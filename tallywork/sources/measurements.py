"""Repeated benchmark measurements, one CSV per configuration, and the prompts behind them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.functions import names
from tallywork.sources.files import directory_value, escaped, write_files

# The headers of the measurement files.
_CONFIGURATION = "COMPILER STRING, MODEL STRING, QUANTIZATION STRING, SEEDING STRING, PROMPT STRING"
_RESULTS = (
    "RUN INT, PROMPT_N INT, PREDICTED_N INT, CACHE_N INT, TTFT DOUBLE, TPOT DOUBLE, MEM BIGINT"
)
MEASUREMENT_SCHEMA = f"{_CONFIGURATION}, {_RESULTS}"
THREADING_SCHEMA = f"{_CONFIGURATION}, THREADS INT, NUMA STRING, {_RESULTS}"

CONFIGURATION = ("compiler", "model", "quantization", "seeding", "prompt")
FILE_KEYS = ("compiler", "model", "quantization")


def read_measurements(
    spark: SparkSession, path: str | list[str], schema: str = MEASUREMENT_SCHEMA
) -> DataFrame:
    """Every file of a directory or glob, checked against the header, names in lower case."""
    raw = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return raw.toDF(*[name.lower() for name in raw.columns])


def write_measurements(
    measurements: DataFrame, path: str, by: tuple[str, ...] = FILE_KEYS
) -> None:
    """CSV with a header, one directory per value of ``by``."""
    (
        measurements.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("header", True)
        .partitionBy(*by)
        .csv(path)
    )


def read_written_measurements(
    spark: SparkSession, path: str, schema: str = MEASUREMENT_SCHEMA, by: tuple[str, ...] = FILE_KEYS
) -> DataFrame:
    """What ``write_measurements`` wrote: ``by`` from the directories' names, the others checked against the header."""
    read = read_measurements(spark, path, schema)
    return read.select(*[name for name in read.columns if name not in by], *by)


def write_prompts(prompts: DataFrame, path: str) -> None:
    """One file per prompt, ``<type>/<id>``, that ends with a line feed."""
    file = F.concat_ws("/", directory_value(F.col("prompt_type")), directory_value(F.col("prompt_id")))
    write_files(prompts, path, file, F.col("text"))


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """One row per prompt file ``<type>/<id>``, with its whole text."""
    file = F.col("_metadata.file_path")
    return (
        spark.read.option("recursiveFileLookup", True)
        .text(path, wholetext=True)
        .select(
            names.parent_name(file).alias("prompt_type"),
            names.base_name(file).alias("prompt_id"),
            F.col("value").alias("text"),
        )
    )


def write_responses(responses: DataFrame, path: str) -> None:
    """Response texts as Parquet, one directory per model and prompt type."""
    (
        responses.select("model", "prompt_type", "prompt_id", "content")
        .hint("rebalance", "model", "prompt_type")
        .write.mode("overwrite")
        .partitionBy("model", "prompt_type")
        .parquet(path)
    )


def write_response_files(responses: DataFrame, path: str) -> None:
    """The same as plain text, one directory per model, prompt type and prompt id."""
    folders = [F.concat(F.lit(f"{key}="), escaped(F.col(key))) for key in ("model", "prompt_type", "prompt_id")]
    write_files(responses, path, F.concat_ws("/", *folders, F.lit("part-0.txt")), F.col("content"), overwrite=True)


def read_response_files(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_response_files`` wrote: the keys from the directories' names, the text without its last line feed."""
    read = spark.read.schema("value STRING, model STRING, prompt_type STRING, prompt_id STRING").text(path, wholetext=True)
    return read.select("model", "prompt_type", "prompt_id", names.without_last_feed(F.col("value")).alias("content"))
