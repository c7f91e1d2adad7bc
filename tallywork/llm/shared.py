"""What several operators need: tables in the shared folder, code on the executors, and ranges of an ordered key."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm import tokens
from tallywork.sources.shared_folder import new_folder, written

__all__ = ["folded", "new_folder", "range_bounds", "range_of", "sparing", "table", "unfolded", "with_code", "written"]

ROWS_PER_RANGE = 2048
MOST_RANGES = 16384

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folded(df: DataFrame, *apart: str) -> DataFrame:
    """The rows with all columns but some in one struct `row`, so that no name of theirs meets one added to them."""
    rest = [F.col(f"`{name}`") for name in df.columns if name not in apart] or [F.lit(0).alias("none")]
    return df.select(F.struct(*rest).alias("row"), *apart)


def unfolded(columns: list[str], *apart: str) -> list[Column]:
    """The columns as they were, from folded rows."""
    return [F.col(f"`{name}`") if name in apart else F.col("row")[name].alias(name) for name in columns]


def with_code(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once for each application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tallywork-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


def range_bounds(df: DataFrame, key: str, rows_per_range: int | None = None) -> list[int]:
    """Lower bounds that cut an integer key into ranges of about so many rows (ROWS_PER_RANGE), by approximate quantiles.

    At most MOST_RANGES numbers reach the driver, whatever the input; beyond that ranges grow.
    A key that is one value for many rows stays in one range. No rows or only NULL keys: no bounds.
    """
    rows = df.where(F.col(key).isNotNull()).count()
    ranges = min(MOST_RANGES, rows // (rows_per_range or ROWS_PER_RANGE) + 1)
    if ranges < 2:
        return []
    fractions = [i / ranges for i in range(1, ranges)]
    found = df.agg(F.percentile_approx(key, fractions, max(10_000, 10 * ranges)).alias("bounds")).first()["bounds"]
    return sorted(set(found))


def range_of(key: Column, bounds: list[int]) -> Column:
    """The number of the range that a key lies in: how many bounds are at or below it. NULL keys lie in range 0."""
    if not bounds:
        return F.lit(0)
    width = int(len(bounds) ** 0.5) + 1
    text = ",".join(map(str, bounds))
    every = F.split(F.lit(text), ",").cast("array<bigint>")
    coarse = F.split(F.lit(",".join(map(str, bounds[width - 1 :: width]))), ",").cast("array<bigint>") if len(bounds) >= width else F.array().cast("array<bigint>")
    below = F.size(F.filter(coarse, lambda bound: bound <= key))
    fine = F.slice(every, below * width + 1, F.lit(width))
    # Never NULL for the planner either: a join on it then adds no filter, and equal shuffles stay equal.
    return F.coalesce((below * width + F.size(F.filter(fine, lambda bound: bound <= key))).cast("int"), F.lit(0))


def sparing(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], encodes: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that gives freed memory back after each batch and, with that of arrays, at its end.

    Spark keeps Python workers from task to task and from stage to stage, and Arrow's pool what the largest batch took.
    A worker that comes to a task that encodes nothing drops the encoders of an earlier stage.
    """

    def given(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            del batch
            pa.default_memory_pool().release_unused()

    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not encodes:
            tokens.forget()
        yield from task(given(batches))
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # where the C library has it
            trim(0)

    return run
