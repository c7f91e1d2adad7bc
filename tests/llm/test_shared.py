"""Ranges of a key, the shared folder, and rows whose names are put apart."""

from __future__ import annotations

import random
import weakref
from bisect import bisect_right

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallywork.llm import shared, tokens


@pytest.mark.parametrize("count", [0, 1, 2, 3, 10, 99, 500])
def test_range_of_is_the_number_of_bounds_at_or_below(spark, count):
    dice = random.Random(count)
    bounds = sorted(dice.sample(range(-1000, 1000), count))
    values = [*range(-1001, 1002, 7), *bounds, -(1 << 62), 1 << 62]
    rows = spark.createDataFrame([(v,) for v in values] + [(None,)], "v bigint").select("v", shared.range_of(F.col("v"), bounds).alias("r")).collect()
    assert all(row["r"] == (0 if row["v"] is None else bisect_right(bounds, row["v"])) for row in rows)


def test_bounds_cut_into_even_ranges(spark):
    df = spark.range(10_000).select((F.col("id") * F.col("id")).alias("v"))
    bounds = shared.range_bounds(df, "v", 500)
    sizes = [row["count"] for row in df.groupBy(shared.range_of(F.col("v"), bounds)).count().collect()]
    assert len(sizes) == 21 and max(sizes) < 600
    assert shared.range_bounds(df.limit(0), "v") == [] and shared.range_bounds(df.select(F.lit(None).cast("bigint").alias("v")), "v") == []
    assert shared.range_bounds(spark.range(9000).select(F.lit(5).cast("bigint").alias("v")), "v", 500) == [5]


def test_folded_rows_come_back(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "row bigint, text string, `odd name` double")
    for apart in ((), ("text",), ("text", "odd name")):
        back = shared.folded(df, *apart).select(shared.unfolded(df.columns, *apart))
        assert back.columns == df.columns and back.collect() == df.collect()


def test_sparing_gives_memory_back_after_each_batch(monkeypatch):
    """The pool is asked to release what it doesn't use once for each batch, and at the end, when none is left."""
    seen, alive = [], []

    class Pool:
        def release_unused(self):
            seen.append(sum(ref() is not None for ref in alive))

    def batches():
        for i in range(3):
            batch = pa.RecordBatch.from_arrays([pa.array([i])], ["x"])
            alive.append(weakref.ref(batch))
            yield batch
            del batch

    def doubled(given):
        for batch in given:
            out = pa.RecordBatch.from_arrays([pa.array([2 * batch.column("x")[0].as_py()])], ["x"])
            del batch
            yield out

    monkeypatch.setattr(shared.pa, "default_memory_pool", Pool)
    assert [batch.column("x").to_pylist() for batch in shared.sparing(doubled)(batches())] == [[0], [2], [4]]
    assert len(seen) == 4 and seen[-1] == 0


def test_a_task_that_encodes_nothing_drops_the_encoders(monkeypatch):
    monkeypatch.setattr(tokens, "_encoders", {("file", True): None})
    assert list(shared.sparing(iter, encodes=True)(iter([]))) == []
    assert tokens._encoders
    assert list(shared.sparing(iter)(iter([]))) == []
    assert not tokens._encoders
