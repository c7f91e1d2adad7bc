"""More sources than the driver plans for."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import functions as F

from tallywork.llm import pfair_mixing, registered


def test_many_sources_are_scheduled_in_groups(spark, monkeypatch):
    monkeypatch.setattr(pfair_mixing, "MOST_SOURCES", 8)
    # Documents of a source stand together; the first four sources are the largest.
    source = F.when(F.col("id") < 400, F.floor(F.col("id") / 100)).otherwise(4 + F.floor((F.col("id") - 400) / 10)).cast("string")
    documents = spark.range(1000).select(F.col("id").alias("doc_id"), source.alias("source"), F.lit("x" * 99).alias("text"))
    for parts in (None, {"0": 5, "7": 2}):
        rows = pfair_mixing.scheduled(documents, parts, block_chars=500, grouped=True).collect()
        assert len({row["doc_id"] for row in rows}) == len(rows) == 1000
        assert {row["source"] for row in rows if row["mix_source"] == row["source"]} == {"0", "1", "2", "3"}
        assert len({row["mix_source"] for row in rows}) <= 8
        members: dict[str, list] = defaultdict(list)
        for row in sorted(rows, key=lambda row: row["mix_place"]):
            assert row["release"] <= row["slot"] < row["deadline"]
            members[row["mix_source"]].append(row)
        for name, own in members.items():
            assert [row["mix_place"] for row in own] == [100 * i for i in range(len(own))]
            if name[0] == "\0":
                sources = {row["source"] for row in own}
                assert len({row["source"] for row in own[: len(own) // 2]}) >= 0.9 * len(sources)
    assert pfair_mixing.mixed(documents).count() == 1000


def test_phases_that_are_too_large_to_broadcast_are_joined(spark, monkeypatch):
    documents = spark.range(600).select(F.col("id").alias("doc_id"), (F.col("id") % 7).cast("string").alias("source"), F.lit("x" * 99).alias("text"))
    own = lambda: sorted(map(tuple, pfair_mixing.scheduled(documents, block_chars=500).collect()))
    plan = lambda: pfair_mixing.scheduled(documents, block_chars=500)._jdf.queryExecution().optimizedPlan().toString()
    expected = own()
    assert "strategy=broadcast" in plan()
    monkeypatch.setattr(pfair_mixing, "MOST_BROADCAST", 0)
    assert "strategy=broadcast" not in plan()
    assert own() == expected


def test_many_sources_are_scheduled_each_for_itself(spark, monkeypatch, tmp_path):
    """The registered query gives the same, however few sources were once scheduled singly."""
    source = F.concat(F.lit("s"), F.floor(F.sqrt("id")).cast("string"))
    spark.range(900).select(F.col("id").alias("doc_id"), source.alias("source"), F.lit("x" * 9999).alias("text")).write.parquet(f"{tmp_path}/documents.parquet")
    own = lambda: sorted(map(tuple, registered.op9_pfair_mixing(spark, str(tmp_path)).collect()))
    expected = own()
    monkeypatch.setattr(pfair_mixing, "MOST_SOURCES", 4)
    assert own() == expected


def test_the_plan_of_many_sources_has_a_row_for_each_block():
    blocks = {f"s{i:05d}": 1 + i % 3 for i in range(20_000)} | {"large": 5000}
    plan = pfair_mixing.phases(blocks, dict.fromkeys(blocks, 1) | {"large": 300})
    assert sum(line.until - line.used for line in plan) == sum(blocks.values()) and len(plan) <= sum(blocks.values())
