"""Sketches against sets of paragraphs."""

from __future__ import annotations

import hashlib
import re

import pytest
from odd_rows import SMALL, rows
from pyspark.sql import functions as F

from tallywork.llm import bloom_sketch, registered, shared

PARAGRAPH = re.compile(r"[^ \t\n\x0b\f\r]+(?:[ \t\x0b\f\r]+[^ \t\n\x0b\f\r]+){0,31}")


def slow(documents: list[tuple]) -> list[tuple]:
    texts = sorted(((name, text or "") for name, text in documents), key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode()))
    out = []
    for i, (name, text) in enumerate(texts):
        following = texts[(i + 1) % len(texts)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, other, after = (set(PARAGRAPH.findall(x)) for x in (text, edited, following))
        like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        out.append((name, len(text), hashlib.sha256(edited.encode()).hexdigest(), like(own, other), like(own, after)))
    return sorted(out, key=repr)


def got(found) -> list[tuple]:
    return sorted((tuple(row) for row in found.select("doc_id", "n_chars", "edited_sha256", "near_edited", "near_next").collect()), key=repr)


def test_documents(spark):
    found = registered.op2_bloom_sketch(spark, SMALL)
    assert found.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert got(found) == slow([(row["doc_id"], row["text"]) for row in documents.select("doc_id", "text").collect()])
    by_text = found.join(documents, "doc_id").groupBy("text").agg(F.count_distinct("fingerprint").alias("n"))
    assert by_text.where("n <> 1").count() == 0


@pytest.mark.parametrize("fill", [1.0, 0.2])
def test_odd_documents_over_small_ranges_and_small_first_tables(odd, empty, fill, monkeypatch):
    monkeypatch.setattr(bloom_sketch, "FILL", fill)
    monkeypatch.setattr(bloom_sketch, "LEAST_CELLS", 2)
    monkeypatch.setattr(shared.range_bounds, "__defaults__", (4,))
    assert got(bloom_sketch.compared(odd)) == slow([row[:2] for row in rows()])
    assert bloom_sketch.compared(empty).count() == 0


def test_the_only_document_is_its_own_next(spark):
    one = spark.createDataFrame([(5, "a b c\nd e f\ng h")], "doc_id bigint, text string")
    assert got(bloom_sketch.compared(one)) == slow([(5, "a b c\nd e f\ng h")])


def test_recovered_digests_are_the_differing_ones(spark):
    rows = spark.createDataFrame([(0, 1, [1, 2, 3, 4], [3, 4, 5], [], False)], "range int, key bigint, own array<bigint>, edited array<bigint>, next array<bigint>, copy boolean")
    cells = bloom_sketch.peeled(bloom_sketch.subtracted(rows, 0), 0).collect()
    found = sorted((row["slot"] >> 42 & 1, row["digest"], row["n"]) for row in cells if row["digest"] is not None)
    assert found == [(0, 1, 1), (0, 2, 1), (0, 5, -1), (1, 1, 1), (1, 2, 1), (1, 3, 1), (1, 4, 1)]
    assert len(cells) == len(found)


def test_no_python_and_no_shuffle_of_cells(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = bloom_sketch.differences(bloom_sketch.versions(documents, [50, 100]), 0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    # One exchange of texts, and the small ones that find each range's first document.
    assert plan.count("Exchange hashpartitioning(range") <= 2
