"""Alignment, deleted blocks, schedules, and the whole pipeline."""

from __future__ import annotations

import itertools
import random
from collections import defaultdict

import corpus_pipeline
import pytest
from odd_rows import SMALL, rows
from pyspark.sql import functions as F
from test_near_copies import slow_firsts

from tallywork.llm import patience_dedup, pfair_mixing, registered, shared


def test_patience_aligns_in_order():
    dice = random.Random(1)
    for _ in range(300):
        first = [dice.randrange(12) for _ in range(dice.randrange(15))]
        second = [dice.randrange(12) for _ in range(dice.randrange(15))]
        found = patience_dedup.patience(first, second)
        assert all(first[x] == second[y] for x, y in found)
        assert all(a < c and b < d for (a, b), (c, d) in itertools.pairwise(found))
        assert patience_dedup.patience(first, first) == [(i, i) for i in range(len(first))]
    assert patience_dedup.patience([1, 2, 3, 9, 4], [7, 2, 3, 8, 8, 4]) == [(1, 1), (2, 2), (4, 5)]
    assert patience_dedup.patience([5, 1, 2, 5], [2, 5, 1, 5]) == [(0, 1), (1, 2), (3, 3)]


LINE = [f"line number {i} has just these words and then {i}" for i in range(20)]


def cleaned(spark, texts: list[str | None]) -> list[str | None]:
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [row["text"] for row in patience_dedup.without_repeats(documents).orderBy("doc_id").collect()]


def test_blocks_go_from_the_later_document(spark):
    texts = [
        "\n".join(LINE[:4]),
        "\n".join(["own words are here in this line", *LINE[1:3], "and some more own words at last"]),
        "\n".join(LINE[:4]),
        "\n".join([LINE[1], "Of.", LINE[2]]),
        "Of.\nshort line\n" + LINE[10] + "\nOf.",
        "Of.\nshort line\n" + LINE[10] + "\nOf.",
        "five words are not enough",
        "five words are not enough",
        None,
        "",
    ]
    assert cleaned(spark, texts) == [
        texts[0],
        "own words are here in this line\nand some more own words at last",
        "",
        "Of.",
        texts[4],
        "",
        texts[6],
        texts[7],
        None,
        "",
    ]


def test_a_line_of_very_many_documents_goes_from_all_but_the_first(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    texts = [f"the document with number {i} begins like this\n{passage}\nand the document with number {i} ends like that" for i in range(300)]
    found = cleaned(spark, texts)
    assert found[0] == texts[0]
    assert found[1:] == [text.replace(passage + "\n", "") for text in texts[1:]]


def test_long_lines_of_documents_are_unique_afterwards(spark):
    found = registered.op8_patience_dedup(spark, SMALL)
    assert found.columns == ["doc_id", "text", "n_lines", "n_deleted"]
    given = dict(map(tuple, spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()))
    holders: dict[str, set[int]] = defaultdict(set)
    before: dict[str, set[int]] = defaultdict(set)
    for row in found.collect():
        kept, whole = row["text"].split("\n"), given[row["doc_id"]].split("\n")
        assert len(whole) == row["n_lines"] and (len(whole) - row["n_deleted"] == len(kept) or (row["text"] == "" and row["n_deleted"] == row["n_lines"]))
        for line in kept:
            holders[line.strip()].add(row["doc_id"])
        for line in whole:
            before[line.strip()].add(row["doc_id"])
    long = [line for line in before if len(line.split()) >= 50 and len(before[line]) > 1]
    assert long and all(min(before[line]) in holders[line] for line in long)
    assert sum(len(holders[line]) > 1 for line in long) <= 0.02 * len(long)
    assert all(ids <= holders[line] for line, ids in before.items() if len(ids) == 1 and len(line.split()) >= 8)


def test_odd_documents_lose_repeats(odd, empty):
    found = patience_dedup.without_repeats(odd)
    assert found.columns == [*odd.columns, "n_lines", "n_deleted"]
    assert found.count() == len(rows()) and patience_dedup.without_repeats(empty).count() == 0
    kept = {row["doc_id"]: row["text"] for row in found.where("doc_id IN (40, 41)").collect()}
    assert kept == {40: "", 41: ""} or kept[40] == ""


@pytest.mark.parametrize("parts", [{"a": 1}, {"a": 500, "b": 300, "c": 200}, {"a": 1, "b": 1, "c": 1}, {"a": 7, "b": 11, "c": 13, "d": 969}, {f"s{i}": 1 + i * i for i in range(12)}])
def test_a_period_deviates_by_less_than_a_block(parts):
    total, slots = sum(parts.values()), pfair_mixing.period(parts)
    assert sorted(slot for own in slots.values() for slot in own) == list(range(total))
    for name, own in slots.items():
        for k, slot in enumerate(own):
            assert k * total // parts[name] <= slot < -(-(k + 1) * total // parts[name])
        given = 0
        for t in range(total + 1):
            assert abs(given * total - parts[name] * t) < total
            given += t in set(own) if total < 50 else (given < len(own) and own[given] == t)


def slow_schedule(blocks: dict[str, int], parts: dict[str, int]) -> list[str]:
    """Slot by slot: the earliest deadline among released blocks; a phase ends with a source."""
    given, out = dict.fromkeys(blocks, 0), []
    while live := [name for name in sorted(blocks) if given[name] < blocks[name]]:
        total, start, t = sum(parts[name] for name in live), dict(given), 0
        while all(given[name] < blocks[name] for name in live):
            open_ = [(-(-(given[n] - start[n] + 1) * total // parts[n]), n) for n in live if (given[n] - start[n]) * total // parts[n] <= t]
            name = min(open_)[1]
            out.append(name)
            given[name] += 1
            t += 1
    return out


def test_phases_are_those_of_a_loop():
    dice = random.Random(2)
    for _ in range(30):
        names = [f"s{i}" for i in range(dice.randrange(1, 6))]
        blocks, parts = {n: dice.randrange(1, 80) for n in names}, {n: dice.randrange(1, 30) for n in names}
        got = {}
        for line in pfair_mixing.phases(blocks, parts):
            for block in range(line.used, line.until):
                whole, step = divmod(block - line.used, line.parts)
                got[line.base + whole * line.period + line.slots[step]] = (line.source, block)
        order = slow_schedule(blocks, parts)
        assert [got[slot][0] for slot in range(len(order))] == order and len(got) == len(order)


def test_documents_have_their_places(spark, monkeypatch):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source", "text")
    monkeypatch.setattr(shared.range_bounds, "__defaults__", (16,))
    found = pfair_mixing.scheduled(documents, block_chars=4000).orderBy("slot", "mix_place").collect()
    assert len(found) == documents.count()
    running: dict[str, int] = defaultdict(int)
    for row in sorted(found, key=lambda row: row["doc_id"]):
        assert row["mix_place"] == running[row["source"]] and row["block"] == row["mix_place"] // 4000
        assert row["release"] <= row["slot"] < row["deadline"]
        running[row["source"]] += len(row["text"]) + 1
    blocks = {name: (size - 1) // 4000 + 1 for name, size in running.items()}
    order = slow_schedule(blocks, pfair_mixing.target_parts(running))
    assert all(order[row["slot"]] == row["source"] for row in found)
    ordered = [row["doc_id"] for row in pfair_mixing.mixed(documents).collect()]
    assert ordered == [row["doc_id"] for row in pfair_mixing.scheduled(documents).orderBy("slot", "mix_place").collect()]


def test_odd_documents_are_mixed(odd, empty):
    found = pfair_mixing.scheduled(odd, {"s1": 3, "s2": 1}, block_chars=100)
    assert found.count() == len(rows()) and {row["mix_source"] for row in found.collect()} == {"", "s1", "s2"}
    assert pfair_mixing.mixed(odd).columns == odd.columns and pfair_mixing.mixed(odd).count() == len(rows())
    assert pfair_mixing.scheduled(empty).count() == 0


def test_too_many_sources_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(pfair_mixing, "MOST_SOURCES", 3)
    documents = spark.range(5).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("source"), F.lit("x").alias("text"))
    with pytest.raises(ValueError, match="sources"):
        pfair_mixing.scheduled(documents)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    given, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given = shared.written(stage(spark, given, SMALL), f"test-{name}")
        assert given.columns == docs.columns and given.dtypes == docs.dtypes
        seen[name] = {row["doc_id"]: row for row in given.collect()}
    texts = {row["doc_id"]: row["text"] for row in docs.collect()}
    assert set(seen["line_dedup"]) <= set(seen["language"]) <= set(texts)
    assert all(any(c.isalpha() for c in texts[name]) for name in seen["language"])
    assert len(seen["language"]) > 0.95 * len(texts)
    assert all(row["n_chars"] == len(row["text"]) for row in seen["line_dedup"].values())
    left = sorted(seen["line_dedup"])
    firsts = {left[i] for i in slow_firsts([seen["line_dedup"][name]["text"] for name in left])}
    assert set(seen["near_dedup"]) == firsts == set(seen["mixing"])
    found = corpus_pipeline.STAGES[-1][1](spark, given, SMALL)
    rows = found.collect()
    assert {row["doc_id"] for row in rows} == set(seen["mixing"])
    order = [row["doc_id"] for row in given.collect()]
    for length in {row["length"] for row in rows}:
        own = [order.index(row["doc_id"]) for row in sorted(rows, key=lambda row: row["sequence_id"]) if row["length"] == length]
        assert own == sorted(own)
    whole = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, whole.drop("sequence_id").collect())) == sorted(map(tuple, found.drop("sequence_id").collect()))


def test_stages_of_odd_and_of_no_documents(spark, odd, empty):
    for given in (odd, empty):
        docs = given
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = shared.written(stage(spark, docs, SMALL), "test-odd")
            assert docs.columns == given.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() >= docs.count()


def test_stages_carry_the_dealt_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "line_dedup", "near_dedup", "mixing", "packing"]
