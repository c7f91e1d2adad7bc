"""Golay keys, links and components against brute force."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from odd_rows import SMALL, rows

from tallywork.llm import golay_simhash, registered


def slow_fingerprint(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda found: found[0].lower(), text or ""))
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(len(words) - size + 1)]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def slow_components(fingerprints: list[int]) -> list[int]:
    values = np.array(fingerprints, np.uint64)
    root = list(range(len(values)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i, value in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values ^ value) <= 2):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_the_code_is_perfect():
    words = np.arange(1 << golay_simhash.MESSAGE, dtype=np.int64)
    low, high, error = golay_simhash._errors()
    assert len(set(error.tolist())) == 1 << 11 and np.bitwise_count(error).max() == 3
    shifted = words << 11
    code = shifted ^ (low[shifted & 0xFFF] ^ high[shifted >> 12])
    assert (golay_simhash.codeword(code) == words).all()
    dice = np.random.default_rng(1)
    for weight in (1, 2, 3):
        flips = np.zeros(len(code), np.int64)
        for i in range(len(code)):
            flips[i] = sum(1 << int(bit) for bit in dice.choice(23, weight, replace=False))
        assert (golay_simhash.codeword(code ^ flips) == words).all()
    assert np.bitwise_count(code[1:]).min() == 7


def test_a_segment_has_one_or_six_nearby_indices():
    found = golay_simhash.nearby(np.random.default_rng(2).integers(0, 1 << 23, 5000))
    assert set((found >= 0).sum(axis=1).tolist()) == {1, 6}


def test_all_pairs_within_two_bits_share_a_key():
    dice = np.random.default_rng(3)
    for value in dice.integers(0, 1 << 63, 5, dtype=np.uint64):
        flips = [np.uint64(0)] + [np.uint64(1 << i) for i in range(64)] + [np.uint64(1 << i | 1 << j) for i in range(64) for j in range(i)]
        near = value ^ np.array(flips, np.uint64)
        row, key = golay_simhash.keys(near)
        own = set(key[row == 0].tolist())
        assert set(row[np.isin(key, list(own))].tolist()) == set(range(len(near)))


@pytest.mark.parametrize("large", [2, 1024])
def test_links_of_crowded_keys(large, monkeypatch):
    monkeypatch.setattr(golay_simhash, "LARGE_GROUP", large)
    dice = np.random.default_rng(4)
    centre = dice.integers(0, 1 << 63, 6, dtype=np.uint64)
    flips = [sum(1 << int(bit) for bit in dice.choice(64, int(dice.integers(0, 5)), replace=False)) for _ in range(1500)]
    values = np.unique(centre[dice.integers(0, 6, 1500)] ^ np.array(flips, np.uint64))
    row, key = golay_simhash.keys(values)
    a, b = golay_simhash.links(key, values[row])
    names = sorted(values.view(np.int64).tolist())
    place = {name: i for i, name in enumerate(names)}
    root = golay_simhash._roots(len(names), np.array([place[x] for x in a.tolist()]), np.array([place[x] for x in b.tolist()]))
    assert root.tolist() == slow_components([int(np.int64(name).view(np.uint64)) for name in names])
    assert len(a) < len(names)


def test_documents(spark):
    found = {row["doc_id"]: row for row in registered.op4_golay_simhash(spark, SMALL).collect()}
    documents = sorted(map(tuple, spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()))
    prints = [slow_fingerprint(text) for _, text in documents]
    assert [int(found[name]["fingerprint"], 16) for name, _ in documents] == prints
    assert all(len(row["fingerprint"]) == 16 for row in found.values())
    assert [found[name]["component_id"] for name, _ in documents] == [documents[i][0] for i in slow_components(prints)]


def test_odd_documents(odd, empty):
    given = rows()
    found = golay_simhash.near_duplicates(odd).collect()
    prints = [slow_fingerprint(row[1]) for row in given]
    root = slow_components(prints)
    names = {}
    for i, row in enumerate(given):
        if row[0] is not None:
            names[root[i]] = min(names.get(root[i], row[0]), row[0])
    wanted = [(row[0], prints[i], names.get(root[i])) for i, row in enumerate(given)]
    assert sorted(((row["doc_id"], row["fingerprint"] & (1 << 64) - 1, row["component_id"]) for row in found), key=repr) == sorted(wanted, key=repr)
    kept = golay_simhash.representatives(odd)
    assert kept.columns == odd.columns
    assert sorted(map(slow_fingerprint, (row["text"] for row in kept.collect()))) == sorted({prints[i] for i in root})
    assert golay_simhash.near_duplicates(empty).count() == 0 and golay_simhash.representatives(empty).count() == 0


def test_a_long_chain_is_one_component(spark):
    nodes = [(i, i + 1) for i in range(0, 300)] + [(1000, 1001), (1001, 1002)]
    found = dict(map(tuple, golay_simhash.components(spark.createDataFrame(nodes, "a bigint, b bigint")).collect()))
    assert found == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000, 1002: 1000}
