"""Near copies of the stage near_dedup against brute force."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline

from tallywork.llm import golay_simhash, near_copies


def shingled(text: str) -> set[tuple[str, ...]]:
    words = text.lower().split()
    size = min(5, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def slow_firsts(texts: list[str]) -> set[int]:
    sets, root = [shingled(text) for text in texts], list(range(len(texts)))

    def find(i: int) -> int:
        return i if root[i] == i else find(root[i])

    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {find(i) for i in range(len(texts))}


def planted() -> list[str]:
    dice = random.Random(9)
    out = []
    for _ in range(25):
        text = [f"w{dice.randrange(3000)}" for _ in range(dice.randrange(40, 300))]
        out.append(" ".join(text))
        for _ in range(8):
            near = list(dice.choice([text, out[-1].split()]))
            for _ in range(dice.randrange(1, 1 + len(near) // 30 + 1)):
                near[dice.randrange(len(near))] = f"x{dice.randrange(3000)}"
            out.append(" ".join(near))
    return out + ["", " \n", "short text", "Short  text", "another short"]


@pytest.mark.parametrize("light", [near_copies.LIGHT, 12 * near_copies.LEAST, 3 * near_copies.LEAST])
def test_near_copies_are_those_of_brute_force(spark, monkeypatch, light):
    """Also where almost all groups are heavy: dealt anew, in stars and in pairs of blocks."""
    monkeypatch.setattr(near_copies, "LIGHT", light)
    texts = planted()
    docs = spark.createDataFrame([(i, text, "en", "s", len(text)) for i, text in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    found = {row["doc_id"] for row in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    wanted = slow_firsts(texts)
    assert found == wanted
    assert len({row["component_id"] for row in golay_simhash.near_duplicates(docs).collect()}) > len(wanted)


def test_links_are_those_of_all_pairs():
    dice = np.random.Generator(np.random.PCG64(4))
    sets = [np.unique(dice.integers(0, 60, dice.integers(1, 40))) for _ in range(50)]
    sets += [np.append(sets[i], 1000 + i) for i in range(10)] + [np.arange(5000, 15_000), np.arange(5500, 15_200)]
    row, root = near_copies.links(sets)
    found = dict(zip(row.tolist(), root.tolist(), strict=True))
    label = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j in range(i):
                both = len(np.intersect1d(a, sets[j]))
                if both >= 0.8 * (len(a) + len(sets[j]) - both):
                    label[i] = label[j] = min(label[i], label[j])
    assert [found.get(i, i) for i in range(len(sets))] == label
    assert near_copies.links([np.arange(3), np.arange(10, 13)])[0].tolist() == []


@pytest.mark.parametrize("light", [near_copies.LIGHT, 4 * near_copies.LEAST])
def test_copies_of_copies_that_are_unlike_one_another_are_linked_by_what_they_are_like(spark, monkeypatch, light):
    """A base and many copies at 0.85 of it, which are below 0.8 among themselves; and a few strangers that share half."""
    monkeypatch.setattr(near_copies, "LIGHT", light)
    dice = random.Random(5)
    base = [f"w{i}" for i in range(300)]

    def changed(n: int) -> str:
        own = list(base)
        for at in dice.sample(range(0, 300, 10), n):
            own[at] = f"x{dice.randrange(10**9)}"
        return " ".join(own)

    texts = [changed(25) for _ in range(6)] + [changed(5) for _ in range(60)] + [" ".join(base)]
    docs = spark.createDataFrame([(i, text, "en", "s", len(text)) for i, text in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert {row["doc_id"] for row in corpus_pipeline.near_dedup(spark, docs, "").collect()} == slow_firsts(texts)


def test_many_near_copies_are_one_component(spark):
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join([*base[: i % 190], f"own{i}", *base[i % 190 + 1 :]]) for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {row["component_id"] for row in near_copies.near_copies(docs).collect()} == {0}


@pytest.mark.parametrize("common", [near_copies.MOST_COMMON, 20])
def test_rare_shingles_keep_every_pair_at_the_limit(spark, monkeypatch, common):
    monkeypatch.setattr(near_copies, "MOST_COMMON", common)
    dice = random.Random(3)
    sets = [sorted(dice.sample(range(400), dice.randrange(1, 60))) for _ in range(60)]
    for own in sets[:40]:
        common = dice.sample(own, -(-len(own) * 4 // 5))
        sets += [sorted(common), sorted({*own, *(1000 + dice.randrange(50) for _ in range(len(own) // 4))})]
    found: dict[int, set[int]] = {}
    for row in near_copies._rarest(spark.createDataFrame(list(enumerate(sets)), "node bigint, shingles array<bigint>")).collect():
        found.setdefault(row["node"], set()).add(row["key"])
    pairs = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if 5 * len({*a} & {*b}) >= 4 * len({*a} | {*b})]
    assert len(pairs) > 60
    assert all(found[i] & found[j] for i, j in pairs)
    assert all(len(keys) <= len(sets[i]) // 5 + 1 for i, keys in found.items())


def test_a_pair_that_shares_only_heavy_groups_is_found(spark, monkeypatch):
    """Four of five shingles in common: this pair had no finer band of ten rows in common."""
    monkeypatch.setattr(near_copies, "LIGHT", near_copies.LEAST)
    words = [f"w234x{i}" for i in range(9)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:8])), (3, "other")], "doc_id bigint, text string")
    assert {row["doc_id"]: row["component_id"] for row in near_copies.near_copies(docs).collect()} == {1: 1, 2: 1, 3: 3}


def test_fingerprints_within_two_bits_share_a_key():
    dice = random.Random(6)
    own = [dice.getrandbits(64) for _ in range(200)]
    own += [one ^ 1 << dice.randrange(64) ^ 1 << dice.randrange(64) for one in own]
    batch = pa.RecordBatch.from_arrays([pa.array(np.array(own, np.uint64).view(np.int64)), pa.array(range(400), pa.int64()), pa.array([9] * 400, pa.int64())], ["fingerprint", "node", "size"])
    keys: dict[int, set[int]] = {}
    for part in near_copies._golay_keys(iter([batch])):
        for key, node in zip(part.column("key").to_pylist(), part.column("node").to_pylist(), strict=True):
            keys.setdefault(node, set()).add(key)
    assert all(keys[i] & keys[i + 200] for i in range(200))


def test_a_text_is_proposed_by_its_golay_keys(spark, monkeypatch):
    """Without any band: texts of one fingerprint meet by its keys, and the sets decide."""
    groups = near_copies._groups
    monkeypatch.setattr(near_copies, "_groups", lambda keyed: groups(keyed.where("key between 0 and 4398046511104") if hasattr(near_copies, "_golay_keys") else keyed.limit(0)))
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(base), " ".join([*base, "more"]), " ".join(reversed(base)), ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert (golay_simhash.fingerprint(texts[0].encode()) ^ golay_simhash.fingerprint(texts[1].encode())).bit_count() <= 2
    assert {row["doc_id"]: row["component_id"] for row in near_copies.near_copies(docs).collect()} == {0: 0, 1: 0, 2: 2, 3: 3}
