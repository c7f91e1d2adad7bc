"""Orchard's search against all distances, and the rounds against a loop over all vectors."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from tallywork.llm import orchard, registered

DICE = np.random.Generator(np.random.PCG64(13))
SCHEMA = "vec_id bigint, embedding array<float>, q int, cluster string, distance string, n int, name string"


def all_distances(vectors, centroids):
    every = ((vectors[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    best = every.argmin(axis=1)
    return best, every[np.arange(len(vectors)), best]


@pytest.mark.parametrize(("k", "spread"), [(1, 50), (2, 1), (7, 2), (40, 300), (200, 3)])
def test_search_is_exact_and_ties_go_to_the_smaller_number(k, spread):
    vectors = DICE.integers(-spread, spread + 1, (3000, 4))
    centroids = DICE.integers(-spread, spread + 1, (k, 4))
    search = orchard.Orchard(centroids)
    best, distance = all_distances(vectors, centroids)
    for start in (None, DICE.integers(0, k, len(vectors))):
        found, own, taken = search.nearest(vectors, start)
        assert np.array_equal(found, best) and np.array_equal(own, distance)
        assert len(vectors) <= taken <= k * len(vectors)


def test_search_leaves_most_centroids_out_where_clusters_lie_apart():
    centroids = DICE.integers(-10_000, 10_000, (100, 8))
    vectors = centroids[DICE.integers(0, 100, 5000)] + DICE.integers(-20, 21, (5000, 8))
    *_, taken = orchard.Orchard(centroids).nearest(vectors)
    assert taken < 40 * len(vectors)


def plain(rows, k=orchard.CENTROIDS, rounds=orchard.ROUNDS):
    """The whole contract as a loop."""
    kept = [(name, [math.floor(256 * float(np.float32(x))) for x in vector]) for name, vector in rows if vector is not None and len(vector) == 64 and all(x is not None and math.isfinite(x) for x in vector)]
    key = lambda row: (row[0] is None, hashlib.sha256(f"2:{row[0]}".encode()).hexdigest() if row[0] is not None else "", row[1])
    centroids = [q for _, q in sorted(kept, key=key)[:k]]
    nearest = lambda q: min(((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), i) for i, c in enumerate(centroids)))
    for _ in range(rounds):
        groups = {}
        for _, q in kept:
            groups.setdefault(nearest(q)[1], []).append(q)
        for i, own in groups.items():
            centroids[i] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    found = [(name, *nearest(q)[::-1]) for name, q in kept]
    inertia = {}
    for _, i, d in found:
        inertia[i] = inertia.get(i, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((name, i, d, inertia[i], sum(inertia.values()), digest[i]) for name, i, d in found), key=repr)


def result(spark, path, rows):
    spark.createDataFrame([(name, vector, 1, "x", "y", 2, "z") for name, vector in rows], SCHEMA).repartition(3).write.parquet(f"{path}/embeddings.parquet")
    return sorted(map(tuple, registered.op13_orchard(spark, str(path)).collect()), key=repr)


def drawn(n, spread=1.0):
    return [[float(x) for x in np.float32(DICE.normal(0, spread, 64))] for _ in range(n)]


def test_query_is_the_loop_on_odd_rows(spark, tmp_path):
    vectors = drawn(120)
    rows = list(enumerate(vectors))
    rows += [(3, vectors[3]), (3, vectors[4]), (500, vectors[5]), (501, vectors[5]), (None, vectors[6]), (None, vectors[7])]
    rows += [(600, None), (601, []), (602, vectors[0][:63]), (603, vectors[0] + [0.0]), (604, [None, *vectors[0][1:]])]
    rows += [(605, [float("nan"), *vectors[0][1:]]), (606, [float("inf"), *vectors[0][1:]]), (607, [float("-inf"), *vectors[0][1:]]), (608, [0.0] * 64)]
    assert result(spark, tmp_path, rows) == plain(rows)


def test_query_is_the_loop_on_copies_and_few_vectors(spark, tmp_path):
    one, two = drawn(2)
    rows = [(i, one if i % 3 else two) for i in range(60)]
    assert result(spark, tmp_path / "copies", rows) == plain(rows)
    rows = list(enumerate(drawn(5)))
    assert result(spark, tmp_path / "few", rows) == plain(rows)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, [1.0])]])
def test_no_vector_no_row(spark, tmp_path, rows):
    assert result(spark, tmp_path, rows) == []


def test_components_that_do_not_fit_stop_the_job(spark):
    rows = spark.createDataFrame([(1, [1e30] * 64)], "vec_id bigint, embedding array<float>")
    with pytest.raises(Exception, match="a component beyond"):
        orchard.clustered(rows)


def test_other_numbers_of_centroids_and_rounds(spark):
    rows = list(enumerate(drawn(50)))
    found = orchard.clustered(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), centroids=3, rounds=2)
    got = sorted((row["vec_id"], row["cluster"], row["distance"], row["cluster_inertia"], row["inertia"]) for row in found.collect())
    assert got == sorted(row[:5] for row in plain(rows, 3, 2))
