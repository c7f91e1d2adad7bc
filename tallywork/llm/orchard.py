"""Centroid clustering with Orchard's search for the nearest centroid.

Each centroid has the list of all centroids sorted by their distance to it. A vector starts at some centroid and
walks that one's list; as soon as a centroid is nearer, its list is walked from the beginning. What has been met is
marked and not measured again. A list ends where its centroids lie strictly beyond twice the current distance: by
the triangle inequality they, and all that follow, are farther from the vector than the current centroid, so ties
are still met. All vectors of a batch take each step together.

Vectors and centroids are whole numbers, so distances and means are exact. A round sends one row for each task and
centroid; the driver holds centroids and sums only: as many rows as there are centroids, whatever the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.llm import shared

COMPONENTS, SCALE = 64, 256
CENTROIDS, ROUNDS, SEED = 40, 5, 2
BATCH = 4096
#: Squared distances of 64 components within it fit into 62 bits.
LARGEST = 1 << 27


class Orchard:
    """Centroids with their neighbour lists: for k of them k x k numbers, in each Python worker."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        k = len(centroids)
        apart = np.empty((k, k), np.int64)
        for i in range(k):
            step = centroids - centroids[i]
            apart[i] = np.einsum("ij,ij->i", step, step)
        # The number of a centroid decides between equal distances, here and below.
        self.neighbours = np.argsort(apart, axis=1, kind="stable")
        self.beyond = np.take_along_axis(apart, self.neighbours, axis=1)

    def measured(self, vectors: np.ndarray, to: np.ndarray) -> np.ndarray:
        step = vectors - self.centroids[to]
        return np.einsum("ij,ij->i", step, step)

    def nearest(self, vectors: np.ndarray, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of the nearest centroid (of equal ones the smaller number), and how many distances it took."""
        n, k = len(vectors), len(self.centroids)
        best = np.zeros(n, np.int64) if start is None else start.copy()
        distance = self.measured(vectors, best)
        visited = np.zeros((n, k), bool)
        visited[np.arange(n), best] = True
        place = np.zeros(n, np.int64)
        taken = n
        row = np.arange(n)
        while len(row):
            # Twice the distance is four times its square.
            row = row[place[row] < k]
            row = row[self.beyond[best[row], place[row]] <= 4 * distance[row]]
            other = self.neighbours[best[row], place[row]]
            place[row] += 1
            new = ~visited[row, other]
            at, other = row[new], other[new]
            visited[at, other] = True
            found = self.measured(vectors[at], other)
            taken += len(at)
            nearer = (found < distance[at]) | ((found == distance[at]) & (other < best[at]))
            at, other = at[nearer], other[nearer]
            best[at], distance[at], place[at] = other, found[nearer], 0
        return best, distance, taken


def _vectors(column: pa.Array, components: int) -> np.ndarray:
    if not isinstance(column, pa.ListArray | pa.LargeListArray):
        column = column.cast(pa.list_(pa.int64()))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, components)


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of the batches with their vectors, clusters and distances; a slice's first vector starts where the last one ended."""
    search, start = Orchard(centroids), 0
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            vectors = _vectors(part.column("q"), centroids.shape[1])
            cluster, distance, _ = search.nearest(vectors, np.full(len(vectors), start))
            start = int(cluster[-1])
            yield part, vectors, cluster, distance


def _summing(centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for _, vectors, cluster, _ in _assigned(batches, centroids):
            n += np.bincount(cluster, minlength=len(n))
            order = np.argsort(cluster, kind="stable")
            own, first = np.unique(cluster[order], return_index=True)
            total[own] += np.add.reduceat(vectors[order], first)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some]), pa.array(list(total[some]), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    return sums


def _assigning(centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, cluster, distance in _assigned(batches, centroids):
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return assign


def whole(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id and q: floor(scale * x) of those vectors that have just so many components, none NULL or not finite.

    A component beyond LARGEST stops the job: squared distances would not fit into a long.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = lambda c: F.floor(c.cast("double") * scale)
    problem = F.raise_error(F.lit(f"a component beyond {LARGEST} in units of 1/{scale}")).cast("bigint")
    held = lambda c: F.when(F.abs(c.cast("double") * scale) < LARGEST, scaled(c)).otherwise(problem)
    # The size is tested first: a NULL vector has none.
    kept = vectors.where(F.when(F.size(x) == components, finite).otherwise(False))
    return kept.select(F.col("vec_id").cast("bigint"), F.transform(x, held).alias("q"))


def _first(kept: DataFrame, centroids: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hashes; equal ones in the order of their components, those without a name last."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.select(name.alias("name"), "q").orderBy(F.asc_nulls_last("name"), "q").limit(centroids).collect()
    return np.array([row["q"] for row in rows], np.int64)


def clustered(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid (its components) of each vector kept.

    The first centroids are the vectors with the smallest hashes of their names. A round assigns all vectors and
    moves each centroid that has any to the floor of their mean. Vectors that `whole` leaves out have no row. With
    fewer vectors than centroids each of them is one; without any, or of an empty table, there are no rows. Equal
    distances go to the smaller number. Rows that repeat, and rows with one vec_id or none, each count. Other
    columns are ignored, whatever their names.
    """
    spark = vectors.sparkSession
    shared.with_code(spark)
    kept = shared.written(whole(vectors), "vectors")
    at = _first(kept, centroids, seed)
    if not len(at):
        nothing = kept.where("false")
        return nothing.select("vec_id", F.lit(0).alias("cluster"), *(F.lit(0).cast("bigint").alias(name) for name in ("distance", "cluster_inertia", "inertia")), F.col("q").alias("centroid"))
    for _ in range(rounds):
        parts = kept.mapInArrow(_summing(at), "cluster bigint, n bigint, sums array<bigint>")
        added = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(at.shape[1])]
        at = at.copy()
        for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *added).collect():
            at[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(at.shape[1])]
    found = shared.written(kept.mapInArrow(_assigning(at), "vec_id bigint, cluster int, distance bigint"), "clusters")
    sums = {row["cluster"]: row["inertia"] for row in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    whole_sum = sum(sums.values())
    rows = [(number, sums[number], whole_sum, at[number].tolist()) for number in sorted(sums)]
    # One row for each centroid, so its size is the parameter's.
    named = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return found.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def digest(centroid: str = "centroid") -> Column:
    """SHA-256 of a centroid's components as decimal numbers joined by commas."""
    return F.sha2(F.array_join(F.col(centroid).cast("array<string>"), ","), 256)
