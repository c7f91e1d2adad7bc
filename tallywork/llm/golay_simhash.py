"""Near duplicates by SimHash, with keys from the binary Golay code.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits. Two errors leave, in cyclic order, a segment
i without any whose successor has one at most: if two fall into one segment, the other two are clean and one
is followed by the other; if they fall into two, the third is clean and followed by a segment with one. So a
key is the exact bits of segment i with a codeword index of segment i + 1. The [23, 12] Golay code is perfect:
each 23-bit word lies within three errors of just one codeword. The codewords that a segment and all its
one-bit neighbours decode to (one or six) are its nearby indices, and segments that differ in one bit share
the index of either one. Fingerprints that share a key meet, are compared, and link within two bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm import shared, tokens

WORDS = 3
SEED = 42
MOST_BITS = 2
SEGMENTS = ((0, 22), (22, 21), (43, 21))
LARGE_GROUP = 1024

# Fixed values of the Golay code: its length, message bits and generator polynomial.
LENGTH, MESSAGE, GENERATOR = 23, 12, 0b110001110101

_LOWER = bytes(code + 32 if 65 <= code <= 90 else code for code in range(256))


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """SimHash of a text's word shingles; bit by bit the strict majority of their hashes. No word: 0."""
    found = text.translate(_LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    size = min(words, len(found))
    counts, n = np.zeros(64, np.int64), len(found) - size + 1
    for at in range(0, n, 1 << 16):
        spans = zip(starts[at : min(n, at + (1 << 16))].tolist(), ends[at + size - 1 :].tolist(), strict=False)
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")
        counts += np.add.reduce(np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = tokens.column(batch, "text")
        found = np.fromiter((fingerprint(text.as_buffer().to_pybytes()) for text in texts), np.uint64, len(texts))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("own"), pa.array(found.view(np.int64))], ["doc_id", "own", "fingerprint"])


@cache
def _errors() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low and of the high bits of a word, and the error of up to three bits for each syndrome."""

    def remainder(word: int) -> int:
        for bit in range(LENGTH - 1, LENGTH - MESSAGE - 1, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - (LENGTH - MESSAGE))
        return word

    low = np.array([remainder(word) for word in range(1 << 12)], np.int64)
    high = np.array([remainder(word << 12) for word in range(1 << (LENGTH - 12))], np.int64)
    error = np.zeros(1 << (LENGTH - MESSAGE), np.int64)
    for weight in range(4):
        for bits in combinations(range(LENGTH), weight):
            word = sum(1 << bit for bit in bits)
            error[remainder(word)] = word
    return low, high, error


def codeword(words: np.ndarray) -> np.ndarray:
    """Index of the codeword nearest to each 23-bit word: its 12 message bits."""
    low, high, error = _errors()
    return (words ^ error[low[words & 0xFFF] ^ high[words >> 12]]) >> (LENGTH - MESSAGE)


def nearby(words: np.ndarray) -> np.ndarray:
    """For each word the codeword indices of the word and of its one-bit neighbours; -1 where one repeats."""
    flips = np.concatenate([[0], 1 << np.arange(LENGTH)])
    found = np.sort(codeword(words[:, None] ^ flips[None, :]), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found


def keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of unsigned fingerprints: the number of the fingerprint, and the key."""
    parts = [(fingerprints >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    rows, found = [], []
    for i, exact in enumerate(parts):
        near = nearby(parts[(i + 1) % len(parts)])
        row, at = np.nonzero(near >= 0)
        rows.append(row)
        found.append(i << 40 | exact[row] << MESSAGE | near[row, at])
    return np.concatenate(rows), np.concatenate(found)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = batch.column("fingerprint").to_numpy()
        for at in range(0, len(own), 2000):
            row, key = keys(own[at : at + 2000].view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(own[at : at + 2000][row])], ["key", "fingerprint"])


def _close(group: np.ndarray, fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of one group (equal numbers stand together) within the allowed bits, all of a group compared."""
    first, second = [], []
    at, step = np.arange(len(group) - 1), 0
    while len(at):
        step += 1
        at = at[at + step < len(group)]
        at = at[group[at] == group[at + step]]
        close = np.bitwise_count(fingerprints[at] ^ fingerprints[at + step]) <= MOST_BITS
        first.append(at[close])
        second.append(at[close] + step)
    return (np.concatenate(first), np.concatenate(second)) if first else (at, at)


def links(key: np.ndarray, fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among distinct fingerprints that share a key, as each one's smallest connected one in this batch.

    A large group is cut again: its exact segment is equal, so of three parts of the other bits one is equal.
    """
    order = np.lexsort((fingerprints, key))
    key, fingerprints = key[order], fingerprints[order]
    _, number, size = np.unique(key, return_inverse=True, return_counts=True)
    large = size[number] > LARGE_GROUP
    small = np.flatnonzero(~large)
    first, second = _close(number[small], fingerprints[small])
    first, second = [small[first]], [small[second]]
    rows = np.flatnonzero(large)
    if len(rows):
        segment = key[rows] >> 40
        rest = np.zeros(len(rows), np.uint64)
        for i, (at, width) in enumerate(SEGMENTS):
            own = segment == i
            low = fingerprints[rows][own] & np.uint64((1 << at) - 1)
            high = fingerprints[rows][own] >> np.uint64(at + width)
            rest[own] = low | high << np.uint64(at)
        for part in (0, 14, 28):
            order = np.lexsort((rest >> np.uint64(part) & np.uint64(0x7FFF if part == 28 else 0x3FFF), number[rows]))
            bits = rest[order] >> np.uint64(part) & np.uint64(0x7FFF if part == 28 else 0x3FFF)
            _, group = np.unique(number[rows][order].astype(np.uint64) << np.uint64(15) | bits, return_inverse=True)
            a, b = _close(group, fingerprints[rows][order])
            first.append(rows[order][a])
            second.append(rows[order][b])
    a, b = np.concatenate(first), np.concatenate(second)
    names, place = np.unique(fingerprints.view(np.int64), return_inverse=True)
    root = _roots(len(names), place[a], place[b])
    linked = np.flatnonzero(root != np.arange(len(names)))
    return names[linked], names[root[linked]]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number that each of n numbers is connected to."""
    root = np.arange(n)
    while len(a):
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if np.array_equal(before, root):
            break
    while not np.array_equal(root, root[root]):
        root = root[root]
    return root


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches come sorted by key; the last key's rows wait for the next batch."""
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    held, last = 0, None

    def found() -> pa.RecordBatch:
        key, own = (np.concatenate(x) for x in zip(*waiting, strict=True))
        a, b = links(key, own.view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    for batch in batches:
        key, own = batch.column("key").to_numpy(), batch.column("fingerprint").to_numpy()
        if not len(key):
            continue
        cut = int(np.searchsorted(key, key[-1])) if key[0] != key[-1] or key[0] != last else 0
        waiting.append((key[:cut], own[:cut]))
        held += cut
        if held >= 100_000 and key[0] != key[-1]:
            yield found()
            waiting, held = [], 0
        waiting.append((key[cut:], own[cut:]))
        held += len(key) - cut
        last = key[-1]
    if waiting:
        yield found()


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that each node of the edges (a, b) is connected to.

    Each round takes the smallest label among the neighbours and then the label's label. A round's labels are a
    table in the shared folder, so lineage does not grow; one number a round reaches the driver.
    """
    both = shared.written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = shared.written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), "labels")
    while True:
        offered = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("offer"))
        hooked = labels.join(offered, "node").select("node", F.least("root", "offer").alias("root"), F.col("root").alias("old"))
        jumped = hooked.join(labels.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left")
        found = shared.written(jumped.select("node", F.least("root", F.coalesce("next", "root")).alias("root"), "old"), "labels")
        changed = found.where("root <> old").limit(1).count()
        labels = found.select("node", "root")
        if not changed:
            return labels


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, fingerprint (bigint, the unsigned number's bits), component_id, the smallest doc_id reachable, own and first_own.

    A NULL or empty text or one of white space has fingerprint 0 and is linked like any other. Equal
    fingerprints are one node however many documents share them, so a group of copies is no larger than one.
    Rows that repeat are rows of the same component. A NULL doc_id never names a component unless all of its
    doc_ids are NULL. own is a hash of the text, first_own that of the component's first document. No documents:
    no rows. Other columns are ignored, whatever their names.
    """
    shared.with_code(documents.sparkSession)
    texts = documents.select("doc_id", F.xxhash64("text").alias("own"), "text")
    own = shared.written(texts.mapInArrow(_fingerprints, "doc_id bigint, own bigint, fingerprint bigint"), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "own")
    nodes = own.groupBy("fingerprint").agg(F.min(first).alias("first"))
    keyed = nodes.select("fingerprint").mapInArrow(_keyed, "key bigint, fingerprint bigint")
    edges = keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_linked, "a bigint, b bigint")
    roots = components(edges)
    rooted = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("first").alias("smallest")), "root")
    names = named.select("fingerprint", F.col("smallest.doc_id").alias("component_id"), F.col("smallest.own").alias("first_own"))
    return own.join(names, "fingerprint").select("doc_id", "fingerprint", "component_id", "own", "first_own")


def representatives(documents: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """One document of each component, the one that names it, with all of its columns. NULLs and repeats: as in near_duplicates.

    `found` are the components, near_duplicates of the documents unless given.
    """
    found = near_duplicates(documents) if found is None else found
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("own") == F.col("first_own")))
    names = shared.written(kept.select(F.col("doc_id").alias("kept_doc_id"), F.col("own").alias("kept_own")).distinct(), "kept")
    rows = shared.folded(documents, "text").select("*", F.col("row.doc_id").alias("own_doc_id"), F.xxhash64("text").alias("own"))
    met = rows.join(names, F.col("own_doc_id").eqNullSafe(F.col("kept_doc_id")) & (F.col("own") == F.col("kept_own")), "left_semi")
    return met.dropDuplicates(["own_doc_id", "own"]).select(shared.unfolded(documents.columns, "text"))
