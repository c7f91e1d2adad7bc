"""Near copies: texts whose sets of word shingles have a Jaccard similarity of SIMILAR or more.

The Golay keys of op4's SimHash and MinHash bands propose pairs, the sets themselves decide. All pairs whose fingerprints
differ in two bits or fewer share a key. A pair at the limit shares a band with probability 1 - (1 - 0.8^5)^24 = 0.9999, a closer
one with more. Equal sets are one node however many texts have them.

The sets of a light group meet in one task, which compares them all and sends on a spanning forest of its links. What
lies in a heavy group is dealt anew by each set's rarest shingles, so many that no pair that is similar enough lacks a common
one; most of what is less alike has none. Of a group that is heavy even then, light blocks are compared, each with
the same one of its nodes; only where that leaves it in several components do the others meet, in pairs of blocks. So no
link between sets that share a key or a band is lost, no task holds more than a light group, and a group costs more than
its size only as far as it stays unconnected.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.llm import golay_simhash, shared, tokens

WORDS = 5
SIMILAR = 0.8
BANDS, ROWS = 24, 5
SEED = 42
CHUNK = 4096
#: A group is light up to so many shingles; each of its sets counts as LEAST at least, so it has 256 sets at most.
LIGHT, LEAST = 1 << 21, 1 << 13
#: Shingles of heavy groups' members that are counted one by one.
MOST_COMMON = 1 << 14

_LOWER = bytes(code + 32 if 65 <= code <= 90 else code for code in range(256))
_dice = np.random.Generator(np.random.PCG64(SEED))
_MOST = BANDS * ROWS
_XOR = _dice.integers(0, 1 << 64, _MOST, np.uint64)
_TIMES = _dice.integers(0, 1 << 64, _MOST, np.uint64) | np.uint64(1)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted different hashes of a text's word shingles; of fewer words all are one shingle, of none there is none."""
    found = text.translate(_LOWER).split()
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    size = min(words, len(found))
    spans = zip(starts.tolist(), ends[size - 1 :].tolist(), strict=False)
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), np.uint64))


def node(own: np.ndarray) -> int:
    """A number for a set of shingles, the same for equal sets."""
    return int(np.frombuffer(xxhash.xxh64_digest(own.astype("<u8").tobytes(), SEED), "<i8")[0])


def bands(own: np.ndarray) -> list[int]:
    """A key for each band of the MinHash signature of a set; none for an empty one."""
    if not len(own):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), CHUNK):
        least = np.minimum(least, ((own[None, at : at + CHUNK] ^ _XOR[:, None]) * _TIMES[:, None]).min(axis=1))
    return [int(np.int64(np.uint64(xxhash.xxh64_intdigest(part.astype("<u8").tobytes(), band)).view(np.int64))) for band, part in enumerate(least.reshape(BANDS, ROWS))]


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last in tokens.slices(texts := tokens.column(batch, "text")):
            raw = [text.as_buffer().to_pybytes() for text in texts.slice(first, last - first)]
            sets = list(map(shingles, raw))
            part = batch.slice(first, last - first)
            fingerprints = np.fromiter(map(golay_simhash.fingerprint, raw), np.uint64, len(raw)).view(np.int64)
            columns = [part.column("doc_id"), part.column("own"), pa.array(map(node, sets), pa.int64()), pa.array(map(len, sets), pa.int64()), pa.array(map(bands, sets), pa.list_(pa.int64())), pa.array(fingerprints)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "own", "node", "size", "bands", "fingerprint"])


def _golay_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            row, key = golay_simhash.keys(part.column("fingerprint").to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key), part.column("node").take(pa.array(row)), part.column("size").take(pa.array(row))], ["key", "node", "size"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, text in zip(batch.column("node"), tokens.column(batch, "text"), strict=True):
            own = shingles(text.as_buffer().to_pybytes()).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([name.as_py()], pa.int64()), pa.array([own], pa.list_(pa.int64()))], ["node", "shingles"])


def links(sets: list[np.ndarray], similar: float = SIMILAR) -> tuple[np.ndarray, np.ndarray]:
    """Each linked set's number and the smallest one that it is connected to, by the exact similarity of all pairs of a light group."""
    n, sizes = len(sets), np.array([len(own) for own in sets])
    _, which, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)
    several = held[which] > 1
    number = np.cumsum(held > 1) - 1
    owner, column = owner[several], number[which[several]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((n, n), np.int64)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, CHUNK):
        low, high = np.searchsorted(column, [at, at + CHUNK])
        part = np.zeros((n, CHUNK), np.float32)
        part[owner[low:high], column[low:high] - at] = 1
        common += (part @ part.T).astype(np.int64)
    every = sizes[:, None] + sizes[None, :] - common
    a, b = np.nonzero(np.triu(common >= similar * every, 1))
    root = golay_simhash._roots(n, a, b)
    linked = np.flatnonzero(root != np.arange(n))
    return linked, root[linked]


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches come sorted by key; a group's sets wait until its last row has come."""
    key, group = None, {}

    def found() -> pa.RecordBatch:
        names = sorted(group)
        row, root = links([group[name] for name in names]) if len(names) > 1 else ([], [])
        return pa.RecordBatch.from_arrays([pa.array([names[i] for i in row], pa.int64()), pa.array([names[i] for i in root], pa.int64())], ["a", "b"])

    for batch in batches:
        sets = batch.column("shingles")
        for at, (own, name) in enumerate(zip(batch.column("key").to_pylist(), batch.column("node").to_pylist(), strict=True)):
            if own != key:
                yield found()
                key, group = own, {}
            group[name] = sets[at].values.to_numpy()
    yield found()


def _weight() -> Column:
    return F.greatest("size", F.lit(LEAST))


def _groups(keyed: DataFrame) -> DataFrame:
    """key, node, size and weight (of the group) where a key has several nodes. Of groups with the same nodes one stays."""
    keyed = shared.written(keyed, "band-keys")
    members = [F.bit_xor(F.xxhash64("node", F.lit(salt))).alias(f"members_{salt}") for salt in (0, 1)]
    groups = keyed.groupBy("key").agg(F.count("*").alias("n"), F.sum(_weight()).alias("weight"), *members).where("n > 1")
    kept = groups.groupBy("n", "weight", "members_0", "members_1").agg(F.min("key").alias("key")).select("key", "weight")
    return shared.written(keyed.join(kept, "key").select("key", "node", "size", "weight"), "band-groups")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, held = np.unique(batch.column("shingles").flatten().to_numpy(), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(held, pa.int64())], ["key", "held"])


def _first(common: np.ndarray, held: np.ndarray, complete: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The first shingles of each set, by what holds them: those that aren't common, then the common ones (sorted, with their counts) by count."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, own in zip(batch.column("node"), batch.column("shingles"), strict=True):
                keys = own.values.to_numpy()
                at = np.minimum(np.searchsorted(common, keys), max(0, len(common) - 1))
                count = np.where(common[at] == keys, held[at], 0) if len(common) else np.zeros(len(keys), np.int64)
                # A millionth less than the limit: one place too many does no harm.
                order = np.lexsort((keys, count))[: len(keys) - math.ceil(len(keys) * SIMILAR - 1e-6) + 1]
                if complete:
                    order = order[count[order] > 0]
                yield pa.RecordBatch.from_arrays([pa.array(keys[order]), pa.array([name.as_py()] * len(order), pa.int64()), pa.array([len(keys)] * len(order), pa.int64())], ["key", "node", "size"])

    return first


def _rarest(sets: DataFrame) -> DataFrame:
    """key, node, size: each set's rarest shingles, without those that it alone has.

    Sets of which one has at least SIMILAR of the other's shingles in common with it share one of the first
    size - SIMILAR * size + 1 in any order that is the same for all. Here the MOST_COMMON shingles that most sets have come last, by their
    number, and the others go by their hash; so the table that reaches the driver and the tasks is bounded, and no pair is lost by that.
    """
    counts = sets.select("shingles").mapInArrow(shared.sparing(_counted), "key bigint, held bigint").groupBy("key").agg(F.sum("held").alias("held")).where("held > 1")
    found = counts.orderBy(F.desc("held"), "key").limit(MOST_COMMON).toArrow()
    common, held = found.column("key").to_numpy(), found.column("held").to_numpy()
    order = np.argsort(common)
    return sets.select("node", "shingles").mapInArrow(shared.sparing(_first(common[order], held[order], len(common) < MOST_COMMON)), "key bigint, node bigint, size bigint")


def _block(weight: Column) -> Column:
    """The block of a node, of as many as a weight needs."""
    return F.pmod(F.xxhash64("node"), F.ceil(weight / LIGHT))


def _stars(heavy: DataFrame) -> DataFrame:
    """key, node: heavy groups in light blocks, each with the group's node that is in most heavy groups."""
    often = heavy.groupBy("node").agg(F.count("*").alias("often"))
    hubs = heavy.join(often, "node").groupBy("key").agg(F.max_by("node", F.struct("often", "node")).alias("hub"))
    blocks = heavy.select(F.xxhash64("key", _block(F.col("weight"))).alias("part"), "key", "node")
    hub_rows = blocks.select("part", "key").distinct().join(hubs, "key").select(F.col("part").alias("key"), F.col("hub").alias("node"))
    return blocks.select(F.col("part").alias("key"), "node").union(hub_rows)


def _crossed(heavy: DataFrame, roots: DataFrame) -> DataFrame:
    """key, node: what is left of heavy groups, in pairs of blocks.

    All nodes that aren't in a group's largest component meet one another and those of it. A group of which all nodes are
    connected has nothing left.
    """
    rooted = shared.written(heavy.join(roots, "node", "left").select("key", "node", _weight().alias("own"), F.coalesce("root", "node").alias("root")), "heavy-roots")
    parts = rooted.groupBy("key", "root").agg(F.sum("own").alias("part"))
    several = parts.groupBy("key").agg(F.count("*").alias("n"), F.max_by("root", F.struct("part", "root")).alias("largest"), F.max("part").alias("main"), F.sum("part").alias("whole")).where("n > 1")
    half = F.lit(LIGHT // 2)
    met = rooted.join(several, "key").withColumns({"mains": F.ceil(F.col("main") / half), "rests": F.ceil((F.col("whole") - F.col("main")) / half), "is_main": F.col("root") == F.col("largest")})
    met = met.withColumn("block", F.pmod(F.xxhash64("node"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("rests"))))
    upto = lambda count: F.sequence(F.lit(0).cast("bigint"), count - 1)
    pair = lambda kind, low, high: F.xxhash64("key", F.lit(kind), low, high)
    with_main = F.transform(upto(F.col("rests")), lambda rest: pair(1, rest, F.col("block")))
    with_rest = F.concat(
        F.transform(upto(F.col("mains")), lambda main: pair(1, F.col("block"), main)),
        F.transform(upto(F.col("rests")), lambda rest: pair(2, F.least(F.col("block"), rest), F.greatest(F.col("block"), rest))),
    )
    return met.select(F.explode(F.when(F.col("is_main"), with_main).otherwise(with_rest)).alias("key"), "node")


def _compared(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) that connect what is similar enough in each light group (key, node)."""
    rows = groups.join(sets, "node").select("key", "node", "shingles")
    return shared.written(rows.repartition("key").sortWithinPartitions("key").mapInArrow(shared.sparing(_linked), "a bigint, b bigint"), "alike")


def near_copies(documents: DataFrame) -> DataFrame:
    """doc_id, component_id, own and first_own as golay_simhash.near_duplicates has them, by exact similarity of proposed pairs.

    NULL texts and those without a word are copies of one another. Very long texts are compared whole. Rows that
    repeat are rows of one component. No documents: no rows. Other columns are ignored, whatever their names.
    """
    shared.with_code(documents.sparkSession)
    texts = documents.select(F.xxhash64("text").alias("own"), "text")
    signed = documents.select("doc_id", F.xxhash64("text").alias("own"), "text").mapInArrow(shared.sparing(_signed), "doc_id bigint, own bigint, node bigint, size bigint, bands array<bigint>, fingerprint bigint")
    own = shared.written(signed, "signatures")
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "own")
    nodes = shared.written(own.groupBy("node").agg(F.min(first).alias("first"), F.min("own").alias("own"), F.first("size").alias("size"), F.first("bands").alias("bands")), "nodes")

    def with_text(names: DataFrame) -> DataFrame:
        return texts.join(nodes.select("node", "own").join(names, "node"), "own").dropDuplicates(["node"]).select("node", "text")

    light, heavy = F.col("weight") <= LIGHT, F.col("weight") > LIGHT
    # Texts of one set may repeat its shingles differently and then have several fingerprints.
    keyed = own.where("size > 0").select("node", "size", "fingerprint").distinct().mapInArrow(shared.sparing(_golay_keys), "key bigint, node bigint, size bigint").distinct()
    coarse = _groups(nodes.select(F.explode("bands").alias("key"), "node", "size").union(keyed))
    sets = shared.written(with_text(coarse.select("node").distinct()).mapInArrow(shared.sparing(_sets), "node bigint, shingles array<bigint>"), "sets")
    fine = _groups(_rarest(shared.written(sets.join(coarse.where(heavy).select("node").distinct(), "node"), "heavy-sets")))
    groups = coarse.where(light).select("key", "node").union(fine.where(light).select("key", "node")).union(_stars(fine.where(heavy)))
    linked = _compared(groups, sets)
    roots = golay_simhash.components(linked)
    if not fine.where(heavy).isEmpty():
        roots = golay_simhash.components(linked.union(_compared(_crossed(fine.where(heavy), roots), sets)))
    rooted = nodes.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("first").alias("smallest")), "root")
    names = named.select("node", F.col("smallest.doc_id").alias("component_id"), F.col("smallest.own").alias("first_own"))
    return own.join(names, "node").select("doc_id", "component_id", "own", "first_own")
