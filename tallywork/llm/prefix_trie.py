"""Prefix trie of conversations, encoded shard by shard as balanced parentheses.

Conversations are paths of turn hashes. The different paths are sorted and dealt into shards of consecutive ones.
A shard's trie is a string of parentheses, one pair for each node in order of depth first; the excess of open ones is
kept with its least and greatest value for each block, and for pairs of blocks above. `find_close` finds a node's
closing parenthesis through these, and what lies between is its subtree: the rank of "()" counts its leaves, and
cumulative arrays over the nodes give its members and savings.

A node that two shards have lies on the spine between them, the common beginning of the last path of one and the
first of the next. Each shard sees these two neighbours of its own paths, so what belongs to a node once (its first
copy, being a leaf, being a child) is counted in one shard only, and the parts of spine nodes are added up by key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm import shared

BLOCK = 64
TURNS_PER_SHARD = 1 << 17
HASH_BYTES = 16
HEAD = 8

NODES = (
    "key binary, parent_key binary, open boolean, parent_open boolean, conv_id bigint, depth bigint, parent_conv_id bigint,"
    " n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string"
)
_NODES = pa.schema(
    [("key", pa.binary()), ("parent_key", pa.binary()), ("open", pa.bool_()), ("parent_open", pa.bool_())]
    + [(name, pa.int64()) for name in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends", pa.string())]
)


class Parentheses:
    """A balanced string of parentheses (True opens) with the range of its excess by blocks, and by pairs of them upwards."""

    def __init__(self, bits: np.ndarray, block: int = BLOCK):
        self.block = block
        self.excess = np.cumsum(np.where(bits, 1, -1))
        self.pairs = np.append(bits[:-1] & ~bits[1:], False)
        blocks = -(-len(bits) // block)
        padded = np.full(blocks * block, np.iinfo(np.int64).max)
        padded[: len(bits)] = self.excess
        low = padded.reshape(blocks, block).min(axis=1)
        padded[len(bits) :] = np.iinfo(np.int64).min
        high = padded.reshape(blocks, block).max(axis=1)
        self.levels = [(low, high)]
        while len(low) > 1:
            even = len(low) % 2
            low = np.append(low, low[-1:])[: len(low) + even].reshape(-1, 2).min(axis=1)
            high = np.append(high, high[-1:])[: len(high) + even].reshape(-1, 2).max(axis=1)
            self.levels.append((low, high))

    def _has(self, level: int, number: np.ndarray, target: np.ndarray) -> np.ndarray:
        low, high = self.levels[level]
        inside = np.minimum(number, len(low) - 1)
        return (number < len(low)) & (low[inside] <= target) & (target <= high[inside])

    def _scan(self, at: np.ndarray, target: np.ndarray, found: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Look for the targets from each place to the end of its block; returns the rows without one."""
        at = at.copy()
        while len(rows):
            inside = (at < len(self.excess)) & (self.excess[np.minimum(at, len(self.excess) - 1)] == target)
            found[rows[inside]] = at[inside]
            more = ~inside & ((at + 1) % self.block != 0)
            if not more.any():
                return rows[~inside]
            missed = rows[~inside & ~more]
            rows, at, target = rows[more], at[more] + 1, target[more]
            if len(missed):
                return np.concatenate([missed, self._scan(at, target, found, rows)])
        return rows

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one: the next place where the excess is less than it was before."""
        target = self.excess[at] - 1
        found = np.full(len(at), -1)
        every = np.arange(len(at))
        within = (at + 1) % self.block != 0
        missed = self._scan(at[within] + 1, target[within], found, every[within])
        rows = np.concatenate([every[~within], missed])
        # Upwards until the block to the right has the excess, then down to the first block that has it.
        number, down = at[rows] // self.block, []
        for level in range(len(self.levels)):
            right = (number % 2 == 0) & self._has(level, number + 1, target[rows])
            down.append((rows[right], number[right] + 1))
            rows, number = rows[~right], number[~right] // 2
        rows, number = down.pop()
        for level in range(len(self.levels) - 2, -1, -1):
            number = 2 * number
            number = number + ~self._has(level, number, target[rows])
            rows, number = np.concatenate([rows, down[level][0]]), np.concatenate([number, down[level][1]])
        self._scan(number * self.block, target[rows], found, rows)
        return found


def _common(a: bytes, b: bytes) -> int:
    """How many turns two paths have in common at their beginning."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most // HASH_BYTES
    depth = 0
    while a[depth : depth + HASH_BYTES] == b[depth : depth + HASH_BYTES]:
        depth += HASH_BYTES
    return depth // HASH_BYTES


def shard_nodes(paths: list[tuple[bytes, list[int], int, int, str]], before: bytes | None = None, after: bytes | None = None) -> dict[str, list]:
    """Columns of the nodes of a shard. paths: (path, sizes of its turns, members that end there, least of these, digest of these), sorted.

    before and after are the paths next to the shard's, where there are any.
    """
    keys, parent, depth, size, ends, least, digest = [b""], [-1], [0], [0], [0], [1 << 63], [None]
    bits, stack, last = bytearray([1]), [0], b""
    for path, sizes, n, conv_id, ends_digest in paths:
        shared_turns = _common(last, path)
        bits += bytes(len(stack) - 1 - shared_turns)
        del stack[shared_turns + 1 :]
        for at in range(shared_turns, len(sizes)):
            bits.append(1)
            keys.append(hashlib.blake2b(keys[stack[-1]] + path[at * HASH_BYTES : (at + 1) * HASH_BYTES], digest_size=HASH_BYTES).digest())
            parent.append(stack[-1])
            depth.append(at + 1)
            size.append(sizes[at])
            ends.append(0)
            least.append(1 << 63)
            digest.append(None)
            stack.append(len(keys) - 1)
        ends[stack[-1]], least[stack[-1]], digest[stack[-1]] = n, conv_id, ends_digest
        last = path
    bits += bytes(len(stack))

    n = len(keys)
    deep, up = np.array(depth), np.array(parent)
    first = np.ones(n, bool)
    is_open = np.zeros(n, bool)
    if before is not None:
        # Nodes of the first path come first, one for each depth.
        seen = _common(before, paths[0][0])
        first[: seen + 1] = False
        is_open[: seen + 1] = True
    tree = Parentheses(np.frombuffer(bits, np.uint8).astype(bool))
    opening = np.flatnonzero(np.frombuffer(bits, np.uint8))
    pairs = tree.pairs
    if after is not None:
        goes_on = _common(last, after)
        is_open[stack[: goes_on + 1]] = True
        if goes_on == len(stack) - 1:
            pairs[opening[stack[-1]]] = False
    closing = tree.find_close(opening)
    below = np.arange(n) + (closing - opening + 1) // 2

    def total(own: np.ndarray) -> np.ndarray:
        so_far = np.concatenate([[0], np.cumsum(own)])
        return so_far[below] - so_far[:n]

    members = total(np.array(ends))
    rank = np.concatenate([[0], np.cumsum(pairs)])
    leaves = rank[closing] - rank[opening]
    saved = total(np.array(size) * (members - first))
    children = np.bincount(up[1:][first[1:]], minlength=n)
    for node in range(n - 1, 0, -1):
        if least[node] < least[parent[node]]:
            least[parent[node]] = least[node]
    of_parent = np.maximum(up, 0)
    return {
        "key": keys,
        "parent_key": [None, *(keys[node] for node in parent[1:])],
        "open": is_open.tolist(),
        "parent_open": is_open[of_parent].tolist(),
        "conv_id": least,
        "depth": deep.tolist(),
        "parent_conv_id": [None, *(least[node] for node in parent[1:])],
        "n_convs": members.tolist(),
        "n_children": children.tolist(),
        "n_leaves": leaves.tolist(),
        "saved_tokens": saved.tolist(),
        "ends": digest,
    }


def _shard(rows: pa.Table) -> pa.Table:
    kinds = rows.column("kind").to_pylist()
    given = zip(kinds, *(rows.column(name).to_pylist() for name in ("path", "sizes", "n", "least", "ends")), strict=True)
    paths, beside = [], {0: None, 2: None}
    for kind, path, *rest in given:
        if kind == 1:
            paths.append((path, *rest))
        else:
            beside[kind] = path
    paths.sort(key=lambda row: row[0])
    return pa.Table.from_pydict(shard_nodes(paths, beside[0], beside[2]) if paths else {field.name: [] for field in _NODES}, _NODES)


def _endings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many conversations have a path, the least of them, and a digest of all. Rows come sorted; only the digest's state is held."""
    held, done = None, []

    def closed() -> pa.RecordBatch:
        keys, counts, least, digests = zip(*done, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(counts, pa.int64()), pa.array(least, pa.int64()), pa.array(digests, pa.string())], ["key", "n", "least", "ends"])

    for batch in batches:
        for key, conv_id in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if held is None or held[0] != key:
                if held is not None:
                    done.append((*held[:3], held[3].hexdigest()))
                held = [key, 0, conv_id, hashlib.sha256()]
            held[3].update(f",{conv_id}".encode() if held[1] else str(conv_id).encode())
            held[1] += 1
        if len(done) >= 10_000:
            yield closed()
            done = []
    if held is not None:
        done.append((*held[:3], held[3].hexdigest()))
    if done:
        yield closed()


def turn_lists(conversations: DataFrame) -> DataFrame:
    """conv_id and turns: structs (turn, hash, size) in the order of turns, NULL first; no texts, 60 bytes a turn.

    hash names role and text, size counts the text's bytes. NULL roles and texts are empty ones. Turns of one number are in the
    order of their hashes, those that repeat stay. Rows without a conv_id belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    narrow = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint"), F.struct(F.col("turn").cast("bigint"), named.alias("hash"), F.octet_length(text).alias("size")).alias("entry")
    )
    return narrow.groupBy("conv_id").agg(F.sort_array(F.collect_list("entry")).alias("turns"))


def spliced(turns: DataFrame, every: int = 5, longest: int = HEAD) -> DataFrame:
    """Each conversation with its first h turns taken from the one that opens its group of `every` numbers; h = crc32(conv_id) % (longest + 1)."""
    turns = shared.written(turns, "turns")
    heads = turns.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("opener"), F.slice("turns", 1, longest).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1)).cast("int")
    met = turns.withColumn("opener", F.col("conv_id") - F.col("conv_id") % every).join(heads, "opener", "left")
    own = F.slice("turns", h + 1, F.size("turns"))
    return met.select("conv_id", F.when(F.col("head").isNull(), own).otherwise(F.concat(F.slice("head", F.lit(1), h), own)).alias("turns"))


def trie(turns: DataFrame, turns_per_shard: int = TURNS_PER_SHARD) -> DataFrame:
    """All nodes of the trie of conversations given as by `turn_lists`.

    conv_id (least member), depth, parent_conv_id (NULL for the root), n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. The root has depth 0; a conversation without turns is a member of it alone. Conversations with one
    path are one path with as many members, so copies cost no more than a row each; the digest of those that end at
    one node reads their numbers in order, in one task, without holding them. No conversation: no node, not even the root.
    """
    shared.with_code(turns.sparkSession)
    joined = F.array_join(F.transform("turns", lambda turn: turn["hash"]), "")
    paths = turns.select("conv_id", F.unhex(joined).alias("path"), F.transform("turns", lambda turn: turn["size"]).alias("sizes"))
    paths = shared.written(paths.withColumn("key", F.md5("path")), "paths")
    endings = paths.select("key", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(_endings, "key string, n bigint, least bigint, ends string")
    different = paths.groupBy("key").agg(F.first("path").alias("path"), F.first("sizes").alias("sizes")).join(endings, "key").drop("key")
    all_turns = paths.agg(F.sum(F.size("sizes").cast("bigint")).alias("n")).first()["n"] or 0
    dealt = different.repartitionByRange(all_turns // turns_per_shard + 1, "path").withColumn("shard", F.spark_partition_id())
    dealt = shared.written(dealt, "shards")
    # Ranges between existing paths: none but the last can be empty, so neighbours have numbers that follow one another.
    edges = dealt.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high"))
    beside = F.array(*(F.struct((F.col("shard") + step).alias("shard"), F.lit(kind).alias("kind"), F.col(path).alias("path")) for step, kind, path in ((1, 0, "high"), (-1, 2, "low"))))
    seams = edges.select(F.explode(beside).alias("seam")).select("seam.*")
    rows = dealt.withColumn("kind", F.lit(1)).unionByName(seams, allowMissingColumns=True)
    nodes = shared.written(rows.groupBy("shard").applyInArrow(_shard, NODES), "nodes")

    sums = [F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    spine = nodes.where("open").groupBy("key").agg(F.first("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), *sums, F.max("ends").alias("ends"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    inner = [name for name in columns if name != "parent_conv_id"]
    settled = nodes.where("NOT open AND NOT parent_open").select(columns)
    hanging = nodes.where("NOT open AND parent_open").select("parent_key", *inner).unionByName(spine.select("parent_key", *inner))
    named = hanging.join(spine.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id")), "parent_key", "left")
    found = settled.unionByName(named.select(columns))
    return found.select(*columns[:-1], F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
