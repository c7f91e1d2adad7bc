"""Line dedup by pairwise alignment: a document meets the first holders of the runs of lines they share, patience
diff aligns the two, and aligned common blocks go from the later document.

A run is a shortest stretch of lines, forwards from a line or backwards from it, that has the words of a block: a
line if it is long, else some together. Whatever block a document shares with an earlier one, such runs cover it,
and each run meets its own first holder, so no block breaks where one of its lines was first held elsewhere. Runs
are a link by a 128-bit hash with the places of their lines. Each links its later holders to the first one only,
so there are no more links than runs (two a line at most, and two more where short lines part long ones), however
many documents share one. Blank lines stand with the line before them and go when both neighbours go.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.llm import shared, tokens

LINE_WORDS = 5
BLOCK_WORDS = 8

PLACES = "array<struct<part:int,at:int,nth:int,long:int,after:int,ends:boolean>>"
RUNS = f"doc_id bigint, own bigint, high bigint, low bigint, parts array<bigint>, sizes array<int>, places {PLACES}"
PLACE = pa.struct([("part", pa.int32()), ("at", pa.int32()), ("nth", pa.int32()), ("long", pa.int32()), ("after", pa.int32()), ("ends", pa.bool_())])

# Fixed value: Thai, Lao, Burmese, Khmer, kana and Han, which are written without blanks. Two such characters count as a word.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def size_of(line: bytes) -> int:
    """How many words a line has; characters of scripts without blanks count by twos."""
    words = len(line.split())
    return words if line.isascii() else words + len(UNSPACED.findall(line.decode())) // 2


def shortest(sizes: list[int], least: int) -> set[tuple[int, int]]:
    """First and last places of the shortest stretches, from each place on and up to each place, that add up to enough."""

    def forward(sizes: list[int]) -> Iterator[tuple[int, int]]:
        total = end = 0
        for first, size in enumerate(sizes):
            while end < len(sizes) and total < least:
                total += sizes[end]
                end += 1
            if total < least:
                return
            yield first, end - 1
            total -= size

    last = len(sizes) - 1
    return {*forward(sizes), *((last - b, last - a) for a, b in forward(sizes[::-1]))}


def runs(text: bytes, least: int = BLOCK_WORDS, long: int = LINE_WORDS) -> dict[bytes, tuple[list[int], list[int], list[dict]]]:
    """A text's runs: hashes and sizes of their lines without the white space around them, and all places of these.

    A place has its number within the run, the line's number, its number among lines that are not blank and among
    long ones (-1 for a short one), and how many blank lines follow. Runs of long lines pass over short ones.
    """
    stripped = [line.strip() for line in text.split(b"\n")]
    at = [number for number, line in enumerate(stripped) if line]
    lines = [stripped[number] for number in at]
    sizes = [size_of(line) for line in lines]
    hashes = [_signed(xxhash.xxh64_intdigest(line)) for line in lines]
    longs = [nth for nth, size in enumerate(sizes) if size >= long]
    rank = {nth: number for number, nth in enumerate(longs)}
    until = [*at[1:], len(stripped)]
    stretches = {tuple(range(a, b + 1)) for a, b in shortest(sizes, least)}
    stretches |= {tuple(longs[a : b + 1]) for a, b in shortest([sizes[nth] for nth in longs], least)}
    found: dict[bytes, tuple[list[int], list[int], list[dict]]] = {}
    for stretch in sorted(stretches):
        own = found.setdefault(b"\n".join([lines[nth] for nth in stretch]), ([hashes[nth] for nth in stretch], [sizes[nth] for nth in stretch], []))
        for part, nth in enumerate(stretch):
            own[2].append({"part": part, "at": at[nth], "nth": nth, "long": rank.get(nth, -1), "after": until[nth] - at[nth] - 1, "ends": nth == len(lines) - 1})
    return found


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in RUNS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(PLACE)]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for batch in batches:
        rows: list[tuple] = []
        texts = tokens.column(batch, "text")
        for doc_id, own, text in zip(batch.column("doc_id").to_pylist(), batch.column("own").to_pylist(), texts, strict=True):
            for run, (parts, sizes, places) in runs(text.as_buffer().to_pybytes()).items():
                number = xxhash.xxh128_intdigest(run)
                rows.append((doc_id, own, _signed(number >> 64), _signed(number & (1 << 64) - 1), parts, sizes, places))
            if len(rows) >= 20_000:
                yield batch_of(rows)
                rows = []
        if rows:
            yield batch_of(rows)


def _longest_rise(values: list[int]) -> list[int]:
    """Indices of a longest strictly rising part of different numbers."""
    tails: list[int] = []
    tops: list[int] = []
    back = [-1] * len(values)
    for i, value in enumerate(values):
        at = bisect_left(tops, value)
        back[i] = tails[at - 1] if at else -1
        if at == len(tails):
            tails.append(i)
            tops.append(value)
        else:
            tails[at], tops[at] = i, value
    out, at = [], tails[-1] if tails else -1
    while at >= 0:
        out.append(at)
        at = back[at]
    return out[::-1]


def patience(first: list[int], second: list[int]) -> list[tuple[int, int]]:
    """Aligned places of two sequences: equal ends, then items that both have once, in rising order, and so on between them.

    Where a part has no such item, the n-th of a kind meets the n-th of that kind.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(first), 0, len(second))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and first[a] == second[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and first[b - 1] == second[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        sides: list[dict[int, list[int]]] = [{}, {}]
        for side, sequence, begin, end in ((0, first, a, b), (1, second, c, d)):
            for at in range(begin, end):
                sides[side].setdefault(sequence[at], []).append(at)
        common = [item for item in sides[0] if item in sides[1]]
        once = [(sides[0][item][0], sides[1][item][0]) for item in common if len(sides[0][item]) == len(sides[1][item]) == 1]
        if not once:
            pairs = sorted(pair for item in common for pair in zip(sides[0][item], sides[1][item], strict=False))
            out += [pairs[i] for i in _longest_rise([y for _, y in pairs])]
            continue
        once.sort()
        anchors = [once[i] for i in _longest_rise([y for _, y in once])]
        out += anchors
        for (x, y), (z, w) in zip([(a - 1, c - 1), *anchors], [*anchors, (b, d)], strict=True):
            todo.append((x + 1, z, y + 1, w))
    return sorted(out)


def deleted(shared_runs: list[dict], least: int = BLOCK_WORDS) -> list[int]:
    """Line numbers that go from the later document of a pair: lines, later and earlier places of each shared run.

    A block's lines follow one another in both documents, either among all lines that are not blank or among long ones.
    """
    sizes: dict[int, int] = {}
    sides: list[dict[int, tuple[int, dict]]] = [{}, {}]
    for run in shared_runs:
        sizes.update(zip(run["parts"], run["sizes"], strict=True))
        for side, name in zip(sides, ("later", "earlier"), strict=True):
            side.update((place["nth"], (run["parts"][place["part"]], place)) for place in run[name])
    later, earlier = ([side[nth] for nth in sorted(side)] for side in sides)
    pairs = [(later[x][1], earlier[y][1], sizes[later[x][0]]) for x, y in patience([line for line, _ in later], [line for line, _ in earlier])]
    out: set[int] = set()
    for count in ("nth", "long"):
        block: list[tuple[dict, dict, int]] = []
        for pair in [*(pair for pair in pairs if pair[0][count] >= 0), None]:
            if block and (pair is None or any(pair[side][count] != block[-1][side][count] + 1 for side in (0, 1))):
                if sum(words for _, _, words in block) >= least:
                    out.update(_gone(block))
                block = []
            if pair:
                block.append(pair)
    return sorted(out)


def _gone(block: list[tuple[dict, dict, int]]) -> Iterator[int]:
    """Line numbers of a block, and of blank lines that both documents have within it or at their end or begin."""
    for i, (mine, other, _) in enumerate(block):
        yield mine["at"]
        follows = i + 1 < len(block) and block[i + 1][0]["nth"] == mine["nth"] + 1 and block[i + 1][1]["nth"] == other["nth"] + 1
        if mine["after"] == other["after"] and (follows or (mine["ends"] and other["ends"])):
            yield from range(mine["at"] + 1, mine["at"] + 1 + mine["after"])
    mine, other, _ = block[0]
    if mine["nth"] == other["nth"] == 0 and mine["at"] == other["at"]:
        yield from range(mine["at"])


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gone = [deleted(runs.as_py()) for runs in batch.column("runs")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("own"), pa.array(gone, pa.list_(pa.int32()))], ["doc_id", "own", "gone"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, gone = batch.column("text"), batch.column("gone")
        out, lines, count = [], [], []
        for text, places in zip(texts, gone, strict=True):
            whole = text.as_py()
            parts = (whole or "").split("\n")
            drop = {number for place in places.as_py() or [] for number in place}
            out.append("\n".join(part for at, part in enumerate(parts) if at not in drop) if drop else whole)
            lines.append(len(parts))
            count.append(len(drop))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string()), pa.array(lines, pa.int64()), pa.array(count, pa.int64())], ["row", "text", "n_lines", "n_deleted"])


def _own(text: Column) -> Column:
    return F.xxhash64(text)


def repeated_lines(documents: DataFrame) -> DataFrame:
    """doc_id, own (hash of the text) and gone: for each earlier document, the line numbers that go.

    Earlier is the smaller doc_id, NULL first; texts that share a doc_id go by their hash. Rows that are equal in
    both are one document. NULL and empty texts have no lines.
    """
    spark = documents.sparkSession
    shared.with_code(spark)
    lines = shared.written(documents.select("doc_id", _own(F.col("text")).alias("own"), "text").mapInArrow(shared.sparing(_lines), RUNS), "runs")
    holder = F.struct("doc_id", "own")
    first = lines.groupBy("high", "low").agg(F.min(holder).alias("first"), F.max(holder).alias("last"), F.min_by("places", holder).alias("earlier")).where("first < last").drop("last")
    # As a table of its own it meets the runs in a join that adaptive execution can split where a run is in very many documents.
    first = shared.written(first, "first-holders")
    later = lines.join(first, ["high", "low"]).where(holder > F.col("first"))
    run = F.struct("parts", "sizes", F.col("places").alias("later"), "earlier")
    pairs = later.groupBy("doc_id", "own", "first").agg(F.collect_set(run).alias("runs"))
    return pairs.select("doc_id", "own", "runs").mapInArrow(shared.sparing(_aligned), "doc_id bigint, own bigint, gone array<int>").groupBy("doc_id", "own").agg(F.collect_list("gone").alias("gone"))


def without_repeats(documents: DataFrame) -> DataFrame:
    """The documents with aligned common blocks taken out of later ones, and n_lines and n_deleted.

    A row's other columns stay as they are, but n_lines and n_deleted are replaced where there were such. A NULL
    text stays NULL and counts one line. A document of which all lines go has an empty text. No documents: no rows.
    """
    columns = [name for name in documents.columns if name not in ("n_lines", "n_deleted")]
    gone = shared.written(repeated_lines(documents), "gone").select(F.col("doc_id").alias("gone_doc_id"), F.col("own").alias("gone_own"), "gone")
    rows = shared.folded(documents, "text").select("*", F.col("row.doc_id").alias("doc_id"), _own(F.col("text")).alias("own"))
    joined = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_doc_id")) & (F.col("own") == F.col("gone_own")), "left").select("row", "text", "gone")
    schema = joined.drop("gone").schema.add("n_lines", "long").add("n_deleted", "long")
    return joined.mapInArrow(shared.sparing(_cut), schema).select(*shared.unfolded(columns, "text"), "n_lines", "n_deleted")
