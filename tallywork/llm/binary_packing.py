"""Packing by powers of two: each document is cut into binary-length pieces, and equal lengths share a bucket.

A sequence is one piece. No sequence crosses documents and, since its length is a power of two, none needs
padding; batches are taken from one bucket at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm import shared, tokens

LONGEST = 4096
END_ID = 2

PIECES = "doc_id bigint, order bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def binary_lengths(n: int, longest: int = LONGEST) -> list[int]:
    """Piece lengths of a document of n ids: as many of the longest as fit, then n's binary digits downwards."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << bit for bit in range(longest.bit_length() - 2, -1, -1) if rest >> bit & 1]


def _cutter(path: str, end_id: int, longest: int, keep_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, orders = batch.column("doc_id").to_pylist(), batch.column("order").to_pylist()
            rows: list[tuple] = []
            for row, ids in tokens.documents_ids(tokens.column(batch, "text"), path, end_id, added=True):
                raw, start = ids.tobytes(), 0
                for length in binary_lengths(len(ids), longest):
                    piece = raw[4 * start : 4 * (start + length)]
                    rows.append((names[row], orders[row], start, length, zlib.crc32(piece), len(ids), *([piece] if keep_ids else [])))
                    start += length
                if len(rows) >= 20_000:
                    yield _batch(rows, keep_ids)
                    rows = []
            if rows:
                yield _batch(rows, keep_ids)

    return cut


def _batch(rows: list[tuple], keep_ids: bool) -> pa.RecordBatch:
    names = [field.split()[0] for field in PIECES.split(", ")] + ["ids"] * keep_ids
    kinds = [pa.int64()] * 6 + [pa.binary()] * keep_ids
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def packed(documents: DataFrame, tokenizer: str, order: str = "doc_id", end_id: int = END_ID, longest: int = LONGEST, keep_ids: bool = True) -> DataFrame:
    """One row for each piece of each document; `ids` holds its ids as little-endian unsigned 32-bit integers.

    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids where they are kept. Sequences
    are numbered from 0 by length from the longest, then by `order` and start. A NULL or empty text is the end
    id alone, one piece of length 1. Rows that repeat, with one doc_id or with none, are packed each for
    itself. No documents: no rows. Other columns are ignored, whatever their names.
    The texts are not shuffled: pieces are cut where a text is read and written once to the shared folder; what
    is numbered are ranges of `order`, so no length and no document has to fit into a task.
    """
    shared.with_code(documents.sparkSession)
    columns = documents.select("doc_id", F.col(order).cast("bigint").alias("order"), "text")
    schema = PIECES + (", ids binary" if keep_ids else "")
    pieces = shared.written(columns.mapInArrow(shared.sparing(_cutter(tokenizer, end_id, longest, keep_ids), encodes=True), schema), "pieces")
    bounds = shared.range_bounds(documents.select(F.col(order).cast("bigint").alias("order")), "order")
    pieces = pieces.withColumn("range", shared.range_of(F.col("order"), bounds))
    sizes = pieces.groupBy("length", "range").agg(F.count(F.lit(1)).alias("sequences"))
    before = Window.orderBy(F.desc("length"), "range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "range", F.coalesce(F.sum("sequences").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "range").orderBy("order", "doc_id", "start", "ids_crc32")
    numbered = pieces.withColumn("at", F.row_number().over(within)).join(bases, ["length", "range"])
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("at") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")]
    return numbered.select(*columns, *(["ids"] if keep_ids else []))
