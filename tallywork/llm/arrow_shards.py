"""Token ids in Arrow stream files: record batches of fixed-size lists, one of ids and one of masks.

A shard holds a range of documents in order. Its ids run on from sequence to sequence, each of equal length;
the mask is false on the padding of the last one. Values lie at (sequence * length) in one buffer of each
batch and all batches but the last have the same number of sequences, so a reader that maps the file reaches
any sequence by arithmetic and without a copy. A second stream file names each document's first id.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm import shared, tokens

LENGTH = 2048
SEQUENCES_PER_BATCH = 256
END_ID = 2

MANIFEST = "range int, path string, n_docs bigint, n_tokens bigint, n_sequences bigint"
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def id_type(vocabulary: int) -> np.dtype:
    """Two bytes hold an id where the vocabulary allows."""
    return np.dtype("<u2") if vocabulary <= 1 << 16 else np.dtype("<u4")


def shard_schema(length: int, kind: np.dtype) -> pa.Schema:
    """Ids and mask of a sequence, both as lists of the given length."""
    return pa.schema([("input_ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("attention_mask", pa.list_(pa.bool_(), length))])


class ShardWriter:
    """Writes one shard under a name of its own and moves it to its place when it is whole, so that a task may run again."""

    def __init__(self, path: str, length: int, per_batch: int, kind: np.dtype):
        self.system, self.path = fs.FileSystem.from_uri(path)
        self.system.create_dir(self.path.rsplit("/", 1)[0])
        self.own = f"{self.path}.{uuid.uuid4().hex}"
        self.length, self.per_batch, self.kind = length, per_batch, kind
        self.schema = shard_schema(length, kind)
        self.sink = self.system.open_output_stream(self.own)
        self.stream = pa.ipc.new_stream(self.sink, self.schema)
        self.waiting: list[np.ndarray] = []
        self.held = self.n_tokens = self.n_sequences = 0
        self.index: list[tuple[int | None, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.index.append((doc_id, self.n_tokens, len(ids)))
        self.waiting.append(ids.astype(self.kind))
        self.held += len(ids)
        self.n_tokens += len(ids)
        if self.held >= self.length * self.per_batch:
            self._write(whole=False)

    def _write(self, whole: bool) -> None:
        ids = np.concatenate(self.waiting)
        step = self.length * self.per_batch
        for at in range(0, len(ids) if whole else len(ids) // step * step, step):
            part = ids[at : at + step]
            sequences = -(-len(part) // self.length)
            filled = np.zeros(sequences * self.length, self.kind)
            filled[: len(part)] = part
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(values), self.length) for values in (filled, np.arange(len(filled)) < len(part))]
            self.stream.write_batch(pa.record_batch(lists, schema=self.schema))
            self.n_sequences += sequences
        rest = ids[len(ids) // step * step :] if not whole else ids[:0]
        self.waiting, self.held = [rest], len(rest)

    def close(self) -> tuple[str, int, int, int]:
        if self.held:
            self._write(whole=True)
        self.stream.close()
        self.sink.close()
        self.system.move(self.own, self.path)
        with self.system.open_output_stream(f"{self.own}.index") as sink, pa.ipc.new_stream(sink, INDEX) as stream:
            columns = [np.array(x) for x in zip(*self.index, strict=True)][1:]
            stream.write_batch(pa.record_batch([pa.array([x[0] for x in self.index], pa.int64()), *map(pa.array, columns)], schema=INDEX))
        self.system.move(f"{self.own}.index", f"{self.path}.index")
        return self.path, len(self.index), self.n_tokens, self.n_sequences


def open_stream(path: str) -> pa.Table:
    """All batches of a stream file; a local file is mapped and its buffers are not copied."""
    system, name = fs.FileSystem.from_uri(path)
    source = pa.memory_map(name) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(name)
    return pa.ipc.open_stream(source).read_all()


def sequence(shard: pa.Table, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of one sequence: the ids are a view of the file's buffer."""
    per_batch = len(shard.column(0).chunk(0))
    chunk, row = divmod(number, per_batch)
    ids, mask = (column.chunk(chunk) for column in shard.columns)
    return ids[row].values.to_numpy(), mask[row].values.to_numpy(zero_copy_only=False)


def _writer(folder: str, tokenizer: str, end_id: int, length: int, per_batch: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number = None, None
        done: list[tuple] = []

        def close() -> None:
            if own:
                done.append((number, f"{folder}/range-{number:06d}.arrow", *own.close()[1:]))

        for batch in batches:
            ranges, names = batch.column("range").to_pylist(), batch.column("doc_id").to_pylist()
            for row, ids in tokens.documents_ids(tokens.column(batch, "text"), tokenizer, end_id, added=True):
                if own is None or ranges[row] != number:
                    close()
                    number = ranges[row]
                    own = ShardWriter(f"{folder}/range-{number:06d}.arrow", length, per_batch, id_type(tokens.encoder(tokenizer, added=True).size))
                own.add(names[row], ids)
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*done, strict=True), [pa.int32(), pa.string(), *[pa.int64()] * 3], strict=True)], ["range", "path", "n_docs", "n_tokens", "n_sequences"])

    return write


def write_shards(documents: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, length: int = LENGTH, per_batch: int = SEQUENCES_PER_BATCH) -> DataFrame:
    """Write the documents' ids, each with the end id, in ascending doc_id order; return one row for each shard.

    A shard is a range of doc_ids, so shards in the order of their numbers hold the documents in order, NULL
    doc_ids first and rows that share a doc_id by text. A NULL or empty text is the end id alone. No documents:
    no shards. Other columns are ignored. `start` is the number of ids in all shards before.
    """
    shared.with_code(documents.sparkSession)
    bounds = shared.range_bounds(documents, "doc_id")
    columns = documents.select(shared.range_of(F.col("doc_id"), bounds).alias("range"), "doc_id", "text")
    ordered = columns.repartition("range").sortWithinPartitions("range", "doc_id", "text")
    shards = shared.written(ordered.mapInArrow(_writer(folder, tokenizer, end_id, length, per_batch), MANIFEST), "shards")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
            shard, index = open_stream(path), open_stream(f"{path}.index")
            flat = [column.combine_chunks().flatten().to_numpy(zero_copy_only=False) for column in shard.columns]
            ids = flat[0][flat[1]].astype("<u4")
            first, count = index.column("start").to_numpy(), index.column("n_tokens").to_numpy()
            sums = [zlib.crc32(ids[a : a + n]) for a, n in zip(first, count, strict=True)]
            yield pa.RecordBatch.from_arrays([index.column("doc_id").combine_chunks(), pa.array(first + start), pa.array(count), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(shards: DataFrame) -> DataFrame:
    """Each document's place among all ids and the checksum of its ids, from the files; a shard at a time.

    There are as many partitions as shards: without a number, adaptive execution would put the few bytes that name
    all shards into one task, which would read all files.
    """
    named = shards.select("range", "path", "start")
    return named.repartition(max(1, named.count()), "range").mapInArrow(_read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
