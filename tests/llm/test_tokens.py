"""Piecewise token ids against the tokenizer on whole texts, and what is written with them."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from odd_rows import SMALL, rows

from pyspark.sql import functions as F

from tallywork.llm import arrow_shards, binary_packing, registered, shared, tokens

FILES = {name: public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "word_bpe_49k.json")}


def whole(name: str, texts: list[str]) -> list[np.ndarray]:
    tokenizer = Tokenizer.from_file(FILES[name])
    tokenizer.encode_special_tokens = True
    return [np.array(found.ids, "<u4") for found in tokenizer.encode_batch(texts, add_special_tokens=False)]


def odd_texts() -> list[str]:
    dice = random.Random(3)
    signs = ["a", "B", "é", "Ü", "×", "÷", "ß", "1", "٣", "²", "'", "'s", "'RE", ".", ",,", "!", "-", "_", " ", "  ", "\n", "\n\n", "\t", "\r", "\x0b", "\x1c", "\x85", " ", " ", "　", "é", "́", "᠎", "İ", "Σ", "ς", "ﬁ", "漢", "😀", "‍", "<|endoftext|>", "\x00", "ɐ", "ʰ"]
    return ["".join(dice.choice(signs) for _ in range(dice.randrange(1, 60))) for _ in range(4000)] + ["", " ", "\n", "abc", " a b ", "x" * 5000]


@pytest.mark.parametrize("name", FILES)
def test_pieces_give_the_ids_of_whole_texts(name):
    texts = odd_texts()
    found = dict(tokens.documents_ids(pa.array(texts, pa.large_string()), FILES[name], 2))
    for row, ids in enumerate(whole(name, texts)):
        assert found[row].tolist() == [*ids.tolist(), 2], repr(texts[row])


def test_a_full_store_of_pieces_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "WORDS_KEPT", 5)
    own = tokens.Encoder(FILES["byte_bpe_50k.json"])
    texts = ["one two three four", "five six seven", "one eight nine ten eleven twelve"]
    for _ in range(3):
        ids, at = own.ids(pa.array(texts, pa.large_string()))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [x.tolist() for x in whole("byte_bpe_50k.json", texts)]


def ordered(spark, documents=None) -> list[tuple]:
    found = documents or spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return sorted(((row[0], row[1]) for row in found), key=lambda row: (row[0] is not None, row[0] or 0, row[1] is not None, row[1] or ""))


def test_shards_hold_all_ids(spark):
    documents = ordered(spark)
    ids = [np.append(x, np.uint32(2)).astype("<u4") for x in whole("byte_bpe_50k.json", [text or "" for _, text in documents])]
    starts = np.cumsum([0, *map(len, ids)])
    found = registered.op3_arrow_shards(spark, SMALL)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, found.collect())) == [(name, int(start), len(x), zlib.crc32(x.tobytes())) for (name, _), start, x in zip(documents, starts, ids, strict=False)]


def test_shards_of_odd_documents(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(shared, "ROWS_PER_RANGE", 4)
    folder = shared.new_folder(spark, "test-shards")
    shards = arrow_shards.write_shards(odd, folder, FILES["byte_bpe_50k.json"], length=16, per_batch=4)
    documents = ordered(spark, rows())
    ids = [np.append(x, np.uint32(2)).astype("<u4") for x in whole("byte_bpe_50k.json", [text or "" for _, text in documents])]
    got = sorted(map(tuple, arrow_shards.read_documents(shards).collect()), key=lambda row: row[1])
    starts = np.cumsum([0, *map(len, ids)])
    assert got == [(name, int(start), len(x), zlib.crc32(x.tobytes())) for (name, _), start, x in zip(documents, starts, ids, strict=False)]
    assert arrow_shards.write_shards(empty, folder + "-none", FILES["byte_bpe_50k.json"]).count() == 0


def test_a_sequence_is_reached_without_a_copy(tmp_path):
    path = f"file://{tmp_path}/one.arrow"
    writer = arrow_shards.ShardWriter(path, 8, 3, np.dtype("<u2"))
    ids = np.arange(100, dtype="<u4")
    for at in range(0, 100, 7):
        writer.add(at, ids[at : at + 7])
    assert writer.close() == (path.removeprefix("file://"), 15, 100, 13)
    shard = arrow_shards.open_stream(path)
    before = pa.total_allocated_bytes()
    for number in range(13):
        own, mask = arrow_shards.sequence(shard, number)
        assert own[mask].tolist() == list(range(8 * number, min(100, 8 * number + 8))) and len(own) == 8
    assert pa.total_allocated_bytes() - before < 64 * 13
    assert shard.schema.field("input_ids").type == pa.list_(pa.uint16(), 8)


def test_shards_are_read_back_in_as_many_tasks(spark, monkeypatch, tmp_path):
    """Adaptive execution merges small partitions, but not those whose number is given."""
    monkeypatch.setattr(shared, "ROWS_PER_RANGE", 20)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    shards = arrow_shards.write_shards(spark.read.parquet(f"{SMALL}/documents.parquet"), f"file://{tmp_path}/shards", FILES["byte_bpe_50k.json"])
    read = arrow_shards.read_documents(shards)
    assert shards.count() >= 8 and read.rdd.getNumPartitions() == shards.count()
    assert read.select(F.spark_partition_id()).distinct().count() > shards.count() // 3


def test_binary_lengths():
    for n in (1, 2, 3, 4095, 4096, 4097, 8191, 123_457):
        found = binary_packing.binary_lengths(n)
        assert sum(found) == n and all(x & (x - 1) == 0 and x <= 4096 for x in found)
        assert len(found) == n // 4096 + (n % 4096).bit_count()


@pytest.mark.parametrize("which", ["table", "odd"])
def test_packing(spark, odd, which, monkeypatch):
    monkeypatch.setattr(shared, "ROWS_PER_RANGE", 4)
    if which == "table":
        found, documents = registered.op7_binary_packing(spark, SMALL), ordered(spark)
    else:
        found, documents = binary_packing.packed(odd, FILES["word_bpe_49k.json"]), ordered(spark, rows())
    found = found.collect()
    assert sorted(row["sequence_id"] for row in found) == list(range(len(found)))
    lengths = [row["length"] for row in sorted(found, key=lambda row: row["sequence_id"])]
    assert lengths == sorted(lengths, reverse=True) and {row["offset"] for row in found} == {0}
    wanted = []
    for (name, _), ids in zip(documents, whole("word_bpe_49k.json", [text or "" for _, text in documents]), strict=True):
        ids, start = np.append(ids, np.uint32(2)).astype("<u4"), 0
        for length in binary_packing.binary_lengths(len(ids)):
            piece = ids[start : start + length].tobytes()
            wanted.append((name, start, length, zlib.crc32(piece), len(ids)))
            start += length
    key = lambda row: (row[0] is not None, *(x or 0 for x in row))
    assert sorted((tuple(row)[:5] for row in found), key=key) == sorted(wanted, key=key)
    if which == "odd":
        assert all(zlib.crc32(row["ids"]) == row["ids_crc32"] and len(row["ids"]) == 4 * row["length"] for row in found)


def test_nothing_to_pack(empty):
    assert binary_packing.packed(empty, FILES["word_bpe_49k.json"]).count() == 0


def test_a_slices_rows_are_views_of_one_array():
    texts = pa.array(["one two", "", "three", ""], pa.large_string())
    rows = dict(tokens.documents_ids(texts, public_tokenizers.path("word_bpe_49k.json"), 2))
    assert [int(rows[i][-1]) for i in range(4)] == [2] * 4 and len(rows[1]) == len(rows[3]) == 1
    assert len({id(ids.base) for ids in rows.values()}) == 1 and rows[0].dtype == "<u4"
