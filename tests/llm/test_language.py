"""Languages and their mixtures."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from odd_rows import SMALL, rows
from pyspark.sql import functions as F

from tallywork.llm import language_mixture, registered

LARGER = "/root/testdata/sf0.01"


def slow_trigrams(text: str) -> list[tuple]:
    out, last = [], " "
    for character in text:
        here = character.lower()[0] if character.isalpha() else " "
        if not (here == " " and last == " "):
            out.append(here)
        last = here
    line = ([" "] if text and text[0].isalpha() else []) + out + ([" "] if out and out[-1] != " " else [])
    return [tuple(line[i : i + 3]) for i in range(len(line) - 2) if line[i + 1] != " "]


def test_trigrams_are_those_of_a_loop():
    texts = ["Ab  c!d", "", "...", "a", "é1ü", "x\n\ny", "ÀÉ 漢字", " ab"]
    doc, cell, letters = language_mixture.trigrams(pa.array(texts, pa.large_string()))
    names: dict[tuple, int] = {}
    for row, text in enumerate(texts):
        wanted = slow_trigrams(text)
        own = cell[doc == row].tolist()
        assert len(own) == len(wanted) and letters[row] == sum(c.isalpha() for c in text)
        for name, number in zip(wanted, own, strict=True):
            assert names.setdefault(name, number) == number


def test_em_finds_the_shares_that_were_mixed():
    dice = np.random.default_rng(1)
    chances = dice.dirichlet(np.ones(50), 3).T
    mix = np.array([0.6, 0.3, 0.1])
    n = dice.multinomial(200_000, chances @ mix).astype(float)
    share, likelihood = language_mixture.proportions(np.zeros(50, np.int64), n, chances, 1, np.ones((1, 3)))
    best = (n * np.log(chances @ mix)).sum()
    assert np.abs(share[0] - mix).max() < 0.05 and likelihood[0] > best - 100
    alone, _ = language_mixture.proportions(np.zeros(50, np.int64), n, chances, 1, np.array([[1.0, 0, 0]]))
    assert alone.tolist() == [[1, 0, 0]]


def test_held_out_documents(spark):
    found = registered.op6_language_mixture(spark, LARGER)
    assert found.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    truth = {row["doc_id"]: row for row in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    rows = found.collect()
    assert len(rows) == len(truth)
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2)
        assert 0 <= row["score"] <= 1
        assert (row["lang_pred"] == "und") == (not any(c.isalpha() for c in truth[row["doc_id"]]["text"]))
    right = [row["lang_pred"] == truth[row["doc_id"]]["lang"] for row in rows if row["held_out"] and len(truth[row["doc_id"]]["text"]) > 100]
    assert sum(right) / len(right) > 0.98


def test_held_out_documents_are_not_learned_from(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    changed = documents.withColumn("lang", F.when(language_mixture.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    a, b = language_mixture.learned(documents), language_mixture.learned(changed)
    assert a.names == b.names and (a.chances == b.chances).all()


def test_two_languages_in_one_text(spark):
    documents = spark.read.parquet(f"{LARGER}/documents.parquet")
    languages = language_mixture.learned(documents)
    long = {row["lang"]: row["text"] for row in documents.where("length(text) > 3000 AND text NOT RLIKE '[*|#!]'").collect()}
    shares, known, _ = language_mixture.mixtures(pa.array([long["de"][:2000] + " " + long["fr"][:1000], long["de"][:3000]], pa.large_string()), languages)
    de, fr = languages.names.index("de"), languages.names.index("fr")
    assert known.all() and abs(shares[0, de] - 2 / 3) < 0.08 and abs(shares[0, fr] - 1 / 3) < 0.08
    assert shares[1, de] > 0.97


def test_odd_documents(odd, empty):
    languages = language_mixture.learned(odd)
    found = language_mixture.with_language(odd, languages)
    assert found.columns == [*odd.columns, "lang_pred", "score", "languages"]
    assert sorted((row["doc_id"] or -1, row["lang_pred"] == "und") for row in found.collect()) == sorted((row[0] or -1, not any(c.isalpha() for c in row[1] or "")) for row in rows())
    nothing = language_mixture.learned(empty)
    assert nothing.names == [] and language_mixture.with_language(empty, languages).count() == 0
    assert {(row["lang_pred"], row["score"]) for row in language_mixture.with_language(odd, nothing).collect()} == {("und", 0.0)}
