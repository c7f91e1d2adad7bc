"""A training corpus from documents: language, repeated passages, near copies, the mixture of sources, packing.

All stages take rows with NULLs in any column, empty and very long texts, rows that repeat, other columns whatever their
names, and no rows at all; what becomes of them stands at each stage. But for the last one they return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm import binary_packing, golay_simhash, language_mixture, near_copies, patience_dedup, pfair_mixing, shared

LEAST_LANGUAGE_SHARE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which one language has at least half; the others, and those without a letter, go.

    A NULL or empty text has no letter and goes. Very long texts are read whole. Rows that repeat are judged each for itself; a NULL doc_id,
    lang or source makes no difference to a row. The languages are learned from the rows with a lang; without any, all rows go. No rows: none.
    """
    found = language_mixture.with_language(shared.folded(docs, "text"), language_mixture.learned(docs))
    kept = (F.col("lang_pred") != language_mixture.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SHARE)
    return found.where(kept).select(shared.unfolded(docs.columns, "text"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without blocks of lines that an earlier one has; those that lose all they had go. n_chars is counted anew.

    Of rows that repeat the first keeps its text. NULL doc_ids come first in the order. A NULL or empty text has no line to lose and stays.
    Very long texts are aligned whole. No rows: none.
    """
    found = patience_dedup.without_repeats(shared.folded(docs, "text", "doc_id"))
    some = found.where((F.col("n_deleted") == 0) | F.col("text").rlike(r"[^ \t-\r]"))
    counted = [F.length("text").cast("bigint").alias("n_chars") if name == "n_chars" else column for name, column in zip(docs.columns, shared.unfolded(docs.columns, "text", "doc_id"), strict=True)]
    return some.select(counted)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity of 0.8 or more), the first.

    Pairs are proposed by the Golay keys of op4's fingerprints and by MinHash bands; the sets of shingles decide.

    Rows that repeat, and ties of one doc_id, leave one row. NULL texts and those without a word are copies of one another. A row with a
    NULL doc_id stays only where no row of its group has one. Very long texts are compared whole. No rows: none.
    """
    return golay_simhash.representatives(docs, near_copies.near_copies(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in files whose order is the mixture's.

    A NULL source is the source '', a NULL or empty text counts one character, a very long one takes as many blocks as it fills. Rows that
    repeat all stay; NULL doc_ids come first, ties go by a hash of the text. No rows: none.
    """
    return pfair_mixing.mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, numbered in the order of the files that hold them; where docs are no files, by doc_id.

    A NULL or empty text is the end id alone. Very long texts are cut like others. Rows that repeat, with one doc_id or none, are packed
    each for itself. No rows: no pieces.
    """
    try:
        place = docs.select("*", F.col("_metadata.file_name").alias("mix_file"), F.col("_metadata.row_index").alias("mix_row"))
    except AnalysisException:
        return binary_packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)
    number = F.coalesce(F.try_to_number(F.nullif(F.regexp_extract("mix_file", r"part-(\d+)", 1), F.lit("")), F.lit("9999999999")).cast("bigint"), F.lit(0))
    ordered = place.select("doc_id", "text", (F.call_function("shiftleft", number, F.lit(36)) + F.col("mix_row")).alias("mix_order"))
    return binary_packing.packed(ordered, public_tokenizers.path("word_bpe_49k.json"), order="mix_order", keep_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# Likelihoods, alignments and token ids can't be written in SQL; tests/llm/test_patience_and_mixing.py compares with loops.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each but the last is written as Parquet and read again by the next. NULLs, repeats and no rows: as in the stages."""
    docs = shared.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
