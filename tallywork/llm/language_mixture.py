"""Language of a text as a mixture: expectation-maximisation over n-gram likelihoods, and a penalised choice of languages.

Letter trigrams (other characters are one blank) fall into a fixed number of cells. Spark adds up their counts
by language over all labelled training documents; the table of logarithms has cells times languages entries,
whatever the corpus. Of a text, each trigram is drawn from one of its languages; EM finds their proportions.
A set of languages has its likelihood less a penalty for each beyond the first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.llm import shared, tokens

SLICE_BYTES = 1 << 20
CELL_BITS = 16
SMOOTHING = 0.5
ROUNDS = 12
LEAST_SHARE = 0.02
PENALTY = 10.0
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"


@dataclass(frozen=True)
class Languages:
    """Names, and the logarithm of each cell's chance in each language."""

    names: list[str]
    chances: np.ndarray


@cache
def _folding() -> np.ndarray:
    """Each code point's small letter, 0 for what is no letter."""
    every = [chr(code) for code in range(0x110000)]
    return np.array([ord(c.lower()[0]) if c.isalpha() else 0 for c in every], np.uint32)


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number and cell of each trigram, and how many letters each document has.

    Runs of other characters, and both ends of a text, count as one blank each.
    """
    parts = [text.as_py().encode("utf-32-le", "replace") for text in texts]
    lengths = np.fromiter((len(part) >> 2 for part in parts), np.int64, len(parts))
    doc = np.repeat(np.arange(len(parts)), lengths + 2)
    folded = np.zeros(len(doc), np.uint32)
    inner = np.ones(len(doc), bool)
    ends = np.cumsum(lengths + 2)
    inner[ends - 1] = False
    inner[ends - lengths - 2] = False
    folded[inner] = _folding()[np.frombuffer(b"".join(parts), "<u4")]
    letters = np.bincount(doc, folded > 0, minlength=len(parts)).astype(np.int64)
    keep = folded > 0
    keep[1:] |= folded[:-1] > 0
    keep[:-1] |= (folded[1:] > 0) & ~inner[:-1]
    folded, doc = folded[keep].astype(np.uint64), doc[keep]
    if len(folded) < 3:
        return doc[:0], folded[:0].astype(np.int64), letters
    mixed = (folded[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ folded[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) ^ folded[2:] * np.uint64(0x165667B19E3779F9)) * np.uint64(0xFF51AFD7ED558CCD)
    same = (doc[:-2] == doc[2:]) & (folded[1:-1] > 0)
    return doc[:-2][same], (mixed >> np.uint64(64 - CELL_BITS)).astype(np.int64)[same], letters


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        names = np.array(batch.column("lang").to_pylist(), object)
        texts = tokens.column(batch, "text")
        for a, b in tokens.slices(texts, SLICE_BYTES):
            doc, cell, _ = trigrams(texts.slice(a, b - a))
            for name in set(names[a:b]):
                own = counts.setdefault(name, np.zeros(1 << CELL_BITS, np.int64))
                own += np.bincount(cell[(names[a:b] == name)[doc]], minlength=1 << CELL_BITS)
    for name, own in counts.items():
        cells = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(cells), pa.string()), pa.array(cells.astype(np.int32)), pa.array(own[cells])], ["lang", "cell", "n"])


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; one without a doc_id is neither held out nor learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def learned(documents: DataFrame) -> Languages:
    """The languages of all training documents: text and lang not NULL, doc_id given and not held out.

    Each task sends at most cells times languages rows, and as many reach the driver. No such document: no languages.
    """
    shared.with_code(documents.sparkSession)
    training = documents.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = training.select("lang", "text").mapInArrow(shared.sparing(_counter), "lang string, cell int, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    language = np.array(found.column("lang").to_pylist(), object)
    names = sorted(set(language))
    table = np.zeros((1 << CELL_BITS, len(names)))
    cell, n = found.column("cell").to_numpy(), found.column("n").to_numpy()
    for number, name in enumerate(names):
        own = language == name
        table[cell[own], number] = n[own]
    table += SMOOTHING
    return Languages(names, np.log(table / table.sum(axis=0)) if names else table)


def proportions(doc: np.ndarray, n: np.ndarray, chances: np.ndarray, documents: int, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM: each document's language shares among those allowed to it, and its log-likelihood under them.

    doc (ascending), n and chances (not logarithms) have a row for each distinct trigram of each document.
    """
    share = allowed / np.maximum(allowed.sum(axis=1, keepdims=True), 1)
    at = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    own = doc[at]
    total = np.add.reduceat(n, at) if len(at) else n[:0]
    likelihood = np.zeros(documents)
    for _ in range(ROUNDS):
        joint = share[doc] * chances
        sums = joint.sum(axis=1)
        if len(at):
            share[own] = np.add.reduceat(joint * (n / sums)[:, None], at, axis=0) / total[:, None]
    if len(at):
        likelihood[own] = np.add.reduceat(n * np.log((share[doc] * chances).sum(axis=1)), at)
    return share, likelihood


def mixtures(texts: pa.Array, languages: Languages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's shares of the languages of its chosen set, whether it has a letter, and how sure its first language is.

    From the best language alone, the one with the next share under all languages joins while that raises the
    log-likelihood by more than PENALTY times the logarithm of the number of trigrams.
    """
    doc, cell, letters = trigrams(texts)
    documents, width = len(texts), len(languages.names)
    pair, n = np.unique(doc << CELL_BITS | cell, return_counts=True)
    doc, logs = pair >> CELL_BITS, languages.chances[pair & ((1 << CELL_BITS) - 1)]
    n = n.astype(float)
    alone = np.stack([np.bincount(doc, n * logs[:, i], minlength=documents) for i in range(width)], axis=1)
    best = alone.argmax(axis=1)
    count = np.bincount(doc, n, minlength=documents)
    price = PENALTY * np.log(count + 1)
    chosen = np.zeros((documents, width))
    chosen[np.arange(documents), best] = 1
    shares, score = chosen.copy(), alone.max(axis=1)
    sure = np.exp(score - np.logaddexp.reduce(alone, axis=1))
    # A text's likelihood under any mixture is below that of the best language for each trigram on its own.
    bound = np.bincount(doc, n * logs.max(axis=1), minlength=documents)
    open_ = bound - score > price
    chances = np.exp(logs)
    full = np.zeros((documents, width))
    rows = open_[doc]
    if rows.any():
        full, together = proportions(doc[rows], n[rows], chances[rows], documents, np.ones((documents, width)))
        open_ &= together - score > price
    for _ in range(width - 1):
        waiting = np.where((chosen > 0) | (full < LEAST_SHARE), -1.0, full)
        following = waiting.argmax(axis=1)
        open_ &= waiting.max(axis=1) > 0
        rows = open_[doc]
        if not rows.any():
            break
        wider = chosen.copy()
        wider[np.flatnonzero(open_), following[open_]] = 1
        share, likelihood = proportions(doc[rows], n[rows], chances[rows], documents, wider)
        open_ &= likelihood - score > price
        chosen[open_], shares[open_], score[open_] = wider[open_], share[open_], likelihood[open_]
    sure = np.where(chosen.sum(axis=1) > 1, shares.max(axis=1), sure)
    return shares, letters > 0, np.clip(sure, 0, 1)


ADDED = ("lang_pred", "score", "languages")


def _predictor(languages: Languages, kept: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tokens.column(batch, "text")
            for a, b in tokens.slices(texts, SLICE_BYTES):
                shares, known, sure = mixtures(texts.slice(a, b - a), languages) if languages.names else (np.zeros((b - a, 1)), np.zeros(b - a, bool), np.zeros(b - a))
                first = shares.argmax(axis=1)
                names = [languages.names[i] if k else UNKNOWN for i, k in zip(first, known, strict=True)]
                several = [",".join(f"{languages.names[i]}:{row[i]:.3f}" for i in np.argsort(-row, kind="stable") if row[i] > 0) if k else "" for row, k in zip(shares, known, strict=True)]
                columns = [*(batch.column(name).slice(a, b - a) for name in kept), pa.array(names, pa.string()), pa.array(np.where(known, sure, 0.0)), pa.array(several, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*kept, *ADDED])

    return predict


def with_language(documents: DataFrame, languages: Languages, keep: list[str] | None = None) -> DataFrame:
    """The documents, or the columns asked for, with lang_pred, score and languages (name:share of the chosen set, by share).

    score is the first language's share of a mixture, or the chance of the only language among all single
    ones. A NULL or empty text or one without a letter is `und` with score 0, as is every text where nothing
    was learned. Rows that repeat are answered each for itself; no documents: no rows. Other columns, such as
    lang and source, are never looked at; those with one of the three names are replaced.
    """
    shared.with_code(documents.sparkSession)
    kept = [name for name in keep or documents.columns if name not in ADDED]
    schema = documents.select(*(f"`{name}`" for name in kept)).schema
    for name, kind in zip(ADDED, ("string", "double", "string"), strict=True):
        schema = schema.add(name, kind)
    seen = documents.select(*(f"`{name}`" for name in dict.fromkeys([*kept, "text"])))
    return seen.mapInArrow(shared.sparing(_predictor(languages, kept)), schema)
