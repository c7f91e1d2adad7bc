"""Quality rules over line sequences: a conditional random field marks each line as content or boilerplate.

Counts and features of whole texts are taken with numpy, a slice of documents at a time; words, lines and
windows are numbered by dictionary encoding, so equality is exact. Lines of a document form a chain that
Viterbi decodes. A document stays if enough of its words are in content lines and the base rules hold.

Labels of lines are weak ones. A line is common if it stands between CONTEXTS or more different pairs of neighbours
in all documents together: copies of a document share a line with its neighbours, boilerplate goes from page to page
without them. Common lines, runs of symbols and the lines of poor documents are boilerplate, the other lines
of good documents content; so the field learns how both follow one another. That a line is common is a feature as well:
the counts are joined to the lines by hash, and the texts stay where they are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm import crf, shared, tokens

WINDOW = 8
FEWEST_WORDS = 20
MOST_REPEATED = 30
CONTENT_SHARE = 0.5
SAMPLE_DOCUMENTS = 2000
SAMPLE_LINES = 32
CONTEXTS = 3
SEED = 42

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
STOP = np.isin(np.arange(256), np.frombuffer(b".!?", np.uint8))
WHITE = b" \t\n\v\f\r"
FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80

FEATURES = (
    "few_words", "some_words", "many_words", "symbols", "heavy_symbols", "bars", "exclaims", "capitals", "digits",
    "repeats", "few_distinct", "long_words", "short_words", "stops", "ends_stop", "seen_before", "first", "last", "blank",
)
SYMBOL_RUN = FEATURES.index("heavy_symbols")


@dataclass
class Lines:
    """Counts of a slice of documents, and the features of their lines."""

    counts: dict[str, np.ndarray]
    features: np.ndarray
    words: np.ndarray
    lengths: np.ndarray
    hashes: np.ndarray


def _numbers(values: pa.Array) -> np.ndarray:
    return values.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _binary(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Binary values that begin at the given places, each up to the next one's."""
    ends = np.append(starts, len(data)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def _running(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])


def _hashed(data: np.ndarray, newline: np.ndarray, line_start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number and a hash for each line, equal for equal lines."""
    coded = _binary(data[~newline], line_start - _running(newline)[line_start]).dictionary_encode()
    number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    return number, np.fromiter((xxhash.xxh64_intdigest(line, SEED) for line in different), np.uint64, len(different)).view(np.int64)[number]


def measured(texts: pa.Array) -> Lines:
    """Counts and line features of whole texts without NULLs."""
    data, ends = tokens.bytes_of(texts)
    n_docs = len(texts)
    newline = data == 10
    breaks = np.flatnonzero(newline)
    doc_start, doc_end = ends[:-1], ends[1:]
    per_doc = np.searchsorted(breaks, doc_end) - np.searchsorted(breaks, doc_start) + 1
    line_doc = np.repeat(np.arange(n_docs), per_doc)
    first_line = np.concatenate([[0], np.cumsum(per_doc)])[:-1]
    # A document's lines begin at its start and after each of its breaks; a break that ends one text is followed by the next text's start.
    line_start = np.empty(len(line_doc), np.int64)
    inner = np.ones(len(line_doc), bool)
    inner[first_line] = False
    line_start[first_line] = doc_start
    line_start[inner] = breaks + 1
    line_end = np.empty(len(line_doc), np.int64)
    last_line = first_line + per_doc - 1
    inner[:] = True
    inner[last_line] = False
    line_end[last_line] = doc_end
    line_end[inner] = breaks

    dark = ~tokens.SPACE[data]
    word_first = dark.copy()
    word_first[1:] &= ~dark[:-1]
    begun = doc_start[doc_start < len(data)]
    word_first[begun] = dark[begun]
    dark_before = _running(dark)
    word_at = np.flatnonzero(word_first)
    word_begin = dark_before[word_at]
    word_size = np.diff(np.append(word_begin, dark_before[-1]))
    word = _numbers(_binary(data[dark], word_begin))
    words_before = _running(word_first)
    line_words = words_before[line_end] - words_before[line_start]
    doc_words = words_before[doc_end] - words_before[doc_start]
    doc_first_word = words_before[doc_start]

    def of_lines(flags: np.ndarray) -> np.ndarray:
        before = _running(flags)
        return before[line_end] - before[line_start]

    def of_docs(flags: np.ndarray) -> np.ndarray:
        before = _running(flags)
        return before[doc_end] - before[doc_start]

    code_points = FIRST_BYTE[data]
    symbols = SYMBOLS[data]
    line_number, hashes = _hashed(data, newline, line_start)
    owned = line_doc * (line_number.max(initial=0) + 1) + line_number
    _, first_of, which = np.unique(owned, return_index=True, return_inverse=True)
    seen = (line_words > 0) & (first_of[which] != np.arange(len(owned)))
    repeated = _repeated(word, doc_first_word, doc_words)
    repeated_before = _running(repeated)
    counts = {
        "n_words": doc_words,
        "word_chars": of_docs(code_points & dark),
        "n_symbols": of_docs(symbols),
        "n_dup_lines": np.bincount(line_doc[seen], minlength=n_docs),
        "n_repeat_words": repeated_before[doc_first_word + doc_words] - repeated_before[doc_first_word],
    }

    size = np.maximum(of_lines(code_points & dark), 1)
    some = np.maximum(line_words, 1)
    line_first_word = words_before[line_start]
    again = np.zeros(len(word), bool)
    again[1:] = word[1:] == word[:-1]
    starts_line = line_first_word[line_words > 0]
    again[starts_line] = False
    again_before = _running(again)
    word_line = np.repeat(np.arange(len(line_doc)), line_words)
    distinct = np.bincount(np.unique(word_line * (word.max(initial=0) + 1) + word) // (word.max(initial=0) + 1), minlength=len(line_doc))
    long_before, short_before = _running(word_size > 12), _running(word_size <= 2)
    line_last_word = line_first_word + line_words
    last_dark = np.zeros(len(line_doc), bool)
    has = line_words > 0
    last_byte = word_begin[np.maximum(line_last_word[has] - 1, 0)] + word_size[np.maximum(line_last_word[has] - 1, 0)] - 1
    last_dark[has] = STOP[data[dark][last_byte]]
    letters = np.maximum(of_lines(UPPER[data]) + of_lines((data >= 97) & (data <= 122)), 1)
    symbol_share = of_lines(symbols) / some
    rows = (
        (line_words > 0) & (line_words <= 4), (line_words > 4) & (line_words <= 12), line_words > 40,
        np.minimum(symbol_share, 1), symbol_share > 0.3, np.minimum(of_lines(data == 124) / some, 1), np.minimum(of_lines(data == 33) / some, 1),
        of_lines(UPPER[data]) / letters > 0.5, of_lines(DIGIT[data]) / size > 0.2,
        (again_before[line_last_word] - again_before[line_first_word]) / some, (distinct < 0.4 * line_words) & (line_words >= 8),
        (long_before[line_last_word] - long_before[line_first_word]) / some, (short_before[line_last_word] - short_before[line_first_word]) / some,
        np.minimum(of_lines(STOP[data]) / some, 1), last_dark, seen,
        np.arange(len(line_doc)) == np.repeat(first_line, per_doc), np.arange(len(line_doc)) == np.repeat(last_line, per_doc), line_words == 0,
    )
    return Lines(counts, np.stack([np.asarray(row, np.float32) for row in rows], axis=1), line_words, per_doc, np.where(line_words > 0, hashes, 0))


def _repeated(word: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Words that lie in a window found twice or more in their document."""
    out = np.zeros(len(word), bool)
    n = len(word) - WINDOW + 1
    if n <= 0:
        return out
    window, span = word, 1
    while span < WINDOW:
        window = _numbers(pa.array(window[:-span] * (window.max(initial=0) + 1) + window[span:]))
        span *= 2
    doc = np.repeat(np.arange(len(first)), count)
    own = np.flatnonzero(doc[:n] == doc[WINDOW - 1 :])
    if not len(own):
        return out
    code = _numbers(pa.array(window[own] * len(first) + doc[own]))
    twice = own[np.bincount(code)[code] > 1]
    edge = np.zeros(len(word) + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + WINDOW, -1)
    return np.cumsum(edge)[:-1] > 0


def _line_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the lines that have more than white space, in their order, for each document."""
    for batch in batches:
        texts = tokens.column(batch, "text")
        for a, b in tokens.slices(texts):
            lines = [[xxhash.xxh64_intdigest(line, SEED) for line in text.as_buffer().to_pybytes().split(b"\n") if line.strip(WHITE)] for text in texts.slice(a, b - a)]
            yield pa.RecordBatch.from_arrays([pa.array([np.array(own, np.uint64).view(np.int64) for own in lines], pa.list_(pa.int64()))], ["lines"])


def common_lines(documents: DataFrame, contexts: int = CONTEXTS) -> DataFrame:
    """The hashes of lines that stand between so many different pairs of neighbours, in all documents together.

    Equal pairs are dropped before the shuffle, and a line that very many documents hold is counted by its pairs first.
    """
    shared.with_code(documents.sparkSession)
    lines = documents.select("text").mapInArrow(_line_hashes, "lines array<bigint>")
    beside = F.transform("lines", lambda line, at: F.struct(line.alias("line"), F.xxhash64(F.get("lines", at - 1), F.get("lines", at + 1)).alias("context")))
    pairs = lines.select(F.explode(beside).alias("at")).select("at.line", "at.context").distinct()
    return shared.written(pairs.groupBy("line").count().where(F.col("count") >= contexts).select("line"), "common-lines")


def _sampler(most_lines: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tokens.column(batch, "text")
            quality, names = batch.column("quality").to_pylist(), batch.column("doc_id")
            for a, b in tokens.slices(texts):
                found = measured(texts.slice(a, b - a))
                ends = np.cumsum(found.lengths)
                for row in range(b - a):
                    n = int(min(found.lengths[row], most_lines))
                    begin = int(ends[row] - found.lengths[row] + (found.lengths[row] - n) // 2)
                    columns = [names.slice(a + row, 1), pa.array([quality[a + row]], pa.int32()), pa.array([found.features[begin : begin + n].tobytes()], pa.binary()), pa.array([found.hashes[begin : begin + n]], pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "quality", "features", "lines"])

    return sample


def weak_labels(features: np.ndarray, common: np.ndarray, quality: int) -> np.ndarray:
    """1 for content, 0 for boilerplate, of the lines of a document of some quality."""
    return ((quality == 1) & ~common & (features[:, SYMBOL_RUN] == 0)).astype(float)


def fitted(documents: DataFrame, labels: DataFrame, common: DataFrame, documents_used: int = SAMPLE_DOCUMENTS, lines_used: int = SAMPLE_LINES) -> crf.Model:
    """The field, from a bounded sample of labelled documents: of each, up to so many lines around its middle.

    The sample is the labelled doc_ids with the smallest hashes, one text for each; rows without a doc_id or quality are
    left out. Its last feature is whether a line is one of the common lines.
    """
    shared.with_code(documents.sparkSession)
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents_used)
    texts = documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id", "quality").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    sample = shared.written(texts.mapInArrow(_sampler(lines_used), "doc_id bigint, quality int, features binary, lines array<bigint>"), "line-sample")
    # At most documents_used * lines_used of them.
    held = sample.select(F.explode("lines").alias("line")).distinct().join(common, "line").collect()
    known_common = np.array(sorted(row["line"] for row in held), np.int64)
    parts, answers = [np.zeros((0, len(FEATURES) + 1))], [np.zeros(0)]
    for row in sample.orderBy("doc_id").collect():
        own = np.frombuffer(row["features"], np.float32).reshape(-1, len(FEATURES)).astype(float)
        is_common = np.isin(np.array(row["lines"], np.int64), known_common)
        parts.append(np.column_stack([own, is_common]))
        answers.append(weak_labels(own, is_common, row["quality"]))
    return crf.fit(np.concatenate(parts), np.concatenate(answers), np.array([len(part) for part in answers[1:]], np.int64))


COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
SCORED = f"doc_id bigint, {COUNTS}, words array<bigint>, scores array<double>, lines array<bigint>"
RESULT = f"doc_id bigint, {COUNTS}, base_failed boolean, kept boolean, n_lines bigint, n_content_lines bigint, content_share double, content array<boolean>"


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _scorer(model: crf.Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    local = crf.Model(model.weights[:-1], model.bias, model.steps, model.first)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, names = tokens.column(batch, "text"), batch.column("doc_id")
            for a, b in tokens.slices(texts):
                found = measured(texts.slice(a, b - a))
                ends = pa.array(np.concatenate([[0], np.cumsum(found.lengths)]), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(values)) for values in (found.words, local.scores(found.features.astype(float)), found.hashes)]
                yield pa.RecordBatch.from_arrays([names.slice(a, b - a), *map(pa.array, found.counts.values()), *lists], _names(SCORED))

    return score


def _decider(model: crf.Model, share: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            counts = {name: batch.column(name).to_numpy() for name in _names(COUNTS)}
            flat = {name: batch.column(name).flatten().to_numpy(zero_copy_only=False) for name in ("words", "scores", "common")}
            lengths = batch.column("words").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            before = np.concatenate([[0], np.cumsum(lengths)])
            flagged = np.repeat(before[:-1], batch.column("common").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)) + flat["common"].astype(np.int64)
            scores = flat["scores"].copy()
            scores[flagged] += model.weights[-1]
            marked = crf.viterbi(scores, lengths, model) == 1
            doc = np.repeat(np.arange(n), lengths)
            words = counts["n_words"]
            failed = (words < FEWEST_WORDS) | (100 * counts["n_repeat_words"] > MOST_REPEATED * words)
            part = np.bincount(doc, flat["words"] * marked, minlength=n) / np.maximum(words, 1)
            columns = [failed, ~failed & (part >= share), lengths, np.bincount(doc, marked, minlength=n).astype(np.int64), part]
            content = pa.ListArray.from_arrays(pa.array(before, pa.int32()), pa.array(marked))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, counts.values()), *map(pa.array, columns), content], _names(RESULT))

    return decide


def judged(documents: DataFrame, model: crf.Model, common: DataFrame, share: float = CONTENT_SHARE) -> DataFrame:
    """Counts, base rules, verdict and the lines that are content, for each document; see RESULT for the columns.

    A NULL or empty text is one empty line: no words, so the base rules fail. Very long texts are measured whole. Rows
    that repeat, and rows with one doc_id or none, are judged each for itself. No documents: no rows. Other columns are
    ignored. A text is measured in the task that reads it; what meets the common lines is a hash of each line.
    """
    shared.with_code(documents.sparkSession)
    scored = documents.select("doc_id", "text").mapInArrow(_scorer(model), SCORED)
    rows = shared.written(scored.withColumn("id", F.monotonically_increasing_id()), "line-scores")
    lines = rows.select("id", F.posexplode("lines").alias("at", "line")).where("line <> 0")
    found = lines.join(common, "line").groupBy("id").agg(F.collect_list("at").alias("common"))
    met = rows.drop("lines").join(found, "id", "left").withColumn("common", F.coalesce("common", F.array().cast("array<int>")))
    return met.mapInArrow(_decider(model, share), RESULT)
