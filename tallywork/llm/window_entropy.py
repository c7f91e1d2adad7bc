"""Secrets: fixed patterns, and strings in which a sliding window has high Shannon entropy.

Candidates are the runs of a character class. A window of fixed width slides over a run; of each character that
enters or leaves only its own count changes, so the sum of c * log2(c) over the window's counts is carried from
place to place and a run costs no more than its length (times the logarithm of it, for the sort that finds a
character's neighbours of its kind). The sums are whole numbers, in units of 2^-20 bits: no rounding decides.
Windows at or above the least entropy of the class are joined to spans. What the allow-list matches is no secret,
nor is anything in it. A row's work needs no other row: nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.llm import shared, tokens

UNIT = 1 << 20


@dataclass(frozen=True)
class Pattern:
    """A base kind: a pattern, the group that is the secret, and the least length of that."""

    name: str
    pattern: str
    group: int
    least: int


@dataclass(frozen=True)
class CharacterClass:
    """Runs of the characters of a class, seen through windows; `needs` are patterns that a span has to have, all of them."""

    name: str
    characters: str
    window: int
    least_bits: float
    needs: tuple[str, ...]

    @property
    def runs(self) -> str:
        return f"[{self.characters}]{{{self.window},}}"


# The patterns of the base kinds, in the order in which spans with one start are listed.
BASE = (
    Pattern("assign", r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    Pattern("access", r"AKIA[A-Z0-9]+", 0, 20),
    Pattern("hex", r"[0-9a-f]+", 0, 24),
)
CLASSES = (
    CharacterClass("high_hex", "0-9A-Fa-f", 20, 3.0, ("[0-9]", "[A-Fa-f]")),
    CharacterClass("high_base64", "A-Za-z0-9+/_=-", 24, 3.9, ("[0-9]", "[A-Za-z]")),
    CharacterClass("high_visible", "!-~", 24, 4.1, ("[0-9]", "[A-Z]", "[a-z]", "[^A-Za-z0-9+/_=-]")),
)
# What looks random and is none: web and mail addresses, identifiers and digests that are public by their form,
# keys that documentation uses as examples, alphabets. Looking back keeps a long run from being read from each place.
ALLOWED = (
    r"(?<![a-z])[a-z]+://[!-~]+",
    r"(?<![!-~])[!-~]+@[A-Za-z0-9.-]+",
    r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",
    r"(?:md5|sha1|sha224|sha256|sha384|sha512)[-:=][0-9A-Za-z+/=]+",
    r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]*EXAMPLE(?:KEY)?",
    r"(?:0123456789|[aA][bB][cC][dD][eE][fF][gG][hH])[0-9A-Za-z+/_=-]*",
)

# A row without so many visible characters side by side and without a word of an assignment has no secret.
_SOME = rf"[!-~]{{{min([20, *(kind.window for kind in CLASSES)])}}}|(?i:password|passwd|secret|token|api_?key)"
# The greedy match is the whole run, so a run that is too short need not be met.
_WITHIN = {"hex": "[0-9a-f]{24,}", "access": "AKIA[A-Z0-9]{16,}"}

SPANS = "array<struct<kind: string, start: bigint, end: bigint, value: string, entropy: bigint>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("entropy", pa.int64())])


def weights(window: int) -> np.ndarray:
    """c * log2(c) in units for the counts 0 to window."""
    return np.array([0] + [int(np.floor(c * np.log2(c) * UNIT + 0.5)) for c in range(1, window + 1)], np.int64)


def entropies(run: str, window: int) -> np.ndarray:
    """The window's entropy times its width, in units, at each place of a run of ASCII that it can begin at.

    weight[c] - weight[c - 1] is what a character adds that is the c-th of its kind in the window, and takes away
    when it leaves. Its count follows from its place among the places of its kind.
    """
    codes = np.frombuffer(run.encode(), np.uint8).astype(np.int64)
    n, apart = len(codes), len(codes) + window + 1
    order = np.argsort(codes, kind="stable")
    keys = codes[order] * apart + order
    number = np.arange(n)
    gain = np.diff(weights(window))
    entering, leaving = np.empty(n, np.int64), np.empty(n, np.int64)
    entering[order] = gain[number - np.searchsorted(keys, keys - window, "right")]
    leaving[order] = gain[np.searchsorted(keys, keys + window, "left") - number - 1]
    # The first window only fills: the counts of what has entered so far are those of a window that leaves nothing.
    change = entering.copy()
    change[window:] -= leaving[: n - window]
    return weights(window)[-1] - np.cumsum(change)[window - 1 :]


def high_spans(run: str, kind: CharacterClass) -> list[tuple[int, int, int]]:
    """Start, end and highest entropy (thousandths of a bit a character) of what windows at the least entropy cover."""
    found = entropies(run, kind.window)
    at = np.flatnonzero(found >= int(kind.least_bits * kind.window * UNIT))
    if not len(at):
        return []
    first = np.flatnonzero(np.concatenate([[True], np.diff(at) > kind.window]))
    last = np.append(first[1:], len(at)) - 1
    best = np.maximum.reduceat(found[at], first) * 1000 // (kind.window * UNIT)
    return list(zip(at[first].tolist(), (at[last] + kind.window).tolist(), best.tolist(), strict=True))


class Cover:
    """Spans, to be asked whether another one lies in one of them."""

    def __init__(self, spans: list[tuple[int, int]]):
        spans = sorted(spans)
        self.starts = [start for start, _ in spans]
        self.reach = list(accumulate((end for _, end in spans), max))

    def holds(self, start: int, end: int) -> bool:
        before = bisect_right(self.starts, start)
        return before > 0 and self.reach[before - 1] >= end


def base_spans(text: str) -> list[tuple]:
    """Confirmed matches of the base kinds by start, then kind."""
    found = []
    for order, kind in enumerate(BASE):
        for match in re.finditer(_WITHIN.get(kind.name, kind.pattern), text):
            if match.end(kind.group) - match.start(kind.group) >= kind.least:
                found.append((match.start(), order, match.end(), match.group()))
    return [(BASE[order].name, start, end, value, None) for start, order, end, value in sorted(found)]


def added_spans(text: str, base: list[tuple], classes: Sequence[CharacterClass] = CLASSES, allowed: Sequence[str] = ALLOWED) -> list[tuple]:
    """Spans of high entropy by start. One that lies in a base span, or in one of an earlier class, is left out."""
    taken = [(start, end) for _, start, end, *_ in base]
    out, known = [], None
    for kind in classes:
        cover, own = Cover(taken), []
        for run in re.finditer(kind.runs, text):
            for start, end, best in high_spans(run.group(), kind):
                start, end = run.start() + start, run.start() + end
                value = text[start:end]
                if cover.holds(start, end) or not all(re.search(need, value) for need in kind.needs):
                    continue
                if known is None:
                    known = Cover([match.span() for pattern in allowed for match in re.finditer(pattern, text)])
                if not known.holds(start, end):
                    own.append((kind.name, start, end, value, best))
        taken += [(start, end) for _, start, end, *_ in own]
        out += own
    return sorted(out, key=lambda span: span[1])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.name for field in _SPAN]
    for batch in batches:
        texts = tokens.column(batch, "text")
        for first, last in tokens.slices(texts):
            part = texts.slice(first, last - first)
            some = np.flatnonzero(pc.match_substring_regex(part, _SOME).to_numpy(zero_copy_only=False))
            base: list[list] = [[] for _ in range(len(part))]
            every: list[list] = [[] for _ in range(len(part))]
            for row in some.tolist():
                text = part[row].as_py()
                own = base_spans(text)
                more = added_spans(text, own)
                # Base spans of one start come before added ones, as kinds are listed.
                for out, spans in ((base, own), (every, sorted(own + more, key=lambda span: span[1]) if more else own)):
                    out[row] = [dict(zip(names, span, strict=True)) for span in spans]
            columns = [batch.column("doc_id").slice(first, last - first), pa.array(base, pa.list_(_SPAN)), pa.array(every, pa.list_(_SPAN))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "base_spans", "spans"])


def secrets(documents: DataFrame) -> DataFrame:
    """doc_id, base_spans and spans: arrays of (kind, start, end, value, entropy), by start and then kind.

    Positions count code points from 0, the end excluded; entropy is that of the best window in thousandths of a
    bit a character, NULL for the base kinds. `spans` has all base spans and those of high entropy that lie in
    none of them, have what their class needs and lie in nothing on the allow-list.
    A NULL or empty text has none. Very long texts and very long runs are scanned whole, in time proportional to
    their length. Rows that repeat, and rows with one doc_id or none, are answered each for itself. No documents: no
    rows. Other columns are ignored, whatever their names.
    """
    shared.with_code(documents.sparkSession)
    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_scan, f"doc_id bigint, base_spans {SPANS}, spans {SPANS}")


def listed(spans: Column, entropy: bool = False) -> Column:
    """kind:start:end of all spans, joined by commas; with the entropy as a fourth part where asked for and there is one."""
    names = ["kind", "start", "end"] + ["entropy"] * entropy
    return F.concat_ws(",", F.transform(spans, lambda span: F.concat_ws(":", *(span[name].cast("string") for name in names))))


def counted(spans: Column, kind: str) -> Column:
    """How many spans of a kind there are."""
    return F.size(F.filter(spans, lambda span: span["kind"] == kind)).cast("bigint")
