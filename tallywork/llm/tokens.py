"""Token ids of whole texts by the tokenizers library, a distinct word at a time.

Byte-pair merges never cross the splits of the pre-tokenizer. A batch of texts is cut with numpy at places
where both kinds of pre-tokenizer used here (letter runs, number runs, other runs, white space in front or
dropped) always split, equal pieces are found by dictionary encoding, and only pieces that the worker has
not met yet go through the tokenizer. Where a split isn't certain no cut is made, and a text with an added token
of the file is one piece, so the ids are those of the whole text (`tests/llm/test_tokens.py`, `test_added_tokens.py`).
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
WORDS_KEPT = 400_000
WORD_BYTES = 1 << 10

_encoders: dict[tuple[str, bool], "Encoder"] = {}


def _classes() -> tuple[np.ndarray, ...]:
    """For each byte, as tables for bytes.translate: what it may end (1 something visible, 2 letters), what it may
    begin (1 white space, 2 a mark, and 4 something visible), and whether it leads in a character (1) or breaks a line (2)."""
    code = np.arange(256)
    space = (code == 32) | ((code >= 9) & (code <= 13))
    letter = ((code >= 65) & (code <= 90)) | ((code >= 97) & (code <= 122))
    visible = (code >= 0x21) & (code <= 0x7E)
    mark = visible & ~letter & (code != 0x27)
    lead = (code >= 0xC3) & (code <= 0xC9)
    tables = visible + 2 * letter, space + 2 * mark + 4 * (visible | lead), lead + 2 * (space & (code != 32))
    return space, *(table.astype(np.uint8).tobytes() for table in tables)


SPACE, ENDS, BEGINS, RARE = _classes()
LOWER = bytes(code | 0x20 if 65 <= code <= 90 else code for code in range(256))


def cuts(data: np.ndarray) -> np.ndarray:
    """Where in UTF-8 bytes a new piece may begin.

    White space after a visible character, a mark or digit (but no apostrophe) after a letter, and a visible
    character after a lone white-space byte other than a blank. Of characters beyond ASCII only U+00C0 to
    U+027F count as visible, and as letters without the two arithmetic signs and the dotted capital I among
    them, whose small form ends with a mark.
    """
    found = np.zeros(len(data), bool)
    if len(data) < 2:
        return found
    raw = data.tobytes()
    ends = np.frombuffer(bytearray(raw.translate(ENDS)), np.uint8)
    begins = np.frombuffer(raw.translate(BEGINS), np.uint8)
    rare = np.frombuffer(raw.translate(RARE), np.uint8)
    at = np.flatnonzero(rare)
    lead, lone = at[(rare[at] == 1) & (at < len(data) - 1)], at[(rare[at] == 2) & (at > 0) & (at < len(data) - 1)]
    first, second = data[lead], data[lead + 1]
    sign = ((first == 0xC3) & ((second == 0x97) | (second == 0xB7))) | ((first == 0xC4) & (second == 0xB0))
    ends[lead + 1] = np.where(sign, 1, 3)
    found[1:] = (ends[:-1] & begins[1:]) != 0
    found[lone + 1] |= (ends[lone - 1] & 1 != 0) & (begins[lone + 1] & 4 != 0)
    return found


class Encoder:
    """One tokenizer file with the ids of the pieces met so far; at most WORDS_KEPT of them are kept, none above WORD_BYTES.

    With `added`, an added token that a text spells is that one token, as the library's plain call has it; else it is text.
    """

    def __init__(self, path: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        found = self.tokenizer.get_added_tokens_decoder().values() if added else []
        self.added = [(token.content, token.normalized) for token in found]
        # Runs of marks have no case: without one of these no added token is spelled. Where a token has none, all texts are searched.
        marks = [max(re.findall(r"[!-/:-@\[-`{-~]+", content), key=len, default="") for content, _ in self.added]
        self.marks = {mark.encode() for mark in marks}
        self.size = self.tokenizer.get_vocab_size()
        self.lower = "Lowercase" in str(self.tokenizer.normalizer)
        self.known: dict[bytes, bytes] = {}

    def _pieces(self, words: list[bytes]) -> list[bytes]:
        out = list(map(self.known.get, words))
        missing = [word for word, ids in zip(words, out, strict=True) if ids is None]
        if not missing:
            return out
        if len(self.known) + len(missing) > WORDS_KEPT:
            self.known = {}
            missing = words
        for at in range(0, len(missing), 50_000):
            part = missing[at : at + 50_000]
            encoded = self.tokenizer.encode_batch_fast([word.decode() for word in part], add_special_tokens=False)
            for word, tokens in zip(part, encoded, strict=True):
                self.known[word] = np.array(tokens.ids, "<u4").tobytes()
        out = [self.known[word] for word in words]
        for word in missing:
            if len(word) > WORD_BYTES:
                self.known.pop(word, None)
        return out

    def _whole(self, texts: pa.Array, data: np.ndarray) -> np.ndarray:
        """Rows of texts, of which data are the bytes, that spell an added token."""
        raw = data.tobytes()
        if not any(mark in raw for mark in self.marks):
            return np.zeros(0, np.int64)
        found = np.zeros(len(texts), bool)
        for content, normalized in self.added:
            found |= pc.match_substring(texts, content, ignore_case=normalized).to_numpy(zero_copy_only=False)
        return np.flatnonzero(found)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's ids begin (one more: the end)."""
        data, ends = bytes_of(texts)
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(texts) + 1, np.int64)
        whole, given = self._whole(texts, data), data
        if self.lower:
            data = np.frombuffer(bytearray(data.tobytes().translate(LOWER)), np.uint8)
        begin = cuts(data)
        for row in whole:
            begin[ends[row] : ends[row + 1]] = False
            if self.lower:
                data[ends[row] : ends[row + 1]] = given[ends[row] : ends[row + 1]]
        begin[ends[:-1][ends[:-1] < len(data)]] = True
        at = np.flatnonzero(begin)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(data)).astype(np.int64)), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False)
        known = self._pieces(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat = np.frombuffer(b"".join(known), "<u4")
        lengths = np.fromiter(map(len, known), np.int64, len(known)) >> 2
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        each = lengths[which]
        until = np.concatenate([[0], np.cumsum(each)])
        out = flat[np.repeat(starts[which] - until[:-1], each) + np.arange(until[-1])]
        return out, until[np.searchsorted(at, ends)]


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of texts without NULLs, and where each begins (one more: the end)."""
    texts = texts.cast(pa.large_string())
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]] if buffers[2] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about so many bytes; a longer text is a slice of its own."""
    if not len(texts):
        return
    _, ends = bytes_of(texts)
    first = 0
    for row in range(1, len(texts) + 1):
        if row == len(texts) or ends[row + 1] - ends[first] > most:
            yield first, row
            first = row


def encoder(path: str, added: bool = False) -> Encoder:
    """The worker's encoder for a tokenizer file; it keeps its pieces from task to task."""
    if (path, added) not in _encoders:
        _encoders[path, added] = Encoder(path, added)
    return _encoders[path, added]


def forget() -> None:
    """Drop the worker's encoders with the pieces they keep."""
    _encoders.clear()


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text column of a batch with NULL as the empty text."""
    return batch.column(name).cast(pa.large_string()).fill_null("")


def documents_ids(texts: pa.Array, path: str, end_id: int, added: bool = False) -> Iterator[tuple[int, np.ndarray]]:
    """Each row's number and its ids with the end id, a slice of rows in memory at a time."""
    own = encoder(path, added)
    for first, last in slices(texts):
        ids, at = own.ids(texts.slice(first, last - first))
        # Room for an end id after each text: the rows are views of one array.
        rows = np.arange(last - first)
        every = np.full(len(ids) + len(rows), end_id, "<u4")
        every[np.arange(len(ids)) + np.repeat(rows, np.diff(at))] = ids
        bounds = (at + np.arange(len(at))).tolist()
        for row in rows.tolist():
            yield first + row, every[bounds[row] : bounds[row + 1]]
