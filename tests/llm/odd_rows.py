"""Documents with NULLs in each column, empty and very long texts, ties, repeated rows, and clashing names."""

from __future__ import annotations

import random

SMALL = "/root/testdata/sf0.001"
#: Names that operators use inside, as other columns of their input.
CLASHING = ("row", "own", "range", "key", "at", "gone", "block", "slot", "base", "parts", "phase", "used", "until", "fingerprint", "length", "order", "score_", "kept_own", "first", "words", "first_id", "mix_run", "n")

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows() -> list[tuple]:
    """Documents with NULLs in each column, empty and very long texts, ties and repeated rows."""
    dice = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    line = lambda n: " ".join(dice.choice(words) for _ in range(n))
    passage = line(60)
    long = "\n".join(line(12) for _ in range(3000))
    texts = [line(30) + "\n" + passage + "\n" + line(25), passage, None, "", " \t\r\n ", long, "Ünïcode ßtraße \U0001f600 " * 30, "!!! ???", "\n\n\n", "x" * 50_000]
    out = [(i, text, "en" if i % 2 else None, "s1" if i % 3 else None, None) for i, text in enumerate(texts)]
    out += [(3, "another text under the same doc_id " + line(20), "fr", "s2", 5), (None, line(40), "en", "s2", 9), (None, None, None, None, None)]
    out += [out[0], out[0], out[5][:1] + (texts[5],) + out[5][2:], (40, texts[0], "en", "s1", 1), (41, texts[0] + " more", "en", "s1", 1)]
    return out
