"""Spans of personal data against Python's regular expressions."""

from __future__ import annotations

import hashlib
import random
import re
import time

from odd_rows import SMALL, rows
from pyspark.sql import functions as F

from tallywork.llm import pii_spans, registered

PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def slow(text: str | None) -> list[str]:
    out = []
    for kind, pattern in PATTERNS:
        for found in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", found[0])
            if kind == "ip" and any(int(part) > 255 for part in found[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{found.start()}:{found.end()}")
    return out


def check(spark, texts: list[str | None]) -> None:
    found = pii_spans.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    for row in found.select("doc_id", pii_spans.listed(F.col("base_spans")).alias("spans")).collect():
        assert row["spans"] == ",".join(slow(texts[row["doc_id"]])), texts[row["doc_id"]]


def test_documents(spark):
    found = registered.op10_pii_spans(spark, SMALL)
    assert found.columns[:7] == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    texts = dict(map(tuple, spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()))
    rows = found.collect()
    assert len(rows) == len(texts) and sum(row["n_card"] for row in rows) > 0
    for row in rows:
        spans = slow(texts[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert row["spans"].startswith(",".join(spans))
        assert [row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]] == [sum(x.startswith(kind) for x in spans) for kind, _ in PATTERNS]


def test_random_signs(spark):
    dice = random.Random(5)
    signs = ["a", "b@", "@", ".", "..", "%", "-", "1", "25", "255.", "256", "0001.", "+", "+1 (", ") ", " ", "\n", "é", "😀", "4111 1111 1111 1111", "4012-8888-8888-1881", "x@y.z", "%d@e.f", "1.2.3.4"]
    check(spark, ["".join(dice.choice(signs) for _ in range(dice.randrange(1, 40))) for _ in range(6000)])


def test_corner_cases(spark):
    check(spark, ["a@b.c%d@e.f", "1.2.3.4.5.6.7.8", "0.0.0.00000000000000000255", "9" * 400, "a" * 20000 + "@b.c", "a." * 20000, "a@" + "b." * 20000 + "c", "+1" + " " * 5000 + "2345678", "1 " * 10000, None, "", "4111111111111111 " * 2000, "1.1.1.1 " * 3000])


def test_checksums_and_context(spark):
    texts = [
        "my IBAN is GB82 WEST 1234 5698 7654 32.",
        "GB82 WEST 1234 5698 7654 33 is wrong",
        "xGB82WEST12345698765432 touches a letter",
        "DE89370400440532013000",
        "amex card 378282246310005 here",
        "number 378282246310005 here",
        "SSN: 078-05-1120",
        "order 078-05-1120",
        "card 123-45-6789-000",
    ]
    found = registered.pii_spans.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    got = {row["doc_id"]: [(x["kind"], x["value"]) for x in row["spans"]] for row in found.collect()}
    assert got == {
        0: [("iban", "GB82 WEST 1234 5698 7654 32")],
        1: [], 2: [], 3: [("iban", "DE89370400440532013000")], 4: [("short_card", "378282246310005")], 5: [], 6: [("ssn", "078-05-1120")], 7: [], 8: [],
    }


def test_scores_rise_with_words_nearby(spark):
    texts = [(0, "call +1 (555) 555-0100 now"), (1, "xyz +1 (555) 555-0100 now"), (2, "phone " + "z" * 50 + " +1 (555) 555-0100")]
    rows = pii_spans.personal_data(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    assert {row["doc_id"]: row["spans"][0]["score"] for row in rows} == {0: 85, 1: 60, 2: 60}


def test_odd_documents(odd, empty):
    found = pii_spans.personal_data(odd)
    assert sorted((row["doc_id"] or -1, len(row["spans"])) for row in found.collect()) == sorted((row[0] or -1, len(slow(row[1]))) for row in rows())
    assert pii_spans.personal_data(empty).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("Exchange RoundRobinPartitioning", "") and "Python" not in plan


def test_a_long_text_of_cards_and_codes_takes_time_in_proportion(spark):
    """Half a megabyte of cards, short cards and account codes side by side."""
    unit = "card 4539578763621486 or code 378282246310005 iban DE89 3704 0044 0532 0130 00 BIC "
    n = 6000
    df = spark.createDataFrame([(1, unit * n)], "doc_id bigint, text string")
    began = time.perf_counter()
    row = pii_spans.personal_data(df).select(F.size("base_spans").alias("base"), F.size("spans").alias("every")).first()
    assert row["base"] >= n and row["every"] >= 2 * n - 10
    assert time.perf_counter() - began < 60


def test_free_and_apart_are_those_of_loops(spark):
    dice = random.Random(3)
    kind = "array<struct<start:int,end:int>>"
    rows, expected = [], []
    for _ in range(60):
        draw = lambda n, most: sorted((a := dice.randrange(400), a + dice.randrange(1, most)) for _ in range(n))
        spans, taken = draw(dice.randrange(150), 12), draw(dice.randrange(20), 9)
        free = [s for s in spans if not any(t[0] < s[1] and s[0] < t[1] for t in taken)]
        kept, end = [], 0
        for s in free:
            if end <= s[0]:
                kept, end = [*kept, s], s[1]
        rows.append((spans, taken))
        expected.append((free, kept))
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, spans {kind}, taken {kind}")
    for row in df.select("i", pii_spans._free(F.col("spans"), F.col("taken")).alias("free"), pii_spans._apart(F.col("spans"), F.col("taken")).alias("kept")).collect():
        assert ([tuple(s) for s in row["free"]], [tuple(s) for s in row["kept"]]) == expected[row["i"]]
