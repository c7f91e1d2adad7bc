"""What the field of op5 learns from where few or no pages give a lesson."""

from __future__ import annotations

from tallywork.llm import page_crf

UNMARKED = "<body><div><p>A page without any name has these words in it, and they are text.</p></div><nav><a>Menu</a></nav></body>"
MARKED = "<body><article><p>This is the main text of the page, a sentence of some words.</p></article><div class='comments'><p>nice one</p></div></body>"


def test_pages_that_give_a_lesson_are_found_among_many_that_do_not(spark):
    pages = spark.createDataFrame([(i, "u", MARKED if i % 100 == 7 else UNMARKED) for i in range(1000)], "page_id bigint, url string, html string")
    model = page_crf.fitted(pages, pages_used=5)
    assert model.steps.any() and model.weights[page_crf.FEATURES.index("article")] > 0


def test_furniture_stays_out_where_nothing_is_learned(spark):
    pages = spark.createDataFrame([(1, "u", UNMARKED)], "page_id bigint, url string, html string")
    assert page_crf.extracted(pages, page_crf.fitted(pages)).first()["text"] == "A page without any name has these words in it, and they are text."
