"""Which elements of a page are hidden."""

from __future__ import annotations

import pytest

from tallywork.llm import page_crf


@pytest.mark.parametrize("attributes", ['style="overflow:hidden"', 'class="overflow-hidden"', 'aria-hidden="false"', 'title="a hidden gem"', "data-hidden=1", "data-x='display:none'", 'style="backface-visibility:hidden"'])
def test_an_article_in_a_wrapper_that_is_shown_stays(attributes):
    found = page_crf.blocks(f"<body><div {attributes}><article><p>Main text of it.</p></article></div></body>")
    assert [(block[0], block[1]) for block in found] == [("Main text of it.", page_crf.ARTICLE)]


@pytest.mark.parametrize("attributes", ["hidden", 'class="x" hidden=""', "HIDDEN", 'style="color:red; display : none"', "style='visibility:hidden'", "aria-hidden=true", 'aria-hidden="TRUE"'])
def test_what_is_hidden_goes(attributes):
    found = page_crf.blocks(f"<body><article><p>Main text of it.</p><div {attributes}><p>Not shown.</p></div></article></body>")
    assert [block[1] == page_crf.ARTICLE for block in found] == [True, False]
