"""Main text of web pages: a conditional random field over a page's leaf blocks, decoded by Viterbi.

A block is the text between two block-level tags. Its features are what its ancestors' tags, classes and ids
name it (article or page furniture), its own tag, and its text; all of them count for every block. Pages whose markup
names an article teach the field: blocks in it are main text, blocks of furniture are not. Each such page is learned
from with all of the names, with half of them left out at random, and with none, so that tags, text and neighbours
decide where markup is silent and have a say where it misleads.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm import crf, shared, tokens

SAMPLE_PAGES = 400
SAMPLE_BLOCKS = 64
SLICE_BYTES = 1 << 20
NONE, NAMED, MAIN, ARTICLE, FURNITURE = 0, 1, 2, 3, 4
ENOUGH = 0.1
#: What a name weighs against one feature of the text: an item of a list in an article belongs to it, though most lists are menus.
NAME = 3.0

# Names of HTML elements, and words that classes and ids of articles and of page furniture use.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
FURNITURE_TAGS = frozenset("aside button dialog fieldset footer form header label menu nav search".split())
WRAPPING_TAGS = frozenset("form header".split())
ARTICLE_WORDS = frozenset("article articlebody body content contents entry main maincontent post prose story text".split())
FURNITURE_WORDS = frozenset(
    "ad ads adbox adsense advert advertisement advertising adverts alert aside banner bottombar breadcrumb breadcrumbs byline comment commentary commentlist comments consent "
    "cookie cookies copyright disclaimer discussion disqus dropdown feedback foot footer form gdpr head header login masthead menu meta modal nav navbar navigation newsletter "
    "notice notification overlay pager pagination paging pane popup privacy promo promoted promotion recommended recommendations related replies reply respond responses search share sharing "
    "sidebar sidenav signup skip social sponsor sponsored subscribe subscription tags teaser toc toolbar topbar tracking warning widget widgets".split()
)
NOTICE = re.compile(r"cookie|subscribe|newsletter|sign up|log ?in|copyright|©|all rights reserved|privacy|terms of|advert|sponsored|read more|share this|comments?\b|reply", re.I)

# Elements whose text is not shown as such. They end with their parent; one that is never closed is taken for a lone tag.
MUTE_TAGS = frozenset("audio canvas datalist noscript object select svg template video".split())

# Only what is raw text runs to the end of the page where it is not closed.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|iframe|textarea|title)\b[^>]*(?<!/)>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^>]*(?:>|\Z)"
    r"|<|[^<]+",
    re.S | re.I,
)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDING = re.compile(r"hidden|display", re.I)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
HIDDEN_STYLE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
ABSENT = re.compile(r"\b(?:has|have|hide|no|show|with|without)[-_]+\w+", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

DIGITS, MARKS = re.compile(r"\d"), re.compile("[|·»©›]")
ITEMS, HEADINGS, CELLS = frozenset(("li", "dt", "dd")), frozenset(f"h{n}" for n in range(1, 7)), frozenset(("td", "th"))

FEATURES = (
    "article", "furniture", "paragraph", "item", "heading", "cell", "link_share", "links_only", "few_words", "some_words", "words", "many_words",
    "stops", "ends_stop", "capital", "digits", "marks", "notice", "first", "last",
)


def _hidden(attributes: str) -> bool:
    """Whether an element is not shown: by its attribute hidden, aria-hidden or style, not by a word in another one."""
    if not HIDING.search(attributes):
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), html.unescape("".join(values))
        if name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true") or (name == "style" and HIDDEN_STYLE.search(value)):
            return True
    return False


def _names(tag: str, attributes: str) -> int:
    """What an element's tag, class, id or role says of the text in it; of several words those of furniture count."""
    if tag in FURNITURE_TAGS:
        return FURNITURE
    own = ARTICLE if tag == "article" else MAIN if tag == "main" else NONE
    if not attributes or tag in ("html", "body"):
        return own
    if _hidden(attributes):
        return FURNITURE
    words = {word.lower() for found in NAMES.findall(attributes) for word in WORD.findall(ABSENT.sub(" ", " ".join(found)))}
    return FURNITURE if words & FURNITURE_WORDS else own or (NAMED if words & ARTICLE_WORDS else NONE)


def _inside(around: int, weak: bool, said: int) -> int:
    """What holds inside an element: furniture stays furniture, but for an article within a form or header that wraps it."""
    if around == FURNITURE and not (weak and said in (MAIN, ARTICLE)):
        return FURNITURE
    return said if said == FURNITURE else max(said, NONE if around == FURNITURE else around)


def blocks(page: str) -> list[tuple[str, int, str, int]]:
    """The page's blocks in order: text, what its nearest naming ancestor says, its block-level tag, characters in links."""
    out: list[tuple[str, int, str, int]] = []
    stack: list[tuple[str, int, str, bool]] = [("", NONE, "", False)]
    opened: Counter[str] = Counter()
    inner: Counter[str] = Counter()
    parts: list[str] = []
    linked, muted = 0, 0
    last_end: dict[str, int] = {}

    def close() -> None:
        nonlocal parts, linked
        if parts:
            if text := " ".join("".join(parts).split()):
                out.append((text, stack[-1][1], stack[-1][2], linked))
            parts, linked = [], 0

    def ends_later(tag: str, at: int) -> bool:
        if tag not in last_end:
            last_end[tag] = max((found.start() for found in re.finditer(f"</{tag}\\b", page, re.I)), default=-1)
        return last_end[tag] > at

    def leave(tag: str) -> None:
        nonlocal muted
        at = len(stack) - 1
        while stack[at][0] != tag:
            at -= 1
        if stack[at - 1][1] != stack[-1][1]:
            close()
        for name, *_ in stack[at:]:
            opened[name] -= 1
            muted -= name in MUTE_TAGS
        del stack[at:]
        if not muted:
            inner.clear()

    for found in TOKEN.finditer(page):
        tag = found[3]
        if tag is None:
            if not muted and found[1] is None and (found[0][0] != "<" or found[0] == "<"):
                text = html.unescape(found[0])
                parts.append(text)
                if opened["a"] > 0:
                    linked += len(text.strip())
            continue
        tag = tag.lower()
        if found[2]:
            if inner[tag] > 0:
                inner[tag] -= 1
                continue
            if tag in BLOCK_TAGS:
                close()
            if opened[tag] > 0:
                leave(tag)
            continue
        if muted and tag not in MUTE_TAGS:
            # What begins inside ends inside; an end of anything else is that of a parent.
            inner[tag] += tag not in VOID_TAGS and not found[4].endswith("/")
            continue
        if tag in BLOCK_TAGS:
            close()
            if opened["p"] > 0:
                leave("p")
            elif tag == "li" and stack[-1][0] == "li":
                leave("li")
        elif tag == "br":
            parts.append(" ")
        if tag in VOID_TAGS or found[4].endswith("/"):
            continue
        if tag in MUTE_TAGS:
            if ends_later(tag, found.start()):
                stack.append((tag, *stack[-1][1:]))
                opened[tag] += 1
                muted += 1
            continue
        _, around, block, weak = stack[-1]
        held = _inside(around, weak, _names(tag, found[4]))
        if held != around:
            close()
        stack.append((tag, held, tag if tag in BLOCK_TAGS else block, tag in WRAPPING_TAGS if held == FURNITURE != around else weak and held == FURNITURE))
        opened[tag] += 1
    close()
    return _settled(out)


def _settled(found: list[tuple[str, int, str, int]]) -> list[tuple[str, int, str, int]]:
    """One kind of article for the page: its article elements if they have enough of all named text, else main, else what classes name.

    Where there are such elements, what lies outside them is furniture.
    """
    size = Counter()
    for text, said, _, _ in found:
        size[said] += len(text)
    every = size[NAMED] + size[MAIN] + size[ARTICLE]
    kind = next((kind for kind in (ARTICLE, MAIN) if size[kind] and size[kind] >= ENOUGH * every), NAMED)
    held = {said: ARTICLE if NONE < kind <= said < FURNITURE else NONE if said < FURNITURE and kind == NAMED else FURNITURE for said in range(FURNITURE + 1)}
    return [(text, held[said], tag, linked) for text, said, tag, linked in found]


def features(found: list[tuple[str, int, str, int]], named: np.ndarray | None = None) -> np.ndarray:
    """A row of FEATURES for each block: its name (where `named` says so, if given), its tag and its text."""
    rows = []
    last = len(found) - 1
    for row, (text, said, tag, linked) in enumerate(found):
        words = text.count(" ") + 1
        link = min(1.0, linked / len(text))
        known = NAME if said != NONE and (named is None or named[row]) else 0.0
        article = said == ARTICLE
        rows.append((
            known * article, known * (not article),
            tag == "p", tag in ITEMS, tag in HEADINGS, tag in CELLS,
            link, link > 0.8, words <= 3, 3 < words <= 10, 10 < words <= 40, words > 40,
            min(1.0, (text.count(".") + text.count("!") + text.count("?")) / words), text[-1] in ".!?", text[0].isupper(),
            5 * len(DIGITS.findall(text)) > len(text), MARKS.search(text) is not None,
            words < 60 and NOTICE.search(text) is not None, row == 0, row == last,
        ))
    return np.array(rows, float).reshape(len(found), len(FEATURES))


def lesson(page: str, most: int = SAMPLE_BLOCKS) -> list[tuple[np.ndarray, np.ndarray]]:
    """What a page teaches: features and answers of up to three quarters of `most` blocks from its start and the rest of them from its end.

    A page that names no article, or has a block that neither kind of ancestor holds, teaches only by the blocks that are named.
    They come with their names, without, and with half of them, drawn by a hash of the page.
    """
    found = [block for block in blocks(page) if block[1] != NONE]
    answers = np.array([block[1] == ARTICLE for block in found], float)
    if not answers.any():
        return []
    head = 3 * most // 4
    cut = [slice(None)] if len(found) <= most else [slice(None, head), slice(head - most, None)]
    half = np.random.Generator(np.random.PCG64(xxhash.xxh64_intdigest(page))).random(len(found)) < 0.5
    return [(rows[part], answers[part]) for named in (None, np.zeros(len(found), bool), half) for rows in [features(found, named)] for part in cut]


def _teacher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, order, page in zip(batch.column("page_id"), batch.column("order"), tokens.column(batch, "html"), strict=True):
            whole = int(np.int64(np.uint64(xxhash.xxh64_intdigest(page.as_py())).view(np.int64)))
            for part, (rows, answers) in enumerate(lesson(page.as_py())):
                columns = [pa.array([value], pa.int64()) for value in (name.as_py(), order.as_py(), whole, part)] + [pa.array([x.tobytes()], pa.binary()) for x in (rows, answers)]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "order", "lesson", "part", "features", "answers"])


def fitted(pages: DataFrame, pages_used: int = SAMPLE_PAGES) -> crf.Model:
    """The field, from a bounded sample: the pages with the smallest hashes of their page_id among all that give a lesson.

    A share of the pages by hash is looked at, and a larger one, all of them at last, where too few of it give a
    lesson. Where none of all does, all blocks but those named as furniture are main text.
    """
    shared.with_code(pages.sparkSession)
    order = F.xxhash64("page_id")
    known = pages.where("page_id IS NOT NULL AND html IS NOT NULL").select("page_id", order.alias("order"), "html")
    share = min(1.0, 4 * pages_used / max(1, known.count()))
    while True:
        tried = known.where(F.col("order") <= int(share * 2**64) - 2**63) if share < 1 else known
        lessons = shared.written(tried.mapInArrow(_teacher, "page_id bigint, order bigint, lesson bigint, part bigint, features binary, answers binary"), "lessons")
        named = lessons.select("page_id", "order").distinct().orderBy("order", "page_id").limit(pages_used)
        if share == 1 or named.count() == pages_used:
            break
        share = min(1.0, 8 * share)
    # Each page's lesson is taken once: rows that share its number would crowd out other pages.
    once = F.row_number().over(Window.partitionBy("page_id").orderBy("lesson"))
    own = lessons.join(F.broadcast(named.select("page_id")), "page_id").select("page_id", "lesson").distinct().withColumn("first", once).where("first = 1").drop("first")
    rows = lessons.join(F.broadcast(own), ["page_id", "lesson"]).dropDuplicates(["page_id", "part"]).orderBy("features", "answers").collect()
    answers = [np.frombuffer(row["answers"]) for row in rows]
    parts = [np.frombuffer(row["features"]).reshape(-1, len(FEATURES)) for row in rows]
    model = crf.fit(np.concatenate([*parts, np.zeros((0, len(FEATURES)))]), np.concatenate([*answers, np.zeros(0)]), np.array([len(part) for part in answers], np.int64))
    if not rows:
        model.weights[FEATURES.index("furniture")] = -2.0
    return model


def main_texts(pages: list[str], model: crf.Model) -> list[str]:
    """The blocks of each page that the field marks as main text, in page order, two line breaks between them. All pages are decoded together."""
    found = [blocks(page) for page in pages]
    lengths = np.array([len(own) for own in found], np.int64)
    rows = np.concatenate([features(own) for own in found if own] or [np.zeros((0, len(FEATURES)))])
    marked = iter((crf.viterbi(model.scores(rows), lengths, model) == 1).tolist())
    return ["\n\n".join([block[0] for block in own if next(marked)]) for own in found]


def main_text(page: str, model: crf.Model) -> str:
    return main_texts([page], model)[0]


RESULT = "page_id bigint, url string, text string, n_chars bigint"


def _extractor(model: crf.Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = tokens.column(batch, "html")
            for first, last in tokens.slices(pages, SLICE_BYTES):
                texts = main_texts(pages.slice(first, last - first).to_pylist(), model)
                columns = [*(batch.column(name).slice(first, last - first) for name in ("page_id", "url")), pa.array(texts, pa.string()), pa.array([len(text) for text in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in RESULT.split(", ")])

    return extract


def extracted(pages: DataFrame, model: crf.Model) -> DataFrame:
    """page_id, url, text and n_chars (code points) of each page.

    A NULL or empty html and a page without main text give an empty text. Very long pages are read whole. Rows that repeat are answered each for
    itself; no pages: no rows; other columns are ignored. A page is read in the task that has it.
    """
    shared.with_code(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInArrow(_extractor(model), RESULT)
