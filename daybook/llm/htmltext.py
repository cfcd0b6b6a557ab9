"""Main text of web pages by two passes over their blocks.

A page is read once into blocks (runs of text between block-level tags) that know the share of their text inside links, the share of
stop words, their length and the zone they stand in. Tags and names of elements tell zones, which are one vote among the others:

* what a page declares to be furniture or comments goes. A name that only contains a furniture word (``layout-sidebar``) tells nothing about an element
  that holds the main article or, on a page without one, every plain text block of the page; a whole name (``sidebar``, ``cookie-banner``) always does;
* the first pass decides by density: blocks made of links go, long blocks rich in stop words stay, and so do long blocks of a page whose language
  has no known stop words. Of what stands outside a declared article nothing stays. Headings, short and doubtful blocks remain open;
* the second pass gives each open block the label of its nearest decided neighbours; within the article it goes only between two that go.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

GOOD, BAD, OPEN = "good", "bad", "open"
ARTICLE, FURNITURE, COMMENTS, BODY = "article", "furniture", "comments", "body"

LONG, SHORT, PLAIN = 30, 8, 4  # words
LINKED = 0.5  # share of characters in links
RICH, POOR = 0.15, 0.05  # shares of stop words
TEASER = 3  # articles with less than one part in so many of the long text outside are teasers beside the main text

SILENT = frozenset("script style template noscript svg math iframe object canvas head title select option textarea button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
FURNITURE_NAMES = frozenset("""ad ads adbox advert adverts advertisement advertising alert banner breadcrumb breadcrumbs byline consent cookie
cookies copyright disclaimer footer gdpr masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination
paywall popup promo promoted promotion recommended related share sharing sidebar signup social sponsor sponsored subscribe tags toolbar
topbar widget""".split())
COMMENT_NAMES = frozenset("comment comments commentlist discussion disqus replies reply respond responses".split())
ARTICLE_NAMES = frozenset("article-body articlebody entry-content post-content story-body".split())
STOP_WORDS = frozenset("""a about all an and are as at be been but by can for from had has have he her his i in is it its no not of on one or out she
so that the their there they this to up was we were what when which who will with would you
au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui mais même ne nous on ou par pas plus pour qu que qui sa se
ses son sur tout un une vous y
aber als am an auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer er es für hat ich im in ist mit nach nicht
noch nur oder sich sie sind so über um und uns von vor war was wie wir zu zum zur
al como con del desde donde dos el ella ellos en entre era es esta este fue ha hay la las lo los más me mi muy no nos o para pero por porque
que se ser si sin sobre son su sus también todo un una y ya""".split())

#: Parts after a furniture word that leave its meaning, and parts of names that tell a state of the page and no zone.
STRUCTURE = frozenset("area block body box container content footer form header inner item items link links list main outer row section thread title wrap wrapper".split())
STATES = frozenset("active allowed closed disabled enabled has hide hides is no not off on open show shows with without".split())

_NAME = re.compile(r"[a-z][a-z0-9]*(?:-[a-z0-9]+)*")
_WORD = re.compile(r"\w+")
_TAG_START = re.compile(r"<[A-Za-z/!?]")
#: Scripts without blanks between words: two characters count as a word.
_UNSPACED = re.compile("[\u0e00-\u0eff\u3040-\u30ff\u3400-\u9fff]+")


@dataclass
class Block:
    zone: str
    heading: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    label: str = OPEN
    mark: "Mark | None" = None
    size: int = 0  # words
    stops: int = 0
    link_share: float = 0.0

    def close(self) -> "Block":
        self.text = " ".join("".join(self.parts).split())
        words = _WORD.findall(self.text.lower())
        self.size = len(words) + sum(map(len, _UNSPACED.findall(self.text))) // 2
        self.stops = sum(w in STOP_WORDS for w in words)
        self.link_share = self.linked / max(1, sum(map(len, self.parts)))
        return self

    def running(self, known: bool) -> int:
        """Characters, if the block is running text; ``known`` tells that stop words count."""
        rich = self.size >= SHORT and (self.stops >= RICH * self.size or not known)
        return len(self.text) if rich and not self.heading and self.link_share <= LINKED else 0

    def plain(self) -> bool:
        """Whether the block is some text of its own, however short."""
        return self.link_share <= LINKED and not self.heading and self.size >= PLAIN


@dataclass(eq=False)
class Mark:
    """An element that tells a zone, within the one around it."""

    outer: "Mark | None"
    kind: str
    loose: bool = False  # told by a part of a name only
    tagged: bool = False  # an article or main element
    aside: bool = False
    running: int = 0
    plain: int = 0
    holds_article: bool = False
    zone: str = BODY
    beside: bool = False  # within an aside

    def chain(self) -> Iterator["Mark"]:
        mark: Mark | None = self
        while mark:
            yield mark
            mark = mark.outer

    def settle(self, main: "Mark | None", around: set["Mark"], plain: int) -> None:
        """``around``: the elements that hold ``main``, the main article; ``plain``: plain blocks of the page."""
        above, beside = (self.outer.zone, self.outer.beside) if self.outer else (BODY, False)
        self.beside = beside or self.aside and self not in around
        if main:
            wraps = self in around or self.kind == FURNITURE and self.holds_article and self.plain == main.plain
        else:
            wraps = self.kind == FURNITURE and 0 < plain == self.plain
        if self is main:
            self.zone = ARTICLE
        elif above == COMMENTS:
            self.zone = COMMENTS
        elif self.loose and wraps:
            self.zone = ARTICLE if self.tagged else above
        elif self.kind == ARTICLE:
            self.zone = FURNITURE if self.beside or above == FURNITURE else ARTICLE
        elif self.kind == "header":
            self.zone = above if above == ARTICLE else FURNITURE
        else:
            self.zone = self.kind


def main_article(marks: list[Mark], plain: int) -> Mark | None:
    """The article with the most running text, the innermost of equals; one within comments or an aside only if it holds all plain blocks."""
    best, rank, within = None, None, set()  # within: elements inside the best
    beside: dict[Mark | None, int] = {None: 0}
    for mark in marks:
        inner = 1 if mark.aside else 2 if mark.kind == COMMENTS else 0
        if inner == 2 and not mark.loose:
            inner = 3  # firm comments hold no main article
        beside[mark] = max(beside[mark.outer], inner)
        if best and (mark.outer is best or mark.outer in within):
            within.add(mark)
        if (mark.kind == ARTICLE or mark.tagged) and (not beside[mark] or beside[mark] < 3 and mark.plain == plain):
            here = (-beside[mark], mark.running)
            if rank is None or here > rank or here == rank and mark in within:
                best, rank, within = mark, here, set()
    return best


def mark_of(tag: str, attributes: dict[str, str | None], outer: Mark | None) -> Mark | None:
    """What an element within ``outer`` tells about its zone; ``outer`` if nothing."""
    if tag in ("body", "html"):
        return outer  # their names tell about the whole site
    whole, parts = set(), set()
    for key in ("class", "id", "role"):
        for name in _NAME.findall((attributes.get(key) or "").lower().replace("_", "-")):
            first, *others = name.split("-")
            bare = STRUCTURE.issuperset(others) or FURNITURE_NAMES.issuperset({first, *others} - STRUCTURE)
            whole |= {name, first} if bare else {name}
            if STATES.isdisjoint(others) and first not in STATES:
                parts |= {first, *others}
    tagged = tag in ("article", "main")
    if whole & COMMENT_NAMES:
        return Mark(outer, COMMENTS)
    if tagged or whole & ARTICLE_NAMES or "main" in whole and "role" in attributes:
        return Mark(outer, COMMENTS if parts & COMMENT_NAMES else ARTICLE, bool(parts & COMMENT_NAMES), tagged)
    if parts & COMMENT_NAMES:
        return Mark(outer, COMMENTS, True)
    if tag in FURNITURE_TAGS:
        return Mark(outer, FURNITURE, aside=tag == "aside")
    if "hidden" in attributes or (attributes.get("aria-hidden") or "") == "true" or whole & FURNITURE_NAMES:
        return Mark(outer, FURNITURE)
    if parts & FURNITURE_NAMES:
        return Mark(outer, FURNITURE, True)
    return Mark(outer, "header") if tag == "header" else outer


class _Reader(HTMLParser):
    """Blocks of one page; tags that are never closed end with the element around them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[tuple[str, Mark | None]] = []
        self.count: Counter[str] = Counter()  # open elements by name
        self.marks: list[Mark] = []  # the outer before the inner
        self.links = self.silent = 0
        self.block = Block(BODY, False)

    def mark(self) -> Mark | None:
        return self.open[-1][1] if self.open else None

    def cut(self, heading: bool = False) -> None:
        if self.block.parts:
            self.blocks.append(self.block.close())
        self.block = Block(BODY, heading, mark=self.mark())

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.handle_data(" ")
        if tag in VOID:
            if tag == "hr":
                self.cut()
            return
        if tag in SILENT:
            self.silent += 1
        elif tag == "a":
            self.links += 1
        if tag == "p":  # a paragraph ends the one before it
            self.pop("p", at_most="p")
        if tag == "body":
            self.silent = 0  # a head that was never closed
        mark = mark_of(tag, dict(attrs), self.mark())
        if mark is not self.mark():
            self.marks.append(mark)
            above = mark.outer if mark.kind == ARTICLE else None
            while above and not above.holds_article:
                above.holds_article, above = True, above.outer
        self.open.append((tag, mark))
        self.count[tag] += 1
        if tag in BLOCKS:
            self.cut(tag in HEADINGS)
        elif self.mark() is not self.block.mark:
            self.cut(self.block.heading)

    def handle_startendtag(self, tag, attrs):
        if tag == "br":
            self.handle_data(" ")

    def pop(self, tag: str, at_most: str | None = None) -> None:
        """Close the innermost ``tag`` and what is open inside; with ``at_most`` no block-level element around it."""
        if not self.count[tag]:
            return
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][0]
            if name == tag:
                for inner, _ in self.open[at:]:
                    self.count[inner] -= 1
                    self.silent -= inner in SILENT and self.silent > 0
                    self.links -= inner == "a" and self.links > 0
                del self.open[at:]
                return
            if at_most and name in BLOCKS:
                return

    def handle_endtag(self, tag):
        self.pop(tag)
        if tag in BLOCKS:
            self.cut()
        elif self.mark() is not self.block.mark:
            self.cut(self.block.heading)

    def handle_data(self, data):
        if not self.silent:
            self.block.parts.append(data)
            if self.links:
                self.block.linked += len(data)

    def read(self, html: str) -> tuple[list[Block], bool]:
        """Blocks with their zones, and whether the page's language has known stop words."""
        cut = _TAG_START.search(html, html.rfind(">") + 1)
        self.feed(html[:cut.start()] if cut else html)  # what begins a tag after the last end of one is cut off within it
        self.close()
        self.cut()
        blocks = [b for b in self.blocks if b.text]
        prose = [b for b in blocks if b.size >= SHORT and b.link_share <= LINKED]
        known = sum(b.stops for b in prose) >= RICH * sum(b.size for b in prose)
        firm: dict[Mark | None, bool] = {None: False}
        for mark in self.marks:
            firm[mark] = firm[mark.outer] or mark.kind != ARTICLE and not mark.loose
        plain = 0
        for block in blocks:
            counts = block.plain() and not firm[block.mark]
            plain += counts
            if block.mark:
                block.mark.running += block.running(known)
                block.mark.plain += counts
        for mark in reversed(self.marks):
            if mark.outer:
                mark.outer.running += mark.running
                mark.outer.plain += mark.plain
        main = main_article(self.marks, plain)
        around = set(main.chain()) if main else set()
        for mark in self.marks:
            mark.settle(main, around, plain)
        for block in blocks:
            block.zone = block.mark.zone if block.mark else BODY
        return blocks, known


def decide(block: Block, declared: bool, known: bool = True) -> str:
    """First pass; ``declared`` tells that the page marks its article, ``known`` that stop words tell running text."""
    if block.zone in (FURNITURE, COMMENTS) or block.zone == BODY and declared:
        return BAD
    if block.link_share > LINKED and not (block.heading and block.zone == ARTICLE):
        return BAD
    if block.heading or block.size < SHORT:
        return OPEN
    share = block.stops / block.size
    if block.size >= LONG:
        return GOOD if share >= POOR or not known else OPEN
    if known and share >= RICH or not known and 2 * block.size >= LONG:
        return GOOD
    return BAD if block.zone == BODY and known and share < POOR and block.link_share > 0.2 else OPEN


def _sides(blocks: list[Block]) -> Iterator[tuple[int, tuple[int, str] | None, tuple[int, str] | None]]:
    """Open blocks with the place and label of the decided ones before and after."""
    before: list[tuple[int, str] | None] = []
    last = None
    for at, block in enumerate(blocks):
        last = (at, block.label) if block.label != OPEN else last
        before.append(last)
    last, found = None, []
    for at in range(len(blocks) - 1, -1, -1):
        if blocks[at].label != OPEN:
            last = (at, blocks[at].label)
        else:
            found.append((at, before[at], last))
    return iter(found)


def settle_open(blocks: list[Block]) -> int:
    """Second pass; returns how many blocks got their label here.

    An open block takes the label of its nearest decided neighbours; if those on either side differ, a heading takes the one
    below, another block the nearer one, and with equal distances it goes. Without any decided block everything stays. Blocks of the article
    look at the article alone, and go only between two that go.
    """
    inside = [b for b in blocks if b.zone == ARTICLE]
    chosen = [(inside[at], BAD if above and below and above[1] == below[1] == BAD else GOOD) for at, above, below in _sides(inside)]
    for block, label in chosen:
        block.label = label
    for at, above, below in (rest := list(_sides(blocks))):
        if not above or not below or above[1] == below[1]:
            blocks[at].label = (above or below or (at, GOOD))[1]
        elif blocks[at].heading:
            blocks[at].label = below[1]
        elif at - above[0] != below[0] - at:
            blocks[at].label = above[1] if at - above[0] < below[0] - at else below[1]
        else:
            blocks[at].label = BAD
    return len(chosen) + len(rest)


def labelled(html: str | None) -> tuple[list[Block], int]:
    """The page's blocks with their labels, and how many of these the second pass gave."""
    blocks, known = _Reader().read(html or "")
    inside = sum(len(b.text) for b in blocks if b.zone == ARTICLE)
    outside = sum(b.running(known) for b in blocks if b.zone == BODY and b.size >= LONG)
    for block in blocks:
        block.label = decide(block, inside > 0 and TEASER * inside >= outside, known)
    return blocks, settle_open(blocks)


def main_text(html: str | None) -> str:
    return " ".join(b.text for b in labelled(html)[0] if b.label == GOOD)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(html) for html in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars per row of ``pages``.

    A null or empty page and one without an article give an empty text. Rows are read one by one, repeated ones too; other columns
    are not read; an empty table gives an empty result.
    """
    read = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInArrow(
        _extract, "page_id long, url string, text string")
    return read.withColumn("n_chars", F.char_length("text").cast("long"))
