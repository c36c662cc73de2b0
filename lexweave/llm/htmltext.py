"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into flat blocks at block-level tags. Each block is described by its own word count and link density, by
those of the blocks before and after it (each, and the greater density of both), by the longest block near it, and by its container: whether it is in an article or
main element, and how much its container looks like boilerplate (3: by its element or role, such as nav or aside; 2: by a class
or id made of words such as ad or comments; 1: by a class or id that only holds such a word, such as share-price). A CART
tree, grown on the labelled table that the pages of htmlpages.py give, decides which blocks are main text. So words and
links decide where containers do not: on pages without an article, in containers of mark 1, and for link lists in articles.

In scripts written without spaces two letters count as a word.

Defined results: null or empty html gives an empty text; character references are decoded, with or without the closing
semicolon; white space inside a block becomes one space; repeated rows give the same text; other columns are not read.
Scripts and styles reach to their end tag or the end of the page; a head without its end tag ends at the first element that
does not belong to it, and any other silent element at the next block. Whole pages are read, whatever their length, and no
block is cut or capped.
"""

from __future__ import annotations

import html as html_lib
import re
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import texts_of
from .htmlpages import labelled_pages

FEATURES = ("words", "link_density", "prev_words", "prev_density", "next_words", "next_density", "near_words", "near_density", "beside_density", "in_article", "container", "page_has_article")
#: Blocks on either side that count as near.
NEAR = 3


@dataclass
class Tree:
    """A CART tree on numeric features, split by Gini impurity."""

    feature: int = -1
    cut: float = 0.0
    low: Tree | None = None
    high: Tree | None = None
    label: int = 0

    def decide(self, x) -> int:
        node = self
        while node.feature >= 0:
            node = node.low if x[node.feature] <= node.cut else node.high
        return node.label


def grow(rows: list[tuple], depth: int = 12, least: int = 4) -> Tree:
    """The tree of rows whose last value is the label; ties go to the first feature and the smallest cut, leaves hold `least` rows."""
    ones, n = sum(r[-1] for r in rows), len(rows)
    leaf = Tree(label=int(2 * ones >= n))
    if ones in (0, n) or not depth or n < 2 * least:
        return leaf
    best = (2.0 * ones * (n - ones) / n - 1e-9, None)
    for f in range(len(rows[0]) - 1):
        ordered, left = sorted((r[f], r[-1]) for r in rows), 0
        for i in range(n - 1):
            left += ordered[i][1]
            if ordered[i][0] != ordered[i + 1][0] and least <= i + 1 <= n - least:
                a, b, right = i + 1, n - i - 1, ones - left
                gini = 2.0 * left * (a - left) / a + 2.0 * right * (b - right) / b
                if gini < best[0] - 1e-12:
                    best = (gini, (f, (ordered[i][0] + ordered[i + 1][0]) / 2))
    if best[1] is None:
        return leaf
    f, cut = best[1]
    return Tree(f, cut, grow([r for r in rows if r[f] <= cut], depth - 1, least), grow([r for r in rows if r[f] > cut], depth - 1, least))


#: Raw text that reaches to the end tag or the end of the page; elements whose content is never text; elements that end a block.
RAW = {"script", "style"}
SILENT = {"template", "iframe", "svg", "canvas", "select", "textarea", "button", "audio", "video"}
HEAD_PARTS = {"title", "meta", "link", "base", "script", "style", "noscript", "template"}
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul caption".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Containers of boilerplate: by element, by role, and by words of class or id; words that say nothing beside those.
BOILER_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
BOILER_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu", "menubar"}
BOILER_WORDS = set(
    "ad ads advert adverts advertisement advertising adsense adbox banner promo promoted promotion sponsor sponsored nav navbar navigation menu submenu topbar breadcrumb breadcrumbs header masthead"
    " footer sidebar sidebars aside widget widgets comment comments commentlist reply replies respond discussion disqus cookie cookies consent gdpr notice notices notification popup modal overlay"
    " newsletter subscribe subscription signup login share sharing social related recommended pagination pager toolbar copyright disclaimer alert form search".split()
)
NEUTRAL_WORDS = set(
    "site page main global primary secondary top bottom left right upper lower first second inner outer wrap wrapper container box block section area region bar list item items row col column group"
    " content text body title link links button buttons btn icon icons post posts article articles story user users reader readers view item element module panel pane slot unit zone space holder"
    " fixed sticky mobile desktop small large big mini js is has the and of for with".split()
)
#: Classes of a whole page say nothing about the text in it.
WHOLE = {"html", "body", "article", "main"}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", re.I)
_WORD = re.compile(r"[a-z]+")
#: Letters of scripts written without spaces: Thai, Lao, Burmese, Khmer, kana and Chinese letters.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003134f]")


def count_words(text: str) -> int:
    """Words between white space; of letters of scripts without spaces two make a word."""
    tokens = text.split()
    letters = 0 if text.isascii() else len(_UNSPACED.findall(text))
    return len(tokens) + (letters - 1) // 2 if letters else len(tokens)


def boilerplate_mark(tag: str, attrs: str, in_article: bool) -> int:
    """0 to 3: how much an element looks like a container of boilerplate."""
    if tag in BOILER_TAGS and not (tag == "header" and in_article):
        return 3
    mark = 0
    if tag in WHOLE or not attrs:
        return mark
    for name, value in _ATTR.findall(attrs):
        value = value.strip("\"'")
        if name.lower() == "role":
            if value.lower() in BOILER_ROLES:
                return 3
            continue
        for token in value.split():
            parts = _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower())
            if any(p in BOILER_WORDS for p in parts):
                mark = max(mark, 2 if all(p in BOILER_WORDS or p in NEUTRAL_WORDS for p in parts) else 1)
    return mark


@dataclass
class Block:
    text: str
    words: int
    density: float
    in_article: bool
    container: int
    label: bool  # inside an element with data-main, which labelled pages have


@dataclass
class _Open:
    parts: list = field(default_factory=list)
    links: list = field(default_factory=list)


class _Cutter:
    """Cuts a page into flat blocks, in one pass over its tags."""

    def __init__(self, page: str):
        self.page, self.out, self.now = page, [], _Open()
        self.stack: list[tuple] = []  # (tag, in article, container, label, its own mark's tag)
        self.article, self.container, self.label, self.cause = False, 0, False, ""
        self.link, self.quiet, self.in_head, self.unclosed = 0, "", False, set()

    def add(self, raw: str) -> None:
        if raw and not self.quiet and not self.in_head:
            self.now.parts.append(raw)
            if self.link:
                self.now.links.append(raw)

    def flush(self) -> None:
        text = " ".join(html_lib.unescape("".join(self.now.parts)).split())
        if text:
            words = max(count_words(text), 1)
            self.out.append(Block(text, words, min(1.0, count_words(html_lib.unescape(" ".join(self.now.links))) / words), self.article, self.container, self.label))
        self.now = _Open()

    def restore(self) -> None:
        self.article, self.container, self.label, self.cause = self.stack[-1][1:] if self.stack else (False, 0, False, "")

    def skip_to(self, tag: str, at: int) -> int:
        """The place after the end tag, or -1; an end tag that was not found is not looked for again."""
        if tag in self.unclosed:
            return -1
        close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(self.page, at)
        if close is None:
            self.unclosed.add(tag)
            return -1
        return close.end()

    def run(self) -> list[Block]:
        at, end = 0, len(self.page)
        while at < end:
            m = _TOKEN.search(self.page, at)
            if m is None:
                self.add(self.page[at:])
                break
            self.add(self.page[at : m.start()])
            at = m.end()
            if m[1] is not None:
                self.add(m[1].replace("&", "&amp;"))
            if m[3] is not None:
                at = (self.close if m[2] else self.open)(m[3].lower(), m[4], at)
        self.flush()
        return self.out

    def close(self, tag: str, attrs: str, at: int) -> int:
        if tag == self.quiet or tag in BLOCKS:
            self.quiet = ""
        if tag == "head":
            self.in_head = False
        if tag in BLOCKS:
            self.flush()
        if tag == "a":
            self.link = max(0, self.link - 1)
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                self.restore()
                break
        return at

    def open(self, tag: str, attrs: str, at: int) -> int:
        if self.in_head and tag not in HEAD_PARTS:
            self.in_head = False
        if tag in RAW:
            close = self.skip_to(tag, at)
            return close if close >= 0 else len(self.page)
        if tag in SILENT or (tag == "title" and self.in_head):
            if attrs.rstrip().endswith("/") and tag == "svg":
                return at
            close = self.skip_to(tag, at)
            # another one of its kind before the end tag: the first was never closed, and only text up to the next block is its
            if close >= 0 and not re.compile(rf"<{tag}[\s>]", re.I).search(self.page, at, close):
                return close
            self.quiet = tag
            return at
        if tag == "head":
            self.in_head = True
            return at
        if tag in BLOCKS:
            self.quiet = ""
            self.flush()
            self.link = 0 if tag not in ("li", "div") else self.link
        elif tag == "br":
            self.add(" ")
        elif tag == "a":
            self.link += 1
        if tag in ("p", "li", "dt", "dd"):
            # these end where the next of their kind begins
            kin = ("dt", "dd") if tag in ("dt", "dd") else (tag,)
            if self.stack and self.stack[-1][0] in kin:
                self.stack.pop()
                self.restore()
        if tag not in VOID and tag not in ("a", "b", "i", "em", "strong"):
            if tag in ("article", "main") and self.cause in ("nav", "form", "header", "menu", "dialog"):
                self.container, self.cause = 0, ""  # an article in a form, or after a menu that was never closed
            mark = boilerplate_mark(tag, attrs, self.article)
            if mark > self.container:
                self.container, self.cause = mark, tag
            self.article = self.article or tag in ("article", "main")
            self.label = self.label or "data-main" in attrs
            self.stack.append((tag, self.article, self.container, self.label, self.cause))
        return at


def blocks_of(page: str) -> list[Block]:
    """The flat blocks of a page in page order."""
    return _Cutter(page).run()


def features(blocks: list[Block]) -> list[tuple]:
    """The values of FEATURES of every block."""
    has, none = int(any(b.in_article for b in blocks)), Block("", 0, 0.0, False, 0, False)
    out = []
    for i, b in enumerate(blocks):
        before, after = (blocks[i - 1] if i else none), (blocks[i + 1] if i + 1 < len(blocks) else none)
        near = max((x for x in blocks[max(i - NEAR, 0) : i + NEAR + 1] if x is not b), key=lambda x: x.words, default=none)
        out.append((b.words, b.density, before.words, before.density, after.words, after.density, near.words, near.density, max(before.density, after.density), int(b.in_article), b.container, has))
    return out


def labelled_table(pages: list[str]) -> list[tuple]:
    """One row a block: its features and 1 for main text."""
    rows = []
    for page in pages:
        blocks = blocks_of(page)
        rows += [(*x, int(b.label)) for x, b in zip(features(blocks), blocks)]
    return rows


@lru_cache(maxsize=1)
def default_tree() -> Tree:
    return grow(labelled_table(labelled_pages()))


def main_text(page: str, tree: Tree) -> str:
    """The main text of one page, its blocks joined by an empty line."""
    blocks = blocks_of(page)
    return "\n\n".join(b.text for b, x in zip(blocks, features(blocks)) if tree.decide(x))


def _extract(tree: Tree):
    def run(batches):
        for b in batches:
            texts = [main_text(t, tree) for t in texts_of(b.column("html"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return run


def extract_pages(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    return pages.select("page_id", "url", "html").mapInArrow(_extract(tree or default_tree()), "page_id long, url string, text string, n_chars long")
