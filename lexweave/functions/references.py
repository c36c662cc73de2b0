"""References to provisions in a sentence: where they stand, which document they name, which provisions they mean.

A provision is a path of five numbers (article, suffix, paragraph, item, sub_item), 0 where a level is not given, so labels
written in any way (第（二）项, 第2项) meet as equal numbers and need no lookup by variants.
"""

from __future__ import annotations

import bisect
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .statute import QUOTES

# fixed values: numeral letters, words for the own document, statutes cited without quotes, connectors, notes that are no
# target, what may stand between a document and a further article of it, words before an anchor, marks of skipped sentences
NUMERAL = "[一二三四五六七八九十百千万零两〇0-9]+"
OWN = ("本法", "本条例", "本办法", "本规定", "本决定", "本解释")
BARE = ("民法典", "刑法", "宪法")
CONNECTORS = "或者|以及|、|，|和|及|或|至|-|—"
NOTE = rf"（(?!{NUMERAL}）)[^）]{{1,40}}）|\((?!{NUMERAL}\))[^)]{{1,40}}\)"
SHARED_GAP = r"\s*(?:[“\"‘][^”\"’]{0,80}[”\"’]|（[^）]{0,40}）)*\s*(?:或者|以及|、|，|和|及|或)?\s*"
PARALLEL_GAPS = ("", "、", "和", "及", "以及", "或者", "或", "，", ",")
ANCHOR_WORDS = ("", "根据", "依照", "按照", "参照", "适用")
SKIP_HEADS = "^(?:序号|法律规定|刑法条文|罪名|发文日期|废止理由)[:：]"
SKIP_WORDS = "修改为|修正为|修订为|废止|停止适用|简称"
TENS = {"十": 10, "百": 100, "千": 1000}
DIGITS = {"零": 0, "〇": 0, "一": 1, "二": 2, "两": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9}

_EITHER = rf"(?:[（(]{NUMERAL}[）)]|{NUMERAL})"
_LABEL = rf"第[一二三四五六七八九十百千万零两〇0-9（()）]+(?:条|款|项|目)"
_UNIT = re.compile(rf"第(?P<article>{NUMERAL})条(?:之(?P<suffix>{NUMERAL}))?|第(?P<paragraph>{NUMERAL})款|(?P<nth>第)?(?:[（(](?P<inside>{NUMERAL})[）)]|(?P<plain>{NUMERAL}))(?P<unit>[项目])")
_GROUP = re.compile(rf"第?{_EITHER}(?:[、，]第?{_EITHER})+项")
_ARTICLE = re.compile(f"第{NUMERAL}条")
_JOIN, _NOTE, _GAP, _NUMBER = re.compile(rf"(?:{CONNECTORS})\s*"), re.compile(rf"\s*(?:{NOTE})"), re.compile(SHARED_GAP), re.compile(NUMERAL)
_TITLE, _OWN, _BARE = re.compile("《([^》]+)》"), re.compile("|".join(OWN)), re.compile("|".join(BARE))
_QUOTE = re.compile(f"[{''.join(QUOTES)}{''.join(QUOTES.values())}]")

PATH = ("article", "suffix", "paragraph", "item", "sub_item")
TARGET = f"struct<{','.join(f'{p}:bigint' for p in PATH)},level:string,upto:bigint>"
REFERENCE = f"array<struct<kind:string,title:string,start:int,end:int,text:string,targets:array<{TARGET}>>>"


def number(word: str) -> int:
    """The number of a numeral, with or without brackets around it."""
    word = word.strip("（()）")
    if word.isdecimal():
        return int(word)
    total = section = digit = 0
    for letter in word:
        if letter in TENS:
            section, digit = section + (digit or 1) * TENS[letter], 0
        elif letter == "万":
            total, section, digit = total + (section + digit) * 10_000, 0, 0
        else:
            digit = DIGITS[letter] if letter in DIGITS else int(letter)
    return total + section + digit


def quote_ranges(text: str) -> list[tuple[int, int]]:
    """(start, end) of every quotation, marks included; one that is never closed ends with the text."""
    waiting, found = [], []
    for event in _QUOTE.finditer(text):
        mark, at = event[0], event.start()
        if waiting and mark == waiting[-1][0]:
            found.append((waiting.pop()[1], at + 1))
        elif mark in QUOTES:
            waiting.append((QUOTES[mark], at))
    return found + [(start, len(text)) for _, start in waiting]


class _Spans:
    """Disjoint spans in order, asked by bisection."""

    def __init__(self, spans=()):
        self.spans = []
        for start, end in sorted(spans, key=lambda s: (s[0], -s[1])):
            if not self.spans or end > self.spans[-1][1]:  # quotations nest, so the outermost are disjoint
                self.spans.append((start, end))

    def holds(self, start: int, end: int) -> bool:
        k = bisect.bisect_right(self.spans, (start, float("inf"))) - 1
        return k >= 0 and end <= self.spans[k][1]

    def add(self, start: int, end: int) -> bool:
        """Whether the span overlapped none, and is now one of them."""
        k = bisect.bisect_left(self.spans, (start, start))
        if (k and self.spans[k - 1][1] > start) or (k < len(self.spans) and self.spans[k][0] < end):
            return False
        self.spans.insert(k, (start, end))
        return True


def _segment(s: str, at: int):
    """(path, end) of the label that begins at a place: units of falling rank next to each other; None where none begins."""
    path, last = [0] * 5, -1
    while unit := _UNIT.match(s, at):
        rank = 0 if unit["article"] else 2 if unit["paragraph"] else 3 if unit["unit"] == "项" else 4
        bare_item = rank == 3 and last < 0 and unit["inside"]  # only an item in brackets may begin a label without 第
        if rank <= last or (rank > 2 and not unit["nth"] and not bare_item):
            break
        path[rank] = number(unit["article"] or unit["paragraph"] or unit["inside"] or unit["plain"])
        if unit["suffix"]:
            path[1] = number(unit["suffix"])
        at, last = unit.end(), rank
    return None if last < 0 else (tuple(path), at)


def _without_notes(s: str, at: int) -> int:
    while note := _NOTE.match(s, at):
        at = note.end()
    while at < len(s) and s[at].isspace():
        at += 1
    return at


def _tail(s: str, path: tuple, at: int, notes: bool = True) -> tuple[list, int]:
    """([(connector, path)], end): a label and all that follow it over connectors, and where the last one ends. With notes,
    remarks in brackets between them are passed over, and 第一、二项 right after the label is several items."""
    parts = [("", path)]
    if notes and (group := _GROUP.match(s, at)):
        items = [number(n) for n in _NUMBER.findall(group[0])]
        parts = [("", (*path[:3], items[0], 0)), *(("、", (0, 0, 0, n, 0)) for n in items[1:])]
        at = group.end()
    while joint := _JOIN.match(s, _without_notes(s, at) if notes else at):
        found = _segment(s, _without_notes(s, joint.end()) if notes else joint.end())
        if not found:
            break
        parts.append((joint[0], found[0]))
        at = found[1]
    return parts, at


def _range(a: tuple, b: tuple):
    """(level, upto) of a至b: the deepest level both have under the same parents; None where there is none or b is before a."""
    for k in (4, 3, 2, 0):
        if a[k] and b[k] and (k == 0 or a[:k] == b[:k]):
            return (k, b[k]) if b[k] >= a[k] else None
    return None


def targets(parts: list, home: tuple[int, int] = (0, 0)) -> list[tuple]:
    """Paths with (level, upto) of a range or (None, None), without repeats.

    A label without an article stands in home, the article of the sentence, where its document is the own one; else it takes
    the article and paragraph of the label before. Ranges are found before that and stay compact: their members are those
    provisions that exist."""
    found, last = [], None
    for joiner, path in parts:
        path = path if path[0] else (*home, *path[2:])
        reach = _range(last, path) if last and "至" in joiner else None
        if reach:
            k, upto = reach
            start = (last[0], 0, *last[2:]) if k == 0 else last
            found.append((start, k, upto))
        else:
            found.append((path, None, None))
        last = path
    out, prior = [], None
    for path, k, upto in found:
        if k is None:
            if prior and (not path[0] or path[:2] == prior[:2]):
                path = (*prior[:2], path[2] or prior[2], path[3] or (prior[3] if path[4] else 0), path[4])
            prior = path
        else:
            prior = (*path[:k], upto, *path[k + 1:])
        out.append((*path, None if k is None else PATH[k], upto))
    return list(dict.fromkeys(out))


def find_references(sentence: str, aliases: dict[str, str] | None = None, title: str = "", home: tuple[int, int] = (0, 0)) -> list[tuple]:
    """(kind, title, start, end, text, targets) of a sentence's references, by place.

    Kinds in the order they claim text: absolute (《title》 and an article), alias (the longest first), bare (a statute named
    without quotes), local (words for the own document), shared (a further article of the document cited before it). Text
    inside quotes is no reference, and none overlaps one claimed earlier."""
    aliases = aliases or {}
    quoted, taken, out = _Spans(quote_ranges(sentence)), _Spans(), []

    def offer(kind: str, name: str, start: int, found: tuple | None, notes: bool = True) -> int | None:
        if not found or not found[0][0]:
            return None
        parts, end = _tail(sentence, *found, notes=notes)
        if not quoted.holds(start, end) and taken.add(start, end):
            out.append((kind, name, start, end, sentence[start:end], targets(parts, home if kind == "local" else (0, 0))))
        return end

    for head in _TITLE.finditer(sentence):
        offer("absolute", head[0], head.start(), _segment(sentence, head.end()))
    for alias in sorted((a for a in aliases if a and a in sentence), key=lambda a: (-len(a), a)):
        for head in re.finditer(re.escape(alias), sentence):
            offer("alias", aliases[alias], head.start(), _segment(sentence, head.end()))
    for head in _BARE.finditer(sentence):
        offer("bare", aliases.get(head[0], f"《{head[0]}》"), head.start(), _segment(sentence, head.end()))
    for head in _OWN.finditer(sentence):
        offer("local", title, head.start(), _segment(sentence, head.end()))
    if _JOIN.search(sentence):
        anchors, at = sorted((r[3], r[2], r[1]) for r in out if r[0] != "local"), 0
        while article := _ARTICLE.search(sentence, at):
            start, found = article.start(), _segment(sentence, article.start())
            at = _tail(sentence, *found, notes=False)[1]
            k = bisect.bisect_right(anchors, (start, float("inf"), "")) - 1
            between = sentence[anchors[k][0]:start] if k >= 0 else ""
            if between.strip() and _GAP.fullmatch(between):
                before = len(out)
                offer("shared", anchors[k][2], start, found, notes=False)
                if len(out) > before:
                    bisect.insort(anchors, (out[-1][3], start, out[-1][1]))
    return sorted(out, key=lambda r: (r[2], r[3]))


def references(sentence, aliases, title, article, suffix) -> Column:
    """find_references as a column (REFERENCE): aliases is array<struct<alias, title>>, article and suffix are the numbers of
    the sentence's own article. A null sentence gives null, null arguments count as absent. A stack of quotes and claims of
    text are no expression of Spark's, so this is an Arrow UDF."""

    @F.pandas_udf(REFERENCE)
    def run(s: pd.Series, a: pd.Series, t: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        whole = lambda x: 0 if pd.isna(x) else int(x)
        out = []
        for sentence, names, title, no, suffix in zip(s, a, t, n, m):
            known = {} if names is None else {x["alias"]: x["title"] for x in names if x["alias"]}
            found = None if sentence is None else find_references(sentence, known, title or "", (whole(no), whole(suffix)))
            out.append(found if found is None else [dict(zip(("kind", "title", "start", "end", "text", "targets"), (*r[:5], [dict(zip((*PATH, "level", "upto"), x)) for x in r[5]]))) for r in found])
        return pd.Series(out, index=s.index, dtype=object)

    return run(sentence, aliases, title, article, suffix)


def quoted(c) -> Column:
    """array<struct<start, end>> of a text's quotations; null in, null out."""

    @F.pandas_udf("array<struct<start:int,end:int>>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else [{"start": a, "end": b} for a, b in quote_ranges(t)])

    return run(c)


def _compact(c) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", "")


def may_refer(c) -> Column:
    """Whether a sentence can hold a reference at all: a label, a title or a word for the own document."""
    return c.rlike(rf"第[一二三四五六七八九十百千万零两〇0-9（()）]{{1,16}}(?:条|款|项|目)|《|{'|'.join(OWN)}")


def is_skipped(c) -> Column:
    """Whether a sentence is a list's head, defines an alias, or amends or repeals."""
    return _compact(c).rlike(f"{SKIP_HEADS}|（以下简称[^）]{{1,20}}）|{SKIP_WORDS}")


def is_own_word(c) -> Column:
    """Whether a reference is nothing but a word for the own document."""
    return F.regexp_replace(_compact(c), "^[，,。；;：:()（）]+|[，,。；;：:()（）]+$", "").isin(*OWN)


def in_quotes(start, end, ranges) -> Column:
    return F.exists(ranges, lambda r: (start >= r["start"]) & (end <= r["end"]))


def disjoint_spans(spans) -> Column:
    """Of an array of structs with start and end, those that overlap none kept before them."""
    none = F.filter(spans, lambda x: F.lit(False))
    free = lambda kept, x: ~F.exists(kept, lambda k: (x["end"] > k["start"]) & (x["start"] < k["end"]))
    return F.aggregate(spans, none, lambda kept, x: F.when(free(kept, x), F.concat(kept, F.array(x))).otherwise(kept))


def is_anchor(c) -> Column:
    """Whether a text holds a title, a word for the own document or a label."""
    return F.coalesce(c, F.lit("")).rlike(f"《[^》]+》|{'|'.join(OWN)}|{_LABEL}")


def _between(text, start, end) -> Column:
    return F.substring(text, start + F.lit(1), end - start)


def is_valid_span(text, start, end) -> Column:
    """Whether a span lies inside the text and holds an anchor; null arguments are no span."""
    return F.coalesce((start >= 0) & (end > start) & (end <= F.char_length(text)) & is_anchor(_between(text, start, end)), F.lit(False))


def is_precise_span(text, start, end) -> Column:
    """Whether a valid span begins with its anchor, a word that leads to it, or the name of a document."""
    span = _between(text, start, end)
    before = F.regexp_replace(F.regexp_extract(span, f"(?s)^(.*?)(?:《[^》]+》|{'|'.join(OWN)}|{_LABEL})", 1), "^[，,：:；; ]+|[，,：:；; ]+$", "")
    starts = span.rlike(rf"^(?:《[^》]+》|[^\s，,。；;：:]{{1,24}}(?:法|法典|条例|规定|办法|解释)|{'|'.join(OWN)}|{_LABEL})")
    return is_valid_span(text, start, end) & F.coalesce(before.isin(*ANCHOR_WORDS) | starts, F.lit(False))


def is_parallel_gap(c) -> Column:
    """Whether the text between two references joins them as equals."""
    return F.regexp_replace(_compact(c), "^[“”\"'‘’]+|[“”\"'‘’]+$", "").isin(*PARALLEL_GAPS)
