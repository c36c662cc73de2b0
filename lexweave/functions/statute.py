"""Functions on regulatory text: sentences, marks around a target, aliases, labels; null in, null out."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: sentence ends, quotes with their closing letter, marks, numeral letters of labels
SENTENCE_ENDS = "。；;!！?？"
QUOTES = {"“": "”", "‘": "’", '"': '"', "《": "》"}
OPEN, CLOSE = "[T]", "[/T]"
LABEL_LETTERS = "一二三四五六七八九十百千万零两〇0-9"

_EVENTS = re.compile(f"[{SENTENCE_ENDS}{''.join(QUOTES)}{''.join(QUOTES.values())}]")


def split_sentences(text: str) -> list[str]:
    """Sentences, each with its end mark, trimmed; an end mark inside quotes ends nothing. Only quotes and end marks are visited."""
    cuts, waiting = [0], []
    for event in _EVENTS.finditer(text):
        mark = event[0]
        if waiting and mark == waiting[-1] and (mark not in QUOTES or mark == QUOTES[mark]):
            waiting.pop()
        elif mark in QUOTES:
            waiting.append(QUOTES[mark])
        elif mark in SENTENCE_ENDS and not waiting:
            cuts.append(event.end())
    pieces = (text[a:b].strip() for a, b in zip(cuts, [*cuts[1:], len(text)]))
    return [p for p in pieces if p]


def sentences(c) -> Column:
    """The array of a text's sentences: a stack of open quotes is no regular language, so this is an Arrow UDF."""

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else split_sentences(t))

    return run(c)


def marked(text: str, start: str, end: str, replacement: str | None = None) -> Column:
    """text with [T]…[/T] around start (from 0) to end; an invalid span leaves the text as it is. All are SQL expressions.

    A replacement takes the target's place, and the longest end of the text before it that begins the replacement goes.
    """
    before, after = f"left({text}, {start})", f"substring({text}, {end} + 1)"
    if replacement is None:
        target = f"substring({text}, {start} + 1, {end} - {start})"
    else:
        target = replacement
        room = f"least(char_length({before}), char_length({target}))"
        overlap = f"coalesce(array_max(if({room} > 0, filter(sequence(1, greatest({room}, 1)), k -> right({before}, k) = left({target}, k)), array())), 0)"
        before = f"left({text}, {start} - {overlap})"
    return F.expr(f"CASE WHEN {start} < 0 OR {end} <= {start} OR {end} > char_length({text}) THEN {text} ELSE concat({before}, '{OPEN}', {target}, '{CLOSE}', {after}) END")


def marked_target(c) -> Column:
    """The trimmed text inside the first mark; empty without one."""
    return F.regexp_replace(F.regexp_extract(c, r"(?s)\[T\](.+?)\[/T\]", 1), r"(?U)^\s+|\s+$", "")


def has_one_mark(c) -> Column:
    times = lambda s: (F.char_length(c) - F.char_length(F.replace(c, F.lit(s), F.lit("")))) / F.lit(len(s))
    return (times(OPEN) == 1) & (times(CLOSE) == 1)


def tail_label(c, suffix: str) -> Column:
    """The last label 第…suffix of a text; empty without one."""
    found = F.regexp_extract_all(c, F.lit(f"(第[（(]?[{LABEL_LETTERS}]+[）)]?{suffix})"), F.lit(1))
    return F.when(c.isNotNull(), F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit("")))


def aliases(c) -> Column:
    """(alias, title) of every 《title》（以下简称alias）: close to the title first, then up to 40 letters on. Patterns apply
    in turn and the last definition of an alias wins, so of two titles in one sentence the earlier one gets it."""
    # a text is searched once for each pattern; a match read alone has the same groups, as no pattern looks beyond its match
    groups = lambda p: lambda m: F.struct(F.regexp_extract(m, p, 2).alias("alias"), F.regexp_extract(m, p, 1).alias("title"))
    found = []
    for gap in (r"\s*", r"[^。；;\n]{0,40}?"):
        for word in ("以下简称", "简称"):
            for left, right, inner in (("（", "）", "[^）]"), (r"\(", r"\)", "[^)]")):
                p = f"(?U)《([^》]+)》{gap}{left}{word}({inner}{{1,20}}){right}"
                found.append(F.transform(F.regexp_extract_all(c, F.lit(p), F.lit(0)), groups(p)))
    strip = lambda x: F.regexp_replace(x, "^[“”\"'《》()（） ]+|[“”\"'《》()（） ]+$", "")
    named = F.transform(F.concat(*found), lambda x: F.struct(strip(x["alias"]).alias("alias"), F.concat(F.lit("《"), F.trim(x["title"]), F.lit("》")).alias("title")))
    pairs = F.filter(named, lambda x: x["alias"] != "")
    last = lambda p: F.filter(p, lambda x, i: ~F.exists(F.slice(p, i + 2, F.greatest(F.size(p), F.lit(1))), lambda y: y["alias"] == x["alias"]))
    # bound as a variable: written into the inner function, all patterns would run again for every pair
    return F.transform(F.array(pairs), last)[0]


def embedding_text(name, description) -> Column:
    return F.regexp_replace(F.concat(name, F.lit("\n"), description), r"(?U)^\s+|\s+$", "")
