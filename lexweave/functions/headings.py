"""Headings of statutes, dates of documents, names and descriptions of concepts, ids: small column expressions; null in, null out
unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: heading patterns by level, marks of items, words of dates, generic ends of concept names, filler before
# descriptions, segments of ids after the document's
_FEW = "[一二三四五六七八九十百零]+"
_ANY = "[一二三四五六七八九十百千万零两〇0-9]+"
HEADINGS = {
    "part": rf"^第{_FEW}编(?:(?U)\s*.+)?$", "chapter": rf"^第{_FEW}章(?:(?U)\s*.+)?$", "section": rf"^第{_FEW}节(?:(?U)\s*.+)?$",
    "article": rf"^第{_ANY}条(?:之{_ANY})?(?:[\s　]+.*)?$",
}
ITEM_START = "^(?:[（(][一二三四五六七八九十]+[）)]|[一二三四五六七八九十]+、|[0-9０-９]+[.．、]|[（(][0-9０-９]+[）)])"
EFFECTIVE = r"自(\d{4}年\d{1,2}月\d{1,2}日)起(?:施行|实施|执行)"
GENERIC_ENDS = ("一般规定", "基本规定", "基本原则", "适用范围", "定义", "制度", "法律", "规则", "主体", "内容", "机制")
GENERIC_LAW = "^.+法(?:一般规定|基本规定|适用范围)$"
FILLER = "(?:是指|系指|指的是?|表示|定义为|定义成|即为|即|是|指)"
MEASURES = "^(?:一种|一类|一个|一项)"
EDGE = r"[：:、，,；;（）()\[\]【】\s　]+"
ID_TAIL = {"document": 0, "article": 1, "paragraph": 2, "item": 3, "sub_item": 4, "segment": 1, "appendix": 1}


def heading_level(c) -> Column:
    """part, chapter, section or article; null for a line that is no heading."""
    out = F.lit(None).cast("string")
    for level, pattern in reversed(HEADINGS.items()):
        out = F.when(c.rlike(pattern), level).otherwise(out)
    return out


def continues_heading(c) -> Column:
    """Whether a line can go on with the heading before it: no sentence marks, no item's mark, at most 24 letters."""
    return (c != "") & ~c.rlike("[。；：，]") & ~c.rlike(ITEM_START) & (F.char_length(F.regexp_replace(c, "[ 　]", "")) <= 24)


def signature_date(lines) -> Column:
    """The last line of the first 40 that is only a date (the lines are an array); empty without one."""
    dates = F.filter(F.transform(F.slice(lines, 1, 40), lambda x: F.trim(x)), lambda x: x.rlike(r"^\d{4}年\d{1,2}月\d{1,2}日$"))
    return F.when(lines.isNotNull(), F.coalesce(F.try_element_at(dates, F.lit(-1)), F.lit("")))


def effective_date(preface, signed, events) -> Column:
    """The date a preface sets, else the signature's where it says 自即日起, else the last event's, else the signature's;
    events is an array of dates, null arguments are empty."""
    said, signed = F.regexp_extract(F.coalesce(preface, F.lit("")), EFFECTIVE, 1), F.coalesce(signed, F.lit(""))
    at_once = F.contains(F.coalesce(preface, F.lit("")), F.lit("自即日起")) & (signed != "")
    return F.when(said != "", said).when(at_once, signed).otherwise(F.coalesce(F.try_element_at(events, F.lit(-1)), signed))


def squeezed(c) -> Column:
    """White space runs to one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def _edges_off(c) -> Column:
    return F.regexp_replace(F.regexp_replace(c, f"{EDGE}$", ""), f"^{EDGE}", "")


def concept_name(c) -> Column:
    """A concept's name without one generic end; null where nothing but generic words is left."""
    name = squeezed(c)
    out = name
    for end in reversed(GENERIC_ENDS):
        stem = squeezed(_edges_off(F.left(name, F.char_length(name) - F.lit(len(end)))))
        void = (stem == "") | F.concat(stem, F.lit(end)).rlike(GENERIC_LAW)
        out = F.when(F.endswith(name, F.lit(end)), F.when(~void, stem)).otherwise(out)
    return F.when((name != "") & ~name.isin(*GENERIC_ENDS) & ~name.rlike(GENERIC_LAW), out)


def concept_description(c, name) -> Column:
    """A description without marks at its ends and filler at its start, the concept's name included; null where nothing is left."""
    text = _edges_off(squeezed(c))
    named = squeezed(F.coalesce(name, F.lit("")))
    rest = F.substring(text, F.char_length(named) + F.lit(1), F.char_length(text))
    lead = rf"(?U)^[，,：:\s]*{FILLER}\s*"
    text = F.when(F.startswith(text, named) & rest.rlike(lead), F.trim(F.regexp_replace(rest, lead, ""))).otherwise(text)
    for pattern in (rf"(?U)^{FILLER}\s*", rf"(?U){MEASURES}\s*"):
        text = F.when(text.rlike(pattern), _edges_off(F.trim(F.regexp_replace(text, pattern, "")))).otherwise(text)
    return F.nullif(squeezed(text), F.lit(""))


def citation(law, article, paragraph, item) -> Column:
    """《law》 with article, paragraph and item; the law's name alone without an article."""
    part = lambda x: F.coalesce(x, F.lit(""))
    return F.when(part(article) == "", law).otherwise(F.concat(F.lit("《"), law, F.lit("》"), part(article), part(paragraph), part(item)))


def token_estimate(texts, most_output: int = 0) -> Column:
    """Letters of an array of texts and the letters an answer may have; null texts count none."""
    return F.aggregate(texts, F.lit(max(most_output, 0)).cast("long"), lambda a, x: a + F.coalesce(F.char_length(x), F.lit(0)))


def source_document(c) -> Column:
    """The document of a node id such as item:law:x:0001:02:03 (law:x): as many segments go at its end as its level has."""
    parts, level = F.split(c, ":"), F.substring_index(c, ":", 1)
    tail = F.lit(1)
    for name, n in ID_TAIL.items():
        tail = F.when(level == name, n).otherwise(tail)
    keep = F.when(F.size(parts) <= tail + 1, F.size(parts) - 1).otherwise(F.size(parts) - 1 - tail)
    return F.when((level == "document") | (F.size(parts) <= 2), c).otherwise(F.array_join(F.slice(parts, F.lit(2), F.greatest(keep, F.lit(0))), ":"))


def granularity(c) -> Column:
    """paragraph, item and sub_item by the id's prefix; all else is article."""
    level = F.substring_index(c, ":", 1)
    return F.when(level.isin("paragraph", "item", "sub_item"), level).otherwise("article")


def category_signature(c) -> Column:
    """The distinct names of an array, trimmed and sorted, joined by |."""
    return F.array_join(F.array_sort(F.array_distinct(F.filter(F.transform(c, lambda x: F.trim(x)), lambda x: x != ""))), "|")


def fingerprint(*columns: str) -> Column:
    """sha256 of a row's columns as JSON, by name, nulls written."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


# fixed values: the unit of each level's label
UNITS = {"article": "条", "paragraph": "款", "item": "项", "sub_item": "目"}


def label(level: str, n: str) -> Column:
    """The label of a number (an SQL expression) at a level; items and sub-items have their number in brackets."""
    from .numerals import to_chinese

    left, right = ("第（", "）") if level in ("item", "sub_item") else ("第", "")
    return F.concat(F.lit(left), to_chinese(n), F.lit(right + UNITS[level]))


def label_number(c: str) -> Column:
    """The number of the first label in a column's text, with or without 第 and brackets; null without one."""
    from .numerals import from_chinese

    return from_chinese(f"nullif(regexp_extract({c}, '[（(]?({_ANY})[）)]?[条款项目]', 1), '')")


def rendered(article: str, suffix: str, paragraph: str, item: str, sub_item: str) -> Column:
    """A path of numbers (SQL expressions, 0 or null where not given) as 第十条之一第二款第三项第四目."""
    from .numerals import to_chinese

    part = lambda n, left, right: F.coalesce(F.concat(F.lit(left), to_chinese(n), F.lit(right)), F.lit(""))
    return F.concat(part(article, "第", "条"), part(suffix, "之", ""), part(paragraph, "第", "款"), part(item, "第", "项"), part(sub_item, "第", "目"))
