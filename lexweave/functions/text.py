"""Scalar text functions of the engine as column expressions; null in, null out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def compact(c) -> Column:
    """Without any white space, U+3000 included."""
    return F.regexp_replace(c, r"(?U)\s+", "")


def clean(c) -> Column:
    """Invisible letters out, runs of blanks (U+3000 too) to one, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, "[​‌‍﻿]", ""), "[ \t　 ]+", " "))


def slug(c) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"(?U)[^\w]+", "-"), "^-+|-+$", "")


def ascii_digits(c) -> Column:
    return F.translate(c, "０１２３４５６７８９", "0123456789")


def strip_html(c) -> Column:
    return F.regexp_replace(c, "<[^>]+>", "")


def iso_date(c) -> Column:
    """YYYY年M月D日 and YYYY-M-D as ISO dates; anything else unchanged."""
    found = lambda p: (F.regexp_extract(c, p, 1), F.regexp_extract(c, p, 2), F.regexp_extract(c, p, 3))
    out = c
    for p in (r"^\s*(\d{4})-(\d{1,2})-(\d{1,2})\s*$", r"^\s*(\d{4})年(\d{1,2})月(\d{1,2})日\s*$"):
        y, m, d = found(p)
        out = F.when(c.rlike(p), F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))).otherwise(out)
    return out


# fixed values: authorities before a title, and the words of versions in brackets after it
AUTHORITIES = ("中华人民共和国", "最高人民法院关于", "最高人民检察院关于", "国务院关于", "全国人民代表大会常务委员会关于", "全国人民代表大会关于")
VERSION_WORDS = ("修正文本", "修正版", "修订版", "修正版文本", "草案", "征求意见稿", "试行", "暂行", "修正案")


def bare_title(c) -> Column:
    """A title without white space and without quotes around it."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", ""), "^[《》“”\"']+|[《》“”\"']+$", "")


def title_variants(c) -> Column:
    """The sorted forms a title is cited by, of two letters at least: bare, without its version in brackets, and each of
    these without the authority before it."""
    version = F.regexp_replace(F.regexp_replace(bare_title(c), rf"[（(](?:\d{{4}}年)?(?:{'|'.join(VERSION_WORDS)}).*?[）)]$", ""), r"[（(]\d{4}年[）)]$", "")
    full = F.array(bare_title(c), version)
    # the pattern asks for a letter after the authority: an authority alone is a title of its own
    short = F.transform(full, lambda x: F.regexp_replace(x, f"^(?:{'|'.join(AUTHORITIES)})(?=.)", ""))
    every = F.transform(F.concat(full, short), lambda x: bare_title(x))
    return F.when(c.isNotNull(), F.array_sort(F.array_distinct(F.filter(every, lambda x: F.char_length(x) >= 2))))


def pair_key(a, b) -> Column:
    """One key for an unordered pair."""
    return F.concat_ws("\t", F.least(a, b), F.greatest(a, b))


def stable_id(*parts) -> Column:
    return F.sha2(F.concat_ws("\t", *parts), 256)


def keywords(c, n: int = 12) -> Column:
    """The first n distinct runs of 2 to 8 Chinese letters."""
    return F.slice(F.array_distinct(F.regexp_extract_all(c, F.lit("([一-鿿]{2,8})"), F.lit(1))), 1, n)


def cited_titles(c) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit("《([^《》]+)》"), F.lit(1)))
