"""Categories, statuses and titles of documents, and the rules on relations that rest on them; column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .labels import has_any, stripped
from .locator import category_rank

# fixed values: categories as written, statuses and titles of excluded documents, marks of interpretations
CATEGORIES = {
    "宪法": "constitution", "法律": "law", "司法解释": "interpretation", "行政法规": "regulation", "地方法规": "regulation", "监察法规": "regulation",
    "constitution": "constitution", "law": "law", "interpretation": "interpretation", "regulation": "regulation",
}
EXCLUDED_STATUS = ("已废止", "已修改")
EXCLUDED_TITLES = "关于(?:废止|修改).+的决定|^废止.+的决定$|修正案|修订草案"
COURTS = ["最高人民法院", "最高人民检察院"]
INTERPRETING_WORDS = ["解释", "批复", "答复"]
TITLE_INTERPRETATIONS = r"关于\[T\].+?\[/T\]的解释$|关于\[T\].+?\[/T\]适用问题的解释$|关于适用\[T\].+?\[/T\]的解释$|关于办理.+?\[T\].+?\[/T\].+?(?:解释|规定|批复|答复)$"
_N = "[一二三四五六七八九十百千万零两〇0-9]+"
LEGISLATIVE_TITLE = f"全国人民代表大会常务委员会关于《[^》]+》第{_N}条(?:之{_N})?(?:第{_N}款)?(?:第(?:[（(]{_N}[）)]|{_N})项)?的解释"


def _text(c) -> Column:
    return stripped(F.coalesce(c, F.lit("")))


def category(c) -> Column:
    """The category of a document as one of four; null for an unknown one (validation reports those)."""
    name, out = _text(c), F.lit(None).cast("string")
    for written, kind in CATEGORIES.items():
        out = F.when(name == written, F.lit(kind)).otherwise(out)
    return out


def is_excluded(title, status, given_category) -> Column:
    """Repealed or amended documents, decisions to repeal or amend, amendments and drafts."""
    return _text(status).isin(*EXCLUDED_STATUS) | _text(title).rlike(EXCLUDED_TITLES) | F.contains(_text(given_category), F.lit("修正案"))


def is_judicial_interpretation(title, issuer, given_category) -> Column:
    kind = F.concat_ws(" ", F.coalesce(given_category, F.lit("")), F.coalesce(issuer, F.lit("")))
    return F.contains(kind, F.lit("司法解释")) | has_any(issuer, COURTS) | has_any(title, INTERPRETING_WORDS)


def is_legislative_interpretation(title, status, given_category) -> Column:
    """Laws in force whose title explains an article of another law."""
    return ~is_excluded(title, status, given_category) & F.coalesce(category(given_category) == "law", F.lit(False)) & _text(title).rlike(LEGISLATIVE_TITLE)


def in_low_confidence(score, low: float, high: float) -> Column:
    return (score > low) & (score < high)


def decision_source(score, corrected, low: float, high: float) -> Column:
    """rule for corrected rows, else model_high, model_low or fallback by the score."""
    return F.when(corrected, "rule").when(score >= high, "model_high").when(score <= low, "model_low").otherwise("fallback")


def corrected_relation(relation, source_category, target_categories, source_node_id, text) -> Column:
    """struct(relation, corrected) after the rules: an obvious title interpretation interprets; then for each target in turn
    whose category ranks below the source's, REFERENCES and INTERPRETS change places (so two such targets cancel out)."""
    by_title = (relation == "REFERENCES") & F.startswith(source_node_id, F.lit("document:")) & _text(text).rlike(TITLE_INTERPRETATIONS)
    start = F.when(by_title, F.lit("INTERPRETS")).otherwise(relation)
    source = category_rank(source_category)
    wrong = F.filter(F.coalesce(target_categories, F.array().cast("array<string>")), lambda t: ~F.coalesce(category_rank(t) <= source, F.lit(False)))
    swaps = F.when(start.isin("REFERENCES", "INTERPRETS"), F.size(wrong)).otherwise(F.lit(0))
    other = F.when(start == "REFERENCES", F.lit("INTERPRETS")).otherwise(F.lit("REFERENCES"))
    return F.struct(F.when(swaps % 2 == 1, other).otherwise(start).alias("relation"), (by_title | (swaps > 0)).alias("corrected"))


def is_accepted(relation, strength, least: int = 7) -> Column:
    """Whether a judged pair counts: a relation other than none, and strong enough."""
    return F.coalesce((_text(relation) != "") & (_text(relation) != "none") & (strength >= least), F.lit(False))
