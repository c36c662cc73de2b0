"""Node ids of the hierarchy: what they say about a node, and how nodes sort; column expressions, null in, null out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the forms of node ids, by kind; groups are named as the fields of a locator
KEY = r"(\d{4})(?:-(\d{2}))?"
FORMS = {
    "document": (r"^document:(.+)$", ()),
    "toc": (r"^(?:part|chapter|section):(.+):(?:.+)$", ()),
    "article": (rf"^article:(.+):{KEY}$", ("article", "suffix")),
    "paragraph": (rf"^paragraph:(.+):{KEY}:(\d{{2}})$", ("article", "suffix", "paragraph")),
    "segment_item": (r"^item:(.+):segment:(\d{4}):(\d{2})$", ("segment", "item")),
    "item": (rf"^item:(.+):{KEY}(?::(\d{{2}}))?:(\d{{2}})$", ("article", "suffix", "paragraph", "item")),
    "segment_sub_item": (r"^sub_item:(.+):segment:(\d{4}):(\d{2}):(\d{2})$", ("segment", "item", "sub_item")),
    "sub_item": (rf"^sub_item:(.+):{KEY}(?::(\d{{2}}))?:(\d{{2}}):(\d{{2}})$", ("article", "suffix", "paragraph", "item", "sub_item")),
    "segment": (r"^segment:(.+):(\d{4})$", ("segment",)),
    "appendix": (r"^appendix:(.+):(\d{2})$", ("appendix",)),
}
FIELDS = ("article", "suffix", "paragraph", "item", "sub_item", "segment", "appendix")
LEVEL_ORDER = {"article": 1, "paragraph": 2, "item": 3, "sub_item": 4, "segment": 5, "appendix": 6, "document": 7}
CATEGORY_ALIASES = {"judicial": "interpretation", "local": "regulation"}
CATEGORY_RANK = {"constitution": 0, "law": 1, "regulation": 2, "interpretation": 3}


def locator(node_id) -> Column:
    """struct(kind, source, article, suffix, paragraph, item, sub_item, segment, appendix) of an id; null for other ids."""
    found = F.lit(None)
    for kind, (pattern, fields) in reversed(FORMS.items()):
        group = lambda k, p=pattern: F.regexp_extract(node_id, p, k)
        number = {f: F.nullif(group(k), F.lit("")).cast("int") for k, f in enumerate(fields, 2)}
        made = F.struct(F.lit(kind).alias("kind"), group(1).alias("source"), *(number.get(f, F.lit(None).cast("int")).alias(f) for f in FIELDS))
        found = F.when(node_id.rlike(pattern), made).otherwise(found)
    return found


def source_id(node_id) -> Column:
    """The source a node id belongs to; of an id of no known form its second part, null without one."""
    return F.coalesce(locator(node_id)["source"], F.get(F.split(node_id, ":"), F.lit(1)))


def node_id(at, source) -> Column:
    """The id of a locator struct in a source; table of contents nodes have none from numbers alone."""
    slug = F.regexp_replace(F.regexp_replace(F.lower(F.trim(source)), r"(?U)[^\w]+", "-"), "^-+|-+$", "")
    two = lambda c: F.format_string("%02d", at[c])
    key = F.concat(F.format_string("%04d", at["article"]), F.coalesce(F.concat(F.lit("-"), F.when(at["suffix"].isNotNull(), two("suffix"))), F.lit("")))
    segment = F.when(at["segment"].isNotNull(), F.format_string("%04d", at["segment"]))
    inner = F.when(at["paragraph"].isNotNull(), two("paragraph"))
    joined = lambda *parts: F.concat_ws(":", *parts)
    # concat_ws leaves out nulls: an item without a paragraph has no part for it
    return (
        F.when(at["kind"] == "document", joined(F.lit("document"), slug))
        .when(at["appendix"].isNotNull(), joined(F.lit("appendix"), slug, two("appendix")))
        .when(at["segment"].isNotNull() & at["item"].isNull(), joined(F.lit("segment"), slug, segment))
        .when(at["segment"].isNotNull() & at["sub_item"].isNull(), joined(F.lit("item"), slug, F.lit("segment"), segment, two("item")))
        .when(at["segment"].isNotNull(), joined(F.lit("sub_item"), slug, F.lit("segment"), segment, two("item"), two("sub_item")))
        .when(at["article"].isNotNull() & at["item"].isNull() & at["paragraph"].isNull(), joined(F.lit("article"), slug, key))
        .when(at["article"].isNotNull() & at["item"].isNull(), joined(F.lit("paragraph"), slug, key, inner))
        .when(at["article"].isNotNull() & at["sub_item"].isNull(), joined(F.lit("item"), slug, key, inner, two("item")))
        .when(at["article"].isNotNull(), joined(F.lit("sub_item"), slug, key, inner, two("item"), two("sub_item")))
    )


def sort_key(node_id, level) -> Column:
    """struct(rank, first, second, id): tables of contents and concepts by id, provisions by their numbers, the document
    last; levels whose ids do not parse come after all."""
    at = locator(node_id)
    numbered = at["kind"].isNotNull()
    rank = F.when(level.isin("part", "chapter", "section", "concept"), F.lit(0))
    for name, place in LEVEL_ORDER.items():
        rank = rank.when((level == name) & (numbered | (level == "document")), F.lit(place))
    first = F.lit(0)
    for name in ("article", "paragraph", "item", "sub_item", "segment", "appendix"):
        first = F.when((level == name) & numbered, F.coalesce(at[name], F.lit(0))).otherwise(first)
    second = F.when((level == "article") & numbered, F.coalesce(at["suffix"], F.lit(0))).otherwise(F.lit(0))
    return F.struct(rank.otherwise(F.lit(99)).alias("rank"), first.alias("first"), second.alias("second"), node_id.alias("id"))


def candidate_category(candidate_id) -> Column:
    """The category before the first colon of a candidate's id, older names included; null for an unknown one."""
    prefix = F.trim(F.element_at(F.split(candidate_id, ":"), 1))
    for old, new in CATEGORY_ALIASES.items():
        prefix = F.when(prefix == old, F.lit(new)).otherwise(prefix)
    return F.when(prefix.isin(*CATEGORY_RANK), prefix)


def category_rank(category) -> Column:
    """0 for the constitution, 1 law, 2 regulation, 3 interpretation; null for others."""
    rank = F.lit(None).cast("int")
    for name, place in CATEGORY_RANK.items():
        rank = F.when(category == name, F.lit(place)).otherwise(rank)
    return rank
