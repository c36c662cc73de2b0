"""Provisions: outlines of statutes from their lines, aliases and titles met in sentences, references resolved to nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexweave.functions import headings, numerals, references, statute
from lexweave.functions.references import PATH
from lexweave.operators import graph
from lexweave.plans.cut import spread

LEVELS = ("document", "part", "chapter", "section", "article", "paragraph", "item", "sub_item")


def with_parents(rows: DataFrame, document: str, place: str, key: str) -> DataFrame:
    """rows (with a level of LEVELS) with parent: the key of the nearest row before it in its document that has a higher level,
    null for none. A heading hides all lower ones before it, so the nearest higher row is also the lowest open one."""
    rank = F.array_position(F.array(*(F.lit(x) for x in LEVELS)), F.col("level"))
    before = Window.partitionBy(document).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    seen = F.array(*(F.last(F.when(F.col("__rank") <= k, F.col(key)), ignorenulls=True).over(before) for k in range(1, len(LEVELS))))
    return rows.withColumn("__rank", rank).withColumn("parent", F.when(F.col("__rank") > 1, F.get(seen, (F.col("__rank") - 2).cast("int")))).drop("__rank")


def with_ordinals(rows: DataFrame, document: str, place: str) -> DataFrame:
    """rows with ordinal: the running number of a row among those of its level under its parent, from 1."""
    return rows.withColumn("ordinal", F.row_number().over(Window.partitionBy(document, "level", "parent").orderBy(place)).cast("long"))


def outline(lines: DataFrame) -> DataFrame:
    """(document, place, level, text, parent, ordinal): lines (document, place, text) that are headings by their level, and every
    other line that is not blank as a paragraph; parent is the place of the row they stand under, null at the top.

    A heading above articles goes on over the next line where that looks like its continuation and no numbered list follows."""
    text = F.trim(F.regexp_replace(F.regexp_replace("text", "[​‌‍﻿]", ""), "[ \t　 ]+", " "))
    rows = lines.select("document", "place", text.alias("text")).filter("text <> ''").withColumn("level", headings.heading_level(F.col("text")))
    w = Window.partitionBy("document").orderBy("place")
    # a row may go on with the one before it; a run of such rows belongs to the heading it begins behind
    loose = F.col("level").isNull() & headings.continues_heading(F.col("text")) & ~F.coalesce(F.lead("text").over(w), F.lit("")).rlike(r"^[0-9０-９]+[.．、]\s*.+$")
    rows = rows.withColumn("loose", loose)
    firm = F.last(F.when(~F.col("loose"), F.col("place")), ignorenulls=True).over(w)
    opens = F.last(F.when(~F.col("loose"), F.coalesce(F.col("level").isin("part", "chapter", "section"), F.lit(False))), ignorenulls=True).over(w)
    rows = rows.withColumns({"firm": firm, "joins": F.col("loose") & F.coalesce(opens, F.lit(False))})
    head = rows.groupBy("document", F.when(F.col("joins"), F.col("firm")).otherwise(F.col("place")).alias("place")).agg(
        F.min_by("level", "place").alias("level"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("place").alias("p"), "text"))), lambda x: x["text"]), "").alias("text"))
    head = head.withColumn("level", F.coalesce("level", F.lit("paragraph")))
    return with_ordinals(with_parents(head, "document", "place", "place"), "document", "place")


def relevant_aliases(sentences: DataFrame, aliases: DataFrame) -> DataFrame:
    """(id, alias, title, rank): the aliases (document, alias, title; a null document: for all) that a sentence (id, document,
    sentence) holds, the longest first; its own document's meaning of an alias hides the common one.

    They meet on the alias's first two letters, so a sentence meets few aliases and no pair is tried by contains alone."""
    s = F.col("sentence")
    starts = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.char_length(s)), lambda k: F.array(F.substring(s, k, F.lit(1)), F.substring(s, k, F.lit(2))))))
    bits = sentences.filter(F.char_length(s) > 0).select("id", F.col("document").alias("__own"), "sentence", F.explode(starts).alias("__start"))
    named = aliases.filter("alias <> ''").withColumn("__start", F.left("alias", F.lit(2))).withColumnRenamed("document", "__of")
    met = bits.join(named, "__start").filter(F.contains("sentence", "alias") & (F.col("__of").isNull() | (F.col("__of") == F.col("__own"))))
    best = met.groupBy("id", "alias").agg(F.min_by("title", F.struct(F.col("__of").isNull(), "title")).alias("title"))
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy(F.desc(F.char_length("alias")), "alias")))


def provision_paths(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(document_id, node_id, article, suffix, paragraph, item, sub_item): the numbers in the labels of a provision (id, level,
    name) and of all above it, 0 for levels it does not have; only nodes below a document and at or below an article."""
    closure = graph.ancestors(edges).select("node", "ancestor").unionByName(nodes.select(F.col("id").alias("node"), F.col("id").alias("ancestor")))
    unit = F.lit("")
    for level, mark in headings.UNITS.items():
        unit = F.when(F.col("level") == level, statute.tail_label(F.col("name"), mark)).otherwise(unit)
    own = nodes.select(F.col("id").alias("ancestor"), "level", "name", unit.alias("__label"))
    own = own.withColumn("no", headings.label_number("__label")).withColumn("suffix", numerals.from_chinese(f"nullif(regexp_extract(name, '条之({numerals.NUMERAL})', 1), '')")).drop("__label", "name")
    at = lambda level, c="no": F.max(F.when(F.col("level") == level, F.col(c)))
    paths = closure.join(own, "ancestor").groupBy("node").agg(
        F.min(F.when(F.col("level") == "document", F.col("ancestor"))).alias("document_id"), at("article").alias("article"), at("article", "suffix").alias("suffix"), *(at(x).alias(x) for x in PATH[2:]))
    return paths.filter("document_id IS NOT NULL AND article IS NOT NULL").select("document_id", F.col("node").alias("node_id"), *(F.coalesce(p, F.lit(0).cast("long")).alias(p) for p in PATH))


def lookup(paths: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (document_id and a path) with node_id, the smallest node of that path; null where there is none."""
    first = paths.groupBy("document_id", *PATH).agg(F.min("node_id").alias("node_id"))
    return wanted.join(first.hint("merge"), ["document_id", *PATH], "left")


def detect(sentences: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """(id, document_id, kind, title, start, end, text, targets) of the references in sentences (id, document_id, title, sentence,
    article, suffix); sentences that can hold none, or amend and define, never reach Python. aliases is (id, alias, title).
    The rest are spread, since Python spends far longer on a sentence than reading it takes."""
    s = sentences.filter(references.may_refer(F.col("sentence")) & ~references.is_skipped(F.col("sentence")))
    if aliases is None:
        s = s.withColumn("__aliases", F.expr("cast(array() AS array<struct<alias:string,title:string>>)"))
    else:
        s = s.join(aliases.groupBy("id").agg(F.collect_list(F.struct("alias", "title")).alias("__aliases")), "id", "left")
    s = spread(s, "id", "sentence")
    found = s.select("id", "document_id", F.explode(references.references(F.col("sentence"), F.col("__aliases"), F.col("title"), F.col("article"), F.col("suffix"))).alias("r"))
    return found.select("id", "document_id", "r.*").filter(~references.is_own_word(F.col("text")))


def resolve(found: DataFrame, titles: DataFrame, paths: DataFrame) -> DataFrame:
    """(id, start, end, text, node_id): the provisions that references (of detect) mean, without repeats.

    A title (title, document_id) may have several documents; a reference to the own document keeps to it. A path meets its
    node on equal numbers; a range meets every node of its document whose number at the range's level lies in it and whose other
    numbers are equal. node_id is null where a known document has no such node; references to unknown titles go.

    Titles and paths are as many as documents and nodes, and Spark takes exploded ones for no larger than what they are made
    of, so they are never broadcast: the merge hints keep them out of the driver. A range's ends are above 0, so it meets
    only nodes that have a number at its level, by all their other numbers."""
    at = found.select("id", "document_id", "kind", "title", "start", "end", "text", F.explode("targets").alias("t"))
    own = at.filter("kind = 'local'").select("id", "document_id", "start", "end", "text", "t.*")
    other = at.filter("kind <> 'local'").drop("document_id").join(titles.select("title", "document_id").distinct().hint("merge"), "title").select("id", "document_id", "start", "end", "text", "t.*")
    every = own.unionByName(other)
    one = lookup(paths, every.filter("level IS NULL")).select("id", "start", "end", "text", "node_id")
    others = lambda level: F.array(*(F.when(level == name, F.lit(0).cast("long")).otherwise(F.col(name)) for name in PATH))
    ranged = every.filter("level IS NOT NULL").select("id", "start", "end", "text", "document_id", "level", "upto", others(F.col("level")).alias("__others"), F.element_at(F.array(*PATH), F.array_position(F.array(*(F.lit(x) for x in PATH)), F.col("level")).cast("int")).alias("__from"))
    numbered = paths.withColumn("__at", F.explode(F.array_compact(F.array(*(F.when(F.col(x) > 0, F.struct(F.lit(x).alias("level"), F.col(x).alias("no"))) for x in PATH)))))
    numbered = numbered.select("document_id", "node_id", F.col("__at.level").alias("level"), others(F.col("__at.level")).alias("__others"), F.col("__at.no").alias("__no"))
    many = ranged.join(numbered.hint("merge"), ["document_id", "level", "__others"]).filter(F.col("__no").between(F.col("__from"), F.col("upto"))).select("id", "start", "end", "text", "node_id")
    return one.unionByName(many).distinct()


def parallel_groups(spans: DataFrame) -> DataFrame:
    """(id, start, end, group_start, group_end): the references of a sentence (id, sentence, start, end) that only connectors
    part, with the span of their group; those alone are left out."""
    w = Window.partitionBy("id").orderBy("start", "end")
    gap = F.substring("sentence", F.lag("end").over(w) + 1, F.greatest(F.col("start") - F.lag("end").over(w), F.lit(0)))
    rows = spans.withColumn("__new", F.when(F.coalesce(references.is_parallel_gap(gap), F.lit(False)), 0).otherwise(1))
    rows = rows.withColumn("__group", F.sum("__new").over(w))
    g = Window.partitionBy("id", "__group")
    rows = rows.withColumns({"__n": F.count("*").over(g), "group_start": F.min("start").over(g), "group_end": F.max("end").over(g)})
    return rows.filter("__n > 1").select("id", "start", "end", "group_start", "group_end")


def grouped_targets(resolved: DataFrame) -> DataFrame:
    """(id, text, node_ids): the distinct targets of a source's marked text, in the order in which they stand (place)."""
    known = resolved.filter("node_id IS NOT NULL").groupBy("id", "text", "node_id").agg(F.min("place").alias("place"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("place", "node_id"))), lambda x: x["node_id"])
    return known.groupBy("id", "text").agg(ordered.alias("node_ids"))


def augmented(sources: DataFrame, nodes: DataFrame, edges: DataFrame, most: int = 220) -> DataFrame:
    """sources (id, node_id, sentence) with text and offset: before the sentence of an item or sub-item stand the texts of the
    nearest two of its paragraph and article (id, level, text), cut to `most` letters; the offset is their length.

    Blank texts, the sentence itself and repeats do not count; all else keeps its sentence and offset 0."""
    up = graph.ancestors(edges).select(F.col("node").alias("node_id"), F.col("ancestor").alias("__a"), "depth")
    above = nodes.filter("level IN ('paragraph', 'article')").select(F.col("id").alias("__a"), F.col("level").alias("__level"), F.trim("text").alias("__text")).filter("__text <> ''")
    low = nodes.filter("level IN ('item', 'sub_item')").select(F.col("id").alias("node_id"))
    flat = lambda c: F.regexp_replace(c, r"(?U)\s+", "")
    met = sources.select("id", "node_id", "sentence").join(low, "node_id").join(up, "node_id").join(above, "__a").filter(flat(F.col("__text")) != flat(F.col("sentence")))
    near = met.groupBy("id", flat(F.col("__text")).alias("__flat")).agg(F.min(F.struct("depth", "__level", "__text")).alias("x")).select("id", "x.*")
    kept = near.withColumn("__r", F.row_number().over(Window.partitionBy("id").orderBy("depth")))
    kept = kept.withColumn("__stop", F.min(F.when(F.col("__level") == "article", F.col("__r"))).over(Window.partitionBy("id"))).filter("__r <= 2 AND __r <= coalesce(__stop, 2)")
    joined = F.array_join(F.transform(F.reverse(F.array_sort(F.collect_list(F.struct("__r", "__text")))), lambda x: x["__text"]), "")
    context = kept.groupBy("id").agg(joined.alias("__c")).withColumn("__c", F.when(F.char_length("__c") > most, F.concat(F.regexp_replace(F.left("__c", F.lit(most)), "[，,；; ]+$", ""), F.lit("..."))).otherwise(F.col("__c")))
    out = sources.join(context, "id", "left")
    use = F.col("__c").isNotNull() & ~F.coalesce(F.startswith(flat(F.col("sentence")), flat(F.col("__c"))), F.lit(False))
    return out.withColumns({"text": F.when(use, F.concat("__c", "sentence")).otherwise(F.col("sentence")), "offset": F.when(use, F.char_length("__c")).otherwise(0)}).drop("__c")
