"""Questions users ask of the graph: laws, provisions, neighbourhoods, and ranked answers. Pages are ordered in full."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.functions.numerals import lookup_article
from lexweave.operators.graph import khop, owners

LEVEL_RANK = {"article": 1, "paragraph": 2, "item": 3, "sub_item": 4}


def _holds(column: str, word: str):
    return F.contains(F.lower(F.coalesce(F.col(column), F.lit(""))), F.lit(word.lower()))


def with_law(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes with law_id and law_name of the document over them (null without one)."""
    law = owners(edges, nodes).select(F.col("node").alias("id"), F.col("owner").alias("law_id"))
    names = nodes.filter("level = 'document'").select(F.col("id").alias("law_id"), F.col("name").alias("law_name"))
    return nodes.join(law, "id", "left").join(names, "law_id", "left")


def _matches(nodes: DataFrame, word: str) -> DataFrame:
    return nodes.filter((F.col("type") == "ProvisionNode") & (_holds("name", word) | _holds("text", word)))


def search_provisions(nodes: DataFrame, edges: DataFrame, word: str, offset: int = 0, limit: int = 20) -> DataFrame:
    """id, name, law_name, level of a page of the provisions that hold a word: articles first, then the shorter text, then id."""
    rank = F.lit(5)
    for level, place in LEVEL_RANK.items():
        rank = F.when(F.col("level") == level, F.lit(place)).otherwise(rank)
    page = _matches(nodes, word).orderBy(rank, F.char_length(F.coalesce("text", "name", F.lit(""))), "id").offset(offset).limit(limit)
    return with_law(nodes, edges).join(page.select("id"), "id", "left_semi").select("id", "name", "law_name", "level")


def count_provisions(nodes: DataFrame, word: str) -> DataFrame:
    """One row: how many provisions hold a word, beside any page of them."""
    return _matches(nodes, word).agg(F.count("*").alias("total"))


def filter_laws(nodes: DataFrame, edges: DataFrame, word: str | None = None, category: str | None = None, status: str | None = None) -> DataFrame:
    """Provisions with their law; a filter that is None lets everything pass, also laws without a value."""
    out = with_law(nodes.select("id", "type", "level", "name", "text"), edges)
    law = nodes.select(F.col("id").alias("law_id"), F.col("category").alias("law_category"), F.col("status").alias("law_status"))
    out = out.join(law, "law_id", "left").filter("type = 'ProvisionNode'")
    if word is not None:
        out = out.filter(_holds("name", word) | _holds("text", word))
    for column, want in (("law_category", category), ("law_status", status)):
        if want is not None:
            out = out.filter(F.col(column) == want)
    return out


def search_laws(nodes: DataFrame, word: str, limit: int = 20) -> DataFrame:
    return nodes.filter((F.col("level") == "document") & _holds("name", word)).orderBy("name", "id").limit(limit).select("id", "name")


def outline(nodes: DataFrame, edges: DataFrame, law_id: str) -> DataFrame:
    """id, parent, depth, level, name of everything under a document, itself at depth 0."""
    from lexweave.operators.graph import ancestors, parents

    under = ancestors(edges).filter(F.col("ancestor") == law_id).select(F.col("node").alias("id"), "depth")
    every = under.unionByName(nodes.filter(F.col("id") == law_id).select("id", F.lit(0).alias("depth")))
    return every.join(nodes.select("id", "level", "name"), "id").join(parents(edges).withColumnRenamed("child", "id"), "id", "left").select("id", "parent", "depth", "level", "name")


def find_law(nodes: DataFrame, asked: DataFrame) -> DataFrame:
    """(asked, id): the document whose id is asked for, else the one with that title (the smallest id of several)."""
    docs = nodes.filter("level = 'document'")
    named = docs.groupBy(F.col("name").alias("asked")).agg(F.min("id").alias("by_name"))
    return asked.join(docs.select(F.col("id").alias("asked"), F.col("id").alias("by_id")), "asked", "left").join(named, "asked", "left").select("asked", F.coalesce("by_id", "by_name").alias("id"))


def find_article(nodes: DataFrame, edges: DataFrame, questions: DataFrame) -> DataFrame:
    """(law, article, id) of questions (law, article): the smallest id of the articles of that name in the laws of that name.

    Names meet by equality after 《》 and numerals are normalised; a question no provision answers has a null id."""
    asked = questions.withColumn("law_key", F.lower(F.translate(F.trim("law"), "《》", ""))).withColumn("article_key", lookup_article("article"))
    known = with_law(nodes, edges).filter("type = 'ProvisionNode'").groupBy(F.lower("law_name").alias("law_key"), F.col("name").alias("article_key")).agg(F.min("id").alias("id"))
    return asked.join(known, ["law_key", "article_key"], "left").select("law", "article", "id")


def subgraph(nodes: DataFrame, edges: DataFrame, start: DataFrame, hops: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) within some undirected hops of each start: nearest first, then by id, at most `limit` a start; edges
    have both ends among the nodes kept."""
    from pyspark.sql import Window

    near = khop(edges, start, hops).withColumn("r", F.row_number().over(Window.partitionBy("start").orderBy("hop", "node"))).filter(F.col("r") <= limit).drop("r")
    a, b = near.select("start", F.col("node").alias("source")), near.select("start", F.col("node").alias("target"))
    return near, edges.select("source", "target", "type").distinct().join(a, "source").join(b, ["start", "target"]).select("start", "source", "target", "type")


def diversify(ranked: DataFrame, k: int, same: int = 2) -> DataFrame:
    """(list_id, rank, item_id) of ranked (list_id, rank, item_id, law): in turn the next item, but after `same` of one law in
    a row the next one of another law, if there is one; k a list.

    Every choice depends on those before it, so each list goes through one pass in Python. A list is an answer's length: of
    each only the first items that k picks can reach are read, k of every law at most."""
    from pyspark.sql import Window

    reach = F.row_number().over(Window.partitionBy("list_id", F.coalesce("law", F.lit(""))).orderBy("rank", "item_id"))
    short = ranked.withColumn("r", reach).filter(F.col("r") <= k).drop("r")

    def pick(rows: pd.DataFrame) -> pd.DataFrame:
        pool = rows.sort_values(["rank", "item_id"])[["item_id", "law"]].values.tolist()
        out, last, streak = [], "", 0
        while pool and len(out) < k:
            at = 0
            if last and streak >= same:
                at = next((i for i, (_, law) in enumerate(pool) if law and law != last), 0)
            item, law = pool.pop(at)
            law = law or ""
            streak = streak + 1 if law and law == last else int(bool(law))
            last = law
            out.append(item)
        return pd.DataFrame({"list_id": rows["list_id"].iloc[0], "rank": range(1, len(out) + 1), "item_id": out})

    schema = f"list_id {ranked.schema['list_id'].dataType.simpleString()}, rank int, item_id {ranked.schema['item_id'].dataType.simpleString()}"
    return short.groupBy("list_id").applyInPandas(pick, schema)


def system_counts(nodes: DataFrame, updated: DataFrame) -> DataFrame:
    """One row: laws, nodes, provisions, and the latest `updated_at`."""
    latest = updated.agg(F.max("updated_at").alias("updated_at")).first()["updated_at"]
    return nodes.agg(F.count_if(F.col("level") == "document").alias("laws"), F.count("*").alias("nodes"), F.count_if(F.col("type") == "ProvisionNode").alias("provisions")).withColumn("updated_at", F.lit(latest))
