"""Set operations of the stages: upserts, ordered differences, deduplication, and edges rebuilt from relations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.functions.text import stable_id
from lexweave.operators.graph import merge_edges, merge_nodes


def merge_index(old: DataFrame, completed: DataFrame, failed: DataFrame, key: str = "source_id") -> DataFrame:
    """old with the completed rows put in place of theirs, without the failed ids; a completed row wins over its failure."""
    rest = [c for c in old.columns if c != key]
    both = merge_nodes(*(d.select(F.col(key).alias("id"), *rest) for d in (old.join(failed.select(key).distinct(), key, "left_anti"), completed)))
    return both.withColumnRenamed("id", key).select(old.columns)


def ordered_subtract(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The rows of left whose key is not in right; their place column keeps the order."""
    return left.join(right.select(key).distinct(), key, "left_anti").select(left.columns)


def ordered_distinct(df: DataFrame, key: str, place: str) -> DataFrame:
    """Each trimmed, non-empty key once, at its first place."""
    return df.select(F.trim(key).alias(key), place).filter(F.col(key) != "").groupBy(key).agg(F.min(place).alias(place))


def first_rows(df: DataFrame, keys: list[str], place: str) -> DataFrame:
    """The first row by `place` of every combination of keys; rows at one place are told apart by their JSON."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(place, F.to_json(F.struct(*rest)))).alias("r")).select(*keys, *(f"r.{c}" for c in rest)).select(df.columns)


def completeness(documents: DataFrame, metadata: DataFrame, loaded: DataFrame, key: str = "source_id") -> DataFrame:
    """One row: how many ids each of three tables has, and how many documents lack metadata or are not loaded."""
    ids = lambda d, name: d.select(F.col(key).alias("k")).filter("k IS NOT NULL").distinct().withColumn(name, F.lit(1))
    met = ids(documents, "d").join(ids(metadata, "m"), "k", "full").join(ids(loaded, "l"), "k", "full")
    return met.agg(F.count("d").alias("documents"), F.count("m").alias("metadata"), F.count("l").alias("loaded"), F.count_if(F.expr("d = 1 AND m IS NULL")).alias("without_metadata"), F.count_if(F.expr("d = 1 AND l IS NULL")).alias("not_loaded"))


CONCEPT_EDGES = ("RELATED_TO", "HAS_SUBORDINATE")
REFERENCE_EDGES = ("REFERENCES", "INTERPRETS")


def replace_concept_edges(edges: DataFrame, relations: DataFrame) -> DataFrame:
    """edges without their concept edges, and new ones from relations (left_id, right_id, relation): related joins the pair in
    order of ids, is_subordinate gives an edge from the parent (right) to the child; other relations give none."""
    related = F.col("relation") == "related"
    made = relations.filter(F.col("relation").isin("related", "is_subordinate")).select(
        F.when(related, F.least("left_id", "right_id")).otherwise(F.col("right_id")).alias("source"),
        F.when(related, F.greatest("left_id", "right_id")).otherwise(F.col("left_id")).alias("target"),
        F.when(related, "RELATED_TO").otherwise("HAS_SUBORDINATE").alias("type"))
    return with_new(edges.filter(~F.col("type").isin(*CONCEPT_EDGES)), made)


def with_new(kept: DataFrame, made: DataFrame) -> DataFrame:
    """(id, source, target, type) of the kept edges and the made ones, each once, ids hashed from the rest."""
    both = merge_edges(*(d.select("source", "target", "type").distinct() for d in (kept, made)))
    return both.select(stable_id("source", "target", "type").alias("id"), "source", "target", "type")


def mentions(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """edges with MENTIONS replaced by one edge for each distinct (root, cluster) of roots; rows with a null end give none."""
    made = roots.filter("root IS NOT NULL AND cluster IS NOT NULL").select(F.col("root").alias("source"), F.col("cluster").alias("target"), F.lit("MENTIONS").alias("type")).distinct()
    return with_new(edges.filter("type <> 'MENTIONS'"), made)


def reference_edges(edges: DataFrame, nodes: DataFrame, results: DataFrame) -> DataFrame:
    """edges with REFERENCES and INTERPRETS replaced by those of results (source_node_id, target_node_ids, label); both ends
    must be nodes."""
    made = results.filter(F.col("label").isin(*REFERENCE_EDGES)).select(F.col("source_node_id").alias("source"), F.explode("target_node_ids").alias("target"), F.col("label").alias("type"))
    for end in ("source", "target"):
        made = made.join(nodes.select(F.col("id").alias(end)).distinct(), end, "left_semi")
    return with_new(edges.filter(~F.col("type").isin(*REFERENCE_EDGES)), made)
