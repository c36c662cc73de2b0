"""Concept pairs: contexts, ancestors, bridges, scores and what a judged pair becomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexweave.operators.graph import ancestors, nearest_at_level, with_self
from lexweave.plans.cut import drop, stash

# fixed values: the levels that are a concept's structural context
STRUCTURE = ("part", "chapter", "section")

#: Contexts of a concept that meet as one set, about.
CONTEXTS = 4096


def concept_ancestors(relations: DataFrame) -> DataFrame:
    """(node, ancestor): everything above a concept over is_subordinate (left under right), whatever the number of parents;
    in a cycle every other concept is above. The reach doubles each round until no pair is new."""
    known = new = stash(relations.filter("relation = 'is_subordinate' AND left_id <> right_id").select(F.col("left_id").alias("node"), F.col("right_id").alias("ancestor")).distinct(), "above")
    while True:
        up = known.select(F.col("node").alias("via"), F.col("ancestor").alias("up"))
        step = new.join(up, F.col("ancestor") == F.col("via")).select("node", F.col("up").alias("ancestor")).filter("node <> ancestor").distinct()
        more = stash(step.join(known, ["node", "ancestor"], "left_anti"), "above-new")
        if more.isEmpty():
            return known
        whole = stash(known.unionByName(more), "above")
        drop(known, *([] if new is known else [new]))
        known, new = whole, more


def contexts(edges: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """(concept, kind, context) of roots (concept, root): the documents and the structural units over a root, itself included."""
    over = with_self(ancestors(edges), nodes).join(nodes.select(F.col("id").alias("ancestor"), "level"), "ancestor")
    kinds = over.select("node", F.when(F.col("level") == "document", "document").when(F.col("level").isin(*STRUCTURE), "structure").alias("kind"), F.col("ancestor").alias("context")).filter("kind IS NOT NULL")
    return roots.select("concept", F.col("root").alias("node")).join(kinds, "node").select("concept", "kind", "context").distinct()


def apart(pairs: DataFrame, concept_contexts: DataFrame, kind: str) -> DataFrame:
    """The pairs (left, right, ...) that share no context of a kind.

    A pair meets the sets of its two concepts, not their contexts one by one; a concept of very many contexts has them dealt
    into several sets by a hash, and like parts meet."""
    one = concept_contexts.filter(F.col("kind") == kind).select("concept", "context").filter("context IS NOT NULL").distinct()
    most = one.groupBy("concept").count().agg(F.max("count")).first()[0] or 0
    parts = max(1, -(-most // CONTEXTS))
    sets = one.groupBy("concept", F.pmod(F.xxhash64("context"), F.lit(parts)).alias("part")).agg(F.collect_list("context").alias("set"))
    left, right = (sets.select(F.col("concept").alias(end), "part", F.col("set").alias(f"{end}_set")) for end in ("left", "right"))
    shared = pairs.select("left", "right").distinct().join(left, "left").join(right, ["right", "part"]).filter(F.arrays_overlap("left_set", "right_set")).select("left", "right").distinct()
    return pairs.join(shared, ["left", "right"], "left_anti")


def bridges(edges: DataFrame, nodes: DataFrame, kinds: tuple[str, ...], level: str) -> DataFrame:
    """(left, right, n): links of the kinds between nodes, both ends lifted to their nearest ancestor of a level (or
    themselves, if of it); counted by unordered pair, pairs within one ancestor aside."""
    at = nearest_at_level(with_self(ancestors(edges), nodes), nodes, level)
    links = edges.filter(F.col("type").isin(*kinds)).select("source", "target")
    for end in ("source", "target"):
        links = links.join(at.select(F.col("node").alias(end), F.col("ancestor").alias(f"{end}_at")), end)
    return links.filter("source_at <> target_at").groupBy(F.least("source_at", "target_at").alias("left"), F.greatest("source_at", "target_at").alias("right")).agg(F.count("*").alias("n"))


def fused_score(weights: dict[str, float]):
    """The weighted sum of feature columns; a missing feature counts 0."""
    total = F.lit(0.0)
    for name, w in weights.items():
        total = total + F.lit(float(w)) * F.coalesce(F.col(name), F.lit(0.0))
    return total


def recall_pass(shortlist: DataFrame, features: DataFrame, known: DataFrame, weights: dict[str, float], least: float, k: int) -> DataFrame:
    """One pass over shortlist (left, right, semantic): without pairs known in either direction, scored with features (low,
    high and one column a weight), cut at `least`, the k best of each left (ties by low and high id), each unordered pair once
    with its best score."""
    pairs = shortlist.filter("left <> right").select("left", "right", F.least("left", "right").alias("low"), F.greatest("left", "right").alias("high"), "semantic")
    seen = known.select(F.least("left_id", "right_id").alias("low"), F.greatest("left_id", "right_id").alias("high")).distinct()
    scored = pairs.join(seen, ["low", "high"], "left_anti").join(features, ["low", "high"], "left").withColumn("score", fused_score(weights)).filter(F.round("score", 9) >= least)
    best = scored.withColumn("r", F.row_number().over(Window.partitionBy("left").orderBy(F.desc(F.round("score", 9)), "high", "low"))).filter(F.col("r") <= k)
    return best.groupBy(F.col("low").alias("left_id"), F.col("high").alias("right_id")).agg(F.max("score").alias("score"))


def best_pairs(pairs: DataFrame) -> DataFrame:
    """One row for each (left_id, right_id): a judged one before one that is not, then the greater score."""
    rest = [c for c in pairs.columns if c not in ("left_id", "right_id")]
    rank = F.struct((F.coalesce("relation", F.lit("")) != "").alias("judged"), "score", F.to_json(F.struct(*rest)))
    return pairs.groupBy("left_id", "right_id").agg(F.max_by(F.struct(*rest), rank).alias("r")).select("left_id", "right_id", *(f"r.{c}" for c in rest))


def inherit_judgment(old: DataFrame, new: DataFrame) -> DataFrame:
    """new pairs (left_id, right_id, score, relation, strength); one that is not judged takes the old pair's judgment."""
    was = old.filter("coalesce(relation, '') <> ''").groupBy("left_id", "right_id").agg(F.max_by(F.struct("relation", "strength"), "score").alias("was"))
    judged = F.coalesce("relation", F.lit("")) != ""
    return new.join(was, ["left_id", "right_id"], "left").select("left_id", "right_id", "score", *(F.when(judged, F.col(c)).otherwise(F.coalesce(F.col(f"was.{c}"), F.col(c))).alias(c) for c in ("relation", "strength")))


def directed(pairs: DataFrame, least: int = 7) -> DataFrame:
    """(left_id, right_id, relation) of the accepted pairs: has_subordinate is turned into is_subordinate, related is in order of ids."""
    from lexweave.functions.category import is_accepted

    turn = (F.col("relation") == "has_subordinate") | ((F.col("relation") == "related") & (F.col("left_id") > F.col("right_id")))
    kept = pairs.filter(is_accepted(F.col("relation"), F.col("strength"), least))
    return kept.select(F.when(turn, F.col("right_id")).otherwise(F.col("left_id")).alias("left_id"), F.when(turn, F.col("left_id")).otherwise(F.col("right_id")).alias("right_id"),
                       F.when(F.col("relation") == "has_subordinate", "is_subordinate").otherwise(F.col("relation")).alias("relation")).distinct()


def representatives(members: DataFrame) -> DataFrame:
    """One row a cluster of members (cluster, member, name, description): the commonest name (then the shortest, the smallest),
    the longest description among rows of that name, else of all, and the smallest member of that name; sorted member ids."""
    n = members.groupBy("cluster", "name").agg(F.count("*").alias("n"))
    named = n.groupBy("cluster").agg(F.min_by("name", F.struct(-F.col("n"), F.char_length("name"), "name")).alias("canonical"))
    met = members.join(named, "cluster")
    own = F.coalesce(F.col("name") == F.col("canonical"), F.lit(False))
    text = F.coalesce("description", F.lit(""))
    return met.groupBy("cluster").agg(
        F.first("canonical").alias("name"), F.max_by(text, F.struct((own & (text != "")).alias("own"), F.char_length(text), F.col("member"))).alias("description"),
        F.min_by("member", F.struct(~own, "member")).alias("representative"), F.sort_array(F.collect_set("member")).alias("member_ids"))


def cluster_ids(members: DataFrame, previous: DataFrame) -> DataFrame:
    """(cluster, id): the smallest previous id (member, id) of its members, else concept: and a hash of the sorted members."""
    met = members.select("cluster", "member").join(previous, "member", "left")
    made = met.groupBy("cluster").agg(F.min("id").alias("was"), F.array_join(F.sort_array(F.collect_set("member")), "\n").alias("all"))
    return made.select("cluster", F.coalesce("was", F.concat(F.lit("concept:"), F.left(F.sha2("all", 256), F.lit(24)))).alias("id"))


def judge_cache_key(*parts):
    """One key for names and descriptions, whatever their white space."""
    return F.sha2(F.concat_ws("\t", *(F.trim(F.regexp_replace(F.coalesce(p, F.lit("")), r"(?U)\s+", " ")) for p in parts)), 256)
