"""Property graphs as two DataFrames: nodes (id, type, name, level, text) and edges (source, target, type)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexweave.functions.labels import document_title, stripped
from lexweave.functions.locator import sort_key
from lexweave.functions.statute import tail_label
from lexweave.functions.text import stable_id
from lexweave.plans.cut import stash

def with_edge_ids(edges: DataFrame) -> DataFrame:
    return edges.withColumn("id", stable_id("source", "target", "type"))


def parents(edges: DataFrame, kind: str = "CONTAINS", order: str | None = None) -> DataFrame:
    """(child, parent): one parent a child. Where data give several, the last by the sequence column `order`, of those at
    one place the greatest; without such a column the smallest. Edges with a null end or to themselves are none."""
    own = edges.filter((F.col("type") == kind) & (F.col("source") != F.col("target"))).groupBy(F.col("target").alias("child"))
    return own.agg((F.min("source") if order is None else F.max_by("source", F.struct(order, "source"))).alias("parent"))


def ancestors(edges: DataFrame, kind: str = "CONTAINS", reflexive: bool = False, order: str | None = None) -> DataFrame:
    """(node, ancestor, depth): the whole closure upward, to whatever depth.

    Each round doubles the reach: the pairs at the present reach meet all pairs known, so a hierarchy of depth d takes
    log2(d) joins. In a cycle every other node is an ancestor once, at its least depth; the rounds end as no pair is new.
    """
    known = far = stash(parents(edges, kind, order).select(F.col("child").alias("node"), F.col("parent").alias("ancestor"), F.lit(1).alias("depth")), "closure")
    reach = 1
    while True:
        on = known.select(F.col("node").alias("via"), F.col("ancestor").alias("up"), F.col("depth").alias("more"))
        step = far.filter(F.col("depth") == reach).join(on, F.col("ancestor") == F.col("via")).select("node", F.col("up").alias("ancestor"), (F.col("depth") + F.col("more")).alias("depth")).filter("node <> ancestor")
        far = stash(step.join(known.select("node", "ancestor"), ["node", "ancestor"], "left_anti"), "closure")
        if far.isEmpty():
            break
        known, reach = known.unionByName(far), 2 * reach
    if reflexive:
        every = edges.filter(F.col("type") == kind).select(F.explode(F.array("source", "target")).alias("node")).filter("node IS NOT NULL").distinct()
        known = known.unionByName(every.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("depth")))
    return known


def nearest_at_level(closure: DataFrame, nodes: DataFrame, level: str) -> DataFrame:
    """(node, ancestor): the nearest ancestor of a level; over a reflexive closure a node of that level is its own."""
    at = nodes.filter(F.col("level") == level).select(F.col("id").alias("ancestor"))
    return closure.join(at, "ancestor").groupBy("node").agg(F.min_by("ancestor", F.struct("depth", "ancestor")).alias("ancestor"))


def with_self(closure: DataFrame, nodes: DataFrame) -> DataFrame:
    """A closure with every node as its own ancestor at depth 0, lone nodes included."""
    own = nodes.select(F.col("id").alias("node"), F.col("id").alias("ancestor"), F.lit(0).alias("depth"))
    return closure.filter("depth > 0").unionByName(own)


def owners(edges: DataFrame, nodes: DataFrame, level: str = "document") -> DataFrame:
    """(node, owner): the document over every node, documents being their own; nodes without one are left out."""
    return nearest_at_level(with_self(ancestors(edges), nodes), nodes, level).withColumnRenamed("ancestor", "owner")


# fixed values: the endings of labels by level; an article's label is its name
LABEL_SUFFIX = {"article": None, "paragraph": "款", "item": "项", "sub_item": "目"}


def label_path(closure: DataFrame, nodes: DataFrame, levels: list[str], suffixes: dict[str, str | None] | None = None) -> DataFrame:
    """node and its label at each level, one column a level: its own and those of its ancestors, the top-most where a
    level repeats. With `suffixes` a level's label is the last label of that ending in the name ('' without one)."""
    label = F.col("name")
    for level, suffix in (suffixes or {}).items():
        if suffix:
            label = F.when(F.col("level") == level, tail_label(F.col("name"), suffix)).otherwise(label)
    named = with_self(closure, nodes).join(nodes.select(F.col("id").alias("ancestor"), "level", label.alias("label")).filter(F.col("level").isin(levels)), "ancestor")
    found = named.groupBy("node").pivot("level", levels).agg(F.max_by("label", F.struct("depth", "ancestor")))
    return nodes.select(F.col("id").alias("node")).join(found, "node", "left")


def breadcrumb(edges: DataFrame, nodes: DataFrame, levels: list[str], document: str = "document") -> DataFrame:
    """(node, path): 《document》 > part > chapter down to the node, its own name included at one of these levels; nameless ones are left out."""
    label = F.when(F.col("level") == document, document_title(F.col("name"))).otherwise(stripped(F.col("name")))
    named = nodes.filter(F.col("level").isin([document, *levels])).select(F.col("id").alias("ancestor"), label.alias("label")).filter("label <> ''")
    steps = ancestors(edges, reflexive=True).join(named, "ancestor").groupBy("node").agg(F.array_sort(F.collect_list(F.struct((-F.col("depth")).alias("up"), "label"))).alias("steps"))
    return steps.select("node", F.array_join(F.transform("steps", lambda x: x["label"]), " > ").alias("path"))


def siblings(nodes: DataFrame, edges: DataFrame, order=None) -> DataFrame:
    """id, parent and previous: the sibling before it under the same parent at the same level, by the numbers in the ids."""
    w = Window.partitionBy("parent", "level").orderBy(sort_key(F.col("id"), F.col("level")) if order is None else order, "id")
    return nodes.join(parents(edges), F.col("id") == F.col("child")).select("id", "parent", F.lag("id").over(w).alias("previous"))


def neighbours(edges: DataFrame, start: DataFrame) -> DataFrame:
    """(start, node) one undirected step away; start is (start)."""
    both = edges.select(F.col("source").alias("a"), F.col("target").alias("node")).unionByName(edges.select(F.col("target").alias("a"), F.col("source").alias("node")))
    return start.join(both, F.col("start") == F.col("a")).select("start", "node").filter("start <> node").distinct()


def khop(edges: DataFrame, start: DataFrame, k: int) -> DataFrame:
    """(start, node, hop): nodes within k undirected steps at their least distance, the start at 0."""
    seen = frontier = start.select("start", F.col("start").alias("node"), F.lit(0).alias("hop"))
    both = edges.select(F.col("source").alias("a"), F.col("target").alias("b")).unionByName(edges.select(F.col("target").alias("a"), F.col("source").alias("b"))).distinct()
    for hop in range(1, k + 1):
        step = frontier.join(both, F.col("node") == F.col("a")).select("start", F.col("b").alias("node")).distinct()
        frontier = stash(step.join(seen.select("start", "node"), ["start", "node"], "left_anti").withColumn("hop", F.lit(hop)), "frontier")
        seen = seen.unionByName(frontier)
    return seen


def replace_scope(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """existing without the scopes that new covers, and new."""
    return existing.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def merge_nodes(*parts: DataFrame) -> DataFrame:
    """Union by id, the last part's row wins; of several in one part the greatest by the other columns as JSON."""
    return _ranked(parts, ["id"], F.max_by)


def merge_edges(*parts: DataFrame) -> DataFrame:
    """Union by (source, target, type), the first part's row wins; of several in one part the smallest by the other columns as JSON."""
    return _ranked(parts, ["source", "target", "type"], F.min_by)


def _ranked(parts, keys, best) -> DataFrame:
    every = None
    for i, p in enumerate(parts):
        p = p.withColumn("__part", F.lit(i))
        every = p if every is None else every.unionByName(p)
    rest = [c for c in every.columns if c not in keys and c != "__part"]
    if not rest:
        return every.select(*keys).distinct()
    return every.groupBy(*keys).agg(best(F.struct(*rest), F.struct("__part", F.to_json(F.struct(*rest)))).alias("r")).select(*keys, *(f"r.{c}" for c in rest))


def keep_active_targets(candidates: DataFrame, active: DataFrame) -> DataFrame:
    """candidates (id, targets) with the targets that are active, in order; without any, the row goes."""
    rows = candidates.select("id", F.posexplode("targets").alias("pos", "target")).join(active.select(F.col("id").alias("target")), "target", "left_semi")
    return rows.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "target"))), lambda x: x["target"]).alias("targets"))


def remap(edges: DataFrame, mapping: DataFrame) -> DataFrame:
    """edges with both ends replaced by mapping (old, new), others unchanged; loops and repeats go."""
    for c in ("source", "target"):
        edges = edges.join(mapping.select(F.col("old").alias(c), F.col("new").alias("__new")), c, "left").withColumn(c, F.coalesce("__new", c)).drop("__new")
    return edges.filter("source <> target").select("source", "target", "type").distinct()


#: Pairs, hubs counted apart, that one task gathers, and links that one task joins, about; so the memory of a task doesn't
#: grow with the table, however few partitions a shuffle has by default.
PAIRS = 2_000_000
LINKS = 500_000


def _tasks(links: DataFrame, tile: int) -> tuple[int, int, int]:
    """How many tasks deal the links by hub, the copies of links by group of a hub, and the pairs."""
    d = F.col("d")
    n, copies, met = links.groupBy("hub").agg(F.count("*").cast("double").alias("d")).agg(F.sum(d), F.sum(d * F.ceil(d / tile)), F.sum(d * (d - 1) / 2)).first()
    least = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return tuple(max(least, int((rows or 0) // most) + 1) for rows, most in ((n, LINKS), (copies, LINKS), (met, PAIRS)))


def hub_rights(links: DataFrame, hub: str, keep: list[str], tile: int = 2048, copies: int | None = None) -> DataFrame:
    """(left, rights, *keep): for every node the greater nodes it has a common hub with, once a hub, as arrays of structs of the
    node and the columns of keep, keep being the left node's own; links is (node, hub, *keep), distinct.

    A hub's nodes are dealt into groups of about `tile`, and two groups at a time meet in one key, so a hub of any degree
    spreads over many tasks (`copies` of them, if given); a node is copied once for each group of its hub, and its partners
    travel as arrays."""
    groups = links.groupBy(hub).agg(F.ceil(F.count("*") / F.lit(float(tile))).cast("int").alias("__n"))
    dealt = links.join(groups, hub).withColumn("__g", F.pmod(F.xxhash64("node"), F.col("__n")).cast("int"))
    each = lambda df, name: df.withColumn(name, F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    met_by = lambda df: df.repartition(copies, hub, "__g", "__x") if copies else df
    lists = dealt.groupBy(hub, "__n", F.col("__g").alias("__x")).agg(F.collect_list(F.struct("node", *keep)).alias("__list"))
    met = met_by(each(dealt, "__x")).join(met_by(each(lists, "__g").drop("__n")), [hub, "__g", "__x"])
    rights = met.select(F.col("node").alias("left"), F.filter("__list", lambda r: r["node"] > F.col("node")).alias("rights"), *keep)
    return rights.filter(F.size("rights") > 0)


def hub_pairs(links: DataFrame, hub: str, keep: list[str], tile: int = 2048) -> DataFrame:
    """(left, right, *keep): every pair left < right of nodes with a common hub, once a hub; links is (node, hub, *keep), distinct."""
    return hub_rights(links, hub, keep, tile).select("left", F.explode("rights.node").alias("right"), *keep)


def adamic_adar(links: DataFrame, tile: int = 2048) -> DataFrame:
    """(left, right, score): 1 - exp(-sum of 1 / ln(degree)) over common neighbours of degree above 1; links is (node, hub)."""
    links = stash(links.select("node", "hub").distinct(), "links")
    by_hub, by_group, by_left = _tasks(links, tile)
    dealt = links.repartition(by_hub, "hub")
    weight = dealt.groupBy("hub").agg(F.count("*").alias("degree")).filter("degree > 1").select("hub", (1 / F.log(F.col("degree").cast("double"))).alias("w"))
    rights = hub_rights(dealt.join(weight, "hub"), "hub", ["w"], tile, by_group).select("left", "w", F.col("rights.node").alias("rights"))
    # dealt by left; grouping by left and right then needs no further shuffle
    return rights.repartition(by_left, "left").select("left", "w", F.explode("rights").alias("right")).groupBy("left", "right").agg((1 - F.exp(-F.sum("w"))).alias("score"))


def common_ratio(sets: DataFrame, tile: int = 2048) -> DataFrame:
    """(left, right, score): common members over the larger set; sets is (node, member)."""
    links = stash(sets.select("node", F.col("member").alias("hub")).distinct(), "sets")
    by_hub, by_group, by_left = _tasks(links, tile)
    n = links.groupBy("node").agg(F.count("*").alias("n"))
    rights = hub_rights(links.join(n, "node").repartition(by_hub, "hub"), "hub", ["n"], tile, by_group)
    # two arrays of plain numbers travel, no array of structs; dealt by left, grouping by left and right needs no further shuffle
    flat = rights.select("left", "n", F.col("rights.node").alias("node"), F.col("rights.n").alias("of"))
    pairs = flat.repartition(by_left, "left").select("left", "n", F.explode(F.arrays_zip("node", "of")).alias("r")).select("left", F.col("r.node").alias("right"), "n", F.col("r.of").alias("of"))
    return pairs.groupBy("left", "right").agg((F.count("*") / F.greatest(F.max("n"), F.max("of"))).alias("score"))


def bridge_score(counts: DataFrame) -> DataFrame:
    """(left, right, score): ln(1 + count) / ln(1 + greatest count); counts is (left, right, n)."""
    top = counts.agg(F.max("n").alias("top")).first()["top"] or 1
    return counts.select("left", "right", (F.log1p(F.col("n").cast("double")) / F.log1p(F.lit(float(top)))).alias("score"))


def merge_directions(relations: DataFrame) -> DataFrame:
    """(left_id, right_id, relation) with one row an unordered pair: equivalent first, subordination both ways is related."""
    low, high = F.least("left_id", "right_id"), F.greatest("left_id", "right_id")
    sub = F.col("relation") == "is_subordinate"
    g = relations.select(low.alias("left_id"), high.alias("right_id"), (F.col("relation") == "equivalent").alias("eq"), (sub & (F.col("left_id") <= F.col("right_id"))).alias("down"), (sub & (F.col("left_id") > F.col("right_id"))).alias("up"))
    g = g.groupBy("left_id", "right_id").agg(F.bool_or("eq").alias("eq"), F.bool_or("down").alias("down"), F.bool_or("up").alias("up"))
    lone_up = F.col("up") & ~F.col("down")
    return g.select(F.when(lone_up & ~F.col("eq"), F.col("right_id")).otherwise(F.col("left_id")).alias("left_id"), F.when(lone_up & ~F.col("eq"), F.col("left_id")).otherwise(F.col("right_id")).alias("right_id"),
                    F.when(F.col("eq"), "equivalent").when(F.col("down") & F.col("up"), "related").when(F.col("down") | F.col("up"), "is_subordinate").otherwise("related").alias("relation"))


# fixed values: the levels of each type of node, and the fields only some types may have
NODE_LEVELS = {"DocumentNode": ("document",), "TocNode": ("part", "chapter", "section"), "ProvisionNode": ("article", "paragraph", "item", "sub_item", "segment", "appendix"), "ConceptNode": ("concept",)}
NODE_FIELDS = {
    "DocumentNode": ("category", "status", "issuer", "publish_date", "effective_date", "source_url"), "TocNode": (), "ProvisionNode": ("text",), "ConceptNode": ("description",),
}


def invalid_nodes(nodes: DataFrame) -> DataFrame:
    """(id, reason) of nodes that break the schema: unknown_type, wrong_level, or foreign_field (a field filled that is not the
    type's); a node is listed once for each reason. Columns that nodes does not have are not checked."""
    known = F.lit(False)
    for kind, levels in NODE_LEVELS.items():
        known = known | ((F.col("type") == kind) & F.col("level").isin(*levels))
    foreign = F.lit(False)
    for field in sorted({f for fields in NODE_FIELDS.values() for f in fields} & set(nodes.columns)):
        owners_of = [k for k, fields in NODE_FIELDS.items() if field in fields]
        foreign = foreign | ((F.coalesce(F.col(field), F.lit("")) != "") & ~F.col("type").isin(*owners_of))
    has_type = F.coalesce(F.col("type").isin(*NODE_LEVELS), F.lit(False))
    reasons = F.array(F.when(~has_type, "unknown_type"), F.when(has_type & ~F.coalesce(known, F.lit(False)), "wrong_level"), F.when(has_type & foreign, "foreign_field"))
    return nodes.select("id", F.explode(F.array_compact(reasons)).alias("reason"))


def structural_type(parent_level, child_level, rules: list[tuple[str, str, str]]):
    """The edge type that the rules (parent level, child level, type) give a pair of levels; null where they give none."""
    out = F.lit(None).cast("string")
    for a, b, kind in rules:
        out = F.when((parent_level == a) & (child_level == b), F.lit(kind)).otherwise(out)
    return out


def invalid_edges_by_rules(nodes: DataFrame, edges: DataFrame, rules: list[tuple[str, str, str, str, str]]) -> DataFrame:
    """(source, target, type, reason) of edges that no rule allows; a rule is (type, source type, source level, target type,
    target level), where * fits anything."""
    n = nodes.select("id", "type", "level")
    end = lambda name: n.select(F.col("id").alias(name), F.col("type").alias(f"{name}_type"), F.col("level").alias(f"{name}_level"))
    met = edges.select("source", "target", "type").join(end("source"), "source", "left").join(end("target"), "target", "left")
    fits = F.lit(False)
    for rule in rules:
        one = F.lit(True)
        for column, want in zip(("type", "source_type", "source_level", "target_type", "target_level"), rule):
            if want != "*":
                one = one & (F.col(column) == want)
        fits = fits | one
    reason = F.when(F.col("source_type").isNull(), "no_source").when(F.col("target_type").isNull(), "no_target").when(~F.coalesce(fits, F.lit(False)), "not_allowed")
    return met.select("source", "target", "type", reason.alias("reason")).filter("reason IS NOT NULL")


def missing_vectors(concepts: DataFrame, vectors: DataFrame) -> DataFrame:
    """id of the concepts without a vector, which similarity would leave out in silence."""
    return concepts.select("id").distinct().join(vectors.filter("size(vector) > 0").select("id").distinct(), "id", "left_anti")


def whole_target_candidates(candidates: DataFrame, nodes: DataFrame) -> DataFrame:
    """The candidates (id, source_node_id, target_node_ids, ...) whose source and all targets are nodes."""
    ids = nodes.select("id").distinct()
    lost = candidates.select(F.col("id").alias("c"), F.explode("target_node_ids").alias("id")).join(ids, "id", "left_anti").select(F.col("c").alias("id")).distinct()
    return candidates.join(ids.withColumnRenamed("id", "source_node_id"), "source_node_id", "left_semi").join(lost, "id", "left_anti").select(candidates.columns)


def invalid_edges(nodes: DataFrame, edges: DataFrame, rules: DataFrame) -> DataFrame:
    """edges with the reason they break the schema; rules is (type, source_level, target_level), a small fixed table."""
    n = nodes.select("id", "level")
    joined = edges.join(n.select(F.col("id").alias("source"), F.col("level").alias("source_level")), "source", "left").join(n.select(F.col("id").alias("target"), F.col("level").alias("target_level")), "target", "left")
    ok = rules.withColumn("ok", F.lit(True))
    return joined.join(ok, ["type", "source_level", "target_level"], "left").select("source", "target", "type", F.when(F.col("source_level").isNull(), "no_source").when(F.col("target_level").isNull(), "no_target").when(F.col("ok").isNull(), "not_allowed").alias("reason")).filter("reason IS NOT NULL")
