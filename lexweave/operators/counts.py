"""Counts and reports of the stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def type_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(kind, type, n): nodes and edges by type."""
    one = lambda d, kind: d.groupBy("type").agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "type", "n")
    return one(nodes, "node").unionByName(one(edges, "edge"))


def weighted_counts(results: DataFrame) -> DataFrame:
    """(label, category, n, weight): rows of results (label, target_categories) by label and category, a row counting once for
    each category and weighing the number of its targets there."""
    all_of = F.col("target_categories")
    each = results.select("label", F.explode(F.transform(F.array_distinct(all_of), lambda c: F.struct(c.alias("category"), F.size(F.filter(all_of, lambda x: x.eqNullSafe(c))).cast("long").alias("w")))).alias("x"))
    return each.groupBy("label", F.col("x.category").alias("category")).agg(F.count("*").alias("n"), F.sum("x.w").alias("weight"))


def judge_counts(pairs: DataFrame, least: int = 7) -> DataFrame:
    """One row: judged pairs, accepted ones, and pairs of each relation."""
    from lexweave.functions.category import is_accepted

    relation = F.coalesce("relation", F.lit(""))
    of = lambda name: F.count_if(relation == name).alias(name)
    return pairs.agg(F.count("*").alias("pairs"), F.count_if(relation != "").alias("judged"), F.count_if(is_accepted(F.col("relation"), F.col("strength"), least)).alias("accepted"), of("related"), of("is_subordinate"), of("has_subordinate"), of("none"))


def graph_diff(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """One row: ids added, removed, changed in any other column, and unchanged."""
    body = lambda d, name: d.select(key, F.to_json(F.struct(*sorted(c for c in d.columns if c != key)), {"ignoreNullFields": "false"}).alias(name))
    met = body(old, "was").join(body(new, "now"), key, "full")
    return met.agg(F.count_if(F.expr("was IS NULL")).alias("added"), F.count_if(F.expr("now IS NULL")).alias("removed"), F.count_if(F.expr("was <> now")).alias("changed"), F.count_if(F.expr("was = now")).alias("unchanged"))


def completed_sources(units: DataFrame) -> DataFrame:
    """source_id of the sources whose units (source_id, done, failed) are all done and none failed."""
    return units.groupBy("source_id").agg(F.bool_and(F.coalesce("done", F.lit(False)) & ~F.coalesce("failed", F.lit(False))).alias("whole")).filter("whole").select("source_id")


def hint_precision(rows: DataFrame, fallback: float) -> DataFrame:
    """(hint, matched, total, precision): the share of a hint's rows whose label is the hint, at least the fallback."""
    n = rows.groupBy("hint").agg(F.count_if(F.col("hint") == F.col("label")).alias("matched"), F.count("*").alias("total"))
    return n.withColumn("precision", F.greatest(F.col("matched") / F.col("total"), F.lit(float(fallback))))


def confusion(rows: DataFrame, gold: str, predicted: str, labels: list[str]) -> DataFrame:
    """gold, one count a predicted label, and accuracy (of all rows, the same in every row)."""
    accuracy = rows.agg((F.count_if(F.col(gold) == F.col(predicted)) / F.greatest(F.count("*"), F.lit(1))).alias("accuracy")).first()["accuracy"]
    return rows.groupBy(F.col(gold).alias("gold")).pivot(predicted, labels).count().fillna(0, labels).withColumn("accuracy", F.lit(accuracy))


def choose_threshold(grid: DataFrame, first: str = "recall", least: float = 0.0) -> DataFrame:
    """The row of a threshold grid to use: of those with precision at least `least` (all, if none has it) the greatest `first`,
    then the greatest f1, then the smallest threshold."""
    ok = F.col("precision") >= least
    return grid.orderBy(F.desc(ok), F.desc(first), F.desc("f1"), "threshold").limit(1)


def deficits(batches: DataFrame, targets: dict[str, int]) -> DataFrame:
    """(batch, label, n, total, deficit): counts of each label by batch, running totals, and what is still missing to the
    label's target; every label of the targets appears in every batch."""
    from pyspark.sql import Window

    n = batches.groupBy("batch", "label").agg(F.count("*").alias("n"))
    wanted = F.array(*(F.struct(F.lit(k).alias("label"), F.lit(v).cast("long").alias("target")) for k, v in targets.items()))
    every = batches.select("batch").distinct().select("batch", F.explode(wanted).alias("w")).select("batch", "w.label", "w.target")
    full = every.join(n, ["batch", "label"], "left").fillna(0, ["n"])
    total = F.sum("n").over(Window.partitionBy("label").orderBy("batch"))
    return full.select("batch", "label", "n", total.alias("total"), F.greatest(F.col("target") - total, F.lit(0)).alias("deficit"))


def audit_rows(rows: DataFrame) -> DataFrame:
    """sample_id and issues, an array of what is wrong with (sample_id, text, label); rows without an issue are left out."""
    from lexweave.functions.statute import has_one_mark, marked_target

    text = F.coalesce("text", F.lit(""))
    checks = {"empty_text": F.trim(text) == "", "not_one_mark": ~has_one_mark(text), "empty_target": has_one_mark(text) & (marked_target(text) == ""), "no_label": F.col("label").isNull()}
    issues = F.array_compact(F.array(*(F.when(c, F.lit(name)) for name, c in checks.items())))
    return rows.select("sample_id", issues.alias("issues")).filter(F.size("issues") > 0)


def detect_counts(found: DataFrame) -> DataFrame:
    """One row: references, their targets, sentences and documents that have any."""
    return found.agg(F.count("*").alias("references"), F.coalesce(F.sum(F.size("targets")), F.lit(0)).alias("targets"), F.count_distinct("id").alias("sentences"), F.count_distinct("document_id").alias("documents"))


def relation_counts(pairs: DataFrame) -> DataFrame:
    """One row: pairs, those still without a relation, and those of each relation."""
    of = lambda value, name: F.count_if(F.coalesce("relation", F.lit("")) == value).alias(f"{name}_count")
    return pairs.agg(F.count("*").alias("pair_count"), of("", "pending"), *(of(x, x) for x in ("equivalent", "is_subordinate", "has_subordinate", "related", "none")))


def pool_checks(pool: DataFrame) -> DataFrame:
    """One row on candidates (sample_id, source_node_id, text): documents, candidates, texts without just one mark or with an
    empty target, repeated sample ids."""
    from lexweave.functions.headings import source_document
    from lexweave.functions.statute import has_one_mark, marked_target

    text = F.coalesce("text", F.lit(""))
    return pool.agg(F.count_distinct(source_document(F.col("source_node_id"))).alias("documents"), F.count("*").alias("candidates"), F.count_if(~has_one_mark(text)).alias("invalid_marks"),
                    F.count_if(marked_target(text) == "").alias("empty_targets"), (F.count("*") - F.count_distinct(F.trim(F.coalesce("sample_id", F.lit(""))))).alias("repeated"))


def concept_rows(roots: DataFrame) -> DataFrame:
    """(id, name, description, parent, root): a root's (root, concepts) core concepts and their subordinates as rows; concepts
    is an array of (concept, description, subordinates), ids are hashes of root, kind and names, a core concept's parent is ''."""
    made = lambda *parts: F.concat(F.lit("concept:"), F.left(F.sha2(F.concat_ws("\t", *parts), 256), F.lit(24)))
    core = roots.select("root", F.explode("concepts").alias("c")).withColumn("core_id", made(F.col("root"), F.lit("core"), F.col("c.concept")))
    below = core.select("root", "core_id", F.col("c.concept").alias("core"), F.explode("c.subordinates").alias("s"))
    top = core.select(F.col("core_id").alias("id"), F.col("c.concept").alias("name"), F.col("c.description").alias("description"), F.lit("").alias("parent"), "root")
    return top.unionByName(below.select(made(F.col("root"), F.lit("subordinate"), F.col("core"), F.col("s.concept")).alias("id"), F.col("s.concept").alias("name"), F.col("s.description").alias("description"), F.col("core_id").alias("parent"), "root"))


def concept_counts(rows: DataFrame) -> DataFrame:
    core = F.trim(F.coalesce("parent", F.lit(""))) == ""
    return rows.agg(F.count("*").alias("concepts"), F.count_if(core).alias("core"), F.count_if(~core).alias("subordinate"))


def cited_laws(citations: DataFrame) -> DataFrame:
    """(id, text): a document's citations (id, place, law, article, paragraph, item) as one string, laws in the order of their
    first citation, each with its labels in order."""
    part = F.concat(*(F.coalesce(c, F.lit("")) for c in ("article", "paragraph", "item")))
    in_order = lambda name, sep: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", F.col(name).alias("x")))), lambda y: y["x"]), sep)
    law = citations.withColumn("label", part).groupBy("id", "law").agg(F.min("place").alias("first"), in_order("label", "、").alias("labels"))
    return law.select("id", F.col("first").alias("place"), F.concat(F.lit("《"), "law", F.lit("》"), "labels").alias("one")).groupBy("id").agg(in_order("one", "、").alias("text"))


def level_quotas(available: dict[str, int], total: int) -> dict[str, int]:
    """How many rows of each kind to take: an equal share or all there are, and what is left one by one from the kind that has
    most rows untaken, the earlier one first. Kinds without rows get none; counts are what an aggregate has brought."""
    kinds = [k for k, n in available.items() if n > 0]
    if not kinds or total <= 0:
        return {}
    taken = {k: min(available[k], max(1, total // len(kinds))) for k in kinds}
    spare = {k: available[k] - taken[k] for k in kinds}
    rest = min(max(total - sum(taken.values()), 0), sum(spare.values()))
    # rows go from the top: find the level down to which all spare heights are cut, then deal the remainder in order
    low, high = 0, max(spare.values())
    while low < high:
        mid = (low + high) // 2
        if sum(max(n - mid, 0) for n in spare.values()) <= rest:
            high = mid
        else:
            low = mid + 1
    cut = {k: max(spare[k] - low, 0) for k in kinds}
    left = rest - sum(cut.values())
    for k in kinds:
        if left and spare[k] - cut[k] == low and low > 0:
            cut[k], left = cut[k] + 1, left - 1
    return {k: taken[k] + cut[k] for k in kinds}


def reuse(units: DataFrame, state: DataFrame) -> DataFrame:
    """units (unit, fingerprint) with reused: whether the state of the last run has the unit with the same fingerprint."""
    last = state.select("unit", "fingerprint").distinct().withColumn("__same", F.lit(True))
    return units.join(last, ["unit", "fingerprint"], "left").withColumn("reused", F.coalesce("__same", F.lit(False))).drop("__same")


def reuse_decision(marked: DataFrame) -> DataFrame:
    """One row: full, partial or none, and how many units are reused or open; without units none."""
    n = marked.agg(F.count_if("reused").alias("reused"), F.count_if(~F.col("reused")).alias("open"))
    return n.select(F.when((F.col("reused") > 0) & (F.col("open") == 0), "full").when(F.col("reused") > 0, "partial").otherwise("none").alias("decision"), "reused", "open")
