"""Connected components of an edge table.

Every node goes over to its smallest neighbour, if that is smaller, and edges between such groups are the next, smaller
graph; a node's component is that of where it went. As the smallest node of a component never moves, it names it. While a
step at least halves the edges it is repeated, so all steps together cost little more than the first. What is left of other
graphs (long paths above all) is settled by labels: they fall to the smallest label of the neighbours, then jump to their
label's label, until nothing changes. Every step is written in the shared folder, so plans stay short and a lost executor
restarts one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.plans.cut import fitted, stash


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) of every node of an edge; component is the smallest node in it.

    Null ends and self loops make no link; a node with only a self loop is its own component. Repeated edges count once.
    """
    links = stash(edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL"), "cc-edges")
    steps, held = [], links.count()
    while True:
        step = stash(fitted(_both(links).groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).select(F.col("a").alias("node"), "label"), 2 * held), "cc-step")
        end = lambda name, label, of=step: of.select(F.col("node").alias(name), F.col("label").alias(label))
        moved = links.join(end("a", "x"), "a").join(end("b", "y"), "b").filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        links = stash(fitted(moved.distinct(), held), "cc-edges")
        steps.append(step)
        before, held = held, links.count()
        if not held or 2 * held > before:
            break
    out = _settled(links) if held else None
    for step in reversed(steps):
        if out is None:
            out = step.select("node", F.col("label").alias("component"))
        else:
            out = step.join(out.select(F.col("node").alias("label"), "component"), "label", "left").select("node", F.coalesce("component", "label").alias("component"))
    return out


def _both(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _settled(links: DataFrame) -> DataFrame:
    """(node, component) by falling labels; links is (a, b), distinct and written."""
    held = links.count()
    both = stash(fitted(_both(links), 2 * held), "cc-both")
    labels = stash(fitted(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).select(F.col("a").alias("node"), "label"), 2 * held), "cc-labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels.node == near.a, "left").select("node", "label", F.least("label", F.coalesce("near", "label")).alias("next"))
        lower = stash(fitted(lower, 2 * held), "cc-lower")
        up = lower.select(F.col("node").alias("up"), F.col("next").alias("jump"))
        labels = stash(fitted(lower.join(up, lower.next == up.up, "left").select("node", F.least("next", F.coalesce("jump", "next")).alias("label"), F.col("label").alias("before")), 2 * held), "cc-labels")
        if not labels.filter("label <> before").limit(1).count():
            break
        labels = labels.select("node", "label")
    return labels.select("node", F.col("label").alias("component"))
