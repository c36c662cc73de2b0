"""Mixing sources to target weights by iterative proportional fitting.

Every document belongs to a cell of (source, language, topic). The cells' token weights are raked until their sums over
each source, language and topic meet the target marginals of a token budget; a cell's calibrated weight over its tokens is
the rate of its documents. Without repetition a cell gives at most its own tokens: each sweep trims the weights to them, and
the next sweep deals what was trimmed to the others, so one rare cell never holds down the whole mix. Sweeps go on until one
moves at most CLOSE of the budget, or SWEEPS of them. Targets that the corpus cannot fill stay unmet by what it lacks:
`gaps` reports, for every category, the target and the share it gets. Each document is taken with its cell's probability by a
hash of its id, so every attempt takes the same ones.

Targets default to tempered shares: a category's share of all tokens to the power `temper`, scaled to sum to 1. Given
targets are scaled to the categories that have tokens; a category without a target gets none.

Defined results: a null source, language or text counts as the category or text ''; documents in cells without tokens are
taken at the rate of the whole mix; rows with one id, repeated ones included, share their fate; an empty table gives
no rows; other columns pass through, and the names used here are dropped again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexweave.plans.cut import drop, fitted

from .common import WORD_SPLIT, stash

DIMS = ("source", "lang", "topic")
TEMPER, KEEP, SWEEPS, CLOSE, SEED = 0.8, 0.8, 100, 1e-3, 42
#: Sweeps between two looks at the residual; cells that one task rakes in memory, more are raked by shuffles.
BLOCK, ONE_TASK_CELLS = 5, 500_000

#: Topic of a text by its form, over {n} words: SQL a caller can replace.
TOPIC = """CASE WHEN {n} = 0 THEN 'empty'
  WHEN regexp_count({t}, '(?i)licen[sc]e|copyright|warrant') > 0 THEN 'legal'
  WHEN 20 * regexp_count({t}, '[|{{}}<>=]') > {n} THEN 'tabular'
  WHEN {n} < 100 THEN 'note' WHEN {n} < 1000 THEN 'article' ELSE 'longform' END"""


def cell_columns(topic: str = TOPIC) -> dict[str, F.Column]:
    """n_tokens (words of the whole text) and the three categories of a row of documents."""
    n = f"size(filter(split(coalesce(`text`, ''), '{WORD_SPLIT.replace(chr(92), chr(92) * 2)}'), w -> w <> ''))"
    made = F.expr(f"transform(array(cast({n} AS bigint)), n -> struct(n AS n, {topic.format(n='n', t='coalesce(`text`, ' + chr(39) * 2 + ')')} AS topic))[0]")
    return {"made": made, "source": F.coalesce("source", F.lit("")), "lang": F.coalesce("lang", F.lit(""))}


def celled(docs: DataFrame, topic: str = TOPIC) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens of every document."""
    c = cell_columns(topic)
    return docs.select("doc_id", c["source"].alias("source"), c["lang"].alias("lang"), c["made"].alias("m")).select("doc_id", "source", "lang", F.col("m.topic").alias("topic"), F.col("m.n").alias("n_tokens"))


def targets_of(cells: DataFrame, dim: str, given: dict[str, float] | None, temper: float) -> DataFrame:
    """(dim, target): shares that sum to 1 over the categories with tokens."""
    share = cells.groupBy(dim).agg(F.sum("tokens").cast("double").alias("t")).filter("t > 0")
    if given is None:
        share = share.withColumn("t", F.pow("t", F.lit(temper)))
    else:
        want = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in given.items()] or [("", 0.0)], f"{dim} string, t double")
        share = share.drop("t").join(want, dim).filter("t > 0")
    total = share.agg(F.sum("t").alias("total")).first()["total"] or 1.0
    return share.select(dim, (F.col("t") / F.lit(total)).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], budget: float, repeat: bool = False, sweeps: int = SWEEPS, close: float = CLOSE) -> DataFrame:
    """cells (dims, tokens) with weight: the calibrated tokens of each cell.

    Up to ONE_TASK_CELLS cells are one partition, whose windows shuffle nothing; a sweep is one plan and one written table, as
    every window of a plan holds its own sort buffer until the task ends. More cells take a join a marginal, so no marginal's
    cells meet in one task.
    """
    now = cells.withColumn("weight", F.col("tokens").cast("double"))
    for d in DIMS:
        now = now.join(targets[d].withColumnRenamed("target", f"{d}_target"), d)
    now = stash(fitted(now, cells.count()), "cells")
    one_task = now.count() <= ONE_TASK_CELLS
    check = BLOCK if one_task else 1
    for sweep in range(1, sweeps + 1):
        was = now
        now = (now.coalesce(1) if one_task else now).withColumn("before", F.col("weight"))
        for d in DIMS:
            if one_task:
                now = now.withColumn("total", F.sum("weight").over(Window.partitionBy(d)))
            else:
                now = now.join(now.groupBy(d).agg(F.sum("weight").alias("total")), d)
            now = now.withColumn("weight", F.when(F.col("total") > 0, F.col("weight") * F.col(f"{d}_target") * F.lit(float(budget)) / F.col("total")).otherwise(0.0)).drop("total")
        if not repeat:
            now = now.withColumn("weight", F.least("weight", F.col("tokens").cast("double")))
        now = stash(now, "cells")
        drop(was)
        moved = now.agg(F.sum(F.abs(F.col("weight") - F.col("before"))).alias("moved")).first()["moved"] if sweep % check == 0 else None
        now = _written(now.drop("before"), now)
        if sweep % check == 0 and (moved or 0.0) <= close * budget:
            break
    return now.select(*DIMS, "tokens", "weight")


def _written(df: DataFrame, table: DataFrame) -> DataFrame:
    """df, known to read the written table, so that dropping it drops that."""
    df._written_at = table._written_at
    return df


def gaps(weighed: DataFrame, targets: dict[str, DataFrame], budget: float) -> DataFrame:
    """(dim, category, target, share): what each category was to get of the budget, and what it gets."""
    parts = [weighed.groupBy(F.col(d).alias("category")).agg((F.sum("weight") / F.lit(float(budget or 1))).alias("share")).join(targets[d].withColumnRenamed(d, "category"), "category", "full")
             .select(F.lit(d).alias("dim"), "category", F.coalesce("target", F.lit(0.0)).alias("target"), F.coalesce("share", F.lit(0.0)).alias("share")) for d in DIMS]
    return reduce(DataFrame.unionByName, parts)


def raked(docs_celled: DataFrame, targets: dict[str, dict[str, float]] | None = None, temper: float = TEMPER, keep: float = KEEP, repeat: bool = False):
    """(cells, weighed cells, targets, budget) of documents with their cells."""
    cells = stash(docs_celled.groupBy(*DIMS).agg(F.sum("n_tokens").alias("tokens")), "token-cells")
    all_cells = cells.agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")).first()
    budget = keep * (all_cells["tokens"] or 0)
    wanted = {d: stash(fitted(targets_of(cells, d, (targets or {}).get(d), temper), all_cells["n"]), f"target-{d}") for d in DIMS}
    return cells, rake(cells, wanted, budget, repeat), wanted, budget


def rates(docs_celled: DataFrame, targets: dict[str, dict[str, float]] | None = None, temper: float = TEMPER, keep: float = KEEP, repeat: bool = False) -> DataFrame:
    """(dims, rate): expected copies of each document of a cell, at most 1 unless `repeat`; `keep` is the budget as a share of all tokens."""
    cells, weighed, _, _ = raked(docs_celled, targets, temper, keep, repeat)
    rate = weighed.filter("tokens > 0").select(*DIMS, (F.col("weight") / F.col("tokens")).alias("rate"))
    # cells without tokens weigh nothing: their documents are taken like the mix as a whole
    rated = cells.join(rate, list(DIMS), "left").select(*DIMS, F.coalesce("rate", F.when(F.col("tokens") == 0, F.lit(float(keep))).otherwise(0.0)).alias("rate"))
    return fitted(rated, cells.count())


def draw(seed: int = SEED) -> F.Column:
    """A number in [0, 1) from the id alone: the first 52 bits of its SHA-256."""
    return F.conv(F.left(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), F.lit(13)), 16, 10).cast("double") / F.lit(float(2**52))


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, temper: float = TEMPER, keep: float = KEEP, repeat: bool = False, seed: int = SEED, topic: str = TOPIC) -> DataFrame:
    """doc_id, the cell, n_tokens, probability (expected copies) and copies of every document."""
    rows = celled(docs, topic)
    rate = stash(rates(rows, targets, temper, keep, repeat), "rates")
    p = F.col("rate")
    return rows.join(rate, list(DIMS)).select("doc_id", *DIMS, "n_tokens", p.alias("probability"), (F.floor(p) + (draw(seed) < p - F.floor(p)).cast("int")).cast("int").alias("copies"))


def sample(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, temper: float = TEMPER, keep: float = KEEP, seed: int = SEED, topic: str = TOPIC) -> DataFrame:
    """The documents taken, all columns as they were; the rates cover all of docs."""
    rate = stash(rates(celled(docs, topic), targets, temper, keep), "rates")
    c = cell_columns(topic)
    keyed = docs.select(*(f"`{x}`" for x in docs.columns), c["source"].alias("__source"), c["lang"].alias("__lang"), c["made"]["topic"].alias("__topic"))
    named = rate.select(*(F.col(d).alias(f"__{d}") for d in DIMS), F.col("rate").alias("__rate"))
    return keyed.join(named, [f"__{d}" for d in DIMS]).filter(draw(seed) < F.col("__rate")).select(*(f"`{x}`" for x in docs.columns))


def oracle(temper: float = TEMPER, keep: float = KEEP, sweeps: int = SWEEPS, close: float = CLOSE, seed: int = SEED, block: int = BLOCK) -> str:
    """DuckDB SQL for mix() with default targets: sweeps as steps of a recursive table, checked every `block` of them."""
    share = lambda d: f"{d}_t AS (SELECT {d}, pow(sum(tokens), {temper}) / sum(pow(sum(tokens), {temper})) OVER () AS target FROM cells GROUP BY {d} HAVING sum(tokens) > 0)"
    step = "SELECT *, weight AS before FROM steps WHERE NOT done"
    for d in DIMS:
        step = f"SELECT * REPLACE (CASE WHEN total > 0 THEN weight * {d}_target * budget / total ELSE 0 END AS weight) FROM (SELECT * REPLACE (sum(weight) OVER (PARTITION BY {d}) AS total) FROM ({step}))"
    trimmed = f"SELECT * REPLACE (least(weight, tokens) AS weight) FROM ({step})"
    moved = f"SELECT *, sum(abs(weight - before)) OVER () AS moved FROM ({trimmed})"
    keys = ", ".join(DIMS)
    return f"""
WITH RECURSIVE words AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS t, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n FROM documents),
celled AS (SELECT r, doc_id, source, lang, CAST(n AS BIGINT) AS n_tokens, CASE WHEN n = 0 THEN 'empty' WHEN regexp_matches(t, '(?i)licen[sc]e|copyright|warrant') THEN 'legal'
  WHEN 20 * (length(t) - length(regexp_replace(t, '[|{{}}<>=]', '', 'g'))) > n THEN 'tabular' WHEN n < 100 THEN 'note' WHEN n < 1000 THEN 'article' ELSE 'longform' END AS topic FROM words),
cells AS MATERIALIZED (SELECT {keys}, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM celled GROUP BY ALL),
{", ".join(share(d) for d in DIMS)},
steps AS (SELECT {keys}, tokens, {", ".join(f"{d}_t.target AS {d}_target" for d in DIMS)}, {keep} * (SELECT sum(tokens) FROM cells) AS budget, tokens AS weight, 0::DOUBLE AS total, 0 AS k, false AS done
  FROM cells {" ".join(f"JOIN {d}_t USING ({d})" for d in DIMS)}
  UNION ALL SELECT {keys}, tokens, {", ".join(f"{d}_target" for d in DIMS)}, budget, weight, total, k + 1, k + 1 >= {sweeps} OR ((k + 1) % {block} = 0 AND moved <= {close} * budget) FROM ({moved})),
rated AS (SELECT {keys}, weight / tokens AS rate FROM steps WHERE done AND tokens > 0),
drawn AS (SELECT c.*, coalesce(rate, CASE WHEN cells.tokens = 0 THEN {keep} ELSE 0 END) AS p, CAST('0x' || substr(sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
  FROM celled c JOIN cells USING ({keys}) LEFT JOIN rated USING ({keys}))
SELECT doc_id, {keys}, n_tokens, round(p, 6) AS probability, CAST(floor(p) + CASE WHEN u < p - floor(p) THEN 1 ELSE 0 END AS INTEGER) AS copies FROM drawn
"""
