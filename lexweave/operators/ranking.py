"""Aggregates and windows of the engine's stages: choices with ties, fusion, metrics, batching and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def best_row(df: DataFrame, keys: list[str], *order) -> DataFrame:
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__rank = 1").drop("__rank")


def mode_of(df: DataFrame, key: str, value: str) -> DataFrame:
    """The commonest value of each key; ties go to the shorter, then the smaller."""
    n = df.groupBy(key, value).agg(F.count("*").alias("n"))
    return n.groupBy(key).agg(F.min_by(value, F.struct(-F.col("n"), F.char_length(F.col(value).cast("string")), value)).alias(value))


def rank_fusion(lists: DataFrame, k: float = 20.0) -> DataFrame:
    """item_id, score (sum of weight / (k + rank)) and its sources; lists is (list_id, rank, item_id, source, weight)."""
    return lists.groupBy("item_id").agg(F.sum(F.col("weight") / (F.lit(k) + F.col("rank"))).alias("score"), F.array_sort(F.collect_set("source")).alias("sources"))


def keyword_score(texts: DataFrame, keywords: dict[str, float], id_col: str, text_col: str) -> DataFrame:
    """The weights of the keywords a text holds, upper and lower case alike; keywords is a small fixed table."""
    low = F.lower(F.col(text_col))
    score = F.lit(0.0)
    for word, w in keywords.items():
        score = score + F.when(low.contains(word.lower()), F.lit(float(w))).otherwise(0.0)
    return texts.select(id_col, score.alias("score")).filter("score > 0")


def latest(df: DataFrame, title: str, *order) -> DataFrame:
    """Each trimmed title's first row in order; untitled rows all stay."""
    t = F.trim(F.col(title))
    named = best_row(df.filter(t != "").withColumn("__title", t), ["__title"], *order).drop("__title")
    return named.unionByName(df.filter(t.isNull() | (t == "")))


def superseded(df: DataFrame, title: str, *order) -> DataFrame:
    """The rows that latest() drops."""
    t = F.trim(F.col(title))
    ranked = df.filter(t != "").withColumn("__rank", F.row_number().over(Window.partitionBy(t).orderBy(*order)))
    return ranked.filter("__rank > 1").drop("__rank")


def fill_split(df: DataFrame, group: str, fractions: tuple[float, float] = (0.8, 0.1), seed: int = 42) -> DataFrame:
    """df with split: whole groups fill train, then dev, up to their fractions of all rows, the rest is test.

    Groups come in the order of a hash; a group goes where the rows before it end, so a fraction is passed by less than one
    group. Running counts are added up by ranges of the hash, so no task sorts all groups."""
    u = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(group).cast("string")), 256), 1, 8), 16, 10).cast("long")
    sizes = df.groupBy(group).agg(F.count("*").alias("n")).withColumn("u", u).withColumn("part", (F.col("u") / F.lit(2**22)).cast("int"))
    within = F.sum("n").over(Window.partitionBy("part").orderBy("u", group)) - F.col("n")
    parts = sizes.groupBy("part").agg(F.sum("n").alias("pn"))  # 1,024 ranges of the hash
    before = parts.withColumn("start", F.sum("pn").over(Window.orderBy("part")) - F.col("pn")).withColumn("all", F.sum("pn").over(Window.partitionBy()))
    at = (within + F.col("start")) / F.col("all")
    placed = sizes.join(F.broadcast(before), "part").select(F.col(group).alias("__g"), F.when(at < fractions[0], "train").when(at < sum(fractions), "dev").otherwise("test").alias("split"))
    return df.join(placed, F.col(group).eqNullSafe(F.col("__g")), "left").drop("__g")


def binary_metrics(df: DataFrame, gold: str, predicted) -> DataFrame:
    """One row of counts, accuracy, precision, recall and F1; a division by zero is 0."""
    g, p = F.col(gold), predicted
    c = df.agg(F.count_if(g & p).alias("tp"), F.count_if(~g & p).alias("fp"), F.count_if(g & ~p).alias("fn"), F.count_if(~g & ~p).alias("tn"))
    div = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    c = c.withColumns({"accuracy": div(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")), "precision": div(F.col("tp"), F.col("tp") + F.col("fp")), "recall": div(F.col("tp"), F.col("tp") + F.col("fn"))})
    return c.withColumn("f1", div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def threshold_grid(df: DataFrame, gold: str, score: str, grid: list[float]) -> DataFrame:
    """threshold, precision, recall, f1 of each point of a short fixed grid, in one pass over the data."""
    rows = df.select(F.col(gold).alias("g"), F.col(score).alias("s"), F.explode(F.array(*(F.lit(float(t)) for t in grid))).alias("threshold"))
    hit = F.col("s") >= F.col("threshold")
    c = rows.groupBy("threshold").agg(F.count_if(F.col("g") & hit).alias("tp"), F.count_if(~F.col("g") & hit).alias("fp"), F.count_if(F.col("g") & ~hit).alias("fn"))
    div = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    c = c.withColumns({"precision": div(F.col("tp"), F.col("tp") + F.col("fp")), "recall": div(F.col("tp"), F.col("tp") + F.col("fn"))})
    return c.select("threshold", "precision", "recall", div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")).alias("f1"))


def error_summary(df: DataFrame, kind: str, message: str, id_col: str, top: int = 10) -> DataFrame:
    """Counts by (kind, message) with the three smallest ids as samples, the commonest first; `top` is the report's length.

    Ids are ranked after their counts are merged, by a running rank that stops at three in every task (a group limit).
    """
    few = df.filter(F.col(id_col).isNotNull()).withColumn("__r", F.row_number().over(Window.partitionBy(kind, message).orderBy(id_col))).filter("__r <= 3")
    n = df.groupBy(kind, message).agg(F.count("*").alias("n")).orderBy(F.desc("n"), kind, message).limit(top)
    named = few.groupBy(F.col(kind).alias("__kind"), F.col(message).alias("__message")).agg(F.sort_array(F.collect_list(id_col)).alias("sample_ids"))
    met = n.join(named, F.col(kind).eqNullSafe(F.col("__kind")) & F.col(message).eqNullSafe(F.col("__message")), "left")
    return met.select(kind, message, "n", F.coalesce("sample_ids", F.array().cast(named.schema["sample_ids"].dataType)).alias("sample_ids"))


def batches(df: DataFrame, keys: list[str], order: list, size: int) -> DataFrame:
    """df with batch: rows of a key in order, `size` to a batch, from 0."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("batch", F.floor((rn - 1) / size).cast("int"))


def group_split(df: DataFrame, group: str, fractions: tuple[float, float] = (0.8, 0.9), seed: int = 42) -> DataFrame:
    """df with split: every group in one of train, dev and test, by a hash of the group."""
    u = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(group).cast("string")), 256), 1, 8), 16, 10).cast("double") / float(2**32)
    return df.withColumn("split", F.when(u < fractions[0], "train").when(u < fractions[1], "dev").otherwise("test"))
