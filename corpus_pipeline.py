"""The corpus pipeline: toxicity, quality rules, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes as Parquet in the shared folder and
rereads as the next stage's docs. All stages but the last return the columns of documents. The tables that a stage writes
for itself are deleted when its result is written.

Defined results: null and empty texts are not toxic, but have too few words for the quality rules and go there; rows with a
null doc_id are judged like others; of a class of copies or near copies one row with its smallest id stays, whatever ids
repeat or are null; exact repeats of a row are copies; ties in packing change sequence ids only; an empty table passes
every stage empty; further columns pass through to the last stage, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from lexweave.llm import mixing, ngramjoin, packing, rules, toxicity
from lexweave.llm.common import parquet, shrink_heaps
from lexweave.llm.queries import tokenizer
from lexweave.plans.cut import new_path, scratch, write
from lexweave.session import ship_package


def lean(stage: Callable) -> Callable:
    """stage, whose steps and whose result begin with executors that hold no garbage of what ran before."""

    @wraps(stage)
    def run_lean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        shrink_heaps(spark)
        kept = stage(spark, docs, sf_dir)
        shrink_heaps(spark)
        return kept

    return run_lean


@lean
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return toxicity.keep_ordinary(docs, parquet(spark, sf_dir, "labels"))


@lean
def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.keep_good(docs)


@lean
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return ngramjoin.keep_one(docs)


@lean
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sample(docs)


@lean
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("quality_rules", drop_poor), ("near_duplicates", drop_near_duplicates), ("mixing", mix_sources), ("packing", pack)]

#: A trained model, MinHash pruning, a hashed draw and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parquet(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        with scratch(spark):
            kept = stage(spark, docs, sf_dir)
            write(kept, path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return docs
