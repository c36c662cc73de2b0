"""Shared helpers: the written tables that cut lineage, and Arrow batch plumbing."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.plans.cut import delete, new_path, shared_folder, stash  # noqa: F401

#: ASCII white space, the separators of words: space, tab, line feed, vertical tab, form feed, return.
WORD_SPLIT = r"[\x20\x09-\x0D]+"


def tidy(run: Callable, forget: Callable | None = None) -> Callable:
    """run, a function of mapInArrow, which at its end forgets what it need not keep and returns free memory to the system:
    an idle Python worker holds what it has until its executor's next task for it, beside that executor's JVM."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            if forget:
                forget()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
                trim(0)

    return tidied


def shrink_heaps(spark: SparkSession) -> None:
    """Have every executor's JVM collect its garbage whole, which gives the free part of its heap back to the system.

    A G1 heap grows under a step that makes much garbage, and stays so until a concurrent cycle happens to end: of three
    executors at the same work one held 1,749 MB where the others had 570 and 840 (measured). One task for each core, all
    started at once, so an idle cluster gives each executor as many as it has cores.
    """
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.expr("java_method('java.lang.System', 'gc')").alias("done")).write.format("noop").mode("overwrite").save()


def rows_to_batch(columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def texts_of(column: pa.Array) -> Iterator[str]:
    """Every text of a column, null as empty, one Python string at a time."""
    for x in column:
        yield x.as_py() or ""


def words_col(text) -> F.Column:
    """Words as runs of characters other than ASCII white space; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SPLIT), lambda w: w != "")


def parquet(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
