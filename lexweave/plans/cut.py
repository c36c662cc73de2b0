"""Written tables in a shared folder: they cut lineage, and a lost executor costs no recomputation."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_made = threading.local()
#: For local files Hadoop starts `chmod` processes, forks of the executor's JVM: with its checksum files 6.1 processes and
#: threads a written file, without them 4.1 (measured). Parquet pages have checksums of their own. In other stores these
#: options do nothing.
LOCAL_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
#: Rows of a narrow table that one file holds, where a table of known size is fitted to fewer files.
FILE_ROWS = 100_000


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: spark.checkpoint.dir, or in local mode (tests) a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", "")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='lexweave-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/lexweave/{name}-{uuid.uuid4().hex}"


def write(df: DataFrame, path: str) -> None:
    """Write df as Parquet for later steps of the same application."""
    df.write.options(**LOCAL_FILES).parquet(path)


def fitted(df: DataFrame, rows: int) -> DataFrame:
    """df, a narrow table of at most so many rows, in as many tasks as they need, at least two a core: else a step over a
    few rows writes a file for each partition of a shuffle. Larger tables keep their partitions."""
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    write(df, path)
    for paths in getattr(_made, "scopes", ())[-1:]:
        paths.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by its keys over as many tasks as a shuffle has. Rows that cost much each must not be left to the few tasks
    that read a small or undivided file."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def drop(*tables: DataFrame) -> None:
    """Delete stashed tables that later written tables have replaced; other DataFrames are left alone."""
    for df in tables:
        if path := getattr(df, "_written_at", None):
            delete(df.sparkSession, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables stashed inside at the end, on failure too. What is to stay must be written outside of it, or read
    before the end: DataFrames are lazy."""
    _made.scopes = [*getattr(_made, "scopes", ()), []]
    try:
        yield
    finally:
        for path in _made.scopes.pop():
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; one that is gone already is no error."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
