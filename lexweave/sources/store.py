"""Artifact tables: JSON lines at the edge, Parquet inside; explicit schemas, missing paths read as empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexweave.plans.cut import stash

SCHEMAS = {
    "metadata": "source_id string, title string, issuer string, publish_date string, effective_date string, category string, status string, source_url string, source_format string",
    "nodes": "id string, type string, name string, level string, text string, description string, category string, status string, issuer string, publish_date string, effective_date string, source_url string",
    "edges": "id string, source string, target string, type string",
    "candidates": "id string, source_node_id string, text string, target_node_ids array<string>, target_categories array<string>",
    "extract_inputs": "id string, hierarchy string, content string",
    "extract_concepts": "id string, concepts array<struct<name:string,description:string>>",
    "aggregate_concepts": "id string, name string, description string, parent string, root string",
    "vectors": "id string, vector array<float>",
    "align_pairs": "left_id string, right_id string, relation string, similarity double",
    "relations": "left_id string, right_id string, relation string",
}


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


class ArtifactStore:
    """Typed tables under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def read(self, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        return self.spark.read.schema(SCHEMAS[name]).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], SCHEMAS[name])

    def write(self, name: str, df: DataFrame) -> None:
        """Only the schema's columns, cast to their types; the commit protocol makes the write atomic."""
        want = self.spark.createDataFrame([], SCHEMAS[name]).schema
        df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in want)).write.mode("overwrite").parquet(f"{self.root}/{name}")

    def read_jsonl(self, path: str, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).json(path) if exists(self.spark, path) else self.spark.createDataFrame([], SCHEMAS[name])


def read_metadata_shards(spark: SparkSession, pattern: str) -> DataFrame:
    """Every shard is a JSON array of objects."""
    return spark.read.schema(SCHEMAS["metadata"]).json(pattern, multiLine=True)


def in_scope(metadata: DataFrame, category=None, category_except=None, status=None, status_except=None) -> DataFrame:
    """source_id of the rows in scope; exclusion keeps nulls, inclusion does not."""
    out = metadata
    for c, keep, drop in (("category", category, category_except), ("status", status, status_except)):
        if keep:
            out = out.filter(F.col(c).isin(*keep))
        if drop:
            out = out.filter(~F.coalesce(F.col(c), F.lit("")).isin(*drop))
    return out.select("source_id")


def shard(df: DataFrame, order: str, size: int) -> DataFrame:
    """df with its shard number when sorted by `order`, `size` rows a shard: ranges first, then numbers within them.

    Range partitions are counted (one small row each) and their starts added to the numbers inside them.
    """
    ranged = stash(df.repartitionByRange(order).withColumn("__part", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("__part").count().orderBy("__part").collect()
    starts, at = {}, 0
    for r in counts:
        starts[r["__part"]] = at
        at += r["count"]
    start = F.element_at(F.create_map(*[F.lit(x) for kv in starts.items() for x in kv]), F.col("__part")) if starts else F.lit(0)
    rn = F.row_number().over(Window.partitionBy("__part").orderBy(order))
    return ranged.withColumn("shard", F.floor((rn - 1 + start) / size).cast("int")).drop("__part")


def parse_judgments(df: DataFrame, xml: str = "xml") -> DataFrame:
    """title, case_no, court and the cited provisions of judgment documents, by XPath."""
    one = lambda p: F.xpath_string(F.col(xml), F.lit(p))
    return df.select("id", one("/doc/title").alias("title"), one("/doc/case_no").alias("case_no"), one("/doc/court").alias("court"), F.xpath(F.col(xml), F.lit("/doc/citation/text()")).alias("citations"))


def validate_scope(source_ids=(), everything: bool = False, category=(), category_except=(), status=(), status_except=()) -> None:
    """ValueError unless just one of ids, everything and filters chooses the scope, and no filter asks for what its other half
    excludes."""
    chosen = sum(map(bool, (source_ids, everything, category or category_except or status or status_except)))
    if chosen != 1:
        raise ValueError("choose a scope by one of source ids, everything, or filters")
    for name, wanted, excluded in (("category", category, category_except), ("status", status, status_except)):
        both = sorted(set(wanted) & set(excluded))
        if both:
            raise ValueError(f"{name} is wanted and excluded: {', '.join(both)}")


def is_materialized(units: DataFrame, results: DataFrame, key: str) -> bool:
    """Whether every unit of a table has a row of results; a table without units is."""
    return units.select(key).distinct().join(results.select(key).distinct(), key, "left_anti").isEmpty()


def page(rows: DataFrame, order: list, number: int, size: int) -> DataFrame:
    """The page of a number (from 1) of rows in an order, which should end in a key."""
    return rows.orderBy(*order).offset((number - 1) * size).limit(size)


def matching(rows: DataFrame, columns: list[str], pattern: str, **equal) -> DataFrame:
    """The rows whose columns equal the given values (None: not asked) and of which one column holds the pattern, in any case."""
    for name, value in equal.items():
        if value is not None:
            rows = rows.filter(F.col(name) == value)
    word = "%" + pattern.replace("\\", "\\\\").replace("%", r"\%").replace("_", r"\_") + "%"
    hit = F.lit(False)
    for name in columns:
        hit = hit | F.coalesce(F.col(name).ilike(word), F.lit(False))
    return rows.filter(hit) if pattern else rows
