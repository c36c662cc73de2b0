"""The registered queries of this folder and their SQL, where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.session import ship_package

from . import htmltext, mixing, ngramjoin, packing, quality, rules, tokenfile, topk, toxicity, urlfilter
from .common import parquet

CRC = "crc32(cast(doc_id AS string))"
THRESHOLD = 0.3


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(parquet(spark, d, "documents"), tokenizer("word_bpe_49k.json"))


def op2_token_files(spark: SparkSession, d: str) -> DataFrame:
    return tokenfile.read_tokens(spark, tokenfile.write_tokens(parquet(spark, d, "documents"), tokenizer("byte_bpe_50k.json")))


def op3_source_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(parquet(spark, d, "documents")).withColumn("probability", F.round("probability", 6))


def _judged(scores: DataFrame, held_out: str) -> DataFrame:
    return scores.select("doc_id", F.expr(held_out).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op4_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return _judged(toxicity.toxicity_scores(parquet(spark, d, "documents"), parquet(spark, d, "labels"), f"{CRC} % 4 <> 2"), f"{CRC} % 4 = 2")


def op5_url_filters(spark: SparkSession, d: str) -> DataFrame:
    return urlfilter.url_filter(parquet(spark, d, "pages"))


def op6_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    return _judged(quality.quality_scores(parquet(spark, d, "documents"), parquet(spark, d, "labels"), f"{CRC} % 5 <> 0"), f"{CRC} % 5 = 0")


def op7_exact_top_k(spark: SparkSession, d: str) -> DataFrame:
    vectors = topk.quantised(parquet(spark, d, "embeddings"))
    return topk.top_k(vectors.filter("vec_id % 20 = 0"), vectors, 20)


def op8_ngram_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return ngramjoin.ngram_join(parquet(spark, d, "documents"))


def op9_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    return htmltext.extract_pages(parquet(spark, d, "pages"))


def op10_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return rules.quality_rules(parquet(spark, d, "documents"))


def pipeline(spark: SparkSession, d: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, d)


def queries() -> dict:
    found = (op1_best_fit_packing, op2_token_files, op3_source_mixing, op4_toxicity, op5_url_filters, op6_quality_classifier, op7_exact_top_k, op8_ngram_jaccard_join, op9_html_extraction, op10_quality_rules, pipeline)

    def shipped(f):
        def query(spark: SparkSession, d: str) -> DataFrame:
            ship_package(spark)
            return f(spark, d)

        return query

    return {f.__name__: shipped(f) for f in found}


_SPACE = r"\x20\x09-\x0D"

OP7_SQL = """
WITH whole AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.r AS qr, q.vec_id AS query_id, c.r AS cr, c.vec_id AS vec_id,
    CAST(coalesce(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])), 0) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id, cr) AS rank FROM scored) WHERE rank <= 20
"""

OP8_SQL = rf"""
WITH RECURSIVE texts AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^{_SPACE}]+') AS w FROM documents),
sets AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [[]] WHEN len(w) < 5 THEN [w]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4])) END AS s FROM texts),
items AS (SELECT r, unnest(s) AS x FROM sets),
linked AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM items a JOIN items b ON a.x = b.x AND a.r <> b.r GROUP BY a.r, b.r
  HAVING count(*) >= 0.8 * ((SELECT len(s) FROM sets WHERE r = a.r) + (SELECT len(s) FROM sets WHERE r = b.r) - count(*))),
reach AS (SELECT r AS a, r AS b FROM sets UNION SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a),
classes AS (SELECT a AS r, min(doc_id) AS class_id FROM reach JOIN sets ON reach.b = sets.r GROUP BY a)
SELECT doc_id, class_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links
FROM sets JOIN classes USING (r) LEFT JOIN (SELECT a AS r, count(*) AS n FROM linked GROUP BY a) USING (r)
"""

OP10_SQL = rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
parts AS (SELECT *, regexp_extract_all(t, '[^{_SPACE}]+') AS w, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^{_SPACE}]')) AS l FROM texts),
windows AS (SELECT r, i, w[i:i + 7] AS x FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM parts)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, sum(least(8, coalesce(nxt - i, 8))) AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM twice) GROUP BY r),
stats AS (
  SELECT doc_id, t, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    len(l) AS n_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM parts LEFT JOIN covered USING (r)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM stats)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > 3 * n_words OR word_chars < 2 * n_words OR word_chars > 25 * n_words OR 2 * n_dup_lines > n_lines
    OR 10 * len(regexp_extract_all(t, '\p{{Lu}}{{2,}}')) > 6 * n_words) AS kept
FROM judged
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_source_mixing": mixing.oracle(), "op5_url_filters": urlfilter.oracle(), "op7_exact_top_k": OP7_SQL, "op8_ngram_jaccard_join": OP8_SQL, "op10_quality_rules": OP10_SQL}
