"""The registered queries of the library on the driver's tables, and their SQL.

The star schema stands in for a statute hierarchy: region > nation > customer > order is a CONTAINS forest of four levels,
suppliers and parts a reference graph, events ranked lists and judgments, documents texts, embeddings concepts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.functions import labels, numerals, statute, text, vectors
from lexweave.operators import graph, ranking, similarity
from lexweave.operators.components import connected_components
from lexweave.plans.cut import spread
from lexweave.session import ship_package
from lexweave.sources import store

_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        def run(spark: SparkSession, d: str) -> DataFrame:
            ship_package(spark)
            return f(lambda t: spark.read.parquet(f"{d}/{t}.parquet"))

        _QUERIES[f.__name__] = run
        if sql:
            _SQL[f.__name__] = sql
        return f

    return keep


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- graphs ---------------------------------------------------------------------------------------------------------

def nodes(t) -> DataFrame:
    def part(df, prefix, key, kind, level, name, body):
        return df.select(F.concat(F.lit(f"{prefix}:"), F.col(key).cast("string")).alias("id"), F.lit(kind).alias("type"), F.lit(level).alias("level"), F.col(name).cast("string").alias("name"), F.col(body).cast("string").alias("text"))

    return (
        part(t("region"), "r", "r_regionkey", "DocumentNode", "document", "r_name", "r_name")
        .unionByName(part(t("nation"), "n", "n_nationkey", "TocNode", "chapter", "n_name", "n_name"))
        .unionByName(part(t("customer"), "c", "c_custkey", "ProvisionNode", "article", "c_name", "c_mktsegment"))
        .unionByName(part(t("orders"), "o", "o_orderkey", "ProvisionNode", "paragraph", "o_orderkey", "o_orderpriority"))
    )


def edges(t) -> DataFrame:
    def part(df, a, ak, b, bk):
        return df.select(F.concat(F.lit(f"{a}:"), F.col(ak).cast("string")).alias("source"), F.concat(F.lit(f"{b}:"), F.col(bk).cast("string")).alias("target"), F.lit("CONTAINS").alias("type"))

    return part(t("nation"), "r", "n_regionkey", "n", "n_nationkey").unionByName(part(t("customer"), "n", "c_nationkey", "c", "c_custkey")).unionByName(part(t("orders"), "c", "o_custkey", "o", "o_orderkey"))


N_SQL = """nodes AS (SELECT 'r:' || r_regionkey AS id, 'DocumentNode' AS type, 'document' AS level, r_name AS name, r_name AS text FROM region
 UNION ALL SELECT 'n:' || n_nationkey, 'TocNode', 'chapter', n_name, n_name FROM nation
 UNION ALL SELECT 'c:' || c_custkey, 'ProvisionNode', 'article', c_name, c_mktsegment FROM customer
 UNION ALL SELECT 'o:' || o_orderkey, 'ProvisionNode', 'paragraph', CAST(o_orderkey AS VARCHAR), o_orderpriority FROM orders)"""
E_SQL = """edges AS (SELECT 'r:' || n_regionkey AS source, 'n:' || n_nationkey AS target, 'CONTAINS' AS type FROM nation
 UNION ALL SELECT 'n:' || c_nationkey, 'c:' || c_custkey, 'CONTAINS' FROM customer UNION ALL SELECT 'c:' || o_custkey, 'o:' || o_orderkey, 'CONTAINS' FROM orders)"""
SELF_SQL = "self AS (SELECT * FROM up UNION ALL SELECT id, id, 0 FROM nodes)"
UP_SQL = "up AS (SELECT target AS node, source AS ancestor, 1 AS depth FROM edges UNION ALL SELECT up.node, e.source, up.depth + 1 FROM up JOIN edges e ON up.ancestor = e.target)"


@query(f"WITH RECURSIVE {E_SQL}, {UP_SQL} SELECT node, ancestor, depth FROM up")
def j3_ancestor_closure(t):
    return graph.ancestors(edges(t))


@query(f"WITH RECURSIVE {N_SQL}, {E_SQL}, {UP_SQL}, {SELF_SQL} SELECT node, ancestor AS owner FROM self JOIN nodes ON id = ancestor WHERE level = 'document'")
def j4_owner_document(t):
    return graph.owners(edges(t), nodes(t))


@query(f"WITH RECURSIVE {N_SQL}, {E_SQL}, {UP_SQL}, {SELF_SQL} SELECT node, min(name) FILTER (level = 'document') AS document, min(name) FILTER (level = 'chapter') AS chapter, min(name) FILTER (level = 'article') AS article FROM self JOIN nodes ON id = ancestor GROUP BY node")
def j5_label_path(t):
    return graph.label_path(graph.ancestors(edges(t)), nodes(t), ["document", "chapter", "article"])


@query(f"WITH {N_SQL}, {E_SQL} SELECT id, source AS parent, lag(id) OVER (PARTITION BY source, level ORDER BY id) AS previous FROM nodes JOIN edges ON id = target")
def j6_previous_sibling(t):
    return graph.siblings(nodes(t), edges(t))


@query(f"WITH RECURSIVE {N_SQL}, {E_SQL}, {UP_SQL} SELECT ancestor AS document, level, count(*) AS n FROM up JOIN nodes ON id = node WHERE ancestor LIKE 'r:%' GROUP BY ALL")
def j35_descendants_by_level(t):
    return graph.ancestors(edges(t)).filter("ancestor LIKE 'r:%'").join(nodes(t).select(F.col("id").alias("node"), "level"), "node").groupBy(F.col("ancestor").alias("document"), "level").agg(F.count("*").alias("n"))


@query(f"WITH {E_SQL}, b AS (SELECT source AS a, target AS node FROM edges UNION SELECT target, source FROM edges) SELECT DISTINCT a AS start, node FROM b WHERE a LIKE 'n:%'")
def j33_neighbours(t):
    e = edges(t)
    return graph.neighbours(e, e.select(F.col("target").alias("start")).filter("start LIKE 'n:%'").distinct())


@query(f"""WITH {E_SQL}, b AS MATERIALIZED (SELECT source AS a, target AS b FROM edges UNION SELECT target, source FROM edges),
 h AS (SELECT 'r:' || r_regionkey AS start, 'r:' || r_regionkey AS node, 0 AS hop FROM region),
 h1 AS (SELECT start, b AS node, 1 AS hop FROM h JOIN b ON node = a), h2 AS (SELECT start, b.b AS node, 2 AS hop FROM h1 JOIN b ON node = a)
 SELECT start, node, min(hop) AS hop FROM (SELECT * FROM h UNION ALL SELECT * FROM h1 UNION ALL SELECT * FROM h2) GROUP BY ALL""")
def j34_two_hop_subgraph(t):
    return graph.khop(edges(t), t("region").select(F.concat(F.lit("r:"), F.col("r_regionkey").cast("string")).alias("start")), 2)


@query(f"""WITH RECURSIVE {E_SQL}, {UP_SQL}, every AS (SELECT source AS node FROM edges UNION SELECT target FROM edges),
 roots AS (SELECT every.node, coalesce(max_by(ancestor, depth), every.node) AS root FROM every LEFT JOIN up ON up.node = every.node GROUP BY every.node)
 SELECT node, min(node) OVER (PARTITION BY root) AS component FROM roots""")
def j30_connected_components(t):
    return connected_components(edges(t), "source", "target")


@query("""WITH old AS (SELECT o_orderkey AS id, o_custkey AS scope, o_orderstatus AS v FROM orders), new AS (SELECT o_orderkey AS id, o_custkey AS scope, 'new' AS v FROM orders WHERE o_totalprice > 450000)
 SELECT * FROM old WHERE scope NOT IN (SELECT scope FROM new) UNION ALL SELECT * FROM new""")
def j16_replace_scope(t):
    part = lambda o, v: o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("scope"), v.alias("v"))
    return graph.replace_scope(part(t("orders"), F.col("o_orderstatus")), part(t("orders").filter("o_totalprice > 450000"), F.lit("new")), "scope")


@query("""WITH c AS (SELECT l_orderkey AS id, list(l_partkey ORDER BY l_linenumber, l_partkey) AS targets FROM lineitem GROUP BY 1),
 x AS (SELECT id, unnest(targets) AS target, generate_subscripts(targets, 1) AS pos FROM c)
 SELECT id, CAST(list(target ORDER BY pos) AS VARCHAR) AS targets FROM x JOIN part ON p_partkey = target WHERE p_size <= 10 GROUP BY id""")
def j14_keep_active_targets(t):
    c = t("lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"]).alias("targets"))
    kept = graph.keep_active_targets(c, t("part").filter("p_size <= 10").select(F.col("p_partkey").alias("id")))
    return kept.select("id", F.concat(F.lit("["), F.array_join(F.transform("targets", lambda x: x.cast("string")), ", "), F.lit("]")).alias("targets"))


@query("""WITH e AS (SELECT DISTINCT l_suppkey AS source, l_partkey % 500 AS target, 'REL' AS type FROM lineitem), m AS (SELECT p_partkey AS old, p_partkey % 50 AS new FROM part WHERE p_size > 30)
 SELECT DISTINCT coalesce(a.new, source) AS source, coalesce(b.new, target) AS target, type FROM e LEFT JOIN m a ON source = a.old LEFT JOIN m b ON target = b.old WHERE coalesce(a.new, source) <> coalesce(b.new, target)""")
def j23_endpoint_remap(t):
    e = t("lineitem").select(F.col("l_suppkey").alias("source"), (F.col("l_partkey") % 500).alias("target"), F.lit("REL").alias("type")).distinct()
    return graph.remap(e, t("part").filter("p_size > 30").select(F.col("p_partkey").alias("old"), (F.col("p_partkey") % 50).alias("new")))


@query("""WITH a AS (SELECT least(l_suppkey, l_partkey) AS lo, greatest(l_suppkey, l_partkey) AS hi FROM lineitem), b AS (SELECT least(o_custkey, o_orderkey % 100) AS lo, greatest(o_custkey, o_orderkey % 100) AS hi FROM orders)
 SELECT DISTINCT lo, hi FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.lo = b.lo AND a.hi = b.hi)""")
def j24_unordered_pair_antijoin(t):
    pair = lambda df, a, b: df.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).distinct()
    return pair(t("lineitem"), F.col("l_suppkey"), F.col("l_partkey")).join(pair(t("orders"), F.col("o_custkey"), F.col("o_orderkey") % 100), ["lo", "hi"], "left_anti")


@query(f"""WITH {N_SQL}, {E_SQL}, bad AS (SELECT * FROM edges UNION ALL SELECT 'o:' || l_orderkey, 'p:' || l_partkey, 'CONTAINS' FROM lineitem WHERE l_linenumber = 1 UNION ALL SELECT 'n:' || c_nationkey, 'o:' || c_custkey, 'CONTAINS' FROM customer)
 SELECT source, target, type, reason FROM (SELECT b.*, CASE WHEN s.id IS NULL THEN 'no_source' WHEN t.id IS NULL THEN 'no_target' WHEN (s.level, t.level) NOT IN (('document', 'chapter'), ('chapter', 'article'), ('article', 'paragraph')) THEN 'not_allowed' END AS reason
 FROM bad b LEFT JOIN nodes s ON s.id = source LEFT JOIN nodes t ON t.id = target) WHERE reason IS NOT NULL""")
def v1_schema_validation(t):
    extra = t("lineitem").filter("l_linenumber = 1").selectExpr("concat('o:', l_orderkey) AS source", "concat('p:', l_partkey) AS target", "'CONTAINS' AS type").unionByName(t("customer").selectExpr("concat('n:', c_nationkey) AS source", "concat('o:', c_custkey) AS target", "'CONTAINS' AS type"))
    n = nodes(t)
    rules = n.sparkSession.createDataFrame([("CONTAINS", "document", "chapter"), ("CONTAINS", "chapter", "article"), ("CONTAINS", "article", "paragraph")], "type string, source_level string, target_level string")
    return graph.invalid_edges(n, edges(t).unionByName(extra), rules)


@query(f"WITH {E_SQL} SELECT DISTINCT sha256(source || chr(9) || target || chr(9) || type) AS id, source, target, type FROM edges")
def u1_merge_edges_with_ids(t):
    return graph.with_edge_ids(graph.merge_edges(edges(t).withColumn("w", F.lit(1)), edges(t).withColumn("w", F.lit(2))).drop("w"))


@query("SELECT o_orderkey AS id, CASE WHEN o_orderpriority = '1-URGENT' THEN 'second' ELSE o_orderstatus END AS v FROM orders")
def u1_merge_nodes(t):
    part = lambda o, v: o.select(F.col("o_orderkey").alias("id"), v.alias("v"))
    return graph.merge_nodes(part(t("orders"), F.col("o_orderstatus")), part(t("orders").filter("o_orderpriority = '1-URGENT'"), F.lit("second")))


@query("SELECT s.l_suppkey AS id FROM (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_quantity > 49) s UNION SELECT s_suppkey FROM supplier WHERE s_acctbal < 0 EXCEPT SELECT s_suppkey FROM supplier WHERE s_nationkey = 3")
def u3_set_operations(t):
    a = t("lineitem").filter("l_quantity > 49").select(F.col("l_suppkey").alias("id"))
    s = t("supplier").select(F.col("s_suppkey").alias("id"), "s_acctbal", "s_nationkey")
    return a.unionByName(s.filter("s_acctbal < 0").select("id")).distinct().join(s.filter("s_nationkey = 3").select("id"), "id", "left_anti")


@query("""WITH a AS (SELECT DISTINCT l_suppkey AS x, l_partkey % 90 AS y FROM lineitem WHERE l_quantity > 40), b AS (SELECT DISTINCT l_suppkey AS x, l_partkey % 90 AS y FROM lineitem WHERE l_discount > 0.05)
 SELECT * FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def u4_symmetric_difference(t):
    keys = lambda w: t("lineitem").filter(w).select(F.col("l_suppkey").alias("x"), (F.col("l_partkey") % 90).alias("y")).distinct()
    a, b = keys("l_quantity > 40").withColumn("a", F.lit(1)), keys("l_discount > 0.05").withColumn("b", F.lit(1))
    return a.join(b, ["x", "y"], "full").filter("a IS NULL OR b IS NULL").select("x", "y")


# --- evidence and fusion --------------------------------------------------------------------------------------------

AA = "l AS (SELECT DISTINCT l_suppkey AS node, l_partkey AS hub FROM lineitem)"


@query(f"""WITH {AA}, w AS (SELECT hub, 1 / ln(count(*)) AS w FROM l GROUP BY hub HAVING count(*) > 1)
 SELECT a.node AS left, b.node AS right, round(1 - exp(-sum(w)), 6) AS score FROM l a JOIN l b USING (hub) JOIN w USING (hub) WHERE a.node < b.node GROUP BY ALL""")
def a16_adamic_adar(t):
    links = t("lineitem").select(F.col("l_suppkey").alias("node"), F.col("l_partkey").alias("hub"))
    return graph.adamic_adar(links).withColumn("score", F.round("score", 6))


@query(f"""WITH {AA}, n AS (SELECT node, count(*) AS n FROM l GROUP BY node) SELECT a.node AS left, b.node AS right, round(count(*) / greatest(any_value(x.n), any_value(y.n)), 6) AS score
 FROM l a JOIN l b USING (hub) JOIN n x ON x.node = a.node JOIN n y ON y.node = b.node WHERE a.node < b.node GROUP BY ALL""")
def a17_common_ratio(t):
    links = t("lineitem").select(F.col("l_suppkey").alias("node"), F.col("l_partkey").alias("member"))
    return graph.common_ratio(links).withColumn("score", F.round("score", 6))


@query("""WITH c AS (SELECT least(s_nationkey, c_nationkey) AS left, greatest(s_nationkey, c_nationkey) AS right, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey <> c_nationkey GROUP BY ALL)
 SELECT "left", "right", round(ln(1 + n) / ln(1 + (SELECT max(n) FROM c)), 6) AS score FROM c""")
def a18_bridge_score(t):
    j = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).filter("s_nationkey <> c_nationkey")
    counts = j.groupBy(F.least("s_nationkey", "c_nationkey").alias("left"), F.greatest("s_nationkey", "c_nationkey").alias("right")).agg(F.count("*").alias("n"))
    return graph.bridge_score(counts).withColumn("score", F.round("score", 6))


@query("""WITH e AS (SELECT user_id AS left_id, event_id % 500 AS right_id, CASE event_type WHEN 'purchase' THEN 'equivalent' WHEN 'click' THEN 'related' ELSE 'is_subordinate' END AS relation FROM events),
 g AS (SELECT least(left_id, right_id) AS a, greatest(left_id, right_id) AS b, bool_or(relation = 'equivalent') AS eq, bool_or(relation = 'is_subordinate' AND left_id <= right_id) AS down, bool_or(relation = 'is_subordinate' AND left_id > right_id) AS up FROM e GROUP BY ALL)
 SELECT CASE WHEN up AND NOT down AND NOT eq THEN b ELSE a END AS left_id, CASE WHEN up AND NOT down AND NOT eq THEN a ELSE b END AS right_id,
 CASE WHEN eq THEN 'equivalent' WHEN up AND down THEN 'related' WHEN up OR down THEN 'is_subordinate' ELSE 'related' END AS relation FROM g""")
def a15_merge_directions(t):
    e = t("events").select(F.col("user_id").alias("left_id"), (F.col("event_id") % 500).alias("right_id"), F.expr("CASE event_type WHEN 'purchase' THEN 'equivalent' WHEN 'click' THEN 'related' ELSE 'is_subordinate' END").alias("relation"))
    return graph.merge_directions(e)


LISTS = "lists AS (SELECT user_id AS list_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rank, event_id % 300 AS item_id, event_type AS source, CASE event_type WHEN 'purchase' THEN 2.0 ELSE 1.0 END AS weight FROM events)"


def ranked_lists(t):
    w = ranking.Window.partitionBy("user_id").orderBy(F.desc("value"), "event_id")
    return t("events").select(F.col("user_id").alias("list_id"), F.row_number().over(w).alias("rank"), (F.col("event_id") % 300).alias("item_id"), F.col("event_type").alias("source"), F.expr("CASE event_type WHEN 'purchase' THEN 2.0D ELSE 1.0D END").alias("weight"))


@query(f"WITH {LISTS} SELECT item_id, round(sum(weight / (20.0 + rank)), 6) AS score, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources FROM lists GROUP BY item_id")
def a20_reciprocal_rank_fusion(t):
    return ranking.rank_fusion(ranked_lists(t)).select("item_id", F.round("score", 6).alias("score"), F.array_join("sources", ",").alias("sources"))


@query(f"""WITH RECURSIVE {N_SQL}, {E_SQL}, {UP_SQL}, owners AS (SELECT node, ancestor AS owner FROM up WHERE ancestor LIKE 'n:%'),
 ranked AS (SELECT owner, node, row_number() OVER (PARTITION BY owner ORDER BY o_totalprice DESC, node) AS rank FROM owners JOIN orders ON node = 'o:' || o_orderkey)
 SELECT owner AS item_id, round(sum(1 / (20.0 + rank)), 6) AS score, count(*) AS n FROM ranked GROUP BY owner""")
def flagship_graph_rank_fusion(t):
    owners = graph.ancestors(edges(t)).filter("ancestor LIKE 'n:%'").select("node", F.col("ancestor").alias("owner"))
    o = t("orders").select(F.concat(F.lit("o:"), F.col("o_orderkey").cast("string")).alias("node"), "o_totalprice")
    ranked = owners.join(o, "node").withColumn("rank", F.row_number().over(ranking.Window.partitionBy("owner").orderBy(F.desc("o_totalprice"), "node")))
    return ranked.groupBy(F.col("owner").alias("item_id")).agg(F.round(F.sum(1 / (20.0 + F.col("rank"))), 6).alias("score"), F.count("*").alias("n"))


VEC = "v AS (SELECT vec_id AS id, embedding, label FROM embeddings)"


@query(f"WITH {VEC} SELECT a.id AS left_id, b.id AS right_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 5) AS similarity FROM v a JOIN v b ON a.id < b.id WHERE list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) >= 0.3")
def j20_similarity_self_join(t):
    v = t("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return similarity.similarity_join(v, v, 0.3, triangular=True).withColumn("similarity", F.round("similarity", 5))


@query(f"""WITH {VEC}, s AS (SELECT a.id AS left_id, b.id AS right_id, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS s FROM v a JOIN v b ON a.id <> b.id)
 SELECT left_id, right_id, round(s, 5) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY round(s, 9) DESC, right_id) AS r FROM s) WHERE r <= 12""")
def j22_knn_join(t):
    v = t("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return similarity.similarity_join(v, v, -1.0, k=12).withColumn("similarity", F.round("similarity", 5))


@query(f"WITH {VEC} SELECT id, round(greatest(0, least(1, (list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(list_reverse(embedding) AS DOUBLE[])) + 1) / 2)), 6) AS score FROM v")
def f33_cosine_and_semantic_score(t):
    return t("embeddings").select(F.col("vec_id").alias("id"), F.round(vectors.semantic_score(vectors.cosine(F.col("embedding"), F.reverse("embedding"))), 6).alias("score"))


# --- aggregates, windows, sorts -------------------------------------------------------------------------------------

@query("SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, length(event_type), event_type) AS r FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)) WHERE r = 1")
def a8_mode_with_ties(t):
    return ranking.mode_of(t("events"), "user_id", "event_type")


@query("SELECT lang, source, max(n_chars) AS longest, CAST(min(doc_id) AS BIGINT) AS first_doc, count(*) AS n, count(DISTINCT n_chars) AS sizes FROM documents GROUP BY ALL")
def a5_grouped_counts(t):
    return t("documents").groupBy("lang", "source").agg(F.max("n_chars").alias("longest"), F.min("doc_id").alias("first_doc"), F.count("*").alias("n"), F.count_distinct("n_chars").alias("sizes"))


@query("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY coalesce(length(text), 0) DESC, doc_id) AS r FROM documents) WHERE r = 1")
def a9_longest_text(t):
    return t("documents").groupBy("source").agg(F.min_by("doc_id", F.struct(-F.coalesce(F.char_length("text"), F.lit(0)), "doc_id")).alias("doc_id"))


@query("SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS statuses, min(o_orderkey) AS representative FROM orders GROUP BY ALL")
def a11_sorted_sets(t):
    return t("orders").groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("statuses"), F.min("o_orderkey").alias("representative"))


@query("SELECT l_suppkey, l_partkey, l_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS r FROM lineitem) WHERE r = 1")
def a12_best_pair(t):
    return ranking.best_row(t("lineitem"), ["l_suppkey", "l_partkey"], F.desc("l_extendedprice"), "l_orderkey", "l_linenumber").select("l_suppkey", "l_partkey", "l_orderkey")


@query("SELECT doc_id, score FROM (SELECT doc_id, CASE WHEN contains(lower(text), 'license') THEN 2.0 ELSE 0 END + CASE WHEN contains(lower(text), 'the') THEN 1.0 ELSE 0 END + CASE WHEN contains(lower(text), 'ung') THEN 0.5 ELSE 0 END AS score FROM documents) WHERE score > 0")
def a21_keyword_score(t):
    return ranking.keyword_score(t("documents"), {"License": 2, "the": 1, "ung": 0.5}, "doc_id", "text")


@query("SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean, count(*) FILTER (value > 50) AS high, max(ts) AS latest FROM events GROUP BY event_type")
def a33_system_counts(t):
    return t("events").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.count_if(F.col("value") > 50).alias("high"), F.max("ts").alias("latest"))


@query("SELECT event_type AS kind, CAST(json_extract(props, '$.k') AS BIGINT) % 5 AS message, count(*) AS n, array_to_string(list_sort(list(event_id))[1:3], ',') AS sample_ids FROM events GROUP BY ALL ORDER BY n DESC, kind, message LIMIT 10")
def a22_error_summary(t):
    e = t("events").select(F.col("event_type").alias("kind"), (F.get_json_object("props", "$.k").cast("bigint") % 5).alias("message"), "event_id")
    return ranking.error_summary(e, "kind", "message", "event_id").withColumn("sample_ids", F.array_join(F.transform("sample_ids", lambda x: x.cast("string")), ","))


METRIC = "m AS (SELECT l_returnflag = 'R' AS g, l_discount * 10 AS s FROM lineitem)"


@query(f"""WITH {METRIC}, c AS (SELECT count(*) FILTER (g AND s >= 0.5) AS tp, count(*) FILTER (NOT g AND s >= 0.5) AS fp, count(*) FILTER (g AND NOT s >= 0.5) AS fn, count(*) FILTER (NOT g AND NOT s >= 0.5) AS tn FROM m)
 SELECT *, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""")
def a30_binary_metrics(t):
    m = t("lineitem").select((F.col("l_returnflag") == "R").alias("g"), (F.col("l_discount") * 10).alias("s"))
    r = ranking.binary_metrics(m, "g", F.col("s") >= 0.5)
    return r.select("tp", "fp", "fn", "tn", *(F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1")))


@query(f"""WITH {METRIC}, c AS (SELECT threshold, count(*) FILTER (g AND s >= threshold) AS tp, count(*) FILTER (NOT g AND s >= threshold) AS fp, count(*) FILTER (g AND NOT s >= threshold) AS fn FROM m, (SELECT unnest([0.25, 0.35, 0.45, 0.55])::DOUBLE AS threshold) GROUP BY threshold)
 SELECT threshold, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""")
def a31_threshold_grid(t):
    m = t("lineitem").select((F.col("l_returnflag") == "R").alias("g"), (F.col("l_discount") * 10).alias("s"))
    return ranking.threshold_grid(m, "g", "s", [0.25, 0.35, 0.45, 0.55]).select("threshold", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")))


@query("SELECT l_returnflag AS gold, count(*) FILTER (l_linestatus = 'O') AS O, count(*) FILTER (l_linestatus = 'F') AS F FROM lineitem GROUP BY 1")
def a32_confusion_matrix(t):
    return t("lineitem").groupBy(F.col("l_returnflag").alias("gold")).pivot("l_linestatus", ["O", "F"]).count().fillna(0)


@query("SELECT event_type, d, sum(n) OVER (PARTITION BY event_type ORDER BY d) AS total FROM (SELECT event_type, strftime(ts, '%Y-%m-%d') AS d, count(*) AS n FROM events GROUP BY ALL)")
def a28_cumulative_counts(t):
    n = t("events").groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("d")).agg(F.count("*").alias("n"))
    return n.select("event_type", "d", F.sum("n").over(ranking.Window.partitionBy("event_type").orderBy("d")).alias("total"))


@query("SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (PARTITION BY trim(o_orderpriority), o_custkey ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def w1_latest_per_title(t):
    o = t("orders").withColumn("title", F.concat(F.trim("o_orderpriority"), F.col("o_custkey").cast("string")))
    return ranking.latest(o, "title", F.desc("o_orderdate"), F.desc("o_totalprice"), F.desc("o_orderkey")).select("o_orderkey", "o_custkey")


@query("SELECT l_suppkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS r FROM lineitem) WHERE r <= 5")
def w2_top_k_per_key(t):
    return similarity.top_per(t("lineitem"), ["l_suppkey"], [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")], 5).select("l_suppkey", "l_orderkey", "l_linenumber")


@query("SELECT o_orderkey, CAST(floor((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) / 4) AS INTEGER) AS batch FROM orders")
def w14_sequential_batches(t):
    return ranking.batches(t("orders"), ["o_custkey"], ["o_orderkey"], 4).select("o_orderkey", "batch")


@query("SELECT o_orderkey, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'dev' ELSE 'test' END AS split FROM (SELECT o_orderkey, CAST('0x' || substr(sha256('42:' || o_custkey), 1, 8) AS BIGINT) / 4294967296.0 AS u FROM orders)")
def w15_group_split(t):
    return ranking.group_split(t("orders"), "o_custkey").select("o_orderkey", "split")


@query("""WITH e AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) > 3600000000 OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 i AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM e) SELECT user_id, CAST(island AS BIGINT) AS island, count(*) AS n, min(event_id) AS first_id FROM i GROUP BY ALL""")
def w6_gaps_and_islands(t):
    w = ranking.Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = t("events").withColumn("s", F.when(F.lag("ts").over(w).isNull() | (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(w).cast("timestamp")) > 3_600_000_000), 1).otherwise(0))
    return e.withColumn("island", F.sum("s").over(w)).groupBy("user_id", "island").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query("""SELECT e.event_id, (SELECT max_by(a.event_id, (a.ts, a.event_id)) FROM events a WHERE a.event_type = 'signup' AND a.user_id = e.user_id AND (a.ts, a.event_id) <= (e.ts, e.event_id)) AS anchor FROM events e""")
def j11_nearest_preceding_anchor(t):
    w = ranking.Window.partitionBy("user_id").orderBy("ts", "event_id")
    return t("events").select("event_id", F.last(F.when(F.col("event_type") == "signup", F.col("event_id")), True).over(w).alias("anchor"))


@query("SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'a') ORDER BY CASE WHEN p_size < 10 THEN 0 WHEN p_size < 30 THEN 1 ELSE 2 END, length(p_name), p_partkey LIMIT 40 OFFSET 20")
def l4_search_page(t):
    return t("part").filter(F.lower("p_name").contains("a")).orderBy(F.expr("CASE WHEN p_size < 10 THEN 0 WHEN p_size < 30 THEN 1 ELSE 2 END"), F.char_length("p_name"), "p_partkey").offset(20).limit(40).select("p_partkey", "p_name")


# --- scalar functions -----------------------------------------------------------------------------------------------

def _numeral_sql(n: str) -> str:
    """SQL that writes a numeral from its decimal digits, another way than the library: zeros kept, then collapsed."""
    digit = lambda v, k: f"CAST(({v} // {10**k}) % 10 AS INTEGER)"
    letter = lambda v, k, unit: f"CASE WHEN {digit(v, k)} = 0 THEN '零' ELSE substr('零一二三四五六七八九', {digit(v, k)} + 1, 1) || '{unit}' END"
    low = lambda v: "regexp_replace(rtrim(ltrim(regexp_replace(" + " || ".join(letter(v, k, u) for k, u in ((3, "千"), (2, "百"), (1, "十"), (0, ""))) + ", '零+', '零', 'g'), '零'), '零'), '^一十', '十')"
    return f"CASE WHEN {n} >= 10000 THEN {low(f'({n} // 10000)')} || '万' || CASE WHEN {n} % 10000 BETWEEN 1 AND 999 THEN '零' ELSE '' END ELSE '' END || {low(f'({n} % 10000)')}"


@query(f"SELECT p_partkey, n, {_numeral_sql('n')} AS numeral, n AS back FROM (SELECT p_partkey, CAST((p_partkey * 4987) % 99999999 + 1 AS BIGINT) AS n FROM part)")
def f1_numeral_round_trip(t):
    n = t("part").select("p_partkey", F.expr("cast(pmod(p_partkey * 4987L, 99999999L) + 1 AS bigint)").alias("n")).withColumn("numeral", numerals.to_chinese("n"))
    return n.select("p_partkey", "n", "numeral", numerals.from_chinese("numeral").alias("back"))


@query("SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9_]+', '-', 'g'), '-') AS slug FROM part")
def f12_slug(t):
    return t("part").select("p_partkey", text.slug(F.col("p_name")).alias("slug"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders")
def f27_iso_dates(t):
    d = F.concat(F.year("o_orderdate"), F.lit("年"), F.month("o_orderdate"), F.lit("月"), F.dayofmonth("o_orderdate"), F.lit("日"))
    return t("orders").select("o_orderkey", text.iso_date(d).alias("d"))


@query("SELECT page_id, length(regexp_replace(html, '<[^>]+>', '', 'g')) AS n FROM pages")
def f43_strip_html(t):
    return t("pages").select("page_id", F.char_length(text.strip_html(F.col("html"))).cast("bigint").alias("n"))


@query("SELECT doc_id, sha256(text) AS sha FROM documents")
def f13_text_hash(t):
    return t("documents").select("doc_id", F.sha2("text", 256).alias("sha"))


@query("""SELECT doc_id, CASE WHEN length(text) < 7 THEN text ELSE substr(text, 1, 3) || '[T]' || substr(text, 4, 4) || '[/T]' || substr(text, 8) END AS marked FROM documents""")
def f22_marked_targets(t):
    """Texts under 7 letters have no such span and stay as they are."""
    return t("documents").select("doc_id", statute.marked("text", "3", "7").alias("marked"))


@query("""SELECT doc_id, coalesce(trim(regexp_extract(text, '(?s)\\[T\\](.+?)\\[/T\\]', 1), ' ' || chr(9) || chr(10) || chr(13)), '') AS target, len(string_split(text, '[T]')) = 2 AND len(string_split(text, '[/T]')) = 2 AS one_mark
 FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN '[T]' || text || '[/T]' ELSE 'a[T] b ' || chr(10) || '[/T]' || text END AS text FROM documents)""")
def f22_extracted_targets(t):
    made = F.expr("CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN concat('[T]', text, '[/T]') ELSE concat('a[T] b \\n[/T]', text) END")
    return t("documents").select("doc_id", made.alias("text")).select("doc_id", statute.marked_target(F.col("text")).alias("target"), statute.has_one_mark(F.col("text")).alias("one_mark"))


@query("SELECT p_partkey, '第' || (p_partkey + 1) || '条' AS label FROM part")
def f19_tail_label(t):
    n = F.col("p_partkey")
    return t("part").select("p_partkey", statute.tail_label(F.concat(F.lit("第"), n, F.lit("条和第"), n + 1, F.lit("条第二款")), "条").alias("label"))


@query("SELECT p_partkey, '丙' || p_partkey AS alias, '《乙' || p_partkey || '》' AS title FROM part")
def f18_aliases(t):
    n = F.col("p_partkey")
    body = F.concat(F.lit("《甲》（以下简称丙"), n, F.lit("）。《乙"), n, F.lit("》（以下简称丙"), n, F.lit("）"))
    return spread(t("part").select("p_partkey"), "p_partkey").select("p_partkey", F.explode(statute.aliases(body)).alias("x")).select("p_partkey", "x.alias", "x.title")


@query("SELECT p_partkey, p_name || chr(10) || p_size AS body FROM part")
def f56_embedding_text(t):
    return t("part").select("p_partkey", statute.embedding_text(F.col("p_name"), F.col("p_size").cast("string")).alias("body"))


def _cases(t, *texts):
    """Every part with one of the texts, chosen by its size; the SQL below lists the labels these texts must get."""
    return t("part").select("p_partkey", F.element_at(F.array(*(F.lit(x) for x in texts)), F.col("p_size") % len(texts) + 1).alias("x"))


def _labels_sql(*want, name="label"):
    return f"SELECT p_partkey, {list(want)}[p_size % {len(want)} + 1] AS {name} FROM part"


@query(_labels_sql("repealed", "amended", "effective", "repealed", "amended"))
def f29_status(t):
    rows = _cases(t, "0|甲", "修订|甲", "有效|甲予以废止", "|甲同时废止。", "?|甲修正").select("p_partkey", F.split("x", r"\|").alias("x"))
    return rows.select("p_partkey", labels.status(F.col("x")[0], F.col("x")[1]).alias("label"))


@query(_labels_sql("reply", "request", "shell", "substantive"))
def f31_document_role(t):
    return _cases(t, "关于甲的批 复通知", "甲的请示", "印发甲规定", "甲条例").select("p_partkey", labels.document_role(F.col("x")).alias("label"))


@query(_labels_sql("revision", "amendment", "adoption", "other"))
def f32_revision_event(t):
    return _cases(t, "通过修订", "修正案公布", "甲施行", "甲").select("p_partkey", labels.revision_event(F.col("x")).alias("label"))


@query("SELECT event_id, event_type IN ('click', 'view') AS yes, CASE WHEN event_type = 'click' THEN event_id END AS id FROM events")
def f41_f42_answers(t):
    answer = F.expr("CASE event_type WHEN 'click' THEN ' YES ' WHEN 'view' THEN '1' ELSE 'no' END")
    number = F.when(F.col("event_type") == "click", F.concat(F.lit(" "), "event_id", F.lit("\n"))).otherwise(F.concat("event_id", F.lit(".5")))
    return t("events").select("event_id", labels.is_yes(answer).alias("yes"), labels.prompt_id(number).alias("id"))


@query(_labels_sql(0.12, 0.82, 0.18, name="score"))
def m4_heuristic_prediction(t):
    return _cases(t, "依照本法所称甲", "甲是指乙", "甲").select("p_partkey", labels.heuristic_prediction(F.col("x"))["score"].alias("score"))


@query("SELECT p_partkey, p_name || ',类' || p_size AS words FROM part")
def f46_keyword_filter(t):
    size = F.concat(F.lit(" 类"), F.col("p_size"))
    both = F.split("p_name", " ")
    found = labels.keyword_filter(F.concat(F.array(F.lit("依法"), F.lit("x")), both, F.array(F.lit(" "), F.lit("eleven long")), both, F.array(size)))
    return t("part").select("p_partkey", F.concat(F.array_join(F.slice(found, 1, 2), " "), F.lit(","), F.array_join(F.slice(found, 3, 9), " ")).alias("words"))


@query("SELECT p_partkey, round(p_retailprice * CASE WHEN contains(p_name, 'widget') THEN 0.7 ELSE 1 END, 6) AS score FROM part")
def f47_cited_penalty(t):
    return t("part").select("p_partkey", F.round(labels.cited_penalty(F.col("p_retailprice"), F.col("p_name"), F.array(F.lit(""), F.lit("widget"))), 6).alias("score"))


@query("""SELECT p_partkey, CASE WHEN p_size < 10 THEN '["a","b"]' WHEN p_size < 20 THEN '["a"]' ELSE '["b"]' END AS ids FROM part""")
def f49_append_id(t):
    ids = F.expr("""CASE WHEN p_size < 10 THEN '["a","b"]' WHEN p_size < 20 THEN '[]' WHEN p_size < 30 THEN 'broken' END""")
    return t("part").select("p_partkey", labels.append_id(ids, F.when(F.col("p_size") < 20, "a").otherwise("b")).alias("ids"))


@query(f"""WITH RECURSIVE {N_SQL}, {E_SQL}, {UP_SQL}, steps AS (SELECT node, ancestor, depth FROM up UNION SELECT source, source, 0 FROM edges UNION SELECT target, target, 0 FROM edges)
 SELECT node, string_agg(CASE level WHEN 'document' THEN '《' || name || '》' ELSE name END, ' > ' ORDER BY depth DESC) AS path FROM steps JOIN nodes ON id = ancestor WHERE level IN ('document', 'chapter') GROUP BY node""")
def f52_breadcrumb(t):
    return graph.breadcrumb(edges(t), nodes(t), ["part", "chapter", "section"])


@query("SELECT p_partkey, '（' || ['一', '十', '二十三'][p_size % 3 + 1] || '）' AS item FROM part")
def f53_item_marker(t):
    n = t("part").select("p_partkey", F.element_at(F.array(F.lit(1), F.lit(10), F.lit(23)), F.col("p_size") % 3 + 1).cast("bigint").alias("n"))
    return n.select("p_partkey", F.concat(F.lit("（"), numerals.to_chinese("n"), F.lit("）")).alias("item"))


@query("SELECT p_partkey, replace(p_name, ' ', '_') || '_法 律' AS title, '法律' AS start FROM part")
def f57_file_titles(t):
    named = t("part").select("p_partkey", F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("/")), F.lit(":法  律. ")).alias("raw"), F.lit("法律 .文").alias("long"))
    return named.select("p_partkey", labels.file_title(F.col("raw")).alias("title"), labels.first_bytes("long", 9).alias("start"))


@query()
def f20_sentences(t):
    """Every sentence of every whole text; nested quotes are beyond SQL, so tests hold it against cases by hand."""
    return t("documents").select("doc_id", F.posexplode(statute.sentences("text")).alias("place", "sentence"))


# --- sources and sinks ----------------------------------------------------------------------------------------------

@query("SELECT c_custkey, CAST(floor((row_number() OVER (ORDER BY c_custkey) - 1) / 100) AS INTEGER) AS shard FROM customer")
def s23_sharded_sink(t):
    return store.shard(t("customer"), "c_custkey", 100).select("c_custkey", "shard")


@query("SELECT CAST(c_custkey AS VARCHAR) AS source_id FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey NOT IN (1, 2)")
def s6_scope_filter(t):
    m = t("customer").select(F.col("c_custkey").cast("string").alias("source_id"), F.col("c_mktsegment").alias("category"), F.col("c_nationkey").cast("string").alias("status"))
    return store.in_scope(m, category=["BUILDING", "MACHINERY"], status_except=["1", "2"])


from lexweave.plans import graph_queries, provision_queries  # noqa: E402,F401  (they register their queries here)
