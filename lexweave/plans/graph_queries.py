"""Registered queries of sets, counts, concepts, search and rules on the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexweave.functions import category, locator, numerals, text
from lexweave.operators import concepts, counts, graph, ranking, search, sets
from lexweave.plans.registry import E_SQL, N_SQL, SELF_SQL, UP_SQL, _cases, _labels_sql, _numeral_sql, edges, nodes, query

GRAPH = f"{N_SQL}, {E_SQL}, {UP_SQL}, {SELF_SQL}"
LAW = "law AS (SELECT s.node AS id, s.ancestor AS law_id, d.name AS law_name FROM self s JOIN nodes d ON d.id = s.ancestor AND d.level = 'document')"

# --- validation -----------------------------------------------------------------------------------------------------


@query("""WITH n AS (SELECT 'c' || c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN 'DocumentNode' WHEN 1 THEN 'TocNode' WHEN 2 THEN 'ProvisionNode' ELSE 'Other' END AS type,
 CASE c_nationkey % 3 WHEN 0 THEN 'document' WHEN 1 THEN 'chapter' ELSE 'article' END AS level, CASE WHEN c_nationkey % 5 = 0 THEN 'x' END AS text, CASE WHEN c_nationkey % 7 = 0 THEN 'law' ELSE '' END AS category FROM customer)
 SELECT id, 'unknown_type' AS reason FROM n WHERE type = 'Other' UNION ALL SELECT id, 'wrong_level' FROM n WHERE type <> 'Other' AND (type, level) NOT IN (('DocumentNode', 'document'), ('TocNode', 'chapter'), ('ProvisionNode', 'article'))
 UNION ALL SELECT id, 'foreign_field' FROM n WHERE type <> 'Other' AND ((text <> '' AND type <> 'ProvisionNode') OR (category <> '' AND type <> 'DocumentNode'))""")
def v2_node_validation(t):
    return graph.invalid_nodes(t("customer").selectExpr(
        "concat('c', c_custkey) AS id", "CASE c_custkey % 4 WHEN 0 THEN 'DocumentNode' WHEN 1 THEN 'TocNode' WHEN 2 THEN 'ProvisionNode' ELSE 'Other' END AS type",
        "CASE c_nationkey % 3 WHEN 0 THEN 'document' WHEN 1 THEN 'chapter' ELSE 'article' END AS level", "if(c_nationkey % 5 = 0, 'x', null) AS text", "if(c_nationkey % 7 = 0, 'law', '') AS category"))


@query(f"""WITH {N_SQL}, {E_SQL}, e AS (SELECT * FROM edges UNION ALL SELECT 'o:' || o_orderkey, 'r:' || (o_custkey % 7), 'REFERENCES' FROM orders UNION ALL SELECT 'c:' || c_custkey, 'c:' || c_nationkey, 'INTERPRETS' FROM customer)
 SELECT source, target, type, reason FROM (SELECT e.source, e.target, e.type, CASE WHEN s.id IS NULL THEN 'no_source' WHEN t.id IS NULL THEN 'no_target'
 WHEN NOT (e.type = 'CONTAINS' OR (e.type = 'REFERENCES' AND s.type = 'ProvisionNode' AND t.level = 'document')) THEN 'not_allowed' END AS reason FROM e LEFT JOIN nodes s ON s.id = source LEFT JOIN nodes t ON t.id = target) WHERE reason IS NOT NULL""")
def v4_wildcard_rules(t):
    more = t("orders").selectExpr("concat('o:', o_orderkey) AS source", "concat('r:', o_custkey % 7) AS target", "'REFERENCES' AS type").unionByName(t("customer").selectExpr("concat('c:', c_custkey) AS source", "concat('c:', c_nationkey) AS target", "'INTERPRETS' AS type"))
    return graph.invalid_edges_by_rules(nodes(t), edges(t).unionByName(more), [("CONTAINS", "*", "*", "*", "*"), ("REFERENCES", "ProvisionNode", "*", "*", "document")])


@query(f"WITH {N_SQL}, {E_SQL} SELECT s.level AS parent_level, t.level AS child_level, CASE WHEN s.level = 'chapter' THEN 'CONTAINS' WHEN s.level = 'article' THEN 'HAS' END AS made, count(*) AS n FROM edges JOIN nodes s ON s.id = source JOIN nodes t ON t.id = target GROUP BY ALL")
def v5_structural_type(t):
    n, e = nodes(t), edges(t)
    met = e.join(n.select(F.col("id").alias("source"), F.col("level").alias("parent_level")), "source").join(n.select(F.col("id").alias("target"), F.col("level").alias("child_level")), "target")
    made = graph.structural_type(F.col("parent_level"), F.col("child_level"), [("chapter", "article", "CONTAINS"), ("article", "paragraph", "HAS")])
    return met.groupBy("parent_level", "child_level", made.alias("made")).agg(F.count("*").alias("n"))


@query("SELECT p_partkey AS id FROM part WHERE p_partkey NOT IN (SELECT vec_id FROM embeddings WHERE label % 3 <> 0)")
def v7_missing_vectors(t):
    return graph.missing_vectors(t("part").select(F.col("p_partkey").alias("id")), t("embeddings").select(F.col("vec_id").alias("id"), F.expr("if(label % 3 = 0, array(), embedding)").alias("vector")))


# --- sets -----------------------------------------------------------------------------------------------------------

@query("""SELECT o_orderkey AS source_id, CASE WHEN o_orderstatus = 'O' THEN 'new' ELSE 'old' END AS document FROM orders WHERE NOT (o_orderpriority = '1-URGENT' AND o_orderstatus <> 'O')""")
def u2_merge_index(t):
    part = lambda df, v: df.select(F.col("o_orderkey").alias("source_id"), F.lit(v).alias("document"))
    return sets.merge_index(part(t("orders"), "old"), part(t("orders").filter("o_orderstatus = 'O'"), "new"), part(t("orders").filter("o_orderpriority = '1-URGENT'"), "x"))


@query("SELECT o_orderkey AS id, o_orderkey * 2 AS place FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 12)")
def u5_ordered_subtract(t):
    left = t("orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") * 2).alias("place"), "o_custkey")
    right = t("customer").filter("c_nationkey < 12").select(F.col("c_custkey").alias("o_custkey"))
    return sets.ordered_subtract(left, right, "o_custkey").drop("o_custkey")


@query("SELECT trim(p_brand) AS unit, min(p_partkey) AS place FROM part WHERE trim(p_brand) <> '' GROUP BY 1")
def u6_ordered_distinct(t):
    return sets.ordered_distinct(t("part").select(F.concat(F.lit(" "), "p_brand").alias("unit"), F.col("p_partkey").alias("place")), "unit", "place")


@query("SELECT l_suppkey, l_partkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_orderkey * 8 + l_linenumber) AS r FROM lineitem) WHERE r = 1")
def u8_first_of_each(t):
    return sets.first_rows(t("lineitem").select("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("place")), ["l_suppkey", "l_partkey"], "place").drop("place")


@query("""WITH d AS (SELECT DISTINCT o_custkey AS k FROM orders), m AS (SELECT c_custkey AS k FROM customer WHERE c_nationkey <> 3), l AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0)
 SELECT (SELECT count(*) FROM d) AS documents, (SELECT count(*) FROM m) AS metadata, (SELECT count(*) FROM l) AS loaded, (SELECT count(*) FROM d WHERE k NOT IN (SELECT k FROM m)) AS without_metadata, (SELECT count(*) FROM d WHERE k NOT IN (SELECT k FROM l)) AS not_loaded""")
def u9_completeness(t):
    c = t("customer").withColumn("source_id", F.col("c_custkey"))
    return sets.completeness(t("orders").select(F.col("o_custkey").alias("source_id")), c.filter("c_nationkey <> 3"), c.filter("c_acctbal > 0"))


REL = "CASE l_linenumber % 3 WHEN 0 THEN 'related' WHEN 1 THEN 'is_subordinate' ELSE 'none' END"


@query(f"""WITH r AS (SELECT 's' || l_suppkey AS l, 'p' || l_partkey AS r, {REL} AS rel FROM lineitem), e AS (SELECT 'c' || c_custkey AS source, 'n' || c_nationkey AS target, 'CONTAINS' AS type FROM customer)
 SELECT DISTINCT sha256(source || chr(9) || target || chr(9) || type) AS id, source, target, type FROM (SELECT * FROM e UNION ALL SELECT least(l, r), greatest(l, r), 'RELATED_TO' FROM r WHERE rel = 'related' UNION ALL SELECT r, l, 'HAS_SUBORDINATE' FROM r WHERE rel = 'is_subordinate')""")
def u10_concept_edges(t):
    r = t("lineitem").selectExpr("concat('s', l_suppkey) AS left_id", "concat('p', l_partkey) AS right_id", f"{REL} AS relation")
    e = t("customer").selectExpr("concat('c', c_custkey) AS source", "concat('n', c_nationkey) AS target", "if(c_custkey % 2 = 0, 'CONTAINS', 'CONTAINS') AS type")
    old = t("customer").selectExpr("concat('x', c_custkey) AS source", "'y' AS target", "'RELATED_TO' AS type")
    return sets.replace_concept_edges(e.unionByName(old), r)


@query("""SELECT DISTINCT sha256(source || chr(9) || target || chr(9) || type) AS id, source, target, type FROM (SELECT 'o' || o_custkey AS source, 'k' || (o_orderkey % 40) AS target, 'MENTIONS' AS type FROM orders WHERE o_orderkey % 11 <> 0)""")
def u11_mentions(t):
    roots = t("orders").selectExpr("concat('o', o_custkey) AS root", "if(o_orderkey % 11 = 0, null, concat('k', o_orderkey % 40)) AS cluster")
    return sets.mentions(t("region").selectExpr("'a' AS source", "r_name AS target", "'MENTIONS' AS type"), roots)


@query("""WITH x AS (SELECT 'o' || l_orderkey AS source, 'p' || l_partkey AS target, CASE l_orderkey % 3 WHEN 0 THEN 'REFERENCES' WHEN 1 THEN 'INTERPRETS' ELSE 'none' END AS type FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey WHERE o_orderstatus = 'F' AND p_size > 20)
 SELECT DISTINCT sha256(source || chr(9) || target || chr(9) || type) AS id, source, target, type FROM x WHERE type <> 'none'""")
def u12_reference_edges(t):
    found = t("lineitem").groupBy("l_orderkey").agg(F.collect_set(F.concat(F.lit("p"), "l_partkey")).alias("target_node_ids")).selectExpr("concat('o', l_orderkey) AS source_node_id", "target_node_ids", "CASE l_orderkey % 3 WHEN 0 THEN 'REFERENCES' WHEN 1 THEN 'INTERPRETS' ELSE 'none' END AS label")
    n = t("orders").filter("o_orderstatus = 'F'").selectExpr("concat('o', o_orderkey) AS id").unionByName(t("part").filter("p_size > 20").selectExpr("concat('p', p_partkey) AS id"))
    return sets.reference_edges(t("region").selectExpr("'a' AS source", "r_name AS target", "'REFERENCES' AS type"), n, found)


@query("""WITH bad AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40))
 SELECT DISTINCT l_orderkey AS id FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P' AND l_orderkey NOT IN (SELECT k FROM bad)""")
def j13_whole_candidates(t):
    c = t("lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_set(F.concat(F.lit("p"), "l_partkey")).alias("target_node_ids")).withColumn("source_node_id", F.concat(F.lit("o"), "id"))
    n = t("orders").filter("o_orderstatus <> 'P'").selectExpr("concat('o', o_orderkey) AS id").unionByName(t("part").filter("p_size <= 40").selectExpr("concat('p', p_partkey) AS id"))
    return graph.whole_target_candidates(c, n).select("id")


# --- counts ---------------------------------------------------------------------------------------------------------

@query(f"WITH {N_SQL}, {E_SQL} SELECT 'node' AS kind, type, count(*) AS n FROM nodes GROUP BY type UNION ALL SELECT 'edge', type, count(*) FROM edges GROUP BY type")
def a1_type_counts(t):
    return counts.type_counts(nodes(t), edges(t))


@query("""WITH x AS (SELECT l_orderkey, CASE l_orderkey % 2 WHEN 0 THEN 'REFERENCES' ELSE 'INTERPRETS' END AS label, l_returnflag AS category FROM lineitem) SELECT label, category, count(DISTINCT l_orderkey) AS n, count(*) AS weight FROM x GROUP BY ALL""")
def a4_weighted_counts(t):
    r = t("lineitem").groupBy("l_orderkey").agg(F.collect_list("l_returnflag").alias("target_categories")).withColumn("label", F.expr("if(l_orderkey % 2 = 0, 'REFERENCES', 'INTERPRETS')"))
    return counts.weighted_counts(r)


JUDGED = "CASE event_type WHEN 'purchase' THEN 'related' WHEN 'click' THEN 'is_subordinate' WHEN 'signup' THEN 'none' ELSE '' END"


@query(f"""WITH x AS (SELECT {JUDGED} AS r, CAST(event_id % 11 AS INTEGER) AS s FROM events) SELECT count(*) AS pairs, count(*) FILTER (r <> '') AS judged, count(*) FILTER (r NOT IN ('', 'none') AND s >= 7) AS accepted,
 count(*) FILTER (r = 'related') AS related, count(*) FILTER (r = 'is_subordinate') AS is_subordinate, count(*) FILTER (r = 'has_subordinate') AS has_subordinate, count(*) FILTER (r = 'none') AS "none" FROM x""")
def a3_judge_counts(t):
    return counts.judge_counts(t("events").selectExpr(f"{JUDGED} AS relation", "cast(event_id % 11 AS int) AS strength"))


@query("""SELECT count(*) FILTER (p_size > 45) AS added, count(*) FILTER (p_size < 5) AS removed, count(*) FILTER (p_size BETWEEN 5 AND 45 AND p_partkey % 4 = 0) AS changed, count(*) FILTER (p_size BETWEEN 5 AND 45 AND p_partkey % 4 <> 0) AS unchanged FROM part""")
def a24_graph_diff(t):
    old = t("part").filter("p_size <= 45").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.lit(None).cast("string").alias("text"))
    new = t("part").filter("p_size >= 5").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.expr("if(p_partkey % 4 = 0, 'x', null)").alias("text"))
    return counts.graph_diff(old, new)


@query("SELECT l_orderkey AS source_id FROM lineitem GROUP BY 1 HAVING bool_and(l_linestatus = 'F' AND l_returnflag <> 'R')")
def a25_completed_sources(t):
    return counts.completed_sources(t("lineitem").select(F.col("l_orderkey").alias("source_id"), (F.col("l_linestatus") == "F").alias("done"), (F.col("l_returnflag") == "R").alias("failed")))


@query("SELECT l_returnflag AS hint, count(*) FILTER (l_returnflag = l_instr) AS matched, count(*) AS total, round(greatest(count(*) FILTER (l_returnflag = l_instr) / count(*), 0.3), 6) AS precision FROM (SELECT l_returnflag, CASE WHEN l_quantity > 30 THEN l_returnflag ELSE 'x' END AS l_instr FROM lineitem) GROUP BY 1")
def a29_hint_precision(t):
    return counts.hint_precision(t("lineitem").selectExpr("l_returnflag AS hint", "if(l_quantity > 30, l_returnflag, 'x') AS label"), 0.3).withColumn("precision", F.round("precision", 6))


@query("SELECT l_returnflag AS gold, count(*) FILTER (l_linestatus = 'O') AS O, count(*) FILTER (l_linestatus = 'F') AS F, (SELECT round(count(*) FILTER (l_returnflag = l_linestatus) / count(*), 6) FROM lineitem) AS accuracy FROM lineitem GROUP BY 1")
def a32_confusion(t):
    return counts.confusion(t("lineitem"), "l_returnflag", "l_linestatus", ["O", "F"]).withColumn("accuracy", F.round("accuracy", 6))


@query("""WITH b AS (SELECT DISTINCT o_orderdate AS batch FROM orders), n AS (SELECT o_orderdate AS batch, o_orderstatus AS label, count(*) AS n FROM orders GROUP BY ALL), f AS (SELECT batch, label, target, coalesce(n, 0) AS n FROM b CROSS JOIN (VALUES ('O', 60), ('F', 900), ('Z', 5)) t(label, target) LEFT JOIN n USING (batch, label))
 SELECT strftime(batch, '%Y-%m-%d') AS batch, label, n, CAST(sum(n) OVER w AS BIGINT) AS total, CAST(greatest(target - sum(n) OVER w, 0) AS BIGINT) AS deficit FROM f WINDOW w AS (PARTITION BY label ORDER BY batch)""")
def a28_deficits(t):
    return counts.deficits(t("orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("batch"), F.col("o_orderstatus").alias("label")), {"O": 60, "F": 900, "Z": 5})


@query("""SELECT p_partkey AS sample_id, CASE p_size % 5 WHEN 0 THEN 'empty_text,not_one_mark' WHEN 1 THEN 'not_one_mark' WHEN 2 THEN 'empty_target' ELSE '' END || CASE WHEN p_size % 3 = 0 THEN CASE WHEN p_size % 5 < 3 THEN ',' ELSE '' END || 'no_label' ELSE '' END AS issues
 FROM part WHERE p_size % 5 < 3 OR p_size % 3 = 0""")
def a27_audit(t):
    rows = t("part").selectExpr("p_partkey AS sample_id", "CASE p_size % 5 WHEN 0 THEN ' ' WHEN 1 THEN concat('[T]', p_name) WHEN 2 THEN 'a[T] [/T]' ELSE concat('x[T]', p_name, '[/T]') END AS text", "if(p_size % 3 = 0, null, true) AS label")
    return counts.audit_rows(rows).withColumn("issues", F.array_join("issues", ","))


# --- windows --------------------------------------------------------------------------------------------------------

@query("SELECT o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r > 1")
def w1_superseded(t):
    return ranking.superseded(t("orders").withColumn("title", F.concat(F.lit(" "), F.col("o_custkey").cast("string"))), "title", F.desc("o_orderdate"), F.desc("o_orderkey")).select("o_orderkey")


@query("""WITH g AS (SELECT o_custkey AS g, count(*) AS n, CAST('0x' || substr(sha256('42:' || o_custkey), 1, 8) AS BIGINT) AS u FROM orders GROUP BY 1), a AS (SELECT g, (sum(n) OVER (ORDER BY u, g) - n) / sum(n) OVER () AS pos FROM g)
 SELECT o_orderkey, CASE WHEN pos < 0.8 THEN 'train' WHEN pos < 0.9 THEN 'dev' ELSE 'test' END AS split FROM orders JOIN a ON g = o_custkey""")
def w15_fill_split(t):
    return ranking.fill_split(t("orders"), "o_custkey").select("o_orderkey", "split")


# --- concepts -------------------------------------------------------------------------------------------------------

SUB = "sub AS (SELECT DISTINCT c AS l, p AS r FROM (SELECT l_suppkey AS c, l_suppkey // 3 AS p FROM lineitem UNION ALL SELECT l_suppkey, (l_suppkey * 7) % 40 FROM lineitem) WHERE c <> p)"


@query(f"WITH RECURSIVE {SUB}, up AS (SELECT l AS node, r AS ancestor FROM sub UNION SELECT node, r FROM up JOIN sub ON l = ancestor) SELECT node, ancestor FROM up WHERE node <> ancestor")
def j26_concept_ancestors(t):
    s = t("lineitem").select("l_suppkey").distinct()
    rel = lambda p: s.select(F.col("l_suppkey").alias("left_id"), F.expr(p).alias("right_id"), F.lit("is_subordinate").alias("relation"))
    return concepts.concept_ancestors(rel("l_suppkey div 3").unionByName(rel("l_suppkey * 7 % 40")))


@query(f"WITH RECURSIVE {GRAPH} SELECT DISTINCT 'k' || o_orderstatus || o_orderpriority AS concept, CASE level WHEN 'document' THEN 'document' ELSE 'structure' END AS kind, ancestor AS context FROM orders JOIN self ON node = 'o:' || o_orderkey JOIN nodes ON id = ancestor WHERE level IN ('document', 'chapter')")
def j28_contexts(t):
    roots = t("orders").select(F.concat(F.lit("k"), "o_orderstatus", "o_orderpriority").alias("concept"), F.concat(F.lit("o:"), "o_orderkey").alias("root"))
    return concepts.contexts(edges(t), nodes(t), roots)


@query("""WITH ctx AS (SELECT DISTINCT l_suppkey AS concept, l_orderkey % 97 AS context FROM lineitem WHERE l_quantity > 45), p AS (SELECT DISTINCT l_suppkey AS l, l_partkey % 60 AS r FROM lineitem)
 SELECT l AS "left", r AS "right" FROM p WHERE NOT EXISTS (SELECT 1 FROM ctx a JOIN ctx b USING (context) WHERE a.concept = l AND b.concept = r)""")
def j25_apart(t):
    ctx = t("lineitem").filter("l_quantity > 45").select(F.col("l_suppkey").alias("concept"), F.lit("structure").alias("kind"), (F.col("l_orderkey") % 97).alias("context")).distinct()
    return concepts.apart(t("lineitem").select(F.col("l_suppkey").alias("left"), (F.col("l_partkey") % 60).alias("right")).distinct(), ctx, "structure")


@query(f"""WITH RECURSIVE {GRAPH}, lifted AS (SELECT node, ancestor FROM self JOIN nodes ON id = ancestor WHERE level = 'chapter'), x AS (SELECT 'o:' || o_orderkey AS s, 'c:' || (o_orderkey % 150) AS t FROM orders)
 SELECT least(a.ancestor, b.ancestor) AS "left", greatest(a.ancestor, b.ancestor) AS "right", count(*) AS n FROM x JOIN lifted a ON a.node = s JOIN lifted b ON b.node = t WHERE a.ancestor <> b.ancestor GROUP BY ALL""")
def j29_bridges(t):
    more = t("orders").selectExpr("concat('o:', o_orderkey) AS source", "concat('c:', o_orderkey % 150) AS target", "'REFERENCES' AS type")
    return concepts.bridges(edges(t).unionByName(more), nodes(t), ("REFERENCES", "INTERPRETS"), "chapter")


PAIRS = "SELECT l_suppkey AS l, l_partkey % 80 AS r, l_discount AS semantic FROM lineitem"


@query(f"""WITH p AS (SELECT l, r, max(semantic) AS semantic FROM ({PAIRS}) WHERE l <> r GROUP BY l, r), f AS (SELECT s_suppkey AS low, s_nationkey AS high FROM supplier WHERE s_suppkey < s_nationkey),
 s AS (SELECT l, r, least(l, r) AS low, greatest(l, r) AS high, 0.6 * semantic * 10 + 0.3 * CASE WHEN f.low IS NULL THEN 0 ELSE 1 END AS score FROM p LEFT JOIN f ON f.low = least(l, r) AND f.high = greatest(l, r) WHERE (least(l, r) + greatest(l, r)) % 5 <> 0),
 k AS (SELECT *, row_number() OVER (PARTITION BY l ORDER BY round(score, 9) DESC, high, low) AS rk FROM s WHERE round(score, 9) >= 0.2) SELECT low AS left_id, high AS right_id, round(max(score), 6) AS score FROM k WHERE rk <= 4 GROUP BY ALL""")
def g16_recall_pass(t):
    p = t("lineitem").select(F.col("l_suppkey").alias("left"), (F.col("l_partkey") % 80).alias("right"), "l_discount").groupBy("left", "right").agg((F.max("l_discount") * 10).alias("semantic"))
    f = t("supplier").filter("s_suppkey < s_nationkey").select(F.col("s_suppkey").alias("low"), F.col("s_nationkey").alias("high"), F.lit(1.0).alias("aa")).distinct()
    known = p.filter("(left + right) % 5 = 0").select(F.col("right").alias("left_id"), F.col("left").alias("right_id"))
    return concepts.recall_pass(p, f, known, {"semantic": 0.6, "aa": 0.3}, 0.2, 4).withColumn("score", F.round("score", 6))


INFER = f"SELECT user_id AS left_id, event_id % 90 AS right_id, value AS score, {JUDGED} AS relation, event_id % 11 AS strength, event_id FROM events"


@query(f"SELECT left_id, right_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY left_id, right_id ORDER BY relation <> '' DESC, score DESC, event_id DESC) AS r FROM ({INFER})) WHERE r = 1")
def a13_best_pairs(t):
    p = t("events").selectExpr("user_id AS left_id", "event_id % 90 AS right_id", "struct(value, event_id) AS score", f"{JUDGED} AS relation", "event_id")
    return concepts.best_pairs(p).select("left_id", "right_id", "event_id")


@query(f"""WITH x AS (SELECT DISTINCT user_id AS l, event_id % 90 AS r, CASE event_type WHEN 'purchase' THEN 'related' WHEN 'click' THEN 'has_subordinate' WHEN 'view' THEN 'is_subordinate' ELSE 'none' END AS rel, CAST(event_id % 11 AS INTEGER) AS s FROM events)
 SELECT DISTINCT CASE WHEN rel = 'has_subordinate' OR (rel = 'related' AND l > r) THEN r ELSE l END AS left_id, CASE WHEN rel = 'has_subordinate' OR (rel = 'related' AND l > r) THEN l ELSE r END AS right_id, CASE rel WHEN 'has_subordinate' THEN 'is_subordinate' ELSE rel END AS relation FROM x WHERE rel <> 'none' AND s >= 7""")
def g18_directed(t):
    return concepts.directed(t("events").selectExpr("user_id AS left_id", "event_id % 90 AS right_id", "CASE event_type WHEN 'purchase' THEN 'related' WHEN 'click' THEN 'has_subordinate' WHEN 'view' THEN 'is_subordinate' ELSE 'none' END AS relation", "cast(event_id % 11 AS int) AS strength"))


@query("""WITH m AS (SELECT p_size AS cluster, p_partkey AS member, split_part(p_name, ' ', 1) AS name, p_type AS d FROM part), n AS (SELECT cluster, name, count(*) AS n FROM m GROUP BY ALL),
 c AS (SELECT cluster, name AS canonical FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, length(name), name) AS r FROM n) WHERE r = 1)
 SELECT m.cluster, any_value(canonical) AS name, (SELECT d FROM m x WHERE x.cluster = m.cluster AND x.name = any_value(canonical) ORDER BY length(d) DESC, member DESC LIMIT 1) AS description,
 min(member) FILTER (name = canonical) AS representative, count(DISTINCT member) AS members FROM m JOIN c USING (cluster) GROUP BY m.cluster""")
def j21_representatives(t):
    m = t("part").select(F.col("p_size").alias("cluster"), F.col("p_partkey").alias("member"), F.split("p_name", " ")[0].alias("name"), F.col("p_type").alias("description"))
    return concepts.representatives(m).select("cluster", "name", "description", "representative", F.size("member_ids").cast("bigint").alias("members"))


@query("""WITH m AS (SELECT p_size AS cluster, 'm' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS member, CASE WHEN p_partkey % 50 = 0 THEN 'concept:' || p_partkey END AS was FROM part)
 SELECT cluster, coalesce(min(was), 'concept:' || substr(sha256(string_agg(member, chr(10) ORDER BY member)), 1, 24)) AS id FROM m GROUP BY cluster""")
def g14_cluster_ids(t):
    m = t("part").select(F.col("p_size").alias("cluster"), F.concat(F.lit("m"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("member"), "p_partkey")
    return concepts.cluster_ids(m, m.filter("p_partkey % 50 = 0").select("member", F.concat(F.lit("concept:"), "p_partkey").alias("id")))


# --- search ---------------------------------------------------------------------------------------------------------

@query(f"""WITH RECURSIVE {GRAPH}, {LAW}, hit AS (SELECT * FROM nodes WHERE type = 'ProvisionNode' AND (contains(lower(name), '1-u') OR contains(lower(text), '1-u'))),
 page AS (SELECT id FROM hit ORDER BY CASE level WHEN 'article' THEN 1 WHEN 'paragraph' THEN 2 ELSE 5 END, length(coalesce(text, name, '')), id LIMIT 15 OFFSET 10) SELECT id, name, law_name, level FROM page JOIN nodes USING (id) LEFT JOIN law USING (id)""")
def q4_search_provisions(t):
    return search.search_provisions(nodes(t), edges(t), "1-U", 10, 15)


@query(f"WITH {N_SQL} SELECT count(*) AS total FROM nodes WHERE type = 'ProvisionNode' AND (contains(lower(name), 'build') OR contains(lower(text), 'build'))")
def a34_search_total(t):
    return search.count_provisions(nodes(t), "Build")


@query(f"""WITH RECURSIVE {GRAPH}, {LAW} SELECT n.id, law_name FROM nodes n JOIN law USING (id) JOIN region ON 'r:' || r_regionkey = law_id WHERE n.type = 'ProvisionNode' AND n.level = 'article' AND r_regionkey % 2 = 1 AND contains(lower(n.text), 'auto')""")
def p21_optional_filters(t):
    n = nodes(t).withColumn("category", F.expr("if(level = 'document', if(cast(substring(id, 3) AS int) % 2 = 1, 'law', null), null)")).withColumn("status", F.lit(None).cast("string"))
    return search.filter_laws(n, edges(t), word="AUTO", category="law", status=None).filter("level = 'article'").select("id", "law_name")


@query("SELECT 'r:' || r_regionkey AS id, r_name AS name FROM region WHERE contains(lower(r_name), 'a') ORDER BY r_name, id LIMIT 3")
def q1_search_laws(t):
    return search.search_laws(nodes(t), "A", 3)


@query(f"WITH RECURSIVE {GRAPH} SELECT s.node AS id, e.source AS parent, s.depth, n.level, n.name FROM self s JOIN nodes n ON n.id = s.node LEFT JOIN edges e ON e.target = s.node WHERE s.ancestor = 'r:1'")
def q1_outline(t):
    return search.outline(nodes(t), edges(t), "r:1")


@query("""SELECT asked, CASE WHEN asked LIKE 'r:%' THEN CASE WHEN CAST(substr(asked, 3) AS INTEGER) < 5 THEN asked END ELSE (SELECT 'r:' || r_regionkey FROM region WHERE r_name = asked) END AS id FROM (SELECT r_name AS asked FROM region UNION SELECT 'r:' || n_nationkey FROM nation UNION SELECT n_name FROM nation)""")
def j36_find_law(t):
    asked = t("region").select(F.col("r_name").alias("asked")).unionByName(t("nation").select(F.concat(F.lit("r:"), "n_nationkey").alias("asked"))).unionByName(t("nation").select(F.col("n_name").alias("asked"))).distinct()
    return search.find_law(nodes(t), asked)


@query("""SELECT law, article, CASE WHEN n % 2 = 1 THEN 'article:' || r || ':' || n END AS id FROM (SELECT p_partkey % 5 AS r, '《law' || (p_partkey % 5) || '》' AS law, (p_partkey % 37 + 1) AS n, CASE p_partkey % 3 WHEN 0 THEN '' || (p_partkey % 37 + 1) WHEN 1 THEN '第' || (p_partkey % 37 + 1) || '条' ELSE ' ' || (p_partkey % 37 + 1) || ' 条' END AS article FROM part)""")
def j37_find_article(t):
    spark = t("part").sparkSession
    laws = spark.range(5).selectExpr("concat('document:', id) AS id", "'DocumentNode' AS type", "'document' AS level", "concat('Law', id) AS name", "cast(null AS string) AS text", "id AS r")
    articles = spark.range(5).selectExpr("id AS r", "explode(sequence(1, 37, 2)) AS n").select(F.expr("concat('article:', r, ':', n)").alias("id"), F.lit("ProvisionNode").alias("type"), F.lit("article").alias("level"), F.concat(F.lit("第"), numerals.short_numeral(F.col("n")), F.lit("条")).alias("name"), F.lit(None).cast("string").alias("text"), "r")
    e = articles.selectExpr("concat('document:', r) AS source", "id AS target", "'CONTAINS' AS type")
    asked = t("part").selectExpr("concat('《law', p_partkey % 5, '》') AS law", "CASE p_partkey % 3 WHEN 0 THEN concat('', p_partkey % 37 + 1) WHEN 1 THEN concat('第', p_partkey % 37 + 1, '条') ELSE concat(' ', p_partkey % 37 + 1, ' 条') END AS article")
    return search.find_article(laws.unionByName(articles).drop("r"), e, asked)


@query()
def w13_diversified(t):
    """The choice depends on all before it; tests hold it against the rule in plain Python."""
    w = ranking.Window.partitionBy("user_id").orderBy(F.desc("value"), "event_id")
    ranked = t("events").select(F.col("user_id").alias("list_id"), F.row_number().over(w).alias("rank"), F.col("event_id").alias("item_id"), F.col("event_type").alias("law"))
    return search.diversify(ranked, 10)


@query(f"WITH {N_SQL} SELECT count(*) FILTER (level = 'document') AS laws, count(*) AS nodes, count(*) FILTER (type = 'ProvisionNode') AS provisions, (SELECT max(ts) FROM events) AS updated_at FROM nodes")
def q8_system_counts(t):
    return search.system_counts(nodes(t), t("events").select(F.col("ts").alias("updated_at")))


# --- rules and functions --------------------------------------------------------------------------------------------

CATEGORY = "CASE p_size % 4 WHEN 0 THEN 'law' WHEN 1 THEN 'regulation' WHEN 2 THEN 'interpretation' ELSE 'constitution' END"
RANK = lambda c: f"CASE {c} WHEN 'constitution' THEN 0 WHEN 'law' THEN 1 WHEN 'regulation' THEN 2 WHEN 'interpretation' THEN 3 END"


@query(f"""WITH p AS (SELECT p_partkey, CASE p_partkey % 2 WHEN 0 THEN 'REFERENCES' ELSE 'INTERPRETS' END AS rel, {CATEGORY} AS src, p_size % 6 AS k FROM part),
 x AS (SELECT *, CASE k WHEN 0 THEN [] WHEN 1 THEN ['law'] WHEN 2 THEN ['interpretation', 'law'] WHEN 3 THEN ['interpretation', 'regulation'] WHEN 4 THEN ['regulation', 'law', 'constitution'] ELSE ['law', 'unknown'] END AS targets FROM p),
 w AS (SELECT *, len(list_filter(targets, lambda t: NOT coalesce({RANK('t')} <= {RANK('src')}, false))) AS wrong FROM x)
 SELECT p_partkey, CASE WHEN wrong % 2 = 1 THEN CASE rel WHEN 'REFERENCES' THEN 'INTERPRETS' ELSE 'REFERENCES' END ELSE rel END AS relation, wrong > 0 AS corrected FROM w""")
def p17_corrected_relation(t):
    targets = "CASE p_size % 6 WHEN 0 THEN array() WHEN 1 THEN array('law') WHEN 2 THEN array('interpretation', 'law') WHEN 3 THEN array('interpretation', 'regulation') WHEN 4 THEN array('regulation', 'law', 'constitution') ELSE array('law', 'unknown') END"
    made = category.corrected_relation(F.expr("if(p_partkey % 2 = 0, 'REFERENCES', 'INTERPRETS')"), F.expr(CATEGORY), F.expr(targets), F.lit("article:x:0001"), F.col("p_name"))
    return t("part").select("p_partkey", made.alias("x")).select("p_partkey", "x.relation", "x.corrected")


@query("SELECT event_id, CASE WHEN event_type = 'click' THEN 'rule' WHEN value >= 80 THEN 'model_high' WHEN value <= 20 THEN 'model_low' ELSE 'fallback' END AS source, value > 20 AND value < 80 AS unsure FROM events")
def p16_decision_source(t):
    return t("events").select("event_id", category.decision_source(F.col("value"), F.col("event_type") == "click", 20, 80).alias("source"), category.in_low_confidence(F.col("value"), 20, 80).alias("unsure"))


@query(_labels_sql(True, True, True, False, True, False, name="excluded"))
def p4_excluded(t):
    rows = _cases(t, "甲法|已废止|法律", "关于修改甲法的决定||法律", "刑法修正案（十一）||法律", "甲法|有效|法律", "甲||修正案", "关于甲的决定||").select("p_partkey", F.split("x", r"\|").alias("x"))
    return rows.select("p_partkey", category.is_excluded(F.col("x")[0], F.col("x")[1], F.col("x")[2]).alias("excluded"))


@query("SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'regulation' WHEN 1 THEN 'law' WHEN 2 THEN 'interpretation' WHEN 3 THEN NULL ELSE 'constitution' END AS category, CASE p_size % 5 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 3 WHEN 3 THEN NULL ELSE 0 END AS rank FROM part")
def p7_category_rank(t):
    given = F.expr("CASE p_size % 5 WHEN 0 THEN ' 地方法规 ' WHEN 1 THEN '法律' WHEN 2 THEN 'interpretation' WHEN 3 THEN '其他' ELSE '宪法' END")
    return t("part").select("p_partkey", category.category(given).alias("category"), locator.category_rank(category.category(given)).alias("rank"))


@query(f"SELECT p_partkey, '第' || {_numeral_sql('p_partkey')} || '条之' || {_numeral_sql('(p_size % 9 + 1)')} AS label, lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(4, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0') || '-' || lpad(CAST(p_size % 9 + 1 AS VARCHAR), 2, '0') AS key FROM (SELECT CAST(p_partkey + 1 AS BIGINT) AS p_partkey, CAST(p_size AS BIGINT) AS p_size FROM part)")
def f5_article_key(t):
    n = t("part").selectExpr("p_partkey + 1 AS p_partkey", "cast(p_partkey + 1 AS bigint) AS a", "cast(p_size % 9 + 1 AS bigint) AS b").withColumn("label", F.concat(F.lit("第"), numerals.to_chinese("a"), F.lit("条之"), numerals.to_chinese("b")))
    return n.select("p_partkey", "label", numerals.article_key("label").alias("key"))


@query("SELECT p_partkey, 'item:s' || p_size || ':' || lpad(CAST(p_partkey % 9999 AS VARCHAR), 4, '0') || ':02:07' AS id, 's' || p_size AS source, CAST(p_partkey % 9999 AS INTEGER) AS article, 2 AS paragraph, 7 AS item FROM part")
def f15_locator(t):
    made = t("part").select("p_partkey", F.format_string("item:s%d:%04d:02:07", F.col("p_size").cast("int"), (F.col("p_partkey") % 9999).cast("int")).alias("given"))
    at = made.select("p_partkey", locator.locator(F.col("given")).alias("at"))
    return at.select("p_partkey", locator.node_id(F.col("at"), F.col("at.source")).alias("id"), "at.source", "at.article", "at.paragraph", "at.item")


@query("SELECT p_partkey, array_to_string(list_sort(list_distinct(['乙' || p_partkey || '法', '乙' || p_partkey || '法（试行）', '国务院关于乙' || p_partkey || '法', '国务院关于乙' || p_partkey || '法（试行）'])), '|') AS variants FROM part")
def f17_title_variants(t):
    return t("part").select("p_partkey", F.array_join(text.title_variants(F.concat(F.lit("《国务院关于 乙"), "p_partkey", F.lit("法（试行）》"))), "|").alias("variants"))
