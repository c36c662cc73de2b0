"""Registered queries of references, provisions, headings and concepts on the driver's tables, and their SQL.

Sentences are made of a part's numbers written as Chinese numerals, so the SQL knows from the numbers alone what must be found.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lexweave.functions import headings, numerals, references, statute
from lexweave.operators import counts, provisions
from lexweave.plans.cut import spread
from lexweave.plans.registry import _cases, _labels_sql, _numeral_sql, query
from lexweave.sources import store

# --- references -----------------------------------------------------------------------------------------------------


def _numbers(t):
    """Every part with its numbers a (article), b (paragraph) and c (item) and their numerals."""
    p = t("part").selectExpr("p_partkey AS id", "cast(p_partkey % 4999 + 1 AS bigint) AS a", "cast(p_size % 9 + 1 AS bigint) AS b", "cast(p_partkey % 7 + 1 AS bigint) AS c")
    return spread(p, "id").withColumns({x: numerals.to_chinese(x[1:]) for x in ("_a", "_b", "_c")})


NUMBERS = "p AS (SELECT p_partkey AS id, CAST(p_partkey % 4999 + 1 AS BIGINT) AS a, CAST(p_size % 9 + 1 AS BIGINT) AS b, CAST(p_partkey % 7 + 1 AS BIGINT) AS c FROM part)"
NOT_FOUND = "CAST(0 AS BIGINT)"


def _sentences(t):
    n = _numbers(t)
    text = F.concat(F.lit("根据《甲"), "id", F.lit("法》第"), "_a", F.lit("条第"), "_b", F.lit("款第（"), "_c", F.lit("）项、第"), "_c", F.lit("款和本法第"), "_b", F.lit("条之"), "_c", F.lit("的规定，“刑法第"), "_a", F.lit("条”除外"))
    return n.select("id", F.concat(F.lit("d"), "id").alias("document_id"), F.concat(F.lit("《乙"), "id", F.lit("法》")).alias("title"), text.alias("sentence"), F.lit(None).cast("bigint").alias("article"), F.lit(None).cast("bigint").alias("suffix"))


FOUND = f"""found AS (SELECT id, 'absolute' AS kind, '《甲' || id || '法》' AS title, a AS article, {NOT_FOUND} AS suffix, b AS paragraph, c AS item, 0 AS place FROM p
 UNION ALL SELECT id, 'absolute', '《甲' || id || '法》', a, 0, c, 0, 1 FROM p UNION ALL SELECT id, 'local', '《乙' || id || '法》', b, c, 0, 0, 2 FROM p)"""


@query(f"WITH {NUMBERS}, {FOUND} SELECT id, kind, title, article, suffix, paragraph, item FROM found")
def t12_references(t):
    found = provisions.detect(_sentences(t)).select("id", "kind", "title", F.explode("targets").alias("t"))
    return found.select("id", "kind", "title", "t.article", "t.suffix", "t.paragraph", "t.item")


@query(f"WITH {NUMBERS} SELECT 2 * count(*) AS \"references\", 3 * count(*) AS targets, count(DISTINCT id) AS sentences, count(DISTINCT id) AS documents FROM p")
def a6_detect_counts(t):
    return counts.detect_counts(provisions.detect(_sentences(t)))


@query(f"WITH {NUMBERS} SELECT id, n.n AS article FROM p, (SELECT unnest(range(1, 13)) AS n) n WHERE n.n BETWEEN b AND b + c - 1")
def t14_ranges(t):
    """A range means each article of the cited document that exists in it; here documents have articles 1 to 12."""
    n = _numbers(t).withColumn("z", F.col("b") + F.col("c") - 1).withColumn("_z", numerals.to_chinese("z"))
    s = n.select("id", F.concat(F.lit("d"), "id").alias("document_id"), F.lit("").alias("title"), F.concat(F.lit("依照《甲"), "id", F.lit("法》第"), "_b", F.lit("条至第"), "_z", F.lit("条处理")).alias("sentence"), F.lit(0).alias("article"), F.lit(0).alias("suffix"))
    titles = n.select(F.concat(F.lit("《甲"), "id", F.lit("法》")).alias("title"), F.concat(F.lit("t"), "id").alias("document_id"))
    zero = [F.lit(0).cast("long").alias(x) for x in references.PATH[1:]]
    paths = titles.select("document_id", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("article")).select("document_id", F.concat("document_id", F.lit(":"), "article").alias("node_id"), F.col("article").cast("long").alias("article"), *zero)
    found = provisions.resolve(provisions.detect(s), titles, paths)
    return found.select("id", F.substring_index("node_id", ":", -1).cast("long").alias("article")).distinct()


def _statutes(t):
    """Nodes and edges: every nation a statute, its customers articles, their orders paragraphs; names are labels of the keys' numbers, from 1."""
    c = t("customer").selectExpr("c_nationkey", "c_custkey", "cast(c_custkey + 1 AS bigint) AS n").withColumn("name", F.concat(F.lit("第"), numerals.to_chinese("n"), F.lit("条")))
    o = t("orders").selectExpr("o_custkey", "o_orderkey", "cast(o_orderkey + 1 AS bigint) AS n").withColumn("name", F.concat(F.lit("第"), numerals.to_chinese("n"), F.lit("款")))
    row = lambda df, prefix, key, level, name: df.select(F.concat(F.lit(prefix), F.col(key).cast("string")).alias("id"), F.lit(level).alias("level"), name.alias("name"))
    nodes = row(t("nation"), "n:", "n_nationkey", "document", F.col("n_name")).unionByName(row(c, "c:", "c_custkey", "article", F.col("name"))).unionByName(row(o, "o:", "o_orderkey", "paragraph", F.col("name")))
    edge = lambda df, a, x, b, y: df.select(F.concat(F.lit(a), F.col(x).cast("string")).alias("source"), F.concat(F.lit(b), F.col(y).cast("string")).alias("target"), F.lit("CONTAINS").alias("type"))
    return nodes, edge(c, "n:", "c_nationkey", "c:", "c_custkey").unionByName(edge(o, "c:", "o_custkey", "o:", "o_orderkey"))


@query("SELECT 'n:' || c_nationkey AS document_id, 'c:' || c_custkey AS node_id, CAST(c_custkey + 1 AS BIGINT) AS article, CAST(0 AS BIGINT) AS paragraph FROM customer UNION ALL SELECT 'n:' || c_nationkey, 'o:' || o_orderkey, c_custkey + 1, o_orderkey + 1 FROM orders JOIN customer ON c_custkey = o_custkey")
def j7_provision_paths(t):
    return provisions.provision_paths(*_statutes(t)).select("document_id", "node_id", "article", "paragraph")


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'o:' || o_orderkey END AS node_id FROM orders JOIN customer ON c_custkey = o_custkey""")
def t15_resolve(t):
    """Every order cites its own paragraph by its nation's title; every third one a paragraph that is not there."""
    nodes, edges = _statutes(t)
    o = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    o = o.selectExpr("o_orderkey AS id", "n_name", "cast(c_custkey + 1 AS bigint) AS a", "cast(if(o_orderkey % 3 = 0, 50000000, 0) + o_orderkey + 1 AS bigint) AS b").withColumns({"_a": numerals.to_chinese("a"), "_b": numerals.to_chinese("b")})
    s = o.select("id", F.lit("x").alias("document_id"), F.lit("").alias("title"), F.concat(F.lit("依照《"), "n_name", F.lit("》第"), "_a", F.lit("条第"), "_b", F.lit("款办理")).alias("sentence"), F.lit(0).alias("article"), F.lit(0).alias("suffix"))
    titles = nodes.filter("level = 'document'").select(F.concat(F.lit("《"), "name", F.lit("》")).alias("title"), F.col("id").alias("document_id"))
    return provisions.resolve(provisions.detect(s), titles, provisions.provision_paths(nodes, edges)).select("id", "node_id")


@query("""WITH w AS (SELECT o_orderkey AS id, CAST(o_orderkey AS VARCHAR) || '/' || CAST(o_custkey AS VARCHAR) AS sentence FROM orders), a AS (SELECT DISTINCT CAST(p_size * 11 AS VARCHAR) AS alias FROM part)
 SELECT id, alias, row_number() OVER (PARTITION BY id ORDER BY length(alias) DESC, alias) AS rank, 'T' || alias AS title FROM w JOIN a ON contains(sentence, alias)""")
def j10_relevant_aliases(t):
    s = t("orders").select(F.col("o_orderkey").alias("id"), F.lit("d").alias("document"), F.concat_ws("/", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")).alias("sentence"))
    a = t("part").select(F.lit(None).cast("string").alias("document"), (F.col("p_size") * 11).cast("string").alias("alias")).distinct().withColumn("title", F.concat(F.lit("T"), "alias"))
    return provisions.relevant_aliases(s, a)


@query(_labels_sql(True, True, True, False, False, name="x"))
def p9_may_refer(t):
    return _cases(t, "依照第十条", "《甲》", "本办法", "第十", "法律").select("p_partkey", references.may_refer(F.col("x")).alias("x"))


@query(_labels_sql(True, True, True, False, False, name="x"))
def p10_skipped(t):
    return _cases(t, "序 号：1", "甲法（以下简称乙）", "第三条修 改为", "依照第十条", "").select("p_partkey", references.is_skipped(F.col("x")).alias("x"))


@query(_labels_sql(True, True, False, False, name="x"))
def p11_own_word(t):
    return _cases(t, " 本法。", "（本条 例）", "本法第一条", "法").select("p_partkey", references.is_own_word(F.col("x")).alias("x"))


@query("SELECT p_partkey, 4 AS opens, length(CAST(p_partkey AS VARCHAR)) + 6 AS closes, true AS inside, false AS outside FROM part")
def f21_quote_ranges(t):
    rows = t("part").select("p_partkey", F.concat(F.lit("依照此“"), F.col("p_partkey").cast("string"), F.lit("》”条")).alias("x")).withColumn("q", references.quoted(F.col("x"))[0])
    one = F.array("q")
    return rows.select("p_partkey", (F.col("q.start") + 1).alias("opens"), F.col("q.end").alias("closes"), references.in_quotes(F.lit(4), F.lit(5), one).alias("inside"), references.in_quotes(F.lit(0), F.lit(5), one).alias("outside"))


@query("SELECT p_partkey, '0-3|' || (p_size + 3) || '-' || (p_size + 9) AS kept FROM part")
def p13_disjoint_spans(t):
    span = lambda a, b: F.struct(F.lit(a).cast("int").alias("start") if isinstance(a, int) else a.cast("int").alias("start"), F.lit(b).cast("int").alias("end") if isinstance(b, int) else b.cast("int").alias("end"))
    size = F.col("p_size")
    kept = references.disjoint_spans(F.array(span(0, 3), span(2, 5), span(size + 3, size + 9), span(size + 8, size + 20), span(size, size + 4)))
    return t("part").select("p_partkey", F.array_join(F.transform(kept, lambda k: F.concat_ws("-", k["start"], k["end"])), "|").alias("kept"))


@query("""SELECT p_partkey, [true, true, false, true][p_size % 4 + 1] AS valid, [true, true, false, false][p_size % 4 + 1] AS precise FROM part""")
def p14_reference_span(t):
    rows = _cases(t, "《甲法》第十条", "根据本法第十条", "甲乙丙", "所谓的，见第十条")
    ends = F.char_length("x")
    return rows.select("p_partkey", references.is_valid_span(F.col("x"), F.lit(0), ends).alias("valid"), references.is_precise_span(F.col("x"), F.lit(0), ends).alias("precise"))


@query("""WITH p AS (SELECT p_partkey AS id FROM part) SELECT id, s AS start, s + 3 AS "end", 0 AS group_start, 7 AS group_end FROM p, (VALUES (0), (4)) v(s)""")
def w11_parallel_groups(t):
    spans = t("part").select(F.col("p_partkey").alias("id"), F.lit("第一条、第二条不同于第三条").alias("sentence"), F.explode(F.array(*(F.struct(F.lit(a).alias("start"), F.lit(a + 3).alias("end")) for a in (0, 4, 10)))).alias("s"))
    return provisions.parallel_groups(spans.select("id", "sentence", "s.*"))


@query("""SELECT id, text, string_agg(node_id, ',' ORDER BY place, node_id) AS nodes FROM (SELECT l_orderkey AS id, l_returnflag AS text, CAST(l_suppkey % 5 AS VARCHAR) AS node_id, min(l_linenumber) AS place FROM lineitem GROUP BY 1, 2, 3) GROUP BY id, text""")
def a7_grouped_targets(t):
    r = t("lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("text"), (F.col("l_suppkey") % 5).cast("string").alias("node_id"), F.col("l_linenumber").alias("place"))
    return provisions.grouped_targets(r).select("id", "text", F.array_join("node_ids", ",").alias("nodes"))


@query(f"WITH {NUMBERS} SELECT id, '第' || {_numeral_sql('a')} || '条第' || {_numeral_sql('b')} || '款第' || {_numeral_sql('c')} || '项' AS text, '第（' || {_numeral_sql('c')} || '）项' AS label, c AS n FROM p")
def f26_rendered(t):
    n = _numbers(t).withColumn("label", headings.label("item", "c"))
    return n.select("id", headings.rendered("a", "nullif(0L, 0L)", "b", "c", "0L").alias("text"), "label", headings.label_number("label").alias("n"))


@query("""SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN '本款所列' || p_name || '下列' || p_name ELSE p_name END AS text, CASE WHEN p_size % 2 = 0 THEN 6 + length(p_name) ELSE 0 END AS "offset" FROM part""")
def f24_augmented(t):
    p = t("part")
    low = p.select(F.concat(F.lit("i"), "p_partkey").alias("id"), F.when(F.col("p_size") % 2 == 0, "item").otherwise("paragraph").alias("level"), F.col("p_name").alias("text"))
    mid = p.select(F.concat(F.lit("g"), "p_partkey").alias("id"), F.lit("paragraph").alias("level"), F.lit("下列").alias("text"))
    top = p.select(F.concat(F.lit("a"), "p_partkey").alias("id"), F.lit("article").alias("level"), F.concat(F.lit(" 本款所列"), "p_name").alias("text"))
    edge = lambda a, b: p.select(F.concat(F.lit(a), "p_partkey").alias("source"), F.concat(F.lit(b), "p_partkey").alias("target"), F.lit("CONTAINS").alias("type"))
    s = p.select(F.col("p_partkey").alias("id"), F.concat(F.lit("i"), "p_partkey").alias("node_id"), F.col("p_name").alias("sentence"))
    return provisions.augmented(s, low.unionByName(mid).unionByName(top), edge("a", "g").unionByName(edge("g", "i"))).select("id", "text", "offset")


# --- headings and documents -----------------------------------------------------------------------------------------

@query(_labels_sql("part", "chapter", "section", "article", "article", "none", "none", name="level"))
def f10_heading_level(t):
    rows = _cases(t, "第一编 总则", "第二章　甲", "第十节", "第12条 甲", "第十条之一", "第十条甲", "甲第一章")
    return rows.select("p_partkey", F.coalesce(headings.heading_level(F.col("x")), F.lit("none")).alias("level"))


@query(_labels_sql(True, False, False, False, False, name="x"))
def f11_continues_heading(t):
    return _cases(t, "和罚则", "甲。", "（一）甲", "", "甲" * 25).select("p_partkey", headings.continues_heading(F.col("x")).alias("x"))


@query("""WITH n AS (SELECT o_custkey AS document, o_orderkey AS place, CASE WHEN o_orderkey % 5 = 0 THEN 1 WHEN o_orderkey % 5 = 1 THEN 2 ELSE 3 END AS r FROM orders),
 x AS (SELECT a.document, a.place, a.r, max(b.place) AS parent FROM n a LEFT JOIN n b ON b.document = a.document AND b.place < a.place AND b.r < a.r GROUP BY ALL)
 SELECT document, place, parent, row_number() OVER (PARTITION BY document, r, parent ORDER BY place) AS ordinal FROM x""")
def w5_level_parents(t):
    rows = t("orders").select(F.col("o_custkey").alias("document"), F.col("o_orderkey").alias("place"), F.expr("CASE WHEN o_orderkey % 5 = 0 THEN 'part' WHEN o_orderkey % 5 = 1 THEN 'chapter' ELSE 'article' END").alias("level"))
    return provisions.with_ordinals(provisions.with_parents(rows, "document", "place", "place"), "document", "place").drop("level")


@query(f"""WITH p AS (SELECT p_partkey AS document, {_numeral_sql('(p_size % 9 + 1)')} AS n FROM part)
 SELECT document, place, level, text, parent, ordinal FROM (SELECT document, 1 AS place, 'chapter' AS level, '第' || n || '章 甲乙' AS text, NULL AS parent, 1 AS ordinal FROM p
 UNION ALL SELECT document, 4, 'article', '第' || n || '条 丙。', 1, 1 FROM p UNION ALL SELECT document, 5, 'paragraph', '丁。', 4, 1 FROM p UNION ALL SELECT document, 6, 'paragraph', '戊', 4, 2 FROM p)""")
def t3_outline(t):
    n = t("part").select(F.col("p_partkey").alias("document"), F.expr("cast(p_size % 9 + 1 AS bigint)").alias("n")).withColumn("n", numerals.to_chinese("n"))
    texts = F.array(F.concat(F.lit("第"), "n", F.lit("章　甲")), F.lit("  "), F.lit("乙"), F.concat(F.lit("第"), "n", F.lit("条 丙。")), F.lit("丁。"), F.lit("戊"))
    lines = n.select("document", F.posexplode(texts).alias("k", "text")).select("document", (F.col("k") + 1).alias("place"), "text")
    return provisions.outline(lines)


@query(_labels_sql("2020年1月2日|2020年3月1日", "2020年1月2日|2020年1月2日", "2020年1月2日|2021年5月5日", "|", name="dates"))
def f28_dates(t):
    signed = headings.signature_date(F.when(F.col("p_size") % 4 == 3, F.array(F.lit("甲"))).otherwise(F.array(F.lit("2019年1月1日"), F.lit(" 2020年1月2日 "), F.lit("2021年1月1日公布"))))
    rows = _cases(t, "自2020年3月1日起施行", "自即日起施行", "甲", "自即日起施行").join(t("part").select("p_partkey", "p_size"), "p_partkey").withColumn("signed", signed)
    events = F.when(F.col("p_size") % 4 == 2, F.array(F.lit("2020年2月2日"), F.lit("2021年5月5日"))).otherwise(F.expr("cast(array() AS array<string>)"))
    return rows.select("p_partkey", F.concat_ws("|", "signed", headings.effective_date(F.col("x"), F.col("signed"), events)).alias("dates"))


@query("SELECT p_partkey, ['law:x', 'law:x', 'document:law:x', 'law:x'][p_size % 4 + 1] AS document, ['article', 'item', 'article', 'article'][p_size % 4 + 1] AS level FROM part")
def f16_source_document(t):
    return _cases(t, "article:law:x:0001", "item:law:x:0001:02:03", "document:law:x", "segment:law:x:01").select("p_partkey", headings.source_document(F.col("x")).alias("document"), headings.granularity(F.col("x")).alias("level"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN '《' || p_name || '》第一条' ELSE p_name END AS cited, CAST(length(p_name) + length(p_brand) + 100 AS BIGINT) AS tokens, p_brand || '|' || p_name AS signature FROM part")
def f48_citation(t):
    name, brand = F.col("p_name"), F.col("p_brand")
    cited = headings.citation(name, F.when(F.col("p_size") % 2 == 0, "第一条"), F.lit(None).cast("string"), F.lit(""))
    return t("part").select("p_partkey", cited.alias("cited"), headings.token_estimate(F.array(name, brand, F.lit(None).cast("string")), 100).alias("tokens"), headings.category_signature(F.array(brand, F.concat(F.lit(" "), brand), F.lit(" "), name)).alias("signature"))


@query("""SELECT sha256('{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '","none":null}') AS fingerprint, c_custkey FROM customer""")
def f14_fingerprint(t):
    return t("customer").withColumn("none", F.lit(None).cast("string")).select(headings.fingerprint("none", "c_mktsegment", "c_custkey").alias("fingerprint"), "c_custkey")


@query(_labels_sql("甲", "none", "none", "甲合同", "none", "甲", name="name"))
def f36_concept_name(t):
    return _cases(t, "甲：制度", "定义", "刑法适用范围", " 甲合同 ", "", "甲基本原则").select("p_partkey", F.coalesce(headings.concept_name(F.col("x")), F.lit("none")).alias("name"))


@query("SELECT p_partkey, ['保护' || p_name, '行为', 'none', '：人'][p_size % 4 + 1] AS text FROM part")
def f37_concept_description(t):
    rows = _cases(t, "0", "是指一种行为。，", "：，", "甲(a)，是指：人").join(t("part").select("p_partkey", "p_name"), "p_partkey")
    given = F.when(F.col("x") == "0", F.concat(F.lit("甲(a)指保护"), "p_name")).when(F.startswith("x", F.lit("是指")), F.lit("是指一种行为，")).otherwise(F.col("x"))
    return rows.select("p_partkey", F.coalesce(headings.concept_description(given, F.lit("甲(a)")), F.lit("none")).alias("text"))


# --- counts and tables ----------------------------------------------------------------------------------------------

RELATION = "CASE l_linenumber % 4 WHEN 0 THEN 'related' WHEN 1 THEN 'equivalent' WHEN 2 THEN 'none' END"


@query(f"""SELECT count(*) AS pair_count, count(*) FILTER (r IS NULL) AS pending_count, count(*) FILTER (r = 'equivalent') AS equivalent_count, 0 AS is_subordinate_count, 0 AS has_subordinate_count,
 count(*) FILTER (r = 'related') AS related_count, count(*) FILTER (r = 'none') AS none_count FROM (SELECT {RELATION} AS r FROM lineitem)""")
def a2_relation_counts(t):
    return counts.relation_counts(t("lineitem").selectExpr(f"{RELATION} AS relation"))


@query("SELECT count(DISTINCT o_custkey) AS documents, count(*) AS candidates, count(*) FILTER (o_orderkey % 3 = 1) AS invalid_marks, count(*) FILTER (o_orderkey % 3 <> 0) AS empty_targets, count(*) - count(DISTINCT o_orderkey // 2) AS repeated FROM orders")
def a26_pool_checks(t):
    p = t("orders").selectExpr("cast(o_orderkey div 2 AS string) AS sample_id", "concat('article:d', o_custkey, ':0001') AS source_node_id", "CASE o_orderkey % 3 WHEN 0 THEN 'a[T]b[/T]' WHEN 1 THEN 'ab' ELSE '[T] [/T]' END AS text")
    return counts.pool_checks(p)


@query("""SELECT o_custkey AS id, string_agg(one, '、' ORDER BY place, one) AS text FROM (SELECT o_custkey, min(o_orderkey) AS place, '《' || o_orderstatus || '》' || string_agg('第' || o_orderkey || '条', '、' ORDER BY o_orderkey) AS one FROM orders GROUP BY o_custkey, o_orderstatus) GROUP BY 1""")
def a35_cited_laws(t):
    return counts.cited_laws(t("orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("place"), F.col("o_orderstatus").alias("law"), F.concat(F.lit("第"), "o_orderkey", F.lit("条")).alias("article"), F.lit(None).cast("string").alias("paragraph"), F.lit("").alias("item")))


def _roots(t):
    sub = F.array(*(F.struct(F.concat("p_type", F.lit(k)).alias("concept"), F.lit("y").alias("description")) for k in ("1", "2")))
    concept = lambda name: F.struct(F.col(name).alias("concept"), F.lit("x").alias("description"), sub.alias("subordinates"))
    return t("part").select(F.col("p_partkey").cast("string").alias("root"), F.array(concept("p_name"), concept("p_brand")).alias("concepts"))


@query("""WITH c AS (SELECT CAST(p_partkey AS VARCHAR) AS root, unnest([p_name, p_brand]) AS name, p_type FROM part), i AS (SELECT *, 'concept:' || left(sha256(root || chr(9) || 'core' || chr(9) || name), 24) AS id FROM c)
 SELECT id, name, 'x' AS description, '' AS parent, root FROM i UNION ALL
 SELECT 'concept:' || left(sha256(root || chr(9) || 'subordinate' || chr(9) || name || chr(9) || p_type || k), 24), p_type || k, 'y', id, root FROM i, (VALUES ('1'), ('2')) v(k)""")
def a38_concept_rows(t):
    return counts.concept_rows(_roots(t))


@query("SELECT 6 * count(*) AS concepts, 2 * count(*) AS core, 4 * count(*) AS subordinate FROM part")
def a37_concept_counts(t):
    return counts.concept_counts(counts.concept_rows(_roots(t)))


@query("SELECT c_custkey AS unit, c_custkey % 3 = 0 AS reused FROM customer")
def r5_reuse(t):
    c = t("customer").select(F.col("c_custkey").alias("unit"), F.col("c_name").alias("fingerprint"))
    return counts.reuse(c, c.filter("unit % 3 <> 1").withColumn("fingerprint", F.expr("if(unit % 3 = 0, fingerprint, 'old')"))).drop("fingerprint")


@query("SELECT CASE WHEN r = n THEN 'full' WHEN r > 0 THEN 'partial' ELSE 'none' END AS decision, r AS reused, n - r AS open FROM (SELECT count(*) AS n, count(*) FILTER (c_nationkey < 20) AS r FROM customer)")
def r5_reuse_decision(t):
    return counts.reuse_decision(t("customer").select((F.col("c_nationkey") < 20).alias("reused")))


@query("SELECT c_custkey FROM customer WHERE c_nationkey = 3 AND (c_name ILIKE '%1%' OR c_mktsegment ILIKE '%BUILD%')")
def p22_matching(t):
    a = store.matching(t("customer"), ["c_name", "c_mktsegment"], "build", c_nationkey=3, c_acctbal=None)
    return a.unionByName(store.matching(t("customer"), ["c_name"], "1", c_nationkey=3)).select("c_custkey").distinct()


@query("SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20 OFFSET 20")
def l7_page(t):
    return store.page(t("orders"), [F.desc("o_orderdate"), F.desc("o_orderkey")], 2, 20).select("o_orderkey")
