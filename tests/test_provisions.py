"""References, outlines and quotas on literals and beside brute force."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from lexweave.functions import references
from lexweave.operators import counts, graph, provisions
from lexweave.sources import store


def found(s, **more):
    return [(r[0], r[1], r[4], [tuple(x) for x in r[5]]) for r in references.find_references(s, **more)]


def path(a, s=0, p=0, i=0, z=0, level=None, upto=None):
    return (a, s, p, i, z, level, upto)


def test_kinds():
    assert found("依照《刑法》第十条之一第二款第（三）项、第4项，和第十二条处理") == [("absolute", "《刑法》", "《刑法》第十条之一第二款第（三）项、第4项", [path(10, 1, 2, 3), path(10, 1, 2, 4)])]
    assert found("民法典第一条") == [("bare", "《民法典》", "民法典第一条", [path(1)])]
    assert found("本法第三条第二款", title="《甲》") == [("local", "《甲》", "本法第三条第二款", [path(3, 0, 2)])]
    assert found("《总则》第五条", aliases={"总则": "《民法总则》"})[0][0] == "absolute"
    assert found("按照总则第五条", aliases={"总则": "《民法总则》", "则": "《丙》"}) == [("alias", "《民法总则》", "总则第五条", [path(5)])]
    assert found("“刑法第三条”规定") == []
    assert found("没有", aliases=None) == [] and found("") == []


def test_parallel_and_shared():
    assert found("《甲》第一条第一、二项")[0][3] == [path(1, i=1), path(1, i=2)]
    assert found("《甲》第一条（下称规定）、第二条")[0][2] == "《甲》第一条（下称规定）、第二条"
    shared = found("《甲》第一条“乙”、第二条第三款和第四款")
    assert [r[0] for r in shared] == ["absolute", "shared"] and shared[1][1:] == ("《甲》", "第二条第三款和第四款", [path(2, 0, 3), path(2, 0, 4)])
    assert found("本法第一条“乙”、第二条", title="《丁》")[-1][0] == "local"


def test_ranges():
    assert found("《甲》第二条至第五条")[0][3] == [path(2), path(2, level="article", upto=5)]
    assert found("《甲》第二条至第一条")[0][3] == [path(2), path(1)]
    assert found("本法第五条第一款", home=(9, 0))[0][3] == [path(5, 0, 1)]
    assert found("本法第五条第一款、第二款", home=(9, 0))[0][3] == [path(5, 0, 1), path(9, 0, 2)]
    assert found("《甲》第一条至第九千九百九十九万条")[0][3][-1][-1] == 99_990_000


def test_spans_and_quotes():
    assert sorted(references.quote_ranges("a“b‘c’”《d")) == [(1, 7), (3, 6), (7, 9)]
    assert references.quote_ranges('"a"') == [(0, 3)] and references.quote_ranges("") == []
    r = random.Random(5)
    for _ in range(300):
        spans, kept, own = [(a, a + r.randint(1, 6)) for a in (r.randint(0, 40) for _ in range(12))], references._Spans(), []
        for a, b in spans:
            free = all(b <= x or a >= y for x, y in own)
            assert kept.add(a, b) == free
            own += [(a, b)] * free
        text = "".join(r.choice("“”《》‘’\"ab") for _ in range(20))
        ranges = references.quote_ranges(text)
        outer = references._Spans(ranges)
        for a in range(20):
            assert outer.holds(a, a + 2) == any(x <= a and a + 2 <= y for x, y in ranges)


def test_long_sentence():
    long = "依照《甲》第一条“乙”、第二条“丙”、" * 3000
    assert len(references.find_references(long)) == 6000


def test_resolve(spark):
    paths = spark.createDataFrame([("d", f"d:{a}:{p}", a, 0, p, 0, 0) for a in (1, 2, 3) for p in (0, 1, 2)] + [("e", "e:1", 1, 0, 0, 0, 0)], "document_id string, node_id string, article long, suffix long, paragraph long, item long, sub_item long")
    titles = spark.createDataFrame([("《甲》", "d"), ("《甲》", "e")], "title string, document_id string")
    s = spark.createDataFrame([(1, "d", "《丁》", "《甲》第一条至第二条", None, None), (2, "d", "《丁》", "本法第三条第二款", 3, 0), (3, "d", None, "《未知》第一条", None, None), (4, "d", None, None, None, None), (5, "d", "", "《甲》第九条", None, None)],
                              "id int, document_id string, title string, sentence string, article long, suffix long")
    got = {(r["id"], r["node_id"]) for r in provisions.resolve(provisions.detect(s), titles, paths).collect()}
    assert got == {(1, "d:1:0"), (1, "d:2:0"), (1, "e:1"), (2, "d:3:2"), (5, None)}


def test_aliases_of_own_document_first(spark):
    s = spark.createDataFrame([(1, "a", "总则和则"), (2, "b", "总则"), (3, "b", ""), (4, "b", None)], "id int, document string, sentence string")
    a = spark.createDataFrame([(None, "总则", "全"), ("a", "总则", "甲"), (None, "则", "短"), ("c", "和", "丙")], "document string, alias string, title string")
    got = sorted((r["id"], r["rank"], r["alias"], r["title"]) for r in provisions.relevant_aliases(s, a).collect())
    assert got == [(1, 1, "总则", "甲"), (1, 2, "则", "短"), (2, 1, "总则", "全"), (2, 2, "则", "短")]


def test_pairs_of_a_hub_in_tiles(spark):
    r = random.Random(1)
    rows = sorted({(r.randint(0, 30), r.choice([0, 0, 0, 1, 2, 3])) for _ in range(120)})
    links = spark.createDataFrame(rows, "node int, hub int")
    want = sorted((a, b) for a, h in rows for b, g in rows if h == g and a < b)
    for tile in (1, 4, 2048):
        assert sorted((x["left"], x["right"]) for x in graph.hub_pairs(links, "hub", [], tile).collect()) == want
    whole, split = ({(x["left"], x["right"]): round(x["score"], 9) for x in graph.adamic_adar(links, k).collect()} for k in (2048, 3))
    assert whole == split and whole


def test_level_quotas():
    r = random.Random(2)
    for _ in range(500):
        available = {k: r.choice([0, r.randint(0, 5), r.randint(0, 60)]) for k in "abcd"}
        total = r.randint(0, 90)
        kinds = [k for k in available if available[k]]
        want = {k: min(available[k], max(1, total // len(kinds))) for k in kinds} if kinds and total else {}
        for _ in range(max(total - sum(want.values()), 0)):
            best = max(kinds, key=lambda k: (available[k] - want[k], -"abcd".index(k))) if want else None
            if best is None or available[best] <= want[best]:
                break
            want[best] += 1
        assert counts.level_quotas(available, total) == want


def test_scope_and_tables(spark):
    store.validate_scope(source_ids=["a"])
    store.validate_scope(category=["x"], status_except=["y"])
    for bad in ({}, {"everything": True, "source_ids": ["a"]}, {"status": ["x"], "status_except": ["x"]}):
        with pytest.raises(ValueError):
            store.validate_scope(**bad)
    a = spark.range(4)
    assert store.is_materialized(a, a, "id") and not store.is_materialized(a, a.filter("id < 3"), "id") and store.is_materialized(a.filter("id < 0"), a, "id")
    d = spark.createDataFrame([("a_b",), ("axb",), (None,)], "x string")
    assert [r["x"] for r in store.matching(d, ["x"], "A_").collect()] == ["a_b"] and store.matching(d, ["x"], "").count() == 3


def test_outline_without_headings(spark):
    d = spark.createDataFrame([("d", 1, "甲"), ("d", 2, None), ("d", 3, "第一章 总则"), ("d", 4, "和附则"), ("d", 5, "1. 乙"), ("d", 6, "第一条 丙")], "document string, place int, text string")
    got = [tuple(r) for r in provisions.outline(d).select("place", "level", "text", "parent").orderBy("place").collect()]
    assert got == [(1, "paragraph", "甲", None), (3, "chapter", "第一章 总则", None), (4, "paragraph", "和附则", 3), (5, "paragraph", "1. 乙", 3), (6, "article", "第一条 丙", 3)]
    empty = provisions.outline(d.filter("place < 0"))
    assert empty.count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_resolve_broadcasts_nothing_that_grows(spark):
    n = spark.range(40).selectExpr("concat('d', id) AS document_id", "concat('《', id, '》') AS title", "id")
    paths = n.select("document_id", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("article")).selectExpr("document_id", "concat(document_id, ':', article) AS node_id", "cast(article AS bigint) AS article", *(f"0L AS {x}" for x in references.PATH[1:]))
    s = n.selectExpr("id", "'x' AS document_id", "'' AS title", "concat('依照', title, '第三条至第五条、第九条') AS sentence", "0 AS article", "0 AS suffix")
    got = provisions.resolve(provisions.detect(s), n, paths)
    assert "Broadcast" not in plan_of(got)
    assert {(r["id"], r["node_id"]) for r in got.collect()} == {(i, f"d{i}:{a}") for i in range(40) for a in (3, 4, 5, 9)}


def test_ranges_below_articles(spark):
    paths = spark.createDataFrame([("d", f"{a}:{p}:{i}", a, 0, p, i, 0) for a in (1, 2) for p in (0, 1, 2, 3) for i in (0, 1, 2, 3)], "document_id string, node_id string, article long, suffix long, paragraph long, item long, sub_item long")
    titles = spark.createDataFrame([("《甲》", "d")], "title string, document_id string")
    s = spark.createDataFrame([(1, "x", "", "《甲》第一条第二款至第一条第三款", None, None), (2, "x", "", "《甲》第二条第一款第一项至第二条第一款第三项", None, None), (3, "x", "", "《甲》第一条至第二条", None, None)], "id int, document_id string, title string, sentence string, article long, suffix long")
    got = {(r["id"], r["node_id"]) for r in provisions.resolve(provisions.detect(s), titles, paths).collect()}
    assert got == {(1, "1:2:0"), (1, "1:3:0"), (2, "2:1:1"), (2, "2:1:2"), (2, "2:1:3"), (3, "1:0:0"), (3, "2:0:0")}


def test_pairs_of_hubs_are_shuffled_once(spark, monkeypatch):
    r = random.Random(4)
    rows = sorted({(r.randint(0, 30), r.choice([0, 0, 1, 2, 3])) for _ in range(120)})
    links = spark.createDataFrame(rows, "node int, member int")
    monkeypatch.setattr(graph, "PAIRS", 20)  # tasks grow in number, not in size
    of = {a: {h for b, h in rows if b == a} for a, _ in rows}
    want = {(a, b): round(len(of[a] & of[b]) / max(len(of[a]), len(of[b])), 9) for a in of for b in of if a < b and of[a] & of[b]}
    for tile in (3, 2048):
        got = graph.common_ratio(links, tile)
        plan = plan_of(got)
        assert plan[:plan.index("REPARTITION_BY_NUM")].count("Exchange") == 1  # nothing above but the one shuffle of pairs, as arrays
        assert {(x["left"], x["right"]): round(x["score"], 9) for x in got.collect()} == want


def test_sentences_are_spread_before_python(spark):
    s = spark.range(8, numPartitions=1).selectExpr("id", "'x' AS document_id", "'' AS title", "concat('依照《甲》第', id + 1, '条') AS sentence", "0 AS article", "0 AS suffix")
    plan = plan_of(provisions.detect(s))
    assert "REPARTITION_BY_NUM" in plan[plan.index("ArrowEvalPython"):]
    assert provisions.detect(s).count() == 8


def test_links_of_hubs_are_dealt_into_more_tasks_as_they_grow(spark, monkeypatch):
    r = random.Random(5)
    rows = sorted({(r.randint(0, 30), r.choice([0, 0, 1, 2, 3])) for _ in range(120)})
    links = spark.createDataFrame(rows, "node int, hub int")
    degree = {h: sum(g == h for _, g in rows) for _, h in rows}
    want = {}
    for (a, h), (b, g) in ((x, y) for x in rows for y in rows if x[0] < y[0] and x[1] == y[1]):
        want[a, b] = want.get((a, b), 0) + 1 / math.log(degree[h])
    monkeypatch.setattr(graph, "LINKS", 5)
    for tile in (3, 2048):
        got = graph.adamic_adar(links, tile)
        numbers = {int(n) for n in re.findall(r"hashpartitioning\([^()]*, (\d+)\), REPARTITION_BY_NUM", plan_of(got))}
        assert len(rows) // 5 + 1 in numbers and max(numbers) > (len(rows) // 5 + 1 if tile == 3 else 4)
        assert {(x["left"], x["right"]): round(x["score"], 9) for x in got.collect()} == {k: round(1 - math.exp(-w), 9) for k, w in want.items()}
