from pyspark.sql import functions as F

from lexweave.functions import locator, numerals, text
from lexweave.operators import graph
from lexweave.plans.cut import drop, scratch, shared_folder, stash


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def contains(spark, pairs):
    return spark.createDataFrame([(a, b, "CONTAINS") for a, b in pairs], "source string, target string, type string")


def test_long_chains(spark):
    for n in (1, 2, 3, 12, 33):
        e = contains(spark, [(f"n{i:02}", f"n{i + 1:02}") for i in range(n)])
        got = {(r["node"], r["ancestor"]): r["depth"] for r in graph.ancestors(e).collect()}
        assert got == {(f"n{i:02}", f"n{j:02}"): i - j for i in range(n + 1) for j in range(i)}
    assert graph.ancestors(contains(spark, [("a", "b")]).limit(0)).count() == 0


def test_cycles_and_parents(spark):
    e = contains(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("c", "x"), ("x", "y"), ("q", "q"), (None, "z")])
    got = rows(graph.ancestors(e).select("node", "ancestor"))
    ring = [(a, b) for a in "abc" for b in "abc" if a != b]
    assert got == sorted(ring + [("x", a) for a in "abc"] + [("y", a) for a in "abcx"])
    two = spark.createDataFrame([("p", "c", "CONTAINS", 1), ("o", "c", "CONTAINS", 2)], "source string, target string, type string, seq int")
    assert rows(graph.parents(two)) == [("c", "o")] and rows(graph.parents(two, order="seq")) == [("c", "o")]
    assert rows(graph.parents(two.withColumn("seq", -F.col("seq")), order="seq")) == [("c", "p")]


def test_owner_and_labels(spark):
    nodes = spark.createDataFrame(
        [("d", "document", "刑法"), ("t", "chapter", "第一章"), ("a", "article", "第十二条"), ("p", "paragraph", "第十二条第二款"), ("i", "item", "第十二条第二款第（一）项"), ("lone", "document", "x"), ("stray", "article", "第一条")],
        "id string, level string, name string")
    e = contains(spark, [("d", "t"), ("t", "a"), ("a", "p"), ("p", "i")])
    assert rows(graph.owners(e, nodes)) == [("a", "d"), ("d", "d"), ("i", "d"), ("lone", "lone"), ("p", "d"), ("t", "d")]
    got = {r[0]: tuple(r)[1:] for r in graph.label_path(graph.ancestors(e), nodes, list(graph.LABEL_SUFFIX), graph.LABEL_SUFFIX).collect()}
    assert got["i"] == ("第十二条", "第二款", "第（一）项", None) and got["a"] == ("第十二条", None, None, None) and got["d"] == (None,) * 4 and got["stray"][0] == "第一条"


def test_sibling_order(spark):
    ids = ["article:x:0002", "article:x:0010", "article:x:0002-01", "article:x:0001"]
    nodes = spark.createDataFrame([(i, "article") for i in ids], "id string, level string")
    got = dict(rows(graph.siblings(nodes, contains(spark, [("d", i) for i in ids])).select("id", "previous").fillna("-")))
    assert got == {"article:x:0001": "-", "article:x:0002": "article:x:0001", "article:x:0002-01": "article:x:0002", "article:x:0010": "article:x:0002-01"}


def test_locators(spark):
    ids = ["document:a-b", "part:s:01", "article:s:0012", "article:s:0012-03", "paragraph:s:0012:02", "item:s:0012:02:01", "item:s:0012:07", "item:s:segment:0004:02", "sub_item:s:0012:02:01:03",
           "sub_item:s:segment:0004:02:01", "segment:s:0003", "appendix:s:01", "odd:thing:here", "plain", None]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    c = F.col("id")
    got = {r["id"]: r for r in df.select("id", locator.locator(c).alias("at"), locator.source_id(c).alias("s"), locator.node_id(locator.locator(c), locator.source_id(c)).alias("back")).collect()}
    for i in ids[:12]:
        assert got[i]["back"] == (None if i.startswith("part") else i) and got[i]["s"] == ("a-b" if "a-b" in i else "s")
    assert got["odd:thing:here"]["s"] == "thing" and got["plain"]["s"] is None and got[None]["at"] is None
    at = got["item:s:0012:02:01"]["at"]
    assert (at["article"], at["suffix"], at["paragraph"], at["item"]) == (12, None, 2, 1)
    kinds = spark.createDataFrame([("law:x",), ("judicial:1",), ("local:2",), ("zzz:1",)], "id string").select(locator.candidate_category(c), locator.category_rank(locator.candidate_category(c)))
    assert [tuple(r) for r in kinds.collect()] == [("law", 1), ("interpretation", 3), ("regulation", 2), (None, None)]


def written(n):
    """An independent writer: sections of four digits, zeros between parts written once."""
    def section(v):
        out, gap = "", False
        for k, unit in ((1000, "千"), (100, "百"), (10, "十"), (1, "")):
            d = v // k % 10
            if not d:
                gap = bool(out)
                continue
            out += ("零" if gap else "") + ("" if d == 1 and k == 10 and not out else "一二三四五六七八九"[d - 1]) + unit
            gap = False
        return out

    high, low = divmod(n, 10000)
    return (section(high) + "万" + ("零" if 0 < low < 1000 else "") if high else "") + section(low)


def test_every_numeral(spark):
    df = spark.range(1, 120_001).select(F.col("id").alias("n"), numerals.to_chinese("id").alias("t")).withColumn("back", numerals.from_chinese("t"))
    for r in df.toLocalIterator():
        assert r["t"] == written(r["n"]) and r["back"] == r["n"]
    odd = spark.createDataFrame([(0,), (-1,), (100_000_000,), (99_999_999,), (None,)], "n long").select(numerals.to_chinese("n")).collect()
    assert [r[0] for r in odd] == [None, None, None, written(99_999_999), None]
    full = spark.createDataFrame([(" １２ ",), ("十x",), ("",)], "s string").select(numerals.from_chinese("s")).collect()
    assert [r[0] for r in full] == [12, None, None]


def test_article_labels(spark):
    cases = {"12": "第十二条"[:0] + "12", "第12条": "第十二条", "第210条之1": "第二百十条之一", "刑法 第 十 条": "第十条", "十二条": "第十二条", "": "", "总则": "总则"}
    cases["12"] = "第十二条"
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "s string").select("s", numerals.lookup_article("s").alias("x"))
    assert {r["s"]: r["x"] for r in df.collect()} == {**cases, None: ""}
    keys = spark.createDataFrame([("第二百二十五条之一",), ("第三条 x",), ("第12条",), ("附件",), (None,)], "s string").select(numerals.article_key("s")).collect()
    assert [r[0] for r in keys] == ["0225-01", None, "0012", None, None]


def test_title_variants(spark):
    cases = {"《中华人民共和国刑法（2020年修正文本）》": ["中华人民共和国刑法", "中华人民共和国刑法（2020年修正文本）", "刑法", "刑法（2020年修正文本）"], "最高人民法院关于 适用 办法（试行）": ["最高人民法院关于适用办法", "最高人民法院关于适用办法（试行）", "适用办法", "适用办法（试行）"],
             "民法（说明）": ["民法（说明）"], "中华人民共和国": ["中华人民共和国"], "国务院关于x": ["国务院关于x"], "": []}
    got = spark.createDataFrame([(k,) for k in cases], "s string").select("s", text.title_variants(F.col("s")).alias("v")).collect()
    assert {r["s"]: r["v"] for r in got} == {k: sorted(v) for k, v in cases.items()}


def test_scratch(spark):
    import pathlib

    root = pathlib.Path(shared_folder(spark).removeprefix("file://")) / "lexweave"
    before = set(root.glob("*")) if root.exists() else set()
    kept = stash(spark.range(3), "kept")
    with scratch(spark):
        a = stash(spark.range(5), "inner")
        b = stash(a.filter("id > 1"), "inner")
        assert b.count() == 3
    drop(spark.range(1))
    assert len(set(root.glob("*")) - before) == 1 and kept.count() == 3
    drop(kept)
    assert set(root.glob("*")) == before
