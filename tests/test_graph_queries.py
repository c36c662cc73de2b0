"""Literals and brute force for operators whose queries have no SQL, or whose edges the tables do not reach."""

from pyspark.sql import functions as F

from lexweave.functions import category
from lexweave.operators import concepts, counts, ranking, search


def test_diversify(spark):
    import random

    r = random.Random(3)
    rows = [(k, i, 100 * k + i, r.choice(["a", "a", "a", "b", None, ""])) for k in range(6) for i in range(25)]
    got = {}
    for x in search.diversify(spark.createDataFrame(rows, "list_id int, rank int, item_id int, law string"), 8).collect():
        got.setdefault(x["list_id"], []).append((x["rank"], x["item_id"]))
    for k in range(6):
        pool, out, last, streak = [(i, law or "") for n, _, i, law in rows if n == k], [], "", 0
        while pool and len(out) < 8:
            at = 0
            if last and streak >= 2:
                at = next((j for j, (_, law) in enumerate(pool) if law and law != last), 0)
            item, law = pool.pop(at)
            last, streak = (last, streak + 1) if law and law == last else (law, int(bool(law)))
            out.append(item)
        assert sorted(got[k]) == list(enumerate(out, 1))


def test_judgments(spark):
    p = "left_id string, right_id string, score double, relation string, strength int"
    old = spark.createDataFrame([("a", "b", 0.8, "related", 9), ("a", "c", 0.7, None, None)], p)
    new = spark.createDataFrame([("a", "b", 0.9, "", None), ("a", "c", 0.6, None, None), ("d", "e", 0.5, "none", 3)], p)
    got = {tuple(r)[:2]: tuple(r)[2:] for r in concepts.inherit_judgment(old, new).collect()}
    assert got == {("a", "b"): (0.9, "related", 9), ("a", "c"): (0.6, None, None), ("d", "e"): (0.5, "none", 3)}
    keys = spark.createDataFrame([("a  b", None), (" a b ", "")], "x string, y string").select(concepts.judge_cache_key(F.col("x"), F.col("y")).alias("k")).collect()
    assert keys[0]["k"] == keys[1]["k"]
    grid = spark.createDataFrame([(0.3, 0.5, 0.9, 0.64), (0.4, 0.9, 0.9, 0.9), (0.5, 0.95, 0.7, 0.8)], "threshold double, precision double, recall double, f1 double")
    assert counts.choose_threshold(grid, "recall", 0.85).first()["threshold"] == 0.4 and counts.choose_threshold(grid, "precision", 0.99).first()["threshold"] == 0.5


def test_subgraph(spark):
    e = spark.createDataFrame([("a", "b", "T"), ("b", "c", "T"), ("c", "d", "T"), ("a", "x", "T"), ("x", "b", "U")], "source string, target string, type string")
    start = spark.createDataFrame([("a",)], "start string")
    near, links = search.subgraph(None, e, start, 2, 3)
    assert sorted((r["node"], r["hop"]) for r in near.collect()) == [("a", 0), ("b", 1), ("x", 1)]
    assert sorted((r["source"], r["target"]) for r in links.collect()) == [("a", "b"), ("a", "x"), ("x", "b")]


def test_interpretations(spark):
    rows = [("关于办理甲案件适用法律的解释", "最高人民法院", "法律", ""), ("全国人民代表大会常务委员会关于《中华人民共和国刑法》第三百一十三条的解释", "x", "法律", "有效"), ("甲条例", None, None, None), ("甲", "x", "司法解释", "")]
    df = spark.createDataFrame(rows, "n string, i string, c string, s string")
    got = df.select(category.is_judicial_interpretation(F.col("n"), F.col("i"), F.col("c")), category.is_legislative_interpretation(F.col("n"), F.col("s"), F.col("c"))).collect()
    assert [tuple(r) for r in got] == [(True, False), (True, True), (False, False), (True, False)]
    title = spark.createDataFrame([("document:x", "关于适用[T]甲法[/T]的解释", ["law"]), ("article:x:0001", "关于适用[T]甲法[/T]的解释", ["law"]), ("document:x", "关于适用[T]甲法[/T]的解释", None)], "s string, t string, c array<string>")
    got = title.select(category.corrected_relation(F.lit("REFERENCES"), F.lit("interpretation"), F.col("c"), F.col("s"), F.col("t")).alias("x")).select("x.*").collect()
    assert [tuple(r) for r in got] == [("INTERPRETS", True), ("REFERENCES", False), ("INTERPRETS", True)]


def test_fill_split_keeps_groups(spark):
    df = spark.range(3000).select((F.col("id") % 300).alias("g"), "id")
    got = ranking.fill_split(df, "g").groupBy("split").agg(F.count("*").alias("n"), F.count_distinct("g").alias("g")).collect()
    assert {r["split"]: r["n"] for r in got} == {"train": 2400, "dev": 300, "test": 300} and sum(r["g"] for r in got) == 300


def test_apart_by_sets(spark, monkeypatch):
    import random

    from lexweave.operators import concepts

    r = random.Random(6)
    rows = [(r.randint(0, 9), r.choice(["structure", "structure", "document"]), r.choice([None, *range(12)])) for _ in range(40)]
    of = {c: {x for b, k, x in rows if b == c and k == "structure" and x is not None} for c in range(12)}
    pairs = [(a, b) for a in range(12) for b in range(12)]
    ctx, p = spark.createDataFrame(rows, "concept int, kind string, context int"), spark.createDataFrame(pairs, "left int, right int")
    for most in (2, 4096):
        monkeypatch.setattr(concepts, "CONTEXTS", most)
        got = concepts.apart(p, ctx, "structure")
        assert sorted(tuple(x) for x in got.collect()) == [(a, b) for a, b in pairs if not of[a] & of[b]]
    assert "arrays_overlap" in got._jdf.queryExecution().optimizedPlan().toString()  # sets meet, not contexts one by one
