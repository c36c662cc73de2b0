from lexweave.operators import graph, similarity
from lexweave.operators.components import connected_components
from lexweave.sources.store import ArtifactStore, parse_judgments
from lexweave.streaming.windows import request_counts


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_components(spark):
    e = spark.createDataFrame([("b", "c"), ("a", "b"), ("x", "y"), (None, "z"), ("q", "q")], "src string, dst string")
    assert pairs(connected_components(e)) == [("a", "a"), ("b", "a"), ("c", "a"), ("q", "q"), ("x", "x"), ("y", "x")]
    assert pairs(connected_components(e.limit(0))) == []


def test_directions(spark):
    r = spark.createDataFrame([("a", "b", "is_subordinate"), ("b", "a", "is_subordinate"), ("d", "c", "is_subordinate"), ("e", "f", "equivalent"), ("f", "e", "related")], "left_id string, right_id string, relation string")
    assert pairs(graph.merge_directions(r)) == [("a", "b", "related"), ("d", "c", "is_subordinate"), ("e", "f", "equivalent")]


def test_features(spark):
    one = spark.createDataFrame([("a", "z"), ("b", "z")], "node string, hub string")
    assert round(graph.adamic_adar(one).first()["score"], 6) == 0.763710
    sets = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 2), ("b", 3)], "node string, member int")
    assert round(graph.common_ratio(sets).first()["score"], 6) == 0.666667
    bridge = spark.createDataFrame([("a", "b", 3), ("c", "d", 7)], "left string, right string, n long")
    assert round(graph.bridge_score(bridge).filter("left = 'a'").first()["score"], 6) == 0.666667


def test_merge(spark):
    n1 = spark.createDataFrame([("a", "1"), ("b", "1")], "id string, v string")
    n2 = spark.createDataFrame([("b", "2")], "id string, v string")
    assert pairs(graph.merge_nodes(n1, n2)) == [("a", "1"), ("b", "2")]
    e = "source string, target string, type string, v string"
    assert pairs(graph.merge_edges(spark.createDataFrame([("a", "b", "T", "1")], e), spark.createDataFrame([("a", "b", "T", "2")], e))) == [("a", "b", "T", "1")]


def test_similarity(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None)], "id long, vector array<double>")
    assert [(r["left_id"], r["right_id"]) for r in similarity.similarity_join(v, v, 0.9, triangular=True).collect()] == [(1, 2)]
    assert similarity.similarity_join(v, v, -1.0, k=1).count() == 3


def test_store(spark, tmp_path):
    store = ArtifactStore(spark, f"file://{tmp_path}/s")
    assert store.read("relations").count() == 0
    store.write("relations", spark.createDataFrame([("a", "b", "related", 1)], "left_id string, right_id string, relation string, more int"))
    assert pairs(store.read("relations")) == [("a", "b", "related")]
    doc = spark.createDataFrame([(1, "<doc><title>T</title><case_no>7</case_no><court>C</court><citation>x</citation><citation>y</citation></doc>")], "id int, xml string")
    assert tuple(parse_judgments(doc).first()) == (1, "T", "7", "C", ["x", "y"])


def test_stream(spark, tmp_path):
    rows = spark.createDataFrame([("2024-01-01 00:00:01", "a"), ("2024-01-01 00:00:05", "a"), ("2024-01-01 00:05:00", "b")], "s string, event_type string").selectExpr("to_timestamp(s) AS ts", "event_type")
    rows.write.parquet(f"{tmp_path}/in")
    batch = request_counts(rows, "10 seconds", "10 seconds")
    assert sorted(r["n"] for r in batch.collect()) == [1, 2]
    q = request_counts(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"), "10 seconds", "10 seconds").writeStream.format("memory").queryName("counts").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["n"] for r in spark.sql("select * from counts").collect()) == [1, 2]


def test_similarity_in_many_blocks(spark, monkeypatch):
    import random

    r = random.Random(3)
    rows = [(i, [float(r.choice([0, 1, 2])) for _ in range(4)] + [1.0]) for i in r.sample(range(1000), 90)] + [(2000, [1.0])]
    v = spark.createDataFrame(rows, "id long, vector array<double>")
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5
    near = {i: sorted((-round(cos(a, b), 9), j) for j, b in rows if i != j and len(a) == len(b)) for i, a in rows}
    monkeypatch.setattr(similarity, "FILE_ROWS", 16)
    monkeypatch.setattr(similarity, "BLOCK", 8)
    spark.conf.set("spark.sql.files.openCostInBytes", 1 << 30)
    try:
        best = similarity.similarity_join(v, v, -1.0, k=3)
        plan = best._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" in plan and plan.count("Exchange") == 1  # blocks are copied by no shuffle; the best of rows meet in one
        assert {(x["left_id"], x["right_id"]) for x in best.collect()} == {(i, j) for i, n in near.items() for _, j in n[:3]}
        assert {(x["left_id"], x["right_id"]) for x in similarity.similarity_join(v, v, 0.9037, triangular=True).collect()} == {(i, j) for i, n in near.items() for s, j in n if i < j and -s >= 0.9037}
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_table_that_meets_itself_is_packed_once(spark, monkeypatch):
    v = spark.createDataFrame([(i, [1.0, float(i % 3)]) for i in range(9)], "id long, vector array<double>")
    made = []
    monkeypatch.setattr(similarity, "stash", lambda df, name, real=similarity.stash: (made.append(name), real(df, name))[1])
    own = pairs(similarity.similarity_join(v, v, 0.99, triangular=True))
    assert made == ["left-blocks"] and len(own) == 9
    assert own == pairs(similarity.similarity_join(v, v.select("id", "vector"), 0.99, triangular=True)) and made[1:] == ["left-blocks", "right-blocks"]


def test_components_of_many_shapes(spark, monkeypatch):
    import random

    from lexweave.operators import components

    r = random.Random(8)
    name = {i: f"{r.randrange(10**6)}-{i}" for i in range(300)}
    forest = [(i, i // 10) for i in range(10, 100)]
    path = [(i, i + 1) for i in range(100, 140)]
    loose = [(r.randrange(140, 300), r.randrange(140, 300)) for _ in range(130)]
    settled = []
    monkeypatch.setattr(components, "_settled", lambda links, real=components._settled: (settled.append(links.count()), real(links))[1])
    for rows, names in ((forest, name), (path, {i: f"{i}" for i in range(300)}), (forest + path + loose + loose[:9], name), ([], name)):
        root = {names[x]: names[x] for e in rows for x in e}
        for _ in range(len(root)):
            for a, b in rows:
                root[names[a]] = root[names[b]] = min(root[names[a]], root[names[b]])
        e = spark.createDataFrame([(names[a], names[b]) for a, b in rows], "src string, dst string")
        assert dict(pairs(connected_components(e))) == root
    assert len(settled) >= 1 and max(settled) < len(forest + path + loose)  # a path is left to the labels
    stashed = []
    monkeypatch.setattr(components, "stash", lambda df, name, real=components.stash: (stashed.append(name), real(df, name))[1])
    e = spark.createDataFrame([(f"c{i // 10}", f"o{i}") for i in range(200)] + [("n0", f"c{i}") for i in range(20)], "src string, dst string")
    assert {x for _, x in pairs(connected_components(e))} == {"c0"}
    assert "cc-lower" not in stashed  # a forest takes no round of labels over all nodes
