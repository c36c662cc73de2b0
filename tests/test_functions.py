from pyspark.sql import functions as F

from lexweave.functions import numerals, text, vectors


def values(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_numerals(spark):
    cases = {"二百二十五": 225, "十": 10, "一百零三": 103, "两千": 2000, "一万零五": 10005, "12": 12}
    got = values(spark, [(k,) for k in cases], "s string", "s", numerals.from_chinese("s"))
    assert dict(got) == cases
    assert values(spark, [("x",), (None,)], "s string", numerals.from_chinese("s")) == [(None,), (None,)]
    back = {10: "十", 11: "十一", 101: "一百零一", 110: "一百一十", 225: "二百二十五", 10005: "一万零五", 12000: "一万二千"}
    assert dict(values(spark, [(k,) for k in back], "n long", "n", numerals.to_chinese("n"))) == back
    assert values(spark, [("第二百二十五条之一",), ("第三条",), ("附件",)], "s string", numerals.article_key("s")) == [("0225-01",), ("0003",), (None,)]


def test_text(spark):
    assert values(spark, [(" Hello World! ",), (None,)], "s string", text.slug(F.col("s"))) == [("hello-world",), (None,)]
    assert values(spark, [("2020年3月5日",), ("2020-3-5",), ("2020/3/5",)], "s string", text.iso_date(F.col("s"))) == [("2020-03-05",), ("2020-03-05",), ("2020/3/5",)]
    got = values(spark, [("中华人民共和国刑法（2020年修正文本）",)], "s string", text.title_variants(F.col("s")))[0][0]
    assert set(got) == {"中华人民共和国刑法（2020年修正文本）", "中华人民共和国刑法", "刑法", "刑法（2020年修正文本）"}


def test_vectors(spark):
    rows = [([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 2.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0], [1.0, 1.0])]
    assert [r[0] for r in values(spark, rows, "a array<double>, b array<double>", vectors.cosine(F.col("a"), F.col("b")))] == [1.0, 0.0, 0.0, 0.0]
