from pyspark.sql import functions as F

from lexweave.functions import statute


def one(spark, text, col):
    return spark.createDataFrame([(text,)], "s string").select(col).first()[0]


def test_sentences(spark):
    cases = {
        "甲。乙；丙": ["甲。", "乙；", "丙"],
        "称“甲。乙”者。丙": ["称“甲。乙”者。", "丙"],
        'a "b! c" d! e': ['a "b! c" d!', "e"],
        "《甲“乙。”丙。》丁。戊": ["《甲“乙。”丙。》丁。", "戊"],
        "“未完。甲。": ["“未完。甲。"],
        "”甲。乙": ["”甲。", "乙"],
        "": [],
        " 。 ": ["。"],
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "s string")
    assert {r[0]: r[1] for r in df.select("s", statute.sentences("s")).collect()} == {**cases, None: None}


def test_marks(spark):
    assert one(spark, "依照本法第三条", statute.marked("s", "2", "4")) == "依照[T]本法[/T]第三条"
    assert one(spark, "依照本法第三条", statute.marked("s", "2", "9")) == "依照本法第三条"
    assert one(spark, "依照本法第三条", statute.marked("s", "4", "7", "'本法第四条'")) == "依照[T]本法第四条[/T]"
    assert one(spark, "本法", statute.marked("s", "0", "1", "'甲'")) == "[T]甲[/T]法"
    assert one(spark, None, statute.marked("s", "0", "1")) is None
    assert one(spark, "a[T] x\ny [/T]b", statute.marked_target(F.col("s"))) == "x\ny"
    assert one(spark, "a[T]x[/T]b", statute.has_one_mark(F.col("s"))) and not one(spark, "a[T]x[/T][T]", statute.has_one_mark(F.col("s")))


def test_labels_and_aliases(spark):
    assert one(spark, "第三条第（二）项和第五条", statute.tail_label(F.col("s"), "条")) == "第五条"
    assert one(spark, "无", statute.tail_label(F.col("s"), "条")) == ""
    got = one(spark, "《中华人民共和国刑法》（以下简称刑法）。《民法典》 (简称“民法”)。《旧法》修正案（以下简称新法）", statute.aliases(F.col("s")))
    assert {r["alias"]: r["title"] for r in got} == {"刑法": "《中华人民共和国刑法》", "民法": "《民法典》", "新法": "《旧法》"}
    assert one(spark, "《甲》（以下简称法）。《乙》（以下简称法）", statute.aliases(F.col("s"))) == [("法", "《乙》")]
    # without an end mark between them, the looser pattern comes last and starts at the earlier title
    assert one(spark, "《甲》和《乙》（以下简称法）", statute.aliases(F.col("s"))) == [("法", "《甲》")]
    assert one(spark, "无", statute.aliases(F.col("s"))) == []


def test_aliases_search_a_text_once(spark):
    plan = spark.createDataFrame([("《甲》（以下简称法）",)], "s string").select(statute.aliases(F.col("s")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") <= 16  # it was 96: all patterns again for every pair
    assert spark.sql("SELECT cast(null AS string) AS s").select(statute.aliases(F.col("s")).alias("x")).first()["x"] is None
