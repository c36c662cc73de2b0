from pyspark.sql import functions as F

from lexweave.functions import labels


def test_nulls_and_edges(spark):
    df = spark.createDataFrame([(None, None), ("", []), (" 依法 ", ["依法", None, " 合同 ", "合同", "字", "长" * 11])], "s string, a array<string>")
    s, a = F.col("s"), F.col("a")
    got = df.select(labels.status(s, s), labels.document_role(s), labels.revision_event(s), labels.is_yes(s), labels.prompt_id(s), labels.keyword_filter(a), labels.document_title(s), labels.file_title(s)).collect()
    assert tuple(got[0]) == ("effective", "substantive", "other", False, None, [], None, None)
    assert tuple(got[1]) == ("effective", "substantive", "other", False, None, [], "", "untitled")
    assert tuple(got[2]) == ("effective", "substantive", "other", False, None, ["合同"], "《依法》", "依法")


def test_first_bytes(spark):
    text = "a法\U0001f642. 律"
    df = spark.createDataFrame([(text,)], "s string")
    for n in range(16):
        want = text if len(text.encode()) <= n else text.encode()[:n].decode(errors="ignore").rstrip(". ")
        assert df.select(labels.first_bytes("s", n)).first()[0] == want


def test_penalty_and_ids(spark):
    df = spark.createDataFrame([("中华人民共和国刑法", ["", "刑法"]), ("民法典", ["刑法"]), ("民法典", None), (None, ["刑法"])], "n string, c array<string>")
    assert [round(r[0], 6) for r in df.select(labels.cited_penalty(F.lit(2.0), F.col("n"), F.col("c"))).collect()] == [1.4, 2.0, 2.0, 2.0]
    df = spark.createDataFrame([(None,), ("{",), ('["a"]',), ('["b"]',)], "s string")
    assert [r[0] for r in df.select(labels.append_id(F.col("s"), F.lit("b"))).collect()] == ['["b"]', '["b"]', '["a","b"]', '["b"]']
