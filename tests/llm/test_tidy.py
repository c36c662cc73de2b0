"""What a Python worker keeps after a task, and an executor's JVM after a stage."""

import pyarrow as pa
import public_tokenizers

import corpus_pipeline
from lexweave.llm import mixing, ngramjoin
from lexweave.llm.common import tidy
from lexweave.llm.tokens import ChunkEncoder


def test_a_task_leaves_no_words_behind():
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["one two three four five six", None]})
    plain = list(ngramjoin._sign([batch]))
    assert ngramjoin._words
    assert list(tidy(ngramjoin._sign, ngramjoin._forget)([batch])) == plain
    assert not ngramjoin._words


def test_the_older_generation_goes_and_ids_stay():
    e = ChunkEncoder(public_tokenizers.path("word_bpe_49k.json"), "word", memo=3)
    texts = ["a few words in here", "and some more of them", "a few words in here"]
    before = [e.encode(t) for t in texts]
    assert e.known.older
    e.forget_older()
    assert not e.known.older and [e.encode(t) for t in texts] == before


def whole_collections(spark) -> int:
    """How often this JVM, in local mode the only executor, has collected its whole heap."""
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    return sum(b.getCollectionCount() for b in beans if "Young" not in b.getName() and "Concurrent" not in b.getName())


def test_every_stage_begins_and_writes_with_small_heaps(spark):
    seen, before = [], whole_collections(spark)
    assert all(hasattr(stage, "__wrapped__") for _, stage in corpus_pipeline.STAGES)
    assert corpus_pipeline.lean(lambda spark, docs, d: seen.append(whole_collections(spark)) or docs)(spark, "docs", "") == "docs"
    assert seen[0] > before and whole_collections(spark) > seen[0]


def test_tables_of_cells_are_few_files(spark, monkeypatch):
    """Partitions are files, and each file of a local store costs forks of the JVM."""
    found = {}
    monkeypatch.setattr(mixing, "stash", lambda df, name, stash=mixing.stash: found.setdefault(name, df.rdd.getNumPartitions()) and stash(df, name))
    docs = spark.createDataFrame([(k, "word " * k, "en", f"s{k % 3}") for k in range(1, 40)], "doc_id long, text string, lang string, source string")
    least, was = 2 * spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.shuffle.partitions")
    for key, value in (("spark.sql.shuffle.partitions", 50), ("spark.sql.adaptive.coalescePartitions.enabled", "false")):
        spark.conf.set(key, value)
    try:
        mixing.sample(docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {n: k for n, k in found.items() if n != "token-cells" and k > least} == {} and len(found) == 6
