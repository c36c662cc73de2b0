"""Written tables: how many files they take."""

from pathlib import Path

from lexweave.operators.components import connected_components
from lexweave.plans import cut


def test_steps_over_few_rows_write_few_files(spark, monkeypatch):
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    seen, real = {}, cut.stash

    def noted(df, name):
        out = real(df, name)
        seen[name] = out._written_at
        return out

    monkeypatch.setattr("lexweave.operators.components.stash", noted)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 90)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = connected_components(spark.range(2000).selectExpr("id AS src", "id - id % 7 AS dst"))
        assert {(r.node, r.component) for r in found.collect()} == {(k, k - k % 7) for k in range(2000)}
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    folder = Path(seen["cc-step"].removeprefix("file://"))
    # before: a file for each of 90 partitions, each with a checksum file beside it
    assert 1 <= len(list(folder.glob("part-*"))) <= 2 * spark.sparkContext.defaultParallelism < 90
    assert not list(folder.glob(".*.crc"))
