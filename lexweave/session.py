"""Sessions, and shipping of this package to the Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def local_session(cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName("lexweave")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", os.environ.get("LEXWEAVE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> None:
    """Give every Python worker this package, once per application; Spark's own file server carries it."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        # texts can be long: a batch of the default size would hold ten times the memory
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    folder = Path(tempfile.mkdtemp(prefix="lexweave-ship-"))
    with zipfile.ZipFile(path := folder / "lexweave_package.zip", "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)
