"""The queries of this package, each over the whole of its table, and their SQL where SQL can say the same."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import bankops

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_shipped: set[str] = set()
ARROW_BYTES = "16m"  # of an Arrow batch; a task holds one or two beside what it makes of them


def ship(spark: SparkSession) -> None:
    """Give executors this package, as ``--py-files`` would, and bound Arrow batches; once for an application."""
    sc = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    if sc.applicationId in _shipped:
        return
    root = Path(bankops.__file__).parent
    file = Path(tempfile.mkdtemp(prefix="bankops-ship-")) / "bankops_package.zip"
    with zipfile.ZipFile(file, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(file))
    _shipped.add(sc.applicationId)


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, folder) -> DataFrame`` under ``key``."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return fn(spark, folder)

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
