"""File sources and sinks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MODES = ("errorifexists", "append", "overwrite", "ignore")


def read_source(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None, **options
) -> DataFrame:
    """Read csv, json, parquet or another installed format; a given schema replaces inference."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _filesystem(spark, path)
    return fs.exists(p)


def has_data(spark: SparkSession, path: str) -> bool:
    """Does a table's folder hold anything to read? A job that stopped early may leave a folder without."""
    fs, p = _filesystem(spark, path)
    return fs.exists(p) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = _filesystem(spark, path)
    fs.delete(p, True)


def move_path(spark: SparkSession, old: str, new: str) -> None:
    fs, source = _filesystem(spark, old)
    target = spark._jvm.org.apache.hadoop.fs.Path(new)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"cannot move {old} to {new}")


def write_sink(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    **options,
) -> None:
    """Write a folder of part files.

    Overwriting writes next to the target first and swaps the folders only when that has succeeded, so a
    failed job leaves the old data, and a frame may overwrite the path it is read from. Between the two renames of the swap there is no
    table for a moment; ``bankops.sources.journal.publish`` has no such moment, for readers that follow its pointer. Rows of a
    partitioned write are first gathered by partition value, of which adaptive execution splits large ones
    and merges small ones: few files, and no task holding a heavy value whole.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")

    rows = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df

    def save(to: str, how: str) -> None:
        writer = rows.write.format(fmt).options(**options).mode(how)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(to)

    spark = df.sparkSession
    if mode != "overwrite" or not path_exists(spark, path):
        save(path, mode)
        return
    mark = uuid.uuid4().hex
    staged, old = f"{path.rstrip('/')}__new_{mark}", f"{path.rstrip('/')}__old_{mark}"
    save(staged, "errorifexists")
    move_path(spark, path, old)
    move_path(spark, staged, path)
    remove_path(spark, old)
    # the session caches file listings by path
    spark.catalog.refreshByPath(path)
