"""Catalog tables, views and inline rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def create_table(
    spark: SparkSession, name: str, columns: str, path: str | None = None, partition_by: Sequence[str] = ()
) -> None:
    """Create a Parquet table from a DDL column list unless it is there already."""
    partitions = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{partitions}"
        + (" LOCATION :path" if path else ""),
        args={"path": path} if path else None,
    )


def write_table(df: DataFrame, name: str, mode: str = "errorifexists", path: str | None = None) -> None:
    writer = df.write.format("parquet").mode(mode)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def truncate_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def inline_rows(spark: SparkSession, rows: Sequence, schema: StructType | str | Sequence[str] | None = None) -> DataFrame:
    """A small frame from typed-in rows: lists, tuples or dicts; names, DDL, StructType or inferred.

    Handed over as an Arrow table, so Spark knows its size and can choose a broadcast join by it.
    """
    fields = spark.createDataFrame(rows, schema).schema

    def value(row, i: int, name: str):
        if isinstance(row, dict):
            return row.get(name)
        return row[i] if isinstance(row, (list, tuple)) else row

    columns = [[value(r, i, f.name) for r in rows] for i, f in enumerate(fields)]
    types = to_arrow_schema(fields)
    return spark.createDataFrame(pa.table([pa.array(c, t.type) for c, t in zip(columns, types)], schema=types), fields)


def id_range(spark: SparkSession, start: int, end: int, step: int = 1) -> DataFrame:
    return spark.range(start, end, step)


def query_view(df: DataFrame, view: str, sql: str, args: Mapping | None = None, shared: bool = False) -> DataFrame:
    """Register the frame as a session (or global) view and run one query with bound parameters."""
    if shared:
        df.createOrReplaceGlobalTempView(view)
    else:
        df.createOrReplaceTempView(view)
    return df.sparkSession.sql(sql, args=dict(args or {}))
