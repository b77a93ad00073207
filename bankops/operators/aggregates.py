"""Grouped and global aggregates, skew handling, target encoding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankops.functions.columns import share
from bankops.operators.heavy import find_heavy
from bankops.operators.skew import part_by, same_keys

_REDUCE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
_FIRST = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: count, mean, sample deviation, min, max, from one pass."""
    one = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("n"),
                F.avg(c).cast("double").alias("mean"),
                F.stddev(c).cast("double").alias("stddev"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(f"_{i}")
            for i, c in enumerate(cols)
        ]
    )
    return one.select(F.inline(F.array(*[f"_{i}" for i in range(len(cols))])))


def text_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per text column: values, distinct values, first and last in order, shortest and longest length in characters."""
    one = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"), F.count(c).alias("n"), F.count_distinct(c).alias("n_distinct"), F.min(c).alias("min"), F.max(c).alias("max"),
                F.min(F.length(c)).cast("long").alias("min_length"), F.max(F.length(c)).cast("long").alias("max_length"),
            ).alias(f"_{i}")
            for i, c in enumerate(cols)
        ]
    )
    return one.select(F.inline(F.array(*[f"_{i}" for i in range(len(cols))])))


def class_ratio(df: DataFrame, condition: Column, name: str = "ratio") -> DataFrame:
    """Share of rows that meet the condition, in one pass."""
    return df.agg(share(F.count_if(condition), F.count(F.lit(1))).alias(name))


def salted_agg(
    df: DataFrame, keys: Sequence[str], aggs: Mapping[str, tuple[str, Column]], salt_from: Sequence[str], buckets: int
) -> DataFrame:
    """Two-stage aggregate: per (key, salt), then per key.

    ``aggs`` maps a name to (sum | count | min | max, column). The salt is a hash of row columns, so a
    retried task computes the same one.
    """
    salt = F.pmod(F.xxhash64(*salt_from), F.lit(buckets)).alias("_salt")
    parts = df.groupBy(*keys, salt).agg(*[_FIRST[kind](c).alias(n) for n, (kind, c) in aggs.items()])
    return parts.groupBy(*keys).agg(*[_REDUCE[kind](n).alias(n) for n, (kind, _) in aggs.items()])


def hot_key_split(df: DataFrame, key: str, threshold: int) -> tuple[DataFrame, DataFrame]:
    """(rows of keys above ``threshold`` rows, all other rows)."""
    names, _ = find_heavy(df, [key], threshold)
    if names is None:
        return df.limit(0), df
    rest, hot = part_by(df, names, [key])
    return hot, rest


def target_encode_fit(train: DataFrame, col: str, label: str | Column, k: float = 0.0) -> DataFrame:
    """Encoding table: category, encoding.

    ``(sum_y + k * global_mean) / (n + k)``; k = 0 is the plain mean. The label is summed as it is
    given: whole numbers and decimals exactly, floating numbers as Spark adds them.
    """
    per = train.groupBy(col).agg(F.sum(label).alias("_s"), F.count(label).alias("_n"))
    if k == 0:
        return per.select(col, share(F.col("_s"), F.col("_n")).alias("encoding"))
    overall = global_mean(train, label)
    smooth = (F.col("_s").cast("double") + k * F.lit(overall)) / (F.col("_n") + k)
    return per.select(col, smooth.alias("encoding"))


def global_mean(df: DataFrame, label: str | Column) -> float | None:
    return df.agg(share(F.sum(label), F.count(label))).first()[0]


def target_encode_apply(df: DataFrame, encoding: DataFrame, col: str, default: float | None = None) -> DataFrame:
    """Add ``encoding``; a category the table does not know gets ``default``."""
    table = encoding.select(F.col(col).alias(f"_e_{col}"), F.col("encoding").alias("_encoding"))
    joined = df.join(table, same_keys(df, table, [col], "_e_"), "left")
    return joined.select(*df.columns, F.coalesce("_encoding", F.lit(default)).cast("double").alias("encoding"))
