"""Everyday verbs: projection, filter, join, sort, set operations, dedup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c) for c in cols])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def add_columns(df: DataFrame, cols: Mapping[str, Column]) -> DataFrame:
    """Add or replace several columns in one projection."""
    return df.withColumns(dict(cols))


WHOLE_NUMBERS = ("int", "integer", "long", "bigint", "short", "smallint", "byte", "tinyint")


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Cast by name; without ``strict`` a value that does not fit becomes NULL instead of an error.

    A text that cannot be a whole number is told by a pattern first: a failed cast costs far more than a failed match.
    """
    kinds = dict(df.dtypes)

    def cast(c: str, to: str) -> Column:
        if strict:
            return F.col(c).cast(to)
        lenient = F.col(c).try_cast(to)
        if kinds[c] == "string" and to in WHOLE_NUMBERS:
            return F.when(F.col(c).rlike(r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$"), lenient)
        return lenient

    return df.withColumns({c: cast(c, t) for c, t in types.items()})


def join_on(left: DataFrame, right: DataFrame, on: Mapping[str, str], how: str = "inner") -> DataFrame:
    """Equi join on differently named keys, left name to right name; both key columns stay."""
    pairs = [left[a] == right[b] for a, b in on.items()]
    return left.join(right, reduce(lambda a, b: a & b, pairs), how)


def keep_known(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``; the key list stays distributed."""
    return df.join(keys.select(*on), list(on), "left_semi")


def drop_known(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys.select(*on), list(on), "left_anti")


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First k rows of a total order; every task keeps only its own k."""
    return df.orderBy(*order).limit(k)


def union_rows(*frames: DataFrame, by_name: bool = True) -> DataFrame:
    """Stack frames and keep duplicates."""
    return reduce(DataFrame.unionByName if by_name else DataFrame.union, frames)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key of a total order.

    Spark cuts each task's rows to one per key before the shuffle, so a heavy key stays small.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", first).filter("_rank = 1").drop("_rank")
