"""Account-level window operators.

``tie`` is a unique column that makes the time order total. Heavy accounts are split as described in
``bankops.operators.skew``; ``hot_rows`` sets the row count above which that happens.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankops.functions.columns import MICROS_PER_DAY, MICROS_PER_SECOND, is_night, micros, share
from bankops.operators.skew import (
    Aggs,
    as_types,
    hot_limit,
    over_range,
    over_rows,
    over_rows_hot,
    running,
    running_hot,
    split_hot,
)

AXIS = "_axis"
_ROW_FUNCTIONS = {
    "sum": F.sum,
    "stddev": F.stddev,
    "min": F.min,
    "max": F.max,
    "count": F.count,
}


def as_list(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def over_days(
    df: DataFrame,
    key: str | Sequence[str],
    ts: str,
    days: float | Mapping[str, float],
    aggs: Aggs,
    tie: str,
    hot_rows: int | None = None,
) -> DataFrame:
    """Several aggregates over the last ``days`` days, both ends included; one length, or one per aggregate."""
    timed = df.withColumn(AXIS, micros(ts))
    if isinstance(days, Mapping):
        span = {n: round(d * MICROS_PER_DAY) for n, d in days.items()}
    else:
        span = round(days * MICROS_PER_DAY)
    return over_range(timed, as_list(key), AXIS, span, aggs, tie, hot_rows=hot_rows).drop(AXIS)


def rolling(
    df: DataFrame,
    key: str | Sequence[str],
    ts: str | None,
    value: str | Column,
    fn: str,
    tie: str | None,
    name: str,
    rows: int | None = None,
    days: float | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """One aggregate over the last ``rows`` rows or the last ``days`` days of a key.

    A frame without an order has no defined content and is refused.
    """
    if ts is None or tie is None:
        raise ValueError("a rolling frame needs a time column and a tie column")
    if (rows is None) == (days is None):
        raise ValueError("give exactly one of rows and days")
    value = F.col(value) if isinstance(value, str) else value
    # a mean is an exact sum over a count, so it does not depend on the summing order
    parts = {"_sum": ("sum", value), "_count": ("count", value)} if fn == "avg" else {name: (fn, value)}
    if rows is not None:
        out = over_rows(
            df,
            as_list(key),
            [F.col(ts), F.col(tie)],
            rows - 1,
            0,
            lambda w: {n: _ROW_FUNCTIONS[f](c).over(w.rowsBetween(1 - rows, 0)) for n, (f, c) in parts.items()},
            hot_rows,
        )
    else:
        out = over_days(df, key, ts, days, parts, tie, hot_rows)
    if fn != "avg":
        return out
    return out.select(*df.columns, share(F.col("_sum"), F.col("_count")).alias(name))


def night_count(
    df: DataFrame, key, ts: str, tie: str, name: str = "night_count", start: int = 0, end: int = 6,
    hot_rows: int | None = None,
) -> DataFrame:
    """Transactions between the two hours, from the key's first row to the current one."""
    night = F.when(is_night(ts, start, end), 1).otherwise(0).cast("long")
    return running(df, as_list(key), [F.col(ts), F.col(tie)], {name: ("sum", night)}, hot_rows)


def ratio_in_window(
    df: DataFrame, key, ts: str, predicate: Column, days: float, tie: str, name: str,
    hot_rows: int | None = None,
) -> DataFrame:
    """Share of the rows in the frame for which ``predicate`` holds."""
    parts = {"_hits": ("sum", F.when(predicate, 1).otherwise(0).cast("long")), "_all": ("count", F.lit(1))}
    out = over_days(df, key, ts, days, parts, tie, hot_rows)
    return out.withColumn(name, share(F.col("_hits"), F.col("_all"))).drop(*parts)


def shifted(
    df: DataFrame, key, ts: str, cols: Mapping[str, str], tie: str, offset: int = -1,
    hot_rows: int | None = None,
) -> DataFrame:
    """Values of the row ``offset`` places away (negative: earlier); ``cols`` maps new name to column."""
    fn, n = (F.lag, -offset) if offset < 0 else (F.lead, offset)
    before, after = (n, 0) if offset < 0 else (0, n)
    return over_rows(
        df,
        as_list(key),
        [F.col(ts), F.col(tie)],
        before,
        after,
        lambda w: {new: fn(old, n).over(w) for new, old in cols.items()},
        hot_rows,
    )


def previous(df: DataFrame, key, ts: str, cols: Mapping[str, str], tie: str, hot_rows: int | None = None) -> DataFrame:
    return shifted(df, key, ts, cols, tie, -1, hot_rows)


def gap_seconds(df: DataFrame, key, ts: str, tie: str, name: str = "gap_seconds", hot_rows: int | None = None) -> DataFrame:
    """Seconds since the key's previous row, with fractions; NULL on its first row."""
    timed = df.withColumn(AXIS, micros(ts))
    out = previous(timed, key, ts, {"_before": AXIS}, tie, hot_rows)
    gap = (F.col(AXIS) - F.col("_before")) / MICROS_PER_SECOND
    return out.withColumn(name, gap).drop(AXIS, "_before")


def hop_flag(
    df: DataFrame, key, ts: str, place: str, tie: str, max_gap: float = 3600, name: str = "hop",
    hot_rows: int | None = None,
) -> DataFrame:
    """1 when the place differs from the previous row's and less than ``max_gap`` seconds passed."""
    timed = df.withColumn(AXIS, micros(ts))
    out = previous(timed, key, ts, {"_before": AXIS, "_place": place}, tie, hot_rows)
    near = (F.col(AXIS) - F.col("_before")) < max_gap * MICROS_PER_SECOND
    hop = F.when((F.col(place) != F.col("_place")) & near, 1).otherwise(0)
    return out.withColumn(name, hop).drop(AXIS, "_before", "_place")


def running_sum(
    df: DataFrame, key: str | Sequence[str] | None, order: str, value: str | Column, tie: str,
    name: str = "running_sum", hot_rows: int | None = None,
) -> DataFrame:
    """Sum from the first row to the current one; without a key over the whole table, still distributed."""
    value = F.col(value) if isinstance(value, str) else value
    keys = [] if key is None else as_list(key)
    return running(df, keys, [F.col(order), F.col(tie)], {name: ("sum", value)}, hot_rows)


def rank_in_group(
    df: DataFrame, key, by: str, kind: str, tie: str, name: str, descending: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """``row_number``, ``rank`` or ``dense_rank`` within a key."""
    keys = as_list(key)
    first = F.col(by).desc() if descending else F.col(by).asc()
    total = [first, F.col(tie)]
    if kind == "row_number":
        out = running(df, keys, total, {name: ("count", F.lit(1))}, hot_rows)
        return out.withColumn(name, F.col(name).cast("int"))
    rest, hot, chunks = split_hot(df, keys, hot_rows)
    fn = {"rank": F.rank, "dense_rank": F.dense_rank}[kind]
    plain = rest.withColumn(name, fn().over(Window.partitionBy(*keys).orderBy(first)))
    if hot is None:
        return plain
    # a value's first row carries its rank; later equal rows take it over
    numbered = running_hot(hot, keys, total, {"_row": ("count", F.lit(1))}, chunks)
    marked = over_rows_hot(
        numbered, keys, total, 1, 0,
        lambda w: {"_new": (F.col("_row") == 1) | ~F.col(by).eqNullSafe(F.lag(by).over(w))},
        chunks, hot_limit(df, hot_rows),
    )
    if kind == "rank":
        agg = ("max", F.when(F.col("_new"), F.col("_row")))
    else:
        agg = ("sum", F.col("_new").cast("int").cast("long"))
    done = running_hot(marked, keys, total, {name: agg}, chunks).select(*plain.columns)
    return plain.unionByName(as_types(done, plain))
