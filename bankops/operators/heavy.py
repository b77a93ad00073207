"""Keys that hold very many rows: a bounded sketch of counters says where they can be, exact counts of the few say which.

Every row adds one to the counter that its key's hash names. Tasks add up their own rows first and hand on at most ``counters``
numbers, whatever the number of keys, and the tasks' counters add up in any order. A counter holds the rows of all its keys, so
it is never below any of them: a key above a bound lies in a counter above it, and no such key is missed. Beyond its
own rows a key's counter holds ``rows / counters`` others on average. Only rows of counters above the bound are counted by key,
so false ones go and counts are exact. There are at most ``rows / bound`` such counters and keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankops.session import BROADCAST_ROWS, durable

COUNTERS = 1 << 16
MOST_COUNTERS = 1 << 24
# searches kept: a frame's features ask for the same keys one after the other
KEPT_SEARCHES = 32
_searches: list[tuple] = []


def counter_of(keys: Sequence[str], counters: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(counters))


def full_counters(df: DataFrame, keys: Sequence[str], least: float, counters: int = COUNTERS) -> tuple[list[int], int]:
    """(counters above ``least`` rows, number of counters used), in one job.

    More counters are taken when so many are full that the rows of light keys must have filled them.
    """
    sketch = df.groupBy(counter_of(keys, counters).alias("_counter")).agg(F.count(F.lit(1)).alias("_n"))
    full = F.when(F.col("_n") > least, F.col("_counter"))
    above, rows = sketch.agg(F.collect_list(full), F.sum("_n")).first()
    needed = min(MOST_COUNTERS, 1 << max(0, int(8 * (rows or 0) / max(least, 1)).bit_length()))
    if len(above) > counters // 4 and needed > counters:
        return full_counters(df, keys, least, needed)
    return above, counters


def heavy_keys(df: DataFrame, keys: Sequence[str], least: float, counters: int = COUNTERS) -> DataFrame | None:
    """(keys, ``_rows``) of the keys with more than ``least`` rows, counted exactly; None if no counter is full.

    Null is a key like any other. An empty table has no heavy keys.
    """
    above, used = full_counters(df, keys, least, counters)
    if not above:
        return None
    listed = df.sparkSession.createDataFrame([(c,) for c in above], "_counter long")
    some = df.select(*keys).join(F.broadcast(listed), counter_of(keys, used) == F.col("_counter"), "left_semi")
    return some.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > least)


def same_search(df: DataFrame, keys: Sequence[str], least: float):
    """The kept search over the same rows, and the plan that says so: what the optimizer leaves of the frame for its keys alone."""
    plan = df.select(*keys)._jdf.queryExecution().optimizedPlan()
    session = df.sparkSession
    for kept in _searches:
        if kept[0] is session and kept[1] == list(keys) and kept[2] == least and plan.sameResult(kept[3]):
            return kept, plan
    return None, plan


def find_heavy(df: DataFrame, keys: Sequence[str], least: float, prefix: str = "_hot_") -> tuple[DataFrame | None, int]:
    """(heavy keys under prefixed names or None, rows they hold), found once for all frames with the same keys in the same rows.

    Features are added to a frame as columns, and its keys stay what they were; the optimizer drops the columns, and equal plans share a
    search. A table that was overwritten under its path since may be answered by an earlier search. That costs time at most: every use
    splits rows by the listed keys and treats both sides exactly.
    """
    kept, plan = same_search(df, keys, least)
    if kept is None:
        found = heavy_keys(df, keys, least)
        rows = 0
        if found is not None:
            found = durable(found.withColumnsRenamed({k: f"{prefix}{k}" for k in keys}))
            n_keys, rows = found.agg(F.count(F.lit(1)), F.sum("_rows")).first()
            names = found.drop("_rows")
            found = None if not n_keys else F.broadcast(names) if n_keys <= BROADCAST_ROWS else names
        kept = (df.sparkSession, list(keys), least, plan, prefix, found, rows or 0)
        _searches.insert(0, kept)
        del _searches[KEPT_SEARCHES:]
    found = kept[5]
    if found is not None and kept[4] != prefix:
        found = found.withColumnsRenamed({f"{kept[4]}{k}": f"{prefix}{k}" for k in keys})
    return found, kept[6]


def carry_search(out: DataFrame, df: DataFrame, keys: Sequence[str], least: float) -> DataFrame:
    """``out``, which has the rows of ``df`` with more columns: the search of ``df`` is kept as its own too."""
    kept, _ = same_search(df, keys, least)
    if kept is not None and kept[5] is not None:
        again, plan = same_search(out, keys, least)
        if again is None:
            _searches.insert(0, (*kept[:3], plan, *kept[4:]))
            del _searches[KEPT_SEARCHES:]
    return out


def join_split(df: DataFrame, table: DataFrame, keys: Sequence[str], limit: int, one_task: bool = False) -> DataFrame:
    """Left join of the rows with a table that has one row for each key, null-safe; the rows' columns, then the table's others.

    A small table goes to every task. A larger one meets the rows by a shuffle, but for the keys above ``limit`` rows: these are few, and their
    part of the table goes to every task, so no task receives all rows of one key.
    """
    right = table.withColumnsRenamed({k: f"_t_{k}" for k in keys})
    new = [c for c in table.columns if c not in keys]

    def on(a: DataFrame, b: DataFrame, prefix: str, left: str = "") -> Column:
        pairs = [a[left + k].eqNullSafe(b[prefix + k]) for k in keys]
        return reduce(lambda x, y: x & y, pairs)

    def meet(rows: DataFrame, some: DataFrame) -> DataFrame:
        return rows.join(some, on(rows, some, "_t_"), "left").select(*[rows[c] for c in df.columns], *[some[c] for c in new])

    if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return meet(df, F.broadcast(right))
    names, _ = (None, 0) if one_task else find_heavy(df, keys, limit)
    if names is None:
        return meet(df, right)
    rest = df.join(names, on(df, names, "_hot_"), "left_anti")
    hot = df.join(names, on(df, names, "_hot_"), "left_semi")
    some = right.join(names, on(right, names, "_hot_", "_t_"), "left_semi")
    return meet(rest, right).unionByName(meet(hot, F.broadcast(some)))
