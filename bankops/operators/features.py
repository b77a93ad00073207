"""Behaviour features of an account, grouped or per row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankops.functions.columns import MICROS_PER_DAY, MICROS_PER_SECOND, count_where, is_weekend, micros, share
from bankops.operators.heavy import join_split
from bankops.operators.skew import fits_one_task, hot_limit, over_range, running
from bankops.operators.windows import AXIS, as_list, gap_seconds, over_days, previous


def weekend_count(df: DataFrame, key: str, ts: str, name: str = "weekend_count") -> DataFrame:
    return df.groupBy(key).agg(count_where(is_weekend(ts)).alias(name))


def holiday_count(df: DataFrame, key: str, ts: str, holidays: DataFrame, name: str = "holiday_count") -> DataFrame:
    """Rows on a date of ``holidays`` (its first column), per key.

    Counts are formed per key and day first, so what meets the holiday table is already small.
    """
    dates = holidays.select(F.col(holidays.columns[0]).cast("date").alias("_day")).distinct()
    dates = dates.withColumn("_off", F.lit(True))
    daily = df.groupBy(key, F.to_date(ts).alias("_day")).agg(F.count(F.lit(1)).alias("_rows"))
    hits = F.when(F.col("_off"), F.col("_rows")).otherwise(0)
    return daily.join(dates, "_day", "left").groupBy(key).agg(F.sum(hits).alias(name))


def hourly_frequency(df: DataFrame, key: str, ts: str) -> DataFrame:
    return df.groupBy(key, F.hour(ts).alias("hour")).agg(F.count(F.lit(1)).alias("n"))


def gap_stats(df: DataFrame, key, ts: str, days: float, tie: str, hot_rows: int | None = None) -> DataFrame:
    """Mean and sample deviation of the gaps (seconds) of the last ``days`` days.

    Built from exact sums of whole microseconds, which add up over any split of the rows.
    """
    timed = df.withColumn(AXIS, micros(ts))
    gaps = previous(timed, key, ts, {"_before": AXIS}, tie, hot_rows)
    gap = (F.col(AXIS) - F.col("_before")).cast("decimal(18,0)")
    parts = {"_s": ("sum", gap), "_q": ("sum", (gap * gap).cast("decimal(38,0)")), "_n": ("count", gap)}
    span = round(days * MICROS_PER_DAY)
    out = over_range(gaps, as_list(key), AXIS, span, parts, tie, hot_rows=hot_rows)
    n, s, q = F.col("_n"), F.col("_s").cast("double"), F.col("_q").cast("double")
    mean = F.try_divide(s, n.cast("double"))
    spread = F.when(n > 1, F.sqrt(F.greatest((q - s * mean) / (n - 1), F.lit(0.0))))
    return out.withColumns(
        {"gap_avg": mean / MICROS_PER_SECOND, "gap_std": spread / MICROS_PER_SECOND}
    ).drop(AXIS, "_before", *parts)


def category_share(df: DataFrame, key: str, cat: str) -> DataFrame:
    """Rows of each category and their share of the key's rows."""
    counts = df.groupBy(key, cat).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(F.col(key).alias("_key")).agg(F.sum("n").alias("_all"))
    joined = counts.join(totals, counts[key].eqNullSafe(totals["_key"]))
    return joined.select(key, cat, "n", share(F.col("n"), F.col("_all")).alias("share"))


def listed_shares(df: DataFrame, key: str, cat: str, values: Sequence[str]) -> DataFrame:
    """One share column per listed category, in a single aggregation."""
    return df.groupBy(key).agg(
        *[share(count_where(F.col(cat) == v), F.count(F.lit(1))).alias(f"{v.lower()}_share") for v in values]
    )


def large_count(df: DataFrame, key: str, value: str, limit: float, name: str = "large_count") -> DataFrame:
    return df.groupBy(key).agg(count_where(F.col(value) > limit).alias(name))


def small_ratio(df: DataFrame, key: str, value: str, limit: float, name: str = "small_ratio") -> DataFrame:
    return df.groupBy(key).agg(share(count_where(F.col(value) < limit), F.count(F.lit(1))).alias(name))


def flow_ratio(
    df: DataFrame, key, ts: str, value: Column, debit: Column, credit: Column, days: float, tie: str,
    name: str = "flow_ratio", hot_rows: int | None = None,
) -> DataFrame:
    """Spending over income in the frame; NULL without income. ``value`` is summed exactly, floating numbers included."""
    parts = {
        "_out": ("sum", F.when(debit, value).otherwise(F.lit(0))),
        "_in": ("sum", F.when(credit, value).otherwise(F.lit(0))),
    }
    out = over_days(df, key, ts, days, parts, tie, hot_rows)
    return out.withColumn(name, share(F.col("_out"), F.col("_in"))).drop(*parts)


def modal_share(df: DataFrame, key: str, cat: str) -> DataFrame:
    """The most frequent category of a key (smallest on ties) and its share of the rows."""
    counts = df.groupBy(key, cat).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(key).agg(
        F.min_by(cat, F.struct(-F.col("_n"), F.col(cat))).alias("modal"),
        share(F.max("_n"), F.sum("_n")).alias("modal_share"),
    )


def status_counts(df: DataFrame, key: str, status: str, values: Mapping[str, str]) -> DataFrame:
    """One count per status; ``values`` maps the new column to the status text."""
    return df.groupBy(key).agg(*[count_where(F.col(status) == v).alias(n) for n, v in values.items()])


def amount_gap(df: DataFrame, key, ts: str, value: str, tie: str, hot_rows: int | None = None) -> DataFrame:
    """Amount times the seconds since the previous row."""
    out = gap_seconds(df, key, ts, tie, "_gap", hot_rows)
    return out.withColumn("amount_gap", F.col(value) * F.col("_gap")).drop("_gap")


def zscore(df: DataFrame, key: str, value: str, name: str = "zscore", hot_rows: int | None = None) -> DataFrame:
    """Distance from the key's mean in sample deviations; NULL for a constant or single row.

    Per-key statistics come from a partial aggregate and are joined back, heavy keys apart, so no key is held in one task.
    """
    stats = df.groupBy(key).agg(F.avg(value).alias("_avg"), F.stddev(value).alias("_std"))
    joined = _joined(df, stats, key, hot_rows)
    return joined.select(*df.columns, F.try_divide(F.col(value) - F.col("_avg"), F.col("_std")).alias(name))


def _joined(df: DataFrame, table: DataFrame, key: str, hot_rows: int | None) -> DataFrame:
    limit = hot_limit(df, hot_rows)
    return join_split(df, table, [key], limit, fits_one_task(df, limit))


def cumulative_share_delta(
    df: DataFrame, key: str, ts: str, value: Column, tie: str, hot_rows: int | None = None
) -> DataFrame:
    """Running share of the key's total, and its change from the previous row (from 0 on the first).

    ``value`` is summed as given; sums of decimals and whole numbers are exact.
    """
    run = running(df, [key], [F.col(ts), F.col(tie)], {"_run": ("sum", value)}, hot_rows)
    joined = _joined(run, df.groupBy(key).agg(F.sum(value).alias("_total")), key, hot_rows)
    before = F.col("_run") - F.coalesce(value, F.lit(0))
    now = share(F.col("_run"), F.col("_total"))
    return joined.select(
        *df.columns, now.alias("cum_share"), (now - share(before, F.col("_total"))).alias("cum_share_delta")
    )


def cross_key_matches(
    df: DataFrame, key: str, match_on: str, ts: str, within_seconds: float, tie: str,
    name: str = "cross_matches", hot_rows: int | None = None,
) -> DataFrame:
    """How many rows of *other* keys share the value and lie within the time span, before or after.

    Counted as all matching rows less the key's own, so the work is linear in the rows: no pair is formed.
    """
    span = round(within_seconds * MICROS_PER_SECOND)
    timed = df.withColumn(AXIS, micros(ts))
    one = {"_all": ("count", F.lit(1))}
    every = over_range(timed, [match_on], AXIS, span, one, tie, after=span, hot_rows=hot_rows)
    own = {"_own": ("count", F.lit(1))}
    both = over_range(every, [match_on, key], AXIS, span, own, tie, after=span, hot_rows=hot_rows)
    return both.withColumn(name, F.col("_all") - F.col("_own")).drop(AXIS, "_all", "_own")
