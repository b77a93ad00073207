"""Queries for account-level windows and behaviour features; the account is ``events.user_id``."""

from __future__ import annotations

from pyspark.sql import functions as F

from bankops.functions.columns import money, share
from bankops.operators import features as fx
from bankops.operators import windows as wx
from bankops.plans.registry import query
from bankops.sources.tables import inline_rows

KEY, TS, TIE = "user_id", "ts", "event_id"
ORDERED = "PARTITION BY user_id ORDER BY ts, event_id"
DAYS = "PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL {n} DAYS PRECEDING AND CURRENT ROW"
D7, D30 = DAYS.format(n=7), DAYS.format(n=30)
AMOUNT = "CAST(value AS DECIMAL(18,2))"


def failed():
    return F.col("event_type") == "error"


def rows(t):
    return t.events.select("event_id", "user_id", "ts", "event_type", "value")


def as_double(df, *cols):
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


@query(
    "account_features",
    f"""SELECT event_id, user_id, count(*) OVER d7 AS n_7d, CAST(sum({AMOUNT}) OVER d30 AS DOUBLE) AS sum_30d,
        CAST(count(*) FILTER (WHERE event_type = 'error') OVER d30 AS DOUBLE) / count(*) OVER d30 AS fail_ratio_30d
        FROM events WINDOW d7 AS ({D7}), d30 AS ({D30})""",
)
def account_features(t):
    aggs = {
        "n_7d": ("count", F.lit(1)),
        "sum_30d": ("sum", money("value")),
        "_failed": ("sum", F.when(failed(), 1).otherwise(0).cast("long")),
        "_all": ("count", F.lit(1)),
    }
    days = {"n_7d": 7, "sum_30d": 30, "_failed": 30, "_all": 30}
    out = wx.over_days(rows(t), KEY, TS, days, aggs, TIE)
    ratio = share(F.col("_failed"), F.col("_all")).alias("fail_ratio_30d")
    return out.select("event_id", "user_id", "n_7d", F.col("sum_30d").cast("double").alias("sum_30d"), ratio)


# ---- windows ----


@query(
    "win_rows_sum3",
    f"SELECT event_id, CAST(sum({AMOUNT}) OVER ({ORDERED} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE) AS sum3 FROM events",
)
def win_rows_sum3(t):
    out = wx.rolling(rows(t), KEY, TS, money("value"), "sum", TIE, "sum3", rows=3)
    return as_double(out.select("event_id", "sum3"), "sum3")


@query("win_range_7d", f"SELECT event_id, CAST(sum({AMOUNT}) OVER ({D7}) AS DOUBLE) AS sum_7d FROM events")
def win_range_7d(t):
    out = wx.rolling(rows(t), KEY, TS, money("value"), "sum", TIE, "sum_7d", days=7)
    return as_double(out.select("event_id", "sum_7d"), "sum_7d")


@query("feat_count_7d", f"SELECT event_id, count(*) OVER ({D7}) AS n_7d FROM events")
def feat_count_7d(t):
    return wx.rolling(rows(t), KEY, TS, F.lit(1), "count", TIE, "n_7d", days=7).select("event_id", "n_7d")


@query("feat_sum_30d", f"SELECT event_id, CAST(sum({AMOUNT}) OVER ({D30}) AS DOUBLE) AS sum_30d FROM events")
def feat_sum_30d(t):
    out = wx.rolling(rows(t), KEY, TS, money("value"), "sum", TIE, "sum_30d", days=30)
    return as_double(out.select("event_id", "sum_30d"), "sum_30d")


@query(
    "win_range_raw",
    f"SELECT event_id, round(sum(value) OVER ({D7}), 6) AS sum_7d, round(sum(value) OVER ({D30}), 6) AS sum_30d FROM events",
)
def win_range_raw(t):
    """Floating amounts as they are, without a cast to decimals."""
    aggs = {"sum_7d": ("sum", F.col("value")), "sum_30d": ("sum", F.col("value"))}
    out = wx.over_days(rows(t), KEY, TS, {"sum_7d": 7, "sum_30d": 30}, aggs, TIE)
    return out.select("event_id", F.round("sum_7d", 6).alias("sum_7d"), F.round("sum_30d", 6).alias("sum_30d"))


@query(
    "feat_io_ratio_raw",
    f"""SELECT event_id, round(sum(CASE WHEN event_type = 'click' THEN value ELSE 0 END) OVER w
        / nullif(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) OVER w, 0), 6) AS flow_ratio FROM events WINDOW w AS ({D7})""",
)
def feat_io_ratio_raw(t):
    kind = F.col("event_type")
    out = fx.flow_ratio(rows(t), KEY, TS, F.col("value"), kind == "click", kind == "purchase", 7, TIE)
    return out.select("event_id", F.round("flow_ratio", 6).alias("flow_ratio"))


LAST30 = f"{ORDERED} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW"


@query("feat_avg_last30", f"SELECT event_id, CAST(sum({AMOUNT}) OVER ({LAST30}) AS DOUBLE) / count(value) OVER ({LAST30}) AS avg_30 FROM events")
def feat_avg_last30(t):
    out = wx.rolling(rows(t), KEY, TS, money("value"), "avg", TIE, "avg_30", rows=30)
    return out.select("event_id", "avg_30")


@query("feat_std_last30", f"SELECT event_id, round(stddev_samp(value) OVER ({LAST30}), 4) AS std_30 FROM events")
def feat_std_last30(t):
    out = wx.rolling(rows(t), KEY, TS, "value", "stddev", TIE, "std_30", rows=30)
    return out.select("event_id", F.round("std_30", 4).alias("std_30"))


@query("feat_minmax_30d", f"SELECT event_id, min(value) OVER w AS lo, max(value) OVER w AS hi FROM events WINDOW w AS ({D30})")
def feat_minmax_30d(t):
    aggs = {"lo": ("min", F.col("value")), "hi": ("max", F.col("value"))}
    return wx.over_days(rows(t), KEY, TS, 30, aggs, TIE).select("event_id", "lo", "hi")


@query(
    "feat_night_count",
    f"""SELECT event_id, CAST(sum(CASE WHEN hour(ts) < 6 THEN 1 ELSE 0 END) OVER ({ORDERED}
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS night_count FROM events""",
)
def feat_night_count(t):
    return wx.night_count(rows(t), KEY, TS, TIE).select("event_id", "night_count")


@query(
    "feat_fail_ratio_30d",
    f"""SELECT event_id, CAST(count(*) FILTER (WHERE event_type = 'error') OVER w AS DOUBLE) / count(*) OVER w AS fail_ratio
        FROM events WINDOW w AS ({D30})""",
)
def feat_fail_ratio_30d(t):
    return wx.ratio_in_window(rows(t), KEY, TS, failed(), 30, TIE, "fail_ratio").select("event_id", "fail_ratio")


@query(
    "feat_prev_amount",
    f"""SELECT event_id, lag(value) OVER w AS prev_amount, value - lag(value) OVER w AS change
        FROM events WINDOW w AS ({ORDERED})""",
)
def feat_prev_amount(t):
    out = wx.previous(rows(t), KEY, TS, {"prev_amount": "value"}, TIE)
    return out.select("event_id", "prev_amount", (F.col("value") - F.col("prev_amount")).alias("change"))


GAP = f"(epoch_us(ts) - lag(epoch_us(ts)) OVER ({ORDERED})) / 1000000"


@query("feat_gap_seconds", f"SELECT event_id, {GAP} AS gap_seconds FROM events")
def feat_gap_seconds(t):
    return wx.gap_seconds(rows(t), KEY, TS, TIE).select("event_id", "gap_seconds")


@query("win_lead", f"SELECT event_id, lead(value) OVER ({ORDERED}) AS next_amount FROM events")
def win_lead(t):
    return wx.shifted(rows(t), KEY, TS, {"next_amount": "value"}, TIE, offset=1).select("event_id", "next_amount")


@query(
    "feat_hop_1h",
    f"""SELECT event_id, CASE WHEN event_type <> lag(event_type) OVER w AND epoch_us(ts) - lag(epoch_us(ts)) OVER w < 3600000000
        THEN 1 ELSE 0 END AS hop FROM events WINDOW w AS ({ORDERED})""",
)
def feat_hop_1h(t):
    return wx.hop_flag(rows(t), KEY, TS, "event_type", TIE).select("event_id", "hop")


@query(
    "win_row_number",
    """SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate)
       ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS nth FROM orders""",
)
def win_row_number(t):
    monthly = t.orders.withColumn("_month", F.trunc("o_orderdate", "month"))
    out = wx.rank_in_group(monthly, ["o_custkey", "_month"], "o_orderdate", "row_number", "o_orderkey", "nth")
    return out.select("o_orderkey", "nth")


@query(
    "win_rank",
    """SELECT event_id, CAST(rank() OVER w AS INTEGER) AS rnk, CAST(dense_rank() OVER w AS INTEGER) AS dense FROM (
       SELECT *, floor(value) AS whole FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY whole DESC)""",
)
def win_rank(t):
    whole = rows(t).withColumn("whole", F.floor("value"))
    ranked = wx.rank_in_group(whole, KEY, "whole", "rank", TIE, "rnk", descending=True)
    return wx.rank_in_group(ranked, KEY, "whole", "dense_rank", TIE, "dense", descending=True).select("event_id", "rnk", "dense")


@query(
    "win_running_sum",
    f"""SELECT event_id, CAST(sum({AMOUNT}) OVER ({ORDERED} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
        AS running_sum FROM events""",
)
def win_running_sum(t):
    return as_double(wx.running_sum(rows(t), KEY, TS, money("value"), TIE).select("event_id", "running_sum"), "running_sum")


@query(
    "win_running_sum_table",
    f"""SELECT event_id, CAST(sum({AMOUNT}) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        AS DOUBLE) AS running_sum FROM events""",
)
def win_running_sum_table(t):
    out = wx.running_sum(rows(t), None, TS, money("value"), TIE)
    return as_double(out.select("event_id", "running_sum"), "running_sum")


# ---- features ----


@query("feat_weekend_count", "SELECT user_id, count(*) FILTER (WHERE dayofweek(ts) IN (0, 6)) AS weekend_count FROM events GROUP BY user_id")
def feat_weekend_count(t):
    return fx.weekend_count(rows(t), KEY, TS)


@query(
    "feat_holiday_count",
    """SELECT user_id, count(*) FILTER (WHERE CAST(ts AS DATE) IN (DATE '2024-01-01', DATE '2024-01-15')) AS holiday_count
       FROM events GROUP BY user_id""",
)
def feat_holiday_count(t):
    holidays = inline_rows(t.spark, [("2024-01-01",), ("2024-01-15",)], "day string")
    return fx.holiday_count(rows(t), KEY, TS, holidays)


@query("feat_hourly_freq", "SELECT user_id, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n FROM events GROUP BY 1, 2")
def feat_hourly_freq(t):
    return fx.hourly_frequency(rows(t), KEY, TS)


# whole microseconds, so that the mean is the same number in any summing order
GAP_MICROS = f"epoch_us(ts) - lag(epoch_us(ts)) OVER ({ORDERED})"


@query(
    "feat_gap_stats",
    f"""SELECT event_id, CAST(sum(g) OVER w AS DOUBLE) / nullif(count(g) OVER w, 0) / 1000000 AS gap_avg,
        round(stddev_samp(g / 1000000) OVER w, 4) AS gap_std FROM (
        SELECT *, {GAP_MICROS} AS g FROM events) WINDOW w AS ({D7})""",
)
def feat_gap_stats(t):
    out = fx.gap_stats(rows(t), KEY, TS, 7, TIE)
    return out.select("event_id", "gap_avg", F.round("gap_std", 4).alias("gap_std"))


@query(
    "feat_channel_share",
    "SELECT user_id, "
    + ", ".join(
        f"CAST(count(*) FILTER (WHERE event_type = '{v}') AS DOUBLE) / count(*) AS {v}_share" for v in ("click", "view", "purchase")
    )
    + " FROM events GROUP BY user_id",
)
def feat_channel_share(t):
    return fx.listed_shares(rows(t), KEY, "event_type", ["click", "view", "purchase"])


@query("feat_large_count", "SELECT user_id, count(*) FILTER (WHERE value > 50) AS large_count FROM events GROUP BY user_id")
def feat_large_count(t):
    return fx.large_count(rows(t), KEY, "value", 50)


@query(
    "feat_small_ratio",
    "SELECT user_id, CAST(count(*) FILTER (WHERE value < 5) AS DOUBLE) / count(*) AS small_ratio FROM events GROUP BY user_id",
)
def feat_small_ratio(t):
    return fx.small_ratio(rows(t), KEY, "value", 5)


@query(
    "feat_category_share",
    """SELECT user_id, event_type, count(*) AS n, CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER (PARTITION BY user_id) AS DOUBLE) AS share
       FROM events GROUP BY user_id, event_type""",
)
def feat_category_share(t):
    return fx.category_share(rows(t), KEY, "event_type")


@query(
    "feat_io_ratio",
    f"""SELECT event_id, CAST(sum(CASE WHEN event_type = 'click' THEN {AMOUNT} ELSE 0 END) OVER w AS DOUBLE)
        / nullif(CAST(sum(CASE WHEN event_type = 'purchase' THEN {AMOUNT} ELSE 0 END) OVER w AS DOUBLE), 0) AS flow_ratio
        FROM events WINDOW w AS ({D7})""",
)
def feat_io_ratio(t):
    kind = F.col("event_type")
    out = fx.flow_ratio(rows(t), KEY, TS, money("value"), kind == "click", kind == "purchase", 7, TIE)
    return out.select("event_id", "flow_ratio")


@query(
    "feat_modal_share",
    """SELECT user_id, event_type AS modal, CAST(n AS DOUBLE) / CAST(total AS DOUBLE) AS modal_share FROM (
       SELECT user_id, event_type, count(*) AS n, sum(count(*)) OVER (PARTITION BY user_id) AS total,
       row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS r FROM events GROUP BY 1, 2) WHERE r = 1""",
)
def feat_modal_share(t):
    return fx.modal_share(rows(t), KEY, "event_type")


@query(
    "feat_status_counts",
    """SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS n_failed,
       count(*) FILTER (WHERE event_type = 'purchase') AS n_bought FROM events GROUP BY user_id""",
)
def feat_status_counts(t):
    return fx.status_counts(rows(t), KEY, "event_type", {"n_failed": "error", "n_bought": "purchase"})


@query("feat_amount_gap", f"SELECT event_id, value * ({GAP}) AS amount_gap FROM events")
def feat_amount_gap(t):
    return fx.amount_gap(rows(t), KEY, TS, "value", TIE).select("event_id", "amount_gap")


@query(
    "feat_zscore",
    """SELECT event_id, round((value - avg(value) OVER w) / nullif(stddev_samp(value) OVER w, 0), 4) AS zscore
       FROM events WINDOW w AS (PARTITION BY user_id)""",
)
def feat_zscore(t):
    return fx.zscore(rows(t), KEY, "value").select("event_id", F.round("zscore", 4).alias("zscore"))


@query(
    "feat_cumshare_delta",
    f"""SELECT event_id, run / total AS cum_share, run / total - before / total AS cum_share_delta FROM (SELECT event_id,
        CAST(sum({AMOUNT}) OVER ({ORDERED} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS run,
        CAST(sum({AMOUNT}) OVER ({ORDERED} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - {AMOUNT} AS DOUBLE) AS before,
        CAST(sum({AMOUNT}) OVER (PARTITION BY user_id) AS DOUBLE) AS total FROM events)""",
)
def feat_cumshare_delta(t):
    out = fx.cumulative_share_delta(rows(t), KEY, TS, money("value"), TIE)
    return out.select("event_id", "cum_share", "cum_share_delta")


@query(
    "feat_cross_account",
    """SELECT a.event_id, count(b.event_id) AS cross_matches FROM events a LEFT JOIN events b
       ON a.event_type = b.event_type AND a.user_id <> b.user_id AND abs(epoch_us(a.ts) - epoch_us(b.ts)) <= 3600000000
       GROUP BY a.event_id""",
)
def feat_cross_account(t):
    return fx.cross_key_matches(rows(t), KEY, "event_type", TS, 3600, TIE).select("event_id", "cross_matches")
