"""Queries for joins, aggregates, dedup, encoding and point-in-time features."""

from __future__ import annotations

from pyspark.sql import functions as F

from bankops.functions.columns import money, share
from bankops.ml.models import split_hash
from bankops.operators.aggregates import (
    class_ratio,
    column_stats,
    global_mean,
    hot_key_split,
    salted_agg,
    target_encode_apply,
    target_encode_fit,
    text_stats,
)
from bankops.operators.point_in_time import (
    FeatureSet,
    lookup_features,
    point_in_time,
    read_features,
    training_set,
    write_features,
)
from bankops.operators.relational import drop_known, join_on, keep_known, latest_per_key
from bankops.operators.windows import over_days
from bankops.plans.registry import query
from bankops.plans.sqltext import sql_uniform
from bankops.session import scratch_path

# ---- joins ----


def customers(t):
    return t.customer.select("c_custkey", "c_mktsegment")


def items(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")


def days(t):
    """Orders placed and items shipped by day; some days have only one of the two."""
    placed = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("o_day")).agg(F.count(F.lit(1)).alias("n_orders"))
    shipped = t.lineitem.groupBy(F.col("l_shipdate").cast("date").alias("l_day")).agg(F.count(F.lit(1)).alias("n_items"))
    return placed, shipped


PLACED = "(SELECT CAST(o_orderdate AS DATE) AS o_day, count(*) AS n_orders FROM orders GROUP BY 1)"
SHIPPED = "(SELECT CAST(l_shipdate AS DATE) AS l_day, count(*) AS n_items FROM lineitem GROUP BY 1)"


@query("join_left", "SELECT o_orderkey, o_custkey, l_linenumber, l_quantity FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey")
def join_left(t):
    """Every order with its items; some have none."""
    out = join_on(t.orders.select("o_orderkey", "o_custkey"), items(t), {"o_orderkey": "l_orderkey"}, "left")
    return out.select("o_orderkey", "o_custkey", "l_linenumber", "l_quantity")


@query("join_right", "SELECT d.doc_id, d.lang, l.quality FROM labels l RIGHT JOIN documents d ON l.doc_id = d.doc_id")
def join_right(t):
    """Every document with its label; most have none."""
    labels = t.labels.select(F.col("doc_id").alias("label_id"), "quality")
    return join_on(labels, t.documents.select("doc_id", "lang"), {"label_id": "doc_id"}, "right").select("doc_id", "lang", "quality")


@query(
    "join_inner",
    "SELECT c.c_custkey, c.c_mktsegment, o.o_orderkey FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey",
)
def join_inner(t):
    return join_on(customers(t), t.orders, {"c_custkey": "o_custkey"}).select("c_custkey", "c_mktsegment", "o_orderkey")


@query(
    "join_full",
    f"SELECT CAST(o_day AS VARCHAR) AS o_day, CAST(l_day AS VARCHAR) AS l_day, n_orders, n_items FROM {PLACED} FULL JOIN {SHIPPED} ON o_day = l_day",
)
def join_full(t):
    out = join_on(*days(t), {"o_day": "l_day"}, "fullouter")
    return out.select(F.col("o_day").cast("string"), F.col("l_day").cast("string"), "n_orders", "n_items")


@query("join_anti", "SELECT o_orderkey FROM orders ANTI JOIN lineitem ON o_orderkey = l_orderkey")
def join_anti(t):
    """Orders without an item."""
    return join_on(t.orders.select("o_orderkey"), items(t), {"o_orderkey": "l_orderkey"}, "left_anti")


@query(
    "join_using",
    """SELECT c_nationkey AS nationkey, c.c_custkey, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
)
def join_using(t):
    left = t.customer.select(F.col("c_nationkey").alias("nationkey"), "c_custkey")
    right = t.nation.select(F.col("n_nationkey").alias("nationkey"), "n_name")
    return left.join(right, on="nationkey", how="inner")


@query("join_semi", "SELECT c_custkey, c_mktsegment FROM customer SEMI JOIN events ON c_custkey = user_id")
def join_semi(t):
    """Customers with events."""
    return keep_known(customers(t), t.events.select(F.col("user_id").alias("c_custkey")), ["c_custkey"])


@query(
    "not_exists",
    "SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
)
def not_exists(t):
    return drop_known(t.documents.select("doc_id", "lang"), t.labels, ["doc_id"])


# ---- aggregates ----

MONEY = "CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"


def total(c: str):
    return F.sum(money(c)).cast("double")


@query("agg_sum", f"SELECT l_returnflag, {MONEY.format(c='l_quantity')} AS sum_qty FROM lineitem GROUP BY l_returnflag")
def agg_sum(t):
    return t.lineitem.groupBy("l_returnflag").agg(total("l_quantity").alias("sum_qty"))


@query(
    "agg_multi",
    f"""SELECT l_returnflag, {MONEY.format(c='l_extendedprice')} AS sum_price,
        {MONEY.format(c='l_extendedprice')} / count(l_extendedprice) AS avg_price,
        min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price, count(*) AS n
        FROM lineitem GROUP BY l_returnflag""",
)
def agg_multi(t):
    price = "l_extendedprice"
    return t.lineitem.groupBy("l_returnflag").agg(
        total(price).alias("sum_price"),
        share(F.sum(money(price)), F.count(price)).alias("avg_price"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.count(F.lit(1)).alias("n"),
    )


@query(
    "agg_multikey",
    f"""SELECT l_returnflag, l_linestatus, {MONEY.format(c='l_quantity')} AS sum_qty
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def agg_multikey(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(total("l_quantity").alias("sum_qty"))


@query("agg_count", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def agg_count(t):
    return t.events.groupBy("event_type").count()


@query("agg_global_count", "SELECT count(*) AS n FROM lineitem")
def agg_global_count(t):
    return t.lineitem.agg(F.count("*").alias("n"))


@query("agg_global_mean", f"SELECT {MONEY.format(c='value')} / count(value) AS mean_value FROM events")
def agg_global_mean(t):
    return t.events.agg(share(F.sum(money("value")), F.count("value")).alias("mean_value"))


@query(
    "agg_conditional",
    """SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_final,
       CAST(sum(CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END) AS BIGINT) AS n_large FROM orders GROUP BY o_custkey""",
)
def agg_conditional(t):
    return t.orders.groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("n_final"),
        F.sum(F.when(F.col("o_totalprice") > 200000, 1).otherwise(0)).alias("n_large"),
    )


@query("agg_ratio", "SELECT CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) / count(*) AS ratio FROM lineitem")
def agg_ratio(t):
    return class_ratio(t.lineitem, F.col("l_returnflag") == "R")


STATS_SQL = """SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev,
               CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""


@query("agg_describe", " UNION ALL ".join(STATS_SQL.format(c=c) for c in ("l_quantity", "l_extendedprice", "l_linenumber")))
def agg_describe(t):
    out = column_stats(t.lineitem, ["l_quantity", "l_extendedprice", "l_linenumber"])
    return out.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


TEXTS = ("l_returnflag", "l_linestatus")
TEXT_SQL = """SELECT '{c}' AS "column", count({c}) AS n, count(DISTINCT {c}) AS n_distinct, min({c}) AS min, max({c}) AS max,
    min(length({c})) AS min_length, max(length({c})) AS max_length FROM lineitem"""


@query("agg_describe_text", " UNION ALL ".join(TEXT_SQL.format(c=c) for c in TEXTS))
def agg_describe_text(t):
    return text_stats(t.lineitem, TEXTS)


@query(
    "agg_salted",
    f"SELECT l_suppkey, {MONEY.format(c='l_extendedprice')} AS revenue, count(*) AS n FROM lineitem GROUP BY l_suppkey",
)
def agg_salted(t):
    aggs = {"revenue": ("sum", money("l_extendedprice")), "n": ("count", F.lit(1))}
    out = salted_agg(t.lineitem, ["l_suppkey"], aggs, ["l_orderkey", "l_linenumber", "l_partkey"], 16)
    return out.withColumn("revenue", F.col("revenue").cast("double"))


@query(
    "agg_hotkey_split",
    f"SELECT event_type, count(*) AS n, {MONEY.format(c='value')} AS total FROM events GROUP BY event_type",
)
def agg_hotkey_split(t):
    # above a fifth of the rows a type is heavy and takes the salted way
    hot, rest = hot_key_split(t.events, "event_type", t.events.count() // 5)
    aggs = {"n": ("count", F.lit(1)), "total": ("sum", money("value"))}
    heavy = salted_agg(hot, ["event_type"], aggs, ["event_id"], 16)
    light = rest.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(money("value")).alias("total"))
    return heavy.unionByName(light).withColumn("total", F.col("total").cast("double"))


# ---- encoding ----

RETURNED = "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END"


def returned(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", F.expr(RETURNED).alias("y"))


@query(
    "target_encode",
    f"""SELECT l_orderkey, l_suppkey, e.encoding FROM lineitem JOIN (
        SELECT l_suppkey AS k, CAST(sum({RETURNED}) AS DOUBLE) / count(*) AS encoding FROM lineitem GROUP BY 1) e
        ON l_suppkey = e.k""",
)
def target_encode(t):
    rows = returned(t)
    coded = target_encode_apply(rows, target_encode_fit(rows, "l_suppkey", "y"), "l_suppkey")
    return coded.select("l_orderkey", "l_suppkey", "encoding")


@query(
    "target_encode_smooth",
    f"""SELECT l_suppkey, (CAST(sum({RETURNED}) AS DOUBLE)
        + 5.0 * (SELECT CAST(sum({RETURNED}) AS DOUBLE) / count(*) FROM lineitem)) / (count(*) + 5.0) AS encoding
        FROM lineitem GROUP BY l_suppkey""",
)
def target_encode_smooth(t):
    return target_encode_fit(returned(t), "l_suppkey", "y", k=5.0)


ENCODE_SPLIT = f"""WITH d AS (SELECT *, {RETURNED} AS y, {sql_uniform('l_orderkey', 0)} AS u FROM lineitem),
    train AS (SELECT * FROM d WHERE u < 0.8),
    e AS (SELECT l_partkey AS k, CAST(sum(y) AS DOUBLE) / count(*) AS encoding FROM train GROUP BY 1)
    SELECT l_orderkey, l_linenumber, l_partkey,
      coalesce(e.encoding, (SELECT CAST(sum(y) AS DOUBLE) / count(*) FROM train)) AS encoding
    FROM d LEFT JOIN e ON d.l_partkey = e.k WHERE d.u >= 0.8"""


@query("target_encode_split", ENCODE_SPLIT)
def target_encode_split(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.expr(RETURNED).alias("y"))
    train, test = split_hash(rows, "l_orderkey", 0.8)
    fitted = target_encode_fit(train, "l_partkey", "y")
    return target_encode_apply(test, fitted, "l_partkey", global_mean(train, "y")).drop("y")


# ---- dedup ----


@query("dedup_all", "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem")
def dedup_all(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity").dropDuplicates()


@query(
    "dedup_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def dedup_key(t):
    newest = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    return latest_per_key(t.orders, ["o_custkey"], newest).select("o_custkey", "o_orderkey", "o_totalprice")


# ---- point in time and feature tables ----

PIT = """SELECT e.event_id, e.user_id, f.value AS {name} FROM
    (SELECT * FROM events WHERE event_type = 'purchase') e
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = '{kind}') f
    ON e.user_id = f.user_id AND e.ts >= f.ts"""


def kind_of(t, kind: str):
    return t.events.filter(F.col("event_type") == kind)


@query("join_pit", PIT.format(name="last_view", kind="view"))
def join_pit(t):
    labels = kind_of(t, "purchase").select("event_id", "user_id", "ts")
    views = kind_of(t, "view").select("event_id", "user_id", "ts", F.col("value").alias("last_view"))
    out = point_in_time(labels, views, ["user_id"], "ts", "ts", ["last_view"], "event_id")
    return out.select("event_id", "user_id", "last_view")


@query(
    "training_set",
    f"""SELECT a.event_id, a.user_id, a.last_view, b.last_click FROM ({PIT.format(name='last_view', kind='view')}) a
        JOIN ({PIT.format(name='last_click', kind='click')}) b ON a.event_id = b.event_id""",
)
def training_set_query(t):
    labels = kind_of(t, "purchase").select("event_id", "user_id", "ts")
    views = kind_of(t, "view").select("event_id", "user_id", "ts", F.col("value").alias("last_view"))
    clicks = kind_of(t, "click").select("event_id", "user_id", "ts", F.col("value").alias("last_click"))
    sets = [FeatureSet(views, ["last_view"], "ts", "event_id"), FeatureSet(clicks, ["last_click"], "ts", "event_id")]
    return training_set(labels, sets, ["user_id"], "ts", "event_id").select("event_id", "user_id", "last_view", "last_click")


def weekly(t):
    aggs = {"n_7d": ("count", F.lit(1)), "sum_7d": ("sum", money("value"))}
    rows = over_days(t.events.select("event_id", "user_id", "ts", "value"), "user_id", "ts", 7, aggs, "event_id")
    return rows.select("event_id", "user_id", "ts", "n_7d", F.col("sum_7d").cast("double").alias("sum_7d"))


WEEKLY = """SELECT event_id, user_id, ts, count(*) OVER w AS n_7d,
    CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) AS sum_7d FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)"""


@query("feature_table", f"SELECT event_id, user_id, n_7d, sum_7d FROM ({WEEKLY})")
def feature_table(t):
    """Two loads of a table by day: the first half of the month, then the days after it, which are all that is written."""
    path = scratch_path(t.spark, "features")
    rows = weekly(t).withColumn("day", F.to_date("ts").cast("string"))
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (rows.filter(~late), rows.filter(late)):
        write_features(part, path, ["event_id"], partition_by="day")
    return read_features(t.spark, path).drop("ts", "day")


@query(
    "feature_lookup",
    f"""SELECT event_id, user_id, n_7d, sum_7d FROM ({WEEKLY}) f
        WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 50)
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def feature_lookup(t):
    wanted = t.events.filter("event_type = 'error' AND value > 50").select("user_id")
    return lookup_features(weekly(t), wanted, ["user_id"], "ts", "event_id").drop("ts")
