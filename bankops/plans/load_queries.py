"""Queries for the strict load and for data layout. The batch is the ``orders`` table read as transactions."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankops.operators import layout
from bankops.operators import load as ld
from bankops.plans.registry import query
from bankops.session import scratch_path, stored
from bankops.sources.files import read_source, write_sink
from bankops.sources.journal import publish, read_published

KEY = "transaction_id"

# Pending orders of some priorities get a broken amount or key, as a faulty feed would send them.
BROKEN_AMOUNT = "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN -o_totalprice ELSE o_totalprice END"
BROKEN_KEY = "CASE WHEN o_orderstatus = 'P' AND o_orderpriority <> '3-MEDIUM' THEN NULL ELSE 'TXN-' || o_orderkey END"
SOURCE = f"""SELECT {BROKEN_KEY} AS transaction_id, 'ACC-' || o_custkey AS account_id, CAST(o_orderdate AS DATE) AS transaction_date,
    CAST({BROKEN_AMOUNT} AS DECIMAL(18,2)) AS amount, o_orderstatus, o_orderkey FROM orders"""
REASON = f"""CASE WHEN amount IS NULL OR amount <= 0 THEN '{ld.INVALID_AMOUNT}'
    WHEN transaction_id IS NULL THEN '{ld.MISSING_KEY}' END"""
KNOWN = "SELECT 'TXN-' || o_orderkey FROM orders WHERE o_orderstatus = 'F'"
CHECKED = f"""SELECT *, CASE WHEN reason IS NOT NULL THEN reason
    WHEN transaction_id IN ({KNOWN}) THEN '{ld.DUPLICATE}' END AS error_reason FROM (SELECT *, {REASON} AS reason FROM ({SOURCE}))"""


def source(t):
    return t.orders.select(
        F.expr(BROKEN_KEY).alias(KEY),
        F.concat(F.lit("ACC-"), "o_custkey").alias("account_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        F.expr(BROKEN_AMOUNT).cast("decimal(18,2)").alias("amount"),
        "o_orderstatus",
        "o_orderkey",
    )


def target(t):
    """Final orders, loaded earlier."""
    return source(t).filter("o_orderstatus = 'F'").drop("o_orderstatus", "o_orderkey")


def checked(t):
    rules = ld.standard_rules("amount", KEY)
    return ld.check_batch(source(t), target(t), KEY, rules, [KEY, "amount", "transaction_date"])


@query(
    "etl_validate",
    f"SELECT o_orderkey, {REASON} AS error_reason, CASE WHEN {REASON} IS NULL THEN 'PASS' ELSE 'REJECT' END AS validation_status FROM ({SOURCE})",
)
def etl_validate(t):
    out = ld.validate(source(t), ld.standard_rules("amount", KEY))
    return out.select("o_orderkey", "error_reason", "validation_status")


@query(
    "etl_dup_check",
    f"SELECT o_orderkey, error_reason, CASE WHEN error_reason IS NULL THEN 'PASS' ELSE 'REJECT' END AS validation_status FROM ({CHECKED})",
)
def etl_dup_check(t):
    return checked(t).select("o_orderkey", "error_reason", "validation_status")


@query(
    "etl_split",
    f"""SELECT CASE WHEN error_reason IS NULL THEN 'good' ELSE 'bad' END AS side, count(*) AS n FROM ({CHECKED}) GROUP BY 1""",
)
def etl_split(t):
    good, bad = ld.split(stored(checked(t).select("validation_status")))
    sides = good.select(F.lit("good").alias("side")).unionByName(bad.select(F.lit("bad").alias("side")))
    return sides.groupBy("side").agg(F.count(F.lit(1)).alias("n"))


@query(
    "etl_reject_log",
    f"""SELECT 'b1' AS "Batch_ID", 'bank_accounts' AS "Dataset", transaction_id AS "Business_Key", error_reason AS "Error_Reason"
        FROM ({CHECKED}) WHERE error_reason IS NOT NULL""",
)
def etl_reject_log(t):
    _, bad = ld.split(checked(t))
    log = ld.reject_rows(bad, "b1", "bank_accounts", KEY, "2024-01-31 00:00:00")
    return log.select("Batch_ID", "Dataset", "Business_Key", "Error_Reason")


@query(
    "etl_control",
    f"""SELECT 'b1' AS "Batch_ID", 'bank_accounts' AS "Dataset", CASE WHEN bad > 0 THEN 'FAILURE' ELSE 'SUCCESS' END AS "Status",
        n || ' / ' || CASE WHEN bad > 0 THEN 0 ELSE n END || ' / ' || bad AS "Count_Summary",
        CASE WHEN bad > 0 THEN 'MISMATCH' ELSE 'MATCH' END AS "Hash_Status"
        FROM (SELECT count(*) AS n, count(error_reason) AS bad FROM ({CHECKED}))""",
)
def etl_control(t):
    return ld.control_row(checked(t), "b1", "bank_accounts").drop("Run_Time")


@query(
    "etl_upsert",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice * 2 END AS price FROM orders",
)
def etl_upsert(t):
    """Stored final and some open orders; the batch doubles the open ones and brings the pending ones."""
    path = scratch_path(t.spark, "upsert")
    rows = t.orders.select("o_orderkey", F.col("o_totalprice").alias("price"), "o_orderpriority", "o_orderstatus")
    old = rows.filter("o_orderstatus = 'F' OR (o_orderstatus = 'O' AND o_orderpriority < '4')").drop("o_orderstatus")
    new = rows.filter("o_orderstatus <> 'F'").withColumn("price", F.col("price") * 2).drop("o_orderstatus")
    write_sink(old, path, partition_by=["o_orderpriority"])
    ld.upsert_table(t.spark, path, new, ["o_orderkey"], partition_by="o_orderpriority")
    return read_source(t.spark, path).select("o_orderkey", "price")


@query(
    "etl_normalise",
    f"""SELECT transaction_id, account_id, CAST(transaction_date AS VARCHAR) AS transaction_date, CAST(amount AS DOUBLE) AS amount,
        'b1' AS batch_id FROM ({CHECKED}) WHERE error_reason IS NULL""",
)
def etl_normalise(t):
    good, _ = ld.split(checked(t).drop("o_orderstatus", "o_orderkey"))
    good = stored(good)
    twice = good.unionByName(good)  # a feed that repeats itself
    kept = ld.normalise(twice, "b1", "2024-01-31 00:00:00")
    return kept.select(KEY, "account_id", F.col("transaction_date").cast("string"), F.col("amount").cast("double"), "batch_id")


@query(
    "etl_run",
    f"""SELECT 'b1' AS "Batch_ID", 'SUCCESS' AS "Status", n || ' / ' || n || ' / 0' AS "Count_Summary", 'MATCH' AS "Hash_Status"
        FROM (SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F')
        UNION ALL SELECT 'b2', 'FAILURE', n || ' / 0 / ' || bad, 'MISMATCH'
        FROM (SELECT count(*) AS n, count(error_reason) AS bad FROM ({CHECKED}))""",
)
def etl_run(t):
    """A clean first batch, then the whole feed, which must be refused."""
    paths = [scratch_path(t.spark, n) for n in ("target", "control", "rejects")]
    feed = source(t).withColumn("period", F.year("transaction_date").cast("string"))
    held = ["transaction_id", "account_id", "transaction_date", "amount", "period"]
    clean = feed.filter("o_orderstatus = 'F'").select(*held)
    stamp = "2024-01-31 00:00:00"
    for batch, rows in (("b1", clean), ("b2", feed.select(*held))):
        ld.run_batch(t.spark, rows, *paths, KEY, ld.standard_rules("amount", KEY), batch, stamp, partition_by="period")
    return read_source(t.spark, paths[1]).select("Batch_ID", "Status", "Count_Summary", "Hash_Status")


@query(
    "etl_gate",
    f"""SELECT 'b1' AS "Batch_ID", 1 AS "Attempt", 'SUCCESS' AS "Status" UNION ALL
        SELECT 'b2', 0, CASE WHEN bad > 0 THEN 'FAILURE' ELSE 'SUCCESS' END FROM (SELECT count(error_reason) AS bad FROM ({CHECKED}))""",
)
def etl_gate(t):
    """What the gate sees: a batch that was refused and mended under its id, and one that stays refused."""
    paths = [scratch_path(t.spark, n) for n in ("target", "control", "rejects")]
    feed = source(t).drop("o_orderstatus", "o_orderkey")
    clean = target(t).drop("o_orderstatus", "o_orderkey")
    for batch, rows in (("b1", feed), ("b1", clean), ("b2", feed)):
        ld.run_batch(t.spark, rows, *paths, KEY, ld.standard_rules("amount", KEY), batch, "2024-01-31 00:00:00")
    return ld.batch_status(read_source(t.spark, paths[1])).select("Batch_ID", "Attempt", "Status")


@query(
    "etl_daily",
    """SELECT 'TXN-' || (row_number() OVER (ORDER BY o_orderkey) + CASE WHEN o_orderstatus = 'F' THEN 0 ELSE blocks * 1000 END) AS transaction_id, o_orderkey
       FROM (SELECT o_orderkey, o_orderstatus, (SELECT (count(*) + 999) // 1000 FROM orders WHERE o_orderstatus = 'F') AS blocks FROM orders WHERE o_orderstatus = 'F')
       UNION ALL SELECT 'TXN-' || (row_number() OVER (ORDER BY o_orderkey) + blocks * 1000), o_orderkey
       FROM (SELECT o_orderkey, (SELECT (count(*) + 999) // 1000 FROM orders WHERE o_orderstatus = 'F') AS blocks FROM orders WHERE o_orderstatus <> 'F')""",
)
def etl_daily(t):
    """Two days of the chain: draw ids from the shared sequence, load, pass the gate."""
    paths = [scratch_path(t.spark, n) for n in ("sequence", "target", "control", "rejects")]
    rows = t.orders.select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("transaction_date"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"), "o_orderstatus"
    )
    rules = ld.standard_rules("amount", KEY)
    for day, part in (("d1", rows.filter("o_orderstatus = 'F'")), ("d2", rows.filter("o_orderstatus <> 'F'"))):
        ld.daily_load(t.spark, part.drop("o_orderstatus"), "o_orderkey", *paths, day, "2024-01-31 00:00:00", rules, block=1000)
    return read_source(t.spark, paths[1]).select(KEY, "o_orderkey")


@query(
    "etl_batch_read",
    "SELECT 'TXN-' || o_orderkey AS transaction_id, o_totalprice AS amount FROM orders WHERE o_orderstatus = 'F'",
)
def etl_batch_read(t):
    stamped = source(t).withColumn("batch_id", F.concat(F.lit("b-"), "o_orderstatus"))
    return ld.read_batch(stamped, "b-F").select(KEY, F.col("amount").cast("double"))


@query(
    "seq_assign",
    """SELECT o_orderkey, 'TXN-' || lpad(CAST((SELECT max(o_custkey) FROM orders) + row_number() OVER (ORDER BY o_orderkey) AS VARCHAR), 12, '0')
       AS transaction_id FROM orders""",
)
def seq_assign(t):
    last = t.orders.agg(F.max("o_custkey")).first()[0]
    return ld.assign_ids(t.orders.select("o_orderkey"), last, "o_orderkey", width=12)


SEQUENCE = "SELECT o_orderpriority AS table_name, CAST(count(*) AS INTEGER) AS last_id FROM orders GROUP BY 1"


def sequences(t):
    counts = t.orders.groupBy(F.col("o_orderpriority").alias("table_name")).agg(F.count(F.lit(1)).cast("int").alias("last_id"))
    return counts


@query(
    "seq_advance",
    f"""SELECT table_name, CASE WHEN table_name = '1-URGENT' THEN last_id + (SELECT CAST(count(*) AS INTEGER) FROM customer)
        ELSE last_id END AS last_id FROM ({SEQUENCE})""",
)
def seq_advance(t):
    drawn = t.customer.agg(F.count(F.lit(1)).cast("int")).scalar()
    return ld.advance_sequence(sequences(t), "1-URGENT", F.col("last_id") + drawn)


@query(
    "insert_if_absent",
    f"""SELECT * FROM ({SEQUENCE}) UNION ALL SELECT c_mktsegment, CAST(count(*) AS INTEGER) FROM customer GROUP BY 1""",
)
def insert_if_absent(t):
    segments = t.customer.groupBy(F.col("c_mktsegment").alias("table_name")).agg(F.count(F.lit(1)).cast("int").alias("last_id"))
    again = sequences(t).withColumn("last_id", F.lit(0))
    return ld.insert_if_absent(sequences(t), segments.unionByName(again), ["table_name"])


@query(
    "as_of_snapshot",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderdate <= TIMESTAMP '1998-06-30 00:00:00'
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def as_of_snapshot(t):
    at = F.lit("1998-06-30 00:00:00").cast("timestamp_ntz")
    return ld.as_of(t.orders, ["o_custkey"], "o_orderdate", at, "o_orderkey").select("o_custkey", "o_orderkey", "o_totalprice")


# ---- layout ----


@query("layout_repartition", "SELECT o_orderkey, o_custkey FROM orders")
def layout_repartition(t):
    return layout.repartition_by(t.orders.select("o_orderkey", "o_custkey"), 16, "o_orderkey")


@query("layout_coalesce", "SELECT o_orderkey, o_custkey FROM orders")
def layout_coalesce(t):
    path = scratch_path(t.spark, "coalesce")
    write_sink(layout.fewer_files(t.orders, 8), path)
    return read_source(t.spark, path).select("o_orderkey", "o_custkey")


@query("layout_zorder", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def layout_zorder(t):
    path = scratch_path(t.spark, "zorder")
    write_sink(layout.zorder(t.orders, ["o_custkey", "o_totalprice"], files=16), path)
    return read_source(t.spark, path).select("o_orderkey", "o_custkey", "o_totalprice")


def by_account(t):
    """Orders clustered by account, a text, and day, inside each status."""
    path = scratch_path(t.spark, "zorder-text")
    rows = t.orders.select(
        "o_orderkey", F.concat(F.lit("ACC-"), F.lpad(F.col("o_custkey").cast("string"), 8, "0")).alias("account_id"),
        F.col("o_orderdate").cast("date").alias("day"), "o_orderstatus",
    )
    layout.write_zordered(rows, path, ["account_id", "day"], files=16, partition_by=["o_orderstatus"])
    return path


ACCOUNTS = """SELECT o_orderkey, 'ACC-' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS account_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
    o_orderstatus FROM orders"""


@query("layout_zorder_text", ACCOUNTS)
def layout_zorder_text(t):
    return read_source(t.spark, by_account(t)).select("o_orderkey", "account_id", F.col("day").cast("string"), "o_orderstatus")


@query(
    "layout_zone_scan",
    f"SELECT * FROM ({ACCOUNTS}) WHERE account_id BETWEEN 'ACC-00000010' AND 'ACC-00000019' AND day >= '1996-01-01'",
)
def layout_zone_scan(t):
    """A range of accounts and days, read from the files that can hold it."""
    path = by_account(t)
    zones = layout.zone_map(t.spark, path, ["account_id", "day"])
    ranges = {"account_id": ("ACC-00000010", "ACC-00000019"), "day": (datetime.date(1996, 1, 1), None)}
    out = layout.read_zones(t.spark, path, zones, ranges)
    return out.select("o_orderkey", "account_id", F.col("day").cast("string"), "o_orderstatus")


@query("layout_compact", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def layout_compact(t):
    """A table of many small files, packed into few."""
    path = scratch_path(t.spark, "compact")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    rows.repartition(12, "o_orderkey").write.partitionBy("o_orderstatus").parquet(path)
    layout.compact(t.spark, path, target_bytes=64 << 20)
    return read_source(t.spark, path).select("o_orderkey", "o_custkey", "o_orderstatus")


@query("write_published", "SELECT 1 AS version, count(*) AS n FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 2, count(*) FROM orders")
def write_published(t):
    """Two versions of a table behind a pointer, each still readable by its number."""
    path = scratch_path(t.spark, "published")
    for rows in (t.orders.filter("o_orderstatus = 'F'"), t.orders):
        publish(rows, path)
    one = lambda v: read_published(t.spark, path, v).agg(F.lit(v).alias("version"), F.count(F.lit(1)).alias("n"))
    return one(1).unionByName(one(2))


@query(
    "seq_claim",
    """SELECT o_orderkey, 'TXN-' || (row_number() OVER (PARTITION BY o_orderstatus = 'F' ORDER BY o_orderkey)
       + CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 500 * (SELECT (count(*) + 499) // 500 FROM orders WHERE o_orderstatus = 'F') END) AS transaction_id FROM orders""",
)
def seq_claim(t):
    """Two loads that draw from one sequence."""
    folder = scratch_path(t.spark, "claims")
    parts = [t.orders.filter(f"o_orderstatus {sign} 'F'").select("o_orderkey") for sign in ("=", "<>")]
    return reduce(DataFrame.unionByName, [ld.claim_ids(p, folder, "o_orderkey", block=500) for p in parts])


@query(
    "layout_advice",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CASE WHEN n <= 2 THEN 'none' WHEN n <= 1000 THEN 'partition' ELSE 'zorder' END AS advice
            FROM (SELECT count(DISTINCT {c}) AS n FROM lineitem)"""
        for c in ("l_returnflag", "l_linestatus", "l_orderkey", "l_quantity")
    ),
)
def layout_advice(t):
    return layout.layout_advice(t.lineitem, ["l_returnflag", "l_linestatus", "l_orderkey", "l_quantity"]).select("column", "advice")


@query(
    "skew_report",
    """SELECT user_id, n, CAST(n AS DOUBLE) / mean AS times_mean FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1),
       (SELECT CAST(count(*) AS DOUBLE) / count(DISTINCT user_id) AS mean FROM events) WHERE n / mean > 1""",
)
def skew_report(t):
    return layout.skew_report(t.events, "user_id")
