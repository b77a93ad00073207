"""Queries for projection, scalar functions, filters, sorting and limits."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from bankops.functions.columns import band, clamp, fingerprint, map_lookup, parse_date, safe_ratio
from bankops.operators.relational import (
    add_columns,
    cast_columns,
    keep_known,
    rename,
    select_columns,
    top_k,
)
from bankops.plans.registry import query
from bankops.session import scratch_path
from bankops.sources.files import read_source, write_sink

# ---- projection ----


@query("select_names", "SELECT o_orderkey, o_orderstatus FROM orders")
def select_names(t):
    return t.orders.select("*").select("o_orderkey", "o_orderstatus")


@query("select_alias", "SELECT o_orderkey AS order_id, o_totalprice AS price, o_custkey AS customer_id FROM orders")
def select_alias(t):
    o = t.orders
    return o.select(o.o_orderkey.alias("order_id"), o["o_totalprice"].alias("price"), F.col("o_custkey").alias("customer_id"))


@query("select_dynamic", "SELECT l_extendedprice, l_discount, l_tax FROM lineitem")
def select_dynamic(t):
    return select_columns(t.lineitem, ["l_extendedprice", "l_discount", "l_tax"])


@query("col_arith", "SELECT l_orderkey, l_extendedprice * 1.1 AS with_fee FROM lineitem")
def col_arith(t):
    return t.lineitem.select("l_orderkey", (F.col("l_extendedprice") * 1.1).alias("with_fee"))


@query("rename_one", "SELECT n_nationkey, n_name AS country, n_regionkey FROM nation")
def rename_one(t):
    return t.nation.withColumnRenamed("n_name", "country")


@query("rename_many", "SELECT c_custkey AS customer_id, c_name AS name, c_acctbal AS balance FROM customer")
def rename_many(t):
    names = {"c_custkey": "customer_id", "c_name": "name", "c_acctbal": "balance"}
    return rename(t.customer, names).select("customer_id", "name", "balance")


@query("add_column", "SELECT o_orderkey, o_totalprice / 1000000 AS millions FROM orders")
def add_column(t):
    return add_columns(t.orders, {"millions": F.col("o_totalprice") / 1000000}).select("o_orderkey", "millions")


@query("replace_column", "SELECT p_partkey, upper(p_name) AS p_name FROM part")
def replace_column(t):
    return add_columns(t.part, {"p_name": F.upper("p_name")}).select("p_partkey", "p_name")


@query(
    "multi_transform",
    """SELECT p_partkey, upper(p_brand) AS brand, p_retailprice / 100 AS hundreds, length(p_name)::INTEGER AS name_length
       FROM part""",
)
def multi_transform(t):
    return t.part.select(
        "p_partkey",
        F.upper("p_brand").alias("brand"),
        (F.col("p_retailprice") / 100).alias("hundreds"),
        F.length("p_name").alias("name_length"),
    )


@query("drop_columns", "SELECT s_suppkey, s_acctbal FROM supplier")
def drop_columns(t):
    return t.supplier.drop("s_name", "s_nationkey")


@query(
    "cast_types",
    """SELECT CAST(o_orderkey AS VARCHAR) AS key_text, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS price, CAST(trunc(o_totalprice) AS INTEGER) AS whole,
       o_custkey, TRY_CAST(o_orderpriority AS INTEGER) AS bad FROM orders""",
)
def cast_types(t):
    src = t.orders.select(
        F.col("o_orderkey").alias("key_text"),
        F.col("o_orderdate").alias("day"),
        F.col("o_totalprice").alias("price"),
        F.col("o_totalprice").alias("whole"),
        "o_custkey",
        F.col("o_orderpriority").alias("bad"),
    )
    types = {"key_text": "string", "day": "date", "price": "decimal(18,2)", "whole": "int", "o_custkey": "long"}
    out = cast_columns(cast_columns(src, types), {"bad": "int"}, strict=False)
    return cast_columns(out, {"day": "string", "price": "double"})


@query("lit_column", "SELECT s_suppkey, 'USA' AS country, 1 AS flag FROM supplier")
def lit_column(t):
    return t.supplier.select("s_suppkey", F.lit("USA").alias("country"), F.lit(1).alias("flag"))


@query("expr_column", "SELECT o_orderkey, o_totalprice / 1000 AS thousands, o_orderstatus || '-' || o_orderpriority AS tag FROM orders")
def expr_column(t):
    return t.orders.select(
        "o_orderkey",
        F.expr("o_totalprice / 1000").alias("thousands"),
        F.expr("o_orderstatus || '-' || o_orderpriority").alias("tag"),
    )


@query("select_expr", "SELECT c_custkey, upper(c_mktsegment) AS segment, c_acctbal * 2 AS doubled FROM customer")
def select_expr(t):
    return t.customer.selectExpr("c_custkey", "upper(c_mktsegment) AS segment", "c_acctbal * 2 AS doubled")


SIZE_CASE = "CASE WHEN o_totalprice > 300000 THEN 'High' WHEN o_totalprice > 100000 THEN 'Medium' ELSE 'Small' END"


@query("case_expr", f"SELECT o_orderkey, {SIZE_CASE} AS size_class FROM orders")
def case_expr(t):
    return t.orders.select("o_orderkey", F.expr(SIZE_CASE).alias("size_class"))


@query(
    "case_when",
    f"""SELECT o_orderkey, {SIZE_CASE} AS size_class,
        CASE WHEN o_totalprice > 300000 THEN 'High' END AS high_only FROM orders""",
)
def case_when(t):
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey",
        band(price, [(300000, "High"), (100000, "Medium")], "Small").alias("size_class"),
        band(price, [(300000, "High")]).alias("high_only"),
    )


@query("clamp", "SELECT c_custkey, least(greatest(c_acctbal, 0.0), 5000.0) AS balance FROM customer")
def clamp_query(t):
    return t.customer.select("c_custkey", clamp(F.col("c_acctbal"), 0.0, 5000.0).alias("balance"))


@query(
    "map_lookup",
    """SELECT c_custkey, CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 1.2 WHEN 'MACHINERY' THEN 1.0
       WHEN 'HOUSEHOLD' THEN 0.8 END AS DOUBLE) AS weight FROM customer""",
)
def map_lookup_query(t):
    weights = {"BUILDING": 1.2, "MACHINERY": 1.0, "HOUSEHOLD": 0.8}
    return t.customer.select("c_custkey", map_lookup(F.col("c_mktsegment"), weights).alias("weight"))


@query("safe_ratio", "SELECT l_orderkey, l_extendedprice / nullif(l_discount, 0) AS ratio FROM lineitem")
def safe_ratio_query(t):
    return t.lineitem.select("l_orderkey", safe_ratio(F.col("l_extendedprice"), F.col("l_discount")).alias("ratio"))


# ---- filters ----


@query("filter_eq", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def filter_eq(t):
    return (
        t.orders.filter(F.col("o_orderstatus") == "F").filter("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_orderstatus")
    )


@query("filter_or", "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' OR c_acctbal > 5000")
def filter_or(t):
    return t.customer.filter((F.col("c_mktsegment") == "BUILDING") | (F.col("c_acctbal") > 5000)).select("c_custkey")


@query("filter_and", "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000")
def filter_and(t):
    return t.customer.filter((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 5000)).select("c_custkey")


@query("filter_computed", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_extendedprice / nullif(l_quantity, 0) > 2000")
def filter_computed(t):
    unit = safe_ratio(F.col("l_extendedprice"), F.col("l_quantity"))
    return t.lineitem.where(unit > 2000).select("l_orderkey", "l_linenumber")


@query("filter_compare", "SELECT event_id, value FROM events WHERE value >= 50 AND event_type <> 'view'")
def filter_compare(t):
    return t.events.filter((F.col("value") >= 50) & (F.col("event_type") != "view")).select("event_id", "value")


@query("filter_null", "SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL")
def filter_null(t):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return joined.filter(F.col("quality").isNull()).select("doc_id")


@query(
    "filter_in_keys",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE')""",
)
def filter_in_keys(t):
    keys = t.customer.filter("c_mktsegment = 'AUTOMOBILE'").select(F.col("c_custkey").alias("o_custkey"))
    return keep_known(t.orders.select("o_orderkey", "o_custkey"), keys, ["o_custkey"])


def partitioned_events(t):
    """Events stored by day and read back; the day filter below prunes folders."""
    path = scratch_path(t.spark, "by_day")
    write_sink(t.events.withColumn("day", F.to_date("ts")), path, partition_by=["day"])
    return read_source(t.spark, path)


@query(
    "filter_pruned",
    """SELECT event_id, user_id, value FROM events
       WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""",
)
def filter_pruned(t):
    days = F.col("day").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-12").cast("date"))
    return partitioned_events(t).filter(days).select("event_id", "user_id", "value")


def margin_udf():
    """A predicate Spark cannot look into; made per call, so it travels to the workers by value."""

    def margin(value: pd.Series) -> pd.Series:
        return value * 2 - 100

    return F.pandas_udf(margin, "double")


@query("filter_udf", "SELECT event_id, value FROM events WHERE value * 2 - 100 > 0")
def filter_udf(t):
    return t.events.select("event_id", "value").filter(margin_udf()("value") > 0)


# ---- sorting ----


@query("sort_single", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC")
def sort_single(t):
    return t.customer.select("c_custkey", "c_acctbal").sort("c_acctbal", ascending=False)


@query("sort_multi", "SELECT c_mktsegment, c_acctbal, c_custkey FROM customer ORDER BY c_mktsegment DESC, c_acctbal DESC")
def sort_multi(t):
    return t.customer.select("c_mktsegment", "c_acctbal", "c_custkey").sort("c_mktsegment", "c_acctbal", ascending=False)


@query("sort_mixed", "SELECT c_mktsegment, c_acctbal, c_custkey FROM customer ORDER BY c_mktsegment ASC, c_acctbal DESC")
def sort_mixed(t):
    cols = t.customer.select("c_mktsegment", "c_acctbal", "c_custkey")
    return cols.orderBy(F.col("c_mktsegment").asc(), F.col("c_acctbal").desc())


@query("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def topk(t):
    return top_k(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 20)


@query("topk_abs", "SELECT c_custkey, c_acctbal FROM customer ORDER BY abs(c_acctbal - 4500) DESC, c_custkey LIMIT 20")
def topk_abs(t):
    off = F.abs(F.col("c_acctbal") - 4500)
    return top_k(t.customer.select("c_custkey", "c_acctbal"), [off.desc(), F.asc("c_custkey")], 20)


# ---- scalar functions ----


def scalar(key: str, table: str, keep: str, column, sql: str):
    """Register ``SELECT keep, <sql> AS result`` and its Spark form."""

    @query(key, f"SELECT {keep}, {sql} AS result FROM {table}")
    def run(t):
        return getattr(t, table).select(keep, column().alias("result"))

    return run


scalar("fn_trim", "part", "p_partkey", lambda: F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))), "trim('  ' || p_name || ' ')")
scalar(
    "fn_initcap", "part", "p_partkey", lambda: F.initcap("p_name"),
    """array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ')""",
)
scalar("fn_upper", "part", "p_partkey", lambda: F.upper("p_name"), "upper(p_name)")
scalar(
    "fn_concat", "orders", "o_orderkey",
    lambda: F.concat("o_orderstatus", F.lit("/"), F.nullif("o_orderpriority", F.lit("5-LOW"))),
    "o_orderstatus || '/' || nullif(o_orderpriority, '5-LOW')",
)
scalar(
    "fn_concat_ws", "orders", "o_orderkey",
    lambda: F.concat_ws(", ", "o_orderstatus", F.nullif("o_orderpriority", F.lit("5-LOW"))),
    "concat_ws(', ', o_orderstatus, nullif(o_orderpriority, '5-LOW'))",
)
scalar("fn_length", "documents", "doc_id", lambda: F.length("text"), "CAST(length(text) AS INTEGER)")
scalar("fn_lpad", "customer", "c_custkey", lambda: F.lpad(F.col("c_custkey").cast("string"), 8, "0"), "lpad(CAST(c_custkey AS VARCHAR), 8, '0')")
scalar("fn_abs", "customer", "c_custkey", lambda: F.abs(F.col("c_acctbal") - 4500), "abs(c_acctbal - 4500)")
scalar("fn_round", "events", "event_id", lambda: F.round(F.col("value").cast("decimal(18,2)"), 1).cast("double"), "CAST(round(CAST(value AS DECIMAL(18,2)), 1) AS DOUBLE)")
scalar(
    "fn_math", "events", "event_id",
    lambda: F.round(F.exp(-F.col("value") / 100) + F.log(F.col("value") + 1) + F.pow(F.col("value"), F.lit(0.7)) + F.floor("value"), 6),
    "round(exp(-value / 100) + ln(value + 1) + pow(value, 0.7) + floor(value), 6)",
)
scalar(
    "fn_to_date", "orders", "o_orderkey",
    lambda: parse_date(F.date_format("o_orderdate", "dd-MM-yyyy"), "dd-MM-yyyy").cast("string"),
    "CAST(CAST(strptime(strftime(o_orderdate, '%d-%m-%Y'), '%d-%m-%Y') AS DATE) AS VARCHAR)",
)
scalar(
    "fn_to_timestamp", "events", "event_id",
    lambda: F.unix_micros(F.to_timestamp(F.date_format("ts", "dd/MM/yyyy HH:mm:ss"), "dd/MM/yyyy HH:mm:ss")),
    "epoch_us(strptime(strftime(ts, '%d/%m/%Y %H:%M:%S'), '%d/%m/%Y %H:%M:%S'))",
)
scalar("fn_date_format", "orders", "o_orderkey", lambda: F.date_format("o_orderdate", "dd, MMMM yyyy"), "strftime(o_orderdate, '%d, %B %Y')")
scalar("fn_datediff", "orders", "o_orderkey", lambda: F.datediff(F.lit("2002-01-01").cast("date"), "o_orderdate"), "CAST(DATE '2002-01-01' - CAST(o_orderdate AS DATE) AS INTEGER)")
scalar(
    "fn_months_between", "events", "event_id",
    lambda: F.months_between(F.lit("2024-06-15 12:00:00").cast("timestamp"), F.col("ts").cast("timestamp")),
    """CASE WHEN day(ts) = 15 THEN CAST(12 * (2024 - year(ts)) + 6 - month(ts) AS DOUBLE)
       ELSE round(12 * (2024 - year(ts)) + 6 - month(ts)
         + ((15 - day(ts)) * 86400 + 43200 - (hour(ts) * 3600 + minute(ts) * 60 + CAST(floor(second(ts)) AS INTEGER))) / 2678400.0, 8)
       END""",
)
scalar("fn_date_add", "orders", "o_orderkey", lambda: F.date_add("o_orderdate", 30).cast("string"), "CAST(CAST(o_orderdate AS DATE) + 30 AS VARCHAR)")
scalar("fn_hour", "events", "event_id", lambda: F.hour("ts"), "CAST(hour(ts) AS INTEGER)")
scalar(
    "fn_sha2", "orders", "o_orderkey",
    lambda: F.sha2(F.concat_ws("||", F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority"), 256),
    "sha256(concat_ws('||', CAST(o_orderkey AS VARCHAR), o_orderstatus, o_orderpriority))",
)
scalar(
    "fn_to_json", "orders", "o_orderkey", lambda: F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus")),
    """'{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"}'""",
)
scalar(
    "fn_element_at", "part", "p_partkey",
    lambda: F.element_at(F.array(*[F.lit(x) for x in ("small", "medium", "large")]), F.when(F.col("p_size") < 15, 1).when(F.col("p_size") < 35, 2).otherwise(3)),
    "['small', 'medium', 'large'][CASE WHEN p_size < 15 THEN 1 WHEN p_size < 35 THEN 2 ELSE 3 END]",
)
scalar("fn_line_total", "lineitem", "l_orderkey", lambda: F.col("l_quantity") * F.col("l_extendedprice") * 0.75, "l_quantity * l_extendedprice * 0.75")
scalar(
    "etl_row_hash", "orders", "o_orderkey",
    lambda: fingerprint(["o_orderkey", "o_orderpriority", "o_orderstatus"]),
    """sha256(coalesce(CAST(o_orderkey AS VARCHAR), '\\N') || '||' || coalesce(o_orderpriority, '\\N') || '||' || coalesce(o_orderstatus, '\\N'))""",
)
