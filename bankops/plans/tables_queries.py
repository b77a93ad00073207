"""Queries for sources, sinks, catalog tables and SQL views."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from bankops.operators.relational import union_rows
from bankops.plans.registry import query
from bankops.session import scratch_path
from bankops.sources.files import read_source, write_sink
from bankops.sources.tables import create_table, id_range, inline_rows, query_view, read_table, truncate_table, write_table

CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
CUSTOMER_DDL = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def _name(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex}"


@query(
    "src_csv",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""",
)
def src_csv(t):
    path = scratch_path(t.spark, "csv")
    write_sink(t.customer.select(*CUSTOMER), path, "csv", sep="|", header=True)
    return read_source(t.spark, path, "csv", sep="|", header=True)


@query("src_csv_infer", CUSTOMER_SQL)
def src_csv_infer(t):
    path = scratch_path(t.spark, "csv")
    write_sink(t.customer.select(*CUSTOMER), path, "csv", sep="|", header=True)
    typed = read_source(t.spark, path, "csv", sep="|", header=True, inferSchema=True)
    return typed.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("src_csv_schema", CUSTOMER_SQL)
def src_csv_schema(t):
    path = scratch_path(t.spark, "csv")
    write_sink(t.customer.select(*CUSTOMER), path, "csv", header=True)
    return read_source(t.spark, path, "csv", schema=CUSTOMER_DDL, header=True)


@query("sink_csv", "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def sink_csv(t):
    path = scratch_path(t.spark, "csv")
    rows = t.part.select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    write_sink(rows, path, "csv", mode="overwrite", sep="\t", header=True)
    return read_source(t.spark, path, "csv", schema=rows.schema, sep="\t", header=True)


@query("src_json", "SELECT event_id, user_id, event_type, value FROM events")
def src_json(t):
    path = scratch_path(t.spark, "json")
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    write_sink(rows, path, "json")
    return read_source(t.spark, path, "json", schema=rows.schema, multiLine=False)


@query("src_parquet", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def src_parquet(t):
    path = scratch_path(t.spark, "parquet")
    write_sink(t.orders, path)
    return read_source(t.spark, path).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("src_table", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def src_table(t):
    name = _name("supplier")
    write_table(t.supplier, name, path=scratch_path(t.spark, "table"))
    return read_table(t.spark, name).select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


@query(
    "sink_partitioned",
    """SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM events GROUP BY event_type""",
)
def sink_partitioned(t):
    path = scratch_path(t.spark, "parts")
    write_sink(t.events, path, partition_by=["event_type"])
    back = read_source(t.spark, path)
    total = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), total.alias("total"))


@query("mode_overwrite", "SELECT count(*) AS n FROM customer")
def mode_overwrite(t):
    path = scratch_path(t.spark, "overwrite")
    write_sink(t.customer, path)
    write_sink(read_source(t.spark, path), path, mode="overwrite")
    return read_source(t.spark, path).agg(F.count(F.lit(1)).alias("n"))


@query("mode_append", "SELECT 2 * count(*) AS n FROM customer")
def mode_append(t):
    path = scratch_path(t.spark, "append")
    write_sink(t.customer, path)
    write_sink(t.customer, path, mode="append")
    return read_source(t.spark, path).agg(F.count(F.lit(1)).alias("n"))


@query("mode_refused", "SELECT count(*) AS n, true AS refused FROM customer")
def mode_refused(t):
    """Without a mode a second write to the path is refused, and the first one's rows stay."""
    path = scratch_path(t.spark, "refused")
    write_sink(t.customer, path)
    try:
        write_sink(t.orders, path)
        refused = False
    except AnalysisException:
        refused = True
    return read_source(t.spark, path).agg(F.count(F.lit(1)).alias("n")).withColumn("refused", F.lit(refused))


@query("table_truncate", "SELECT count(*) AS before, CAST(0 AS BIGINT) AS after FROM supplier")
def table_truncate(t):
    name = _name("truncated")
    write_table(t.supplier, name)
    before = read_table(t.spark, name).count()
    truncate_table(t.spark, name)
    after = read_table(t.spark, name).count()
    t.spark.sql(f"DROP TABLE {name}")
    return inline_rows(t.spark, [(before, after)], "before long, after long")


@query(
    "src_inline",
    """WITH p(o_orderpriority, days) AS (VALUES ('1-URGENT', 1), ('2-HIGH', 3), ('3-MEDIUM', 7))
       SELECT o.o_orderkey, p.days FROM orders o LEFT JOIN p ON o.o_orderpriority = p.o_orderpriority""",
)
def src_inline(t):
    due = inline_rows(t.spark, [("1-URGENT", 1), ("2-HIGH", 3), ("3-MEDIUM", 7)], "o_orderpriority string, days int")
    return t.orders.join(due, "o_orderpriority", "left").select("o_orderkey", "days")


@query(
    "src_range",
    """SELECT r.id AS c_custkey, count(o.o_orderkey) AS n
       FROM range(0, (SELECT max(c_custkey) + 1 FROM customer)) r(id)
       LEFT JOIN orders o ON o.o_custkey = r.id GROUP BY r.id""",
)
def src_range(t):
    last = t.customer.agg(F.max("c_custkey")).first()[0]
    per = t.orders.groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"))
    ids = id_range(t.spark, 0, last + 1)
    return ids.join(per, ids.id == per.o_custkey, "left").select(
        F.col("id").alias("c_custkey"), F.coalesce("n", F.lit(0)).alias("n")
    )


@query("ddl_tables", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def ddl_tables(t):
    name, path = _name("accounts"), scratch_path(t.spark, "ddl")
    for _ in range(2):  # the second call finds the table and leaves it
        create_table(t.spark, name, "c_custkey bigint, c_acctbal double, c_mktsegment string", path, ["c_mktsegment"])
    t.customer.select("c_custkey", "c_acctbal", "c_mktsegment").write.insertInto(name)
    return read_table(t.spark, name).select("c_custkey", "c_mktsegment", "c_acctbal")


VIEW_SQL = """SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
              FROM {view} GROUP BY o_orderstatus"""


@query("sql_view", VIEW_SQL.format(view="orders"))
def sql_view(t):
    view = _name("v")
    return query_view(t.orders, view, VIEW_SQL.format(view=view))


@query("sql_global_view", VIEW_SQL.format(view="orders"))
def sql_global_view(t):
    view = _name("g")
    return query_view(t.orders, view, VIEW_SQL.format(view=f"global_temp.{view}"), shared=True)


@query("sql_param", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def sql_param(t):
    view = _name("v")
    sql = f"SELECT o_orderkey, o_totalprice FROM {view} WHERE o_orderstatus = :status AND o_totalprice > :floor"
    return query_view(t.orders, view, sql, {"status": "F", "floor": 100000})


@query(
    "union_all",
    """SELECT c_custkey AS id, c_acctbal AS balance FROM customer
       UNION ALL SELECT s_suppkey, s_acctbal FROM supplier UNION ALL SELECT s_suppkey, s_acctbal FROM supplier""",
)
def union_all(t):
    customers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    suppliers = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"))
    return union_rows(customers, suppliers, suppliers)
