"""The strict load, file modes, feature tables and layout, on real folders."""

import collections
import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from bankops.operators import layout
from bankops.operators import load as ld
from bankops.operators.point_in_time import (
    FeatureSet,
    lookup_features,
    point_in_time,
    read_features,
    training_set,
    write_features,
)
from bankops.sources.files import path_exists, read_source, write_sink
from bankops.sources.tables import create_table, inline_rows, read_table, truncate_table, write_table

STAMP = "2024-01-31 00:00:00"
DDL = "transaction_id string, account_id string, transaction_date date, amount decimal(18,2)"


def batch(spark, rows):
    typed = [(k, a, dt.date(2024, 1, d), None if v is None else round(v, 2)) for k, a, d, v in rows]
    return spark.createDataFrame([(k, a, d, None if v is None else str(v)) for k, a, d, v in typed],
                                 "transaction_id string, account_id string, transaction_date date, amount string").withColumn(
        "amount", F.col("amount").cast("decimal(18,2)"))


def ids(df, col="transaction_id"):
    return sorted(r[col] for r in df.select(col).collect())


@pytest.fixture()
def paths(tmp_path):
    return [str(tmp_path / n) for n in ("target", "control", "rejects")]


def run(spark, rows, paths, batch_id, **more):
    return ld.run_batch(spark, batch(spark, rows), *paths, "transaction_id", ld.standard_rules("amount", "transaction_id"),
                        batch_id, STAMP, partition_by="transaction_date", **more)


GOOD = [("T1", "A", 1, 10.0), ("T2", "A", 2, 20.5), ("T3", "B", 2, 1.0)]


def test_batches_are_all_or_nothing(spark, paths):
    first = run(spark, GOOD, paths, "b1")
    assert (first.status, first.source_rows, first.success_rows, first.reject_rows) == ("SUCCESS", 3, 3, 0)
    bad = [("T4", "A", 3, 5.0), ("T5", "A", 3, 0.0), ("T6", "A", 3, None), (None, "A", 3, 7.0), ("T1", "A", 3, 9.0), (None, "B", 3, -1.0)]
    second = run(spark, bad, paths, "b2")
    assert (second.status, second.source_rows, second.success_rows, second.reject_rows) == ("FAILURE", 6, 0, 5)
    target, control, rejects = (read_source(spark, p) for p in paths)
    assert ids(target) == ["T1", "T2", "T3"]
    assert {(r.Business_Key, r.Error_Reason) for r in rejects.collect()} == {
        ("T5", ld.INVALID_AMOUNT), ("T6", ld.INVALID_AMOUNT), (None, ld.MISSING_KEY), ("T1", ld.DUPLICATE), (None, ld.INVALID_AMOUNT)}
    assert {(r.Batch_ID, r.Count_Summary, r.Hash_Status) for r in control.collect()} == {("b1", "3 / 3 / 0", "MATCH"), ("b2", "6 / 0 / 5", "MISMATCH")}
    ld.assert_batch_ok(control, "b1")
    with pytest.raises(ld.BatchFailed):
        ld.assert_batch_ok(control, "b2")
    assert ids(ld.read_batch(target, "b1")) == ["T1", "T2", "T3"]


def test_a_batch_can_be_run_again(spark, paths):
    run(spark, GOOD, paths, "b1")
    again = run(spark, GOOD, paths, "b1")
    assert again.status == "SUCCESS" and ids(read_source(spark, paths[0])) == ["T1", "T2", "T3"]
    assert run(spark, GOOD, paths, "b2").reject_rows == 3


def test_repeats_in_one_batch_collapse_or_are_refused(spark, paths):
    twice = GOOD + [("T1", "A", 1, 10.0)]
    assert run(spark, twice, paths, "b1").success_rows == 4
    assert read_source(spark, paths[0]).count() == 3
    checked = ld.check_batch(batch(spark, twice), None, "transaction_id", ld.standard_rules("amount", "transaction_id"), ["transaction_id"], True)
    assert [r.error_reason for r in checked.filter("validation_status = 'REJECT'").collect()] == [ld.DUPLICATE_IN_SOURCE] * 2


def test_upsert_moves_a_row_between_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = inline_rows(spark, [(1, "a", "x"), (2, "a", "y"), (3, "b", "z")], "id int, v string, p string")
    ld.upsert_table(spark, path, rows.select("id", "v", "p"), ["id"], "p")
    new = inline_rows(spark, [(3, "moved", "x"), (4, "new", "y")], "id int, v string, p string")
    for _ in range(2):  # doing it twice changes nothing
        ld.upsert_table(spark, path, new, ["id"], "p")
        got = sorted((r.id, r.v, r.p) for r in read_source(spark, path).collect())
        assert got == [(1, "a", "x"), (2, "a", "y"), (3, "moved", "x"), (4, "new", "y")]
    assert not path_exists(spark, f"{path}/p=z")


def test_upsert_with_partition_values_that_need_escaping(spark, tmp_path):
    path = str(tmp_path / "t")
    ddl = "id int, v string, p string"
    ld.upsert_table(spark, path, inline_rows(spark, [(1, "a", "x y"), (2, "b", "u:v"), (3, "c", None)], ddl), ["id"], "p")
    ld.upsert_table(spark, path, inline_rows(spark, [(2, "moved", "x y"), (3, "moved", "u:v")], ddl), ["id"], "p")
    got = sorted((r.id, r.v, r.p) for r in read_source(spark, path).collect())
    assert got == [(1, "a", "x y"), (2, "moved", "x y"), (3, "moved", "u:v")]


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "m")
    df = spark.range(195)
    write_sink(df, path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_sink(df, path)
    write_sink(read_source(spark, path), path, mode="overwrite")
    assert read_source(spark, path).count() == 195
    write_sink(df, path, mode="append")
    assert read_source(spark, path).count() == 390
    with pytest.raises(ValueError):
        write_sink(df, path, mode="replace")


def test_failed_overwrite_keeps_the_old_data(spark, tmp_path):
    path = str(tmp_path / "k")
    write_sink(spark.range(10), path)
    broken = spark.range(10).select(F.raise_error(F.lit("stop")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        write_sink(broken, path, mode="overwrite")
    assert read_source(spark, path).count() == 10


def test_csv_without_options_is_one_text_column(spark, tmp_path):
    path = str(tmp_path / "csv")
    write_sink(inline_rows(spark, [("a", 1), ("b", 2)], "k string, n int"), path, "csv", sep="|", header=True)
    raw = read_source(spark, path, "csv")
    assert len(raw.columns) == 1 and {t for _, t in raw.dtypes} == {"string"}
    assert dict(read_source(spark, path, "csv", sep="|", header=True, inferSchema=True).dtypes) == {"k": "string", "n": "int"}
    assert dict(read_source(spark, path, "csv", "k string, n long", sep="|", header=True).dtypes) == {"k": "string", "n": "bigint"}


def test_tables(spark, tmp_path):
    create_table(spark, "acc_test", "id bigint, p string", str(tmp_path / "t"), ["p"])
    create_table(spark, "acc_test", "id bigint, p string", str(tmp_path / "t"), ["p"])
    assert read_table(spark, "acc_test").count() == 0
    spark.range(3).withColumn("p", F.lit("a")).write.insertInto("acc_test")
    assert read_table(spark, "acc_test").count() == 3
    spark.sql("DROP TABLE acc_test")
    write_table(spark.range(3), "own_test")
    truncate_table(spark, "own_test")
    assert read_table(spark, "own_test").count() == 0
    spark.sql("DROP TABLE own_test")


def test_ids_and_sequence(spark):
    out = ld.assign_ids(spark.range(0, 100, 1, 7), 41, "id", hot_rows=10)
    assert sorted((r.id, r.transaction_id) for r in out.collect()) == [(i, f"TXN-{42 + i}") for i in range(100)]
    control = inline_rows(spark, [("a", 1), ("b", 5)], "table_name string, last_id int")
    assert {(r.table_name, r.last_id) for r in ld.advance_sequence(control, "a", F.col("last_id") + 3).collect()} == {("a", 4), ("b", 5)}
    more = inline_rows(spark, [("a", 0), ("c", 0)], "table_name string, last_id int")
    assert ids(ld.insert_if_absent(control, more, ["table_name"]), "table_name") == ["a", "b", "c"]


def test_as_of_only_moves_forward(spark):
    rows = inline_rows(spark, [(k, d, d * 10) for k in "ab" for d in range(1, 6)], "k string, d int, v int")
    seen = [sum(r.v for r in ld.as_of(rows, ["k"], "d", F.lit(t), "v").collect()) for t in range(0, 7)]
    assert seen == [0, 20, 40, 60, 80, 100, 100]


def test_feature_table(spark, tmp_path):
    path = str(tmp_path / "f")
    rows = inline_rows(spark, [("A", 1, 5), ("A", 2, 6), ("B", 1, 7)], "acc string, t int, v int")
    write_features(rows, path, ["acc", "t"])
    write_features(inline_rows(spark, [("A", 2, 60), ("C", 1, 8)], "acc string, t int, v int"), path, ["acc", "t"])
    stored = read_features(spark, path)
    assert sorted(map(tuple, stored.collect())) == [("A", 1, 5), ("A", 2, 60), ("B", 1, 7), ("C", 1, 8)]
    with pytest.raises(ValueError):
        write_features(rows, path, ["acc"])
    wanted = inline_rows(spark, [("A",), ("Z",)], "acc string")
    assert [tuple(r) for r in lookup_features(stored, wanted, ["acc"], "t", "v").collect()] == [("A", 2, 60)]


@pytest.mark.parametrize("hot", [None, 3])
def test_point_in_time(spark, hot):
    feats = inline_rows(spark, [("A", 1, 10, 0), ("A", 5, 20, 1), ("A", 5, 21, 2), ("B", 9, 30, 3)], "k string, t int, v int, fid int")
    labels = inline_rows(spark, [("A", 0, 1), ("A", 1, 2), ("A", 4, 3), ("A", 5, 4), ("A", 99, 5), ("B", 8, 6), (None, 9, 7)], "k string, t int, id int")
    out = point_in_time(labels, feats, ["k"], "t", "t", ["v"], "id", "fid", hot_rows=hot)
    assert sorted((r.id, r.v) for r in out.collect()) == [(1, None), (2, 10), (3, 10), (4, 21), (5, 21), (6, None), (7, None)]


@pytest.mark.parametrize("hot", [None, 2])
def test_training_set_takes_each_set_as_of_the_label(spark, hot):
    ddl = "k string, t int, {} int, id int"
    a = inline_rows(spark, [("A", 1, 10, 0), ("A", 6, 11, 1)], ddl.format("a"))
    b = inline_rows(spark, [("A", 3, 20, 0), ("A", 4, None, 1)], ddl.format("b"))
    labels = inline_rows(spark, [("A", 0, 1), ("A", 2, 2), ("A", 3, 3), ("A", 5, 4), ("A", 9, 5)], "k string, t int, id int")
    sets = [FeatureSet(a, ["a"], "t", "id"), FeatureSet(b, ["b"], "t", "id")]
    out = training_set(labels, sets, ["k"], "t", "id", hot)
    # the latest row counts even where its value is NULL
    assert sorted((r.id, r.a, r.b) for r in out.collect()) == [(1, None, None), (2, 10, None), (3, 10, 20), (4, 10, None), (5, 11, None)]
    plan = training_set(labels, sets, ["k"], "t", "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_partition_filter_and_pushdown(spark, tmp_path):
    path = str(tmp_path / "days")
    write_sink(spark.range(100).select("id", (F.col("id") % 5).cast("string").alias("day")), path, partition_by=["day"])
    plan = read_source(spark, path).filter("day = '3' AND id > 50")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "GreaterThan(id,50)" in plan
    assert len(glob.glob(f"{path}/day=*")) == 5


def test_zorder_narrows_files(spark, tmp_path):
    df = spark.range(20000).select(F.pmod(F.col("id") * 7919, F.lit(10007)).alias("a"), F.pmod(F.col("id") * 104729, F.lit(9973)).alias("b"))
    touched = {}
    for name, frame in (("plain", df.repartition(16)), ("z", layout.zorder(df, ["a", "b"], 16))):
        path = str(tmp_path / name)
        write_sink(frame, path)
        assert read_source(spark, path).count() == 20000
        stats = []
        for f in glob.glob(f"{path}/*.parquet"):
            groups = pq.ParquetFile(f).metadata
            cols = [[groups.row_group(g).column(i).statistics for g in range(groups.num_row_groups)] for i in range(2)]
            stats.append([(min(s.min for s in c), max(s.max for s in c)) for c in cols])
        touched[name] = [sum(lo <= 5000 <= hi for lo, hi in (s[i] for s in stats)) for i in range(2)]
    # file bounds come from a sample, so the exact number varies a little
    assert touched["plain"] == [16, 16] and sum(touched["z"]) <= 20


def test_zorder_spreads_equal_rows(spark):
    same = spark.range(8000).select(F.lit(1).alias("a"), F.lit(2).alias("b"), "id")
    sizes = [r["count"] for r in layout.zorder(same, ["a", "b"], 8).groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2000


def test_file_count_follows_coalesce(spark, tmp_path):
    path = str(tmp_path / "c")
    write_sink(layout.fewer_files(spark.range(100, numPartitions=8), 3), path)
    assert len(glob.glob(f"{path}/*.parquet")) == 3


def test_upsert_refuses_other_columns_and_doubled_keys(spark, tmp_path):
    path = str(tmp_path / "strict")
    spark.createDataFrame([(1, "a b", 10, 5)], "id int, p string, v int, extra int").write.partitionBy("p").parquet(path)
    with pytest.raises(ValueError):
        ld.upsert_table(spark, path, spark.createDataFrame([(1, "a b", 11)], "id int, p string, v int"), ["id"], "p")
    twice = spark.createDataFrame([(1, "a b", 11, 6), (1, "a b", 12, 6)], "id int, p string, v int, extra int")
    with pytest.raises(ValueError):
        ld.upsert_table(spark, path, twice, ["id"], "p")
    assert [tuple(r) for r in spark.read.parquet(path).select("id", "v", "extra").collect()] == [(1, 10, 5)]


def test_upsert_with_spaces_rewrites_only_touched_partitions(spark, tmp_path):
    path = tmp_path / "spaces"
    rows = spark.createDataFrame([(1, "a b", 10), (2, "c d", 20)], "id int, p string, v int")
    rows.write.partitionBy("p").parquet(str(path))
    before = sorted(f.name for f in (path / "p=c d").iterdir() if f.name.endswith(".parquet"))
    ld.upsert_table(spark, str(path), spark.createDataFrame([(1, "e f", 11)], "id int, p string, v int"), ["id"], "p")
    assert sorted(f.name for f in (path / "p=c d").iterdir() if f.name.endswith(".parquet")) == before
    assert not (path / "p=a b").exists()
    assert sorted(tuple(r) for r in spark.read.parquet(str(path)).select("id", "p", "v").collect()) == [(1, "e f", 11), (2, "c d", 20)]


def test_rows_without_a_key_do_not_meet_in_one_task(spark):
    """A third of a feed has no key, or is refused already: none of these rows is looked up, and all stay."""
    feed = spark.range(0, 9000, 1, 6).select(
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("T"), "id")).alias("transaction_id"), F.when(F.col("id") % 5 > 0, 1.0).alias("amount"), "id"
    )
    target = feed.where("id % 2 = 0").select("transaction_id").where("transaction_id IS NOT NULL")
    rules = ld.standard_rules("amount", "transaction_id")
    held = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for c, v in zip(held, ("false", "-1")):
            spark.conf.set(c, v)
        checked = ld.check_batch(feed, target, "transaction_id", rules, ["transaction_id", "amount"])
        rows = checked.select("*", F.spark_partition_id().alias("task")).collect()
    finally:
        for c, v in held.items():
            spark.conf.set(c, v)
    tasks = collections.Counter(r.task for r in rows if r.transaction_id is None)
    assert max(tasks.values()) <= 500 and sum(tasks.values()) == 3000 and sorted(r.id for r in rows) == list(range(9000))
    for r in rows:
        known = ld.DUPLICATE if r.id % 2 == 0 else None
        reason = ld.INVALID_AMOUNT if r.id % 5 == 0 else ld.MISSING_KEY if r.id % 3 == 0 else known
        assert r.error_reason == reason and (r.validation_status == ld.PASS) == (reason is None)
