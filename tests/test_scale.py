"""Heavy keys by sketch, exact floating sums, categories without a list on the driver, layouts and steps that happen once."""

import collections
import datetime as dt
import glob
import math
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from bankops.functions.columns import money
from bankops.ml import regression
from bankops.ml.frequency import frequency_index, join_categories, one_hot_table
from bankops.ml.synth import synth_fraud, synth_loans, uniform
from bankops.operators import exact, heavy, layout, windows
from bankops.operators import features as fx
from bankops.operators import load as ld
from bankops.sources import journal
from bankops.sources.files import path_exists, read_source, write_sink
from bankops.sources.tables import inline_rows

# ---- heavy keys ----


def keyed(spark):
    """Many light keys, some heavy ones, null among them."""
    rows = [(i % 5000, "x") for i in range(10_000)] + [(7, "x")] * 900 + [(None, "y")] * 700 + [(8, None)] * 500
    return spark.createDataFrame(rows, "k int, s string").repartition(6)


@pytest.mark.parametrize("counters", [1, 16, 1024, heavy.COUNTERS])
def test_heavy_keys_equal_exact_counts(spark, counters):
    df = keyed(spark)
    for keys in (["k"], ["k", "s"]):
        for least in (1, 2.5, 499, 500, 5000):
            counts = df.groupBy(*keys).count().where(F.col("count") > least)
            found = heavy.heavy_keys(df, keys, least, counters)
            assert sorted(map(str, found.collect() if found is not None else [])) == sorted(str(r).replace("count=", "_rows=") for r in counts.collect())
    assert heavy.heavy_keys(df.limit(0), ["k"], 0, counters) is None


def test_saturated_counters_are_taken_anew(spark, monkeypatch):
    used = []
    real = heavy.full_counters
    monkeypatch.setattr(heavy, "full_counters", lambda df, keys, least, counters=16: used.append(counters) or real(df, keys, least, counters))
    above, counters = heavy.full_counters(keyed(spark), ["k"], 100, 16)
    assert used == [16, 1024] and counters == 1024 and len(above) <= 4


def test_features_of_a_frame_share_a_search(spark, monkeypatch):
    """Three features of one frame, one after the other on each other's columns: one search, and one more for another key."""
    searches = []
    real = heavy.heavy_keys
    monkeypatch.setattr(heavy, "heavy_keys", lambda *a: searches.append(a[1]) or real(*a))
    monkeypatch.setattr(heavy, "_searches", [])
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(minutes=7 * i), i % 3, float(i % 11), "ab"[i % 2]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, ts timestamp, user long, value double, kind string").repartition(2)
    spark.conf.set("spark.bankops.hotRows", "30")
    try:
        out = windows.previous(df, "user", "ts", {"before": "value"}, "id")
        out = fx.gap_stats(out, "user", "ts", 7, "id")
        out = windows.running_sum(out, "user", "ts", money("value"), "id")
        out = fx.zscore(out, "user", "value")
        assert searches == [["user"]]
        windows.running_sum(df, "kind", "ts", money("value"), "id").collect()
        assert searches == [["user"], ["kind"]]
    finally:
        spark.conf.unset("spark.bankops.hotRows")


@pytest.mark.parametrize("hot", [None, 20])
def test_gap_stats_equal_the_plain_window(spark, hot):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(seconds=rng.randrange(10**6)), "ab"[i % 5 == 0], rng.random()) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, ts timestamp, user string, value double")
    got = {r.id: (r.gap_avg, r.gap_std) for r in fx.gap_stats(df, "user", "ts", 2, "id", hot_rows=hot).collect()}
    for i, at, user, _ in rows:
        mine = sorted((t, j) for j, t, u, _ in rows if u == user)
        gaps = [(b[0] - a[0]).total_seconds() for a, b in zip(mine, mine[1:]) if at - dt.timedelta(days=2) <= b[0] <= at]
        mean, std = (np.mean(gaps) if gaps else None), (np.std(gaps, ddof=1) if len(gaps) > 1 else None)
        assert got[i] == (mean and pytest.approx(mean), std and pytest.approx(std, abs=1e-6))


def test_join_split_sends_heavy_keys_apart(spark, monkeypatch):
    monkeypatch.setattr(heavy, "BROADCAST_ROWS", 3)
    df = keyed(spark)
    table = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = heavy.join_split(df, table, ["k"], 400)
    assert got.columns == ["k", "s", "n"]
    want = collections.Counter(r.k for r in df.collect())
    assert collections.Counter((r.k, r.n) for r in got.collect()) == collections.Counter({(k, n): n for k, n in want.items()})


def test_skew_report_counts_null_and_factor(spark):
    got = {r.k: (r.n, r.times_mean) for r in layout.skew_report(keyed(spark), "k", 100).collect()}
    mean = 12_100 / 5001
    assert got == {7: (902, 902 / mean), None: (700, 700 / mean), 8: (502, 502 / mean)}
    assert layout.skew_report(keyed(spark).limit(0), "k").count() == 0


# ---- exact sums ----


FLOATS = [
    [0.1, 0.2, 0.3, 1e16, -1e16, 0.1, None, 3.3],
    [1e300, 1.0, -1e300, 1e-300, 5e-324, -1e-300, 2.0, 0.0],
    [-1e-300, 1.0, -1.0, 1e-300, -5e-324],
    [1e40, 1.0, -1e40, 1e-20],
    [1.5, float("inf"), 2.0], [float("inf"), float("-inf")], [float("nan"), 1.0], [None, None], [],
]


@pytest.mark.parametrize("values", FLOATS)
def test_sums_of_limbs_are_exact(spark, values):
    """Every range of exponents, and the values that are no numbers, against the exactly rounded sum."""
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    limbs = exact.as_limbs(df, F.col("v"), "_p")
    sums = limbs.rows.agg(*[F.sum(c).alias(n) for n, c in limbs.parts.items()])
    got = sums.select(limbs.total().alias("t")).first().t
    held = [v for v in values if v is not None]
    try:
        want = math.fsum(held) if held else None
    except ValueError:
        want = float("nan")
    assert got == want or (want != want and got != got)


@pytest.mark.parametrize("values, hot", [(FLOATS[0], 2), ([1e30, 1.0, -1e30, 1e-20, 2.0], None), ([1.5, float("inf"), 2.0, float("nan"), 1.0], None)])
def test_rolling_sums_of_floats_are_exact(spark, values, hot):
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(days=i), "u", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id long, ts timestamp, user string, value double")
    for r in windows.rolling(df, "user", "ts", "value", "sum", "id", "total", days=2, hot_rows=hot).collect():
        frame = [v for v in values[max(0, r.id - 2) : r.id + 1] if v is not None]
        want = math.fsum(frame) if frame else None
        assert r.total == want or (want != want and r.total != r.total), (r.id, r.total, want)


def test_rolling_sums_of_random_floats(spark):
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(hours=i), i % 2, rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randrange(-12, 12)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, ts timestamp, user int, value double").repartition(3)
    for hot in (40,):
        for r in windows.over_days(df, "user", "ts", {"s": 2, "n": 1}, {"s": ("sum", F.col("value")), "n": ("count", F.col("value"))}, "id", hot).collect():
            frame = [v for i, t, u, v in rows if u == r.user and r.ts - dt.timedelta(days=2) <= t <= r.ts]
            assert r.s == pytest.approx(math.fsum(frame), rel=1e-15) and r.n == sum(r.ts - dt.timedelta(days=1) <= t <= r.ts for i, t, u, v in rows if u == r.user)


# ---- categories ----


def test_frequency_index_equals_the_plain_indexer(spark):
    rows = [(i, "abcde"[min(int(math.log2(i + 1)), 4)]) for i in range(40)] + [(100, None), (101, "zz"), (102, "é")]
    df = spark.createDataFrame(rows, "id long, c string").repartition(3)
    plain = StringIndexer(inputCol="c", outputCol="idx", handleInvalid="skip").fit(df.dropna())
    want = {r.c: r.idx for r in plain.transform(df.dropna()).collect()}
    for hot in (None, 2):
        index = frequency_index(df, "c", hot_rows=hot)
        assert {r.c: r.idx for r in index.collect()} == want
    for drop_last in (True, False):
        vec = one_hot_table(index, "c", drop_last=drop_last)
        coder = OneHotEncoder(inputCol="idx", outputCol="vec", dropLast=drop_last).fit(plain.transform(df.dropna()))
        old = {r.id: r.vec for r in coder.transform(plain.transform(df.dropna())).collect()}
        got = {r.id: r.vec for r in join_categories(df, vec, "c").collect()}
        assert got == {**old, 100: None}


def test_a_million_categories_stay_off_the_driver(spark, monkeypatch):
    """Numbers of a million categories, one of which holds a fifth of the rows, by ranges and a split join; the driver sees a few rows."""
    df = spark.range(0, 1_250_000, 1, 8).select(F.when(F.col("id") < 250_000, "hot").otherwise(F.concat(F.lit("c"), "id")).alias("c"))
    taken, real = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: taken.append(real(self)) or taken[-1])
    monkeypatch.setattr(heavy, "BROADCAST_ROWS", 1000)
    out = join_categories(df, frequency_index(df, "c", hot_rows=200_000), "c", hot_rows=200_000)
    n, last, hot = out.agg(F.count("idx"), F.max("idx"), F.max(F.when(F.col("c") == "hot", F.col("idx")))).first()
    assert (n, last, hot) == (1_250_000, 1_000_000.0, 0.0)
    assert max(map(len, taken)) <= 10


# ---- models ----

DRIVERS = ["credit_score", "log_revenue", "industry_risk", "tenor_years", "secured", "utilization", "relationship_years"]
SIGNALS = ["amount", "night_txn", "cross_border", "device_change"]


@pytest.fixture(scope="module")
def loans(spark):
    return synth_loans(spark.range(3000), "id").cache()


@pytest.fixture(scope="module")
def cards(spark):
    return synth_fraud(spark.range(4000), "id").withColumn("n", F.substring("transaction_id", 4, 12).cast("long")).cache()


@pytest.mark.parametrize("reg", [0.0, 0.05, 20.0])
def test_linear_model_equals_the_library(spark, loans, reg):
    vectors = VectorAssembler(inputCols=DRIVERS, outputCol="raw").transform(loans)
    scaled = StandardScaler(inputCol="raw", outputCol="x", withMean=False, withStd=True).fit(vectors)
    old = LinearRegression(featuresCol="x", labelCol="spread_bps", regParam=reg, solver="normal").fit(scaled.transform(vectors))
    model = regression.fit_linear(loans, DRIVERS, "spread_bps", reg)
    assert np.allclose(model.coefficients * model.deviation, old.coefficients.toArray(), rtol=1e-5)
    assert model.intercept == pytest.approx(old.intercept, rel=1e-5)
    table = {r.feature: r.coefficient for r in model.table(loans).collect()}
    assert set(table) == {*DRIVERS, regression.INTERCEPT} and table[regression.INTERCEPT] == model.intercept
    centred = {r.feature: r.coefficient for r in model.table(loans, raw=False).collect()}
    assert centred[regression.INTERCEPT] == pytest.approx(loans.agg(F.avg("spread_bps")).first()[0])


def test_moments_add_up_and_do_not_depend_on_order(spark, loans):
    cols = ["credit_score", "utilization", "spread_bps"]
    whole = regression.moments(loans, cols)
    assert whole == regression.moments(loans.repartition(7), cols)
    parts = regression.moments(loans.withColumn("p", F.col("secured")), cols, by="p")
    assert parts[0.0] + parts[1.0] == whole and whole - parts[1.0] == parts[0.0]
    pdf = loans.select(*cols).toPandas()
    assert np.allclose(whole.covariance(True), np.cov(pdf.to_numpy().T), rtol=1e-4)
    holes = loans.withColumn("utilization", F.when(F.col("secured") == 1, F.col("utilization")))
    assert regression.moments(holes, cols).rows == loans.where("secured = 1").count()
    flat = regression.fit_linear(loans.withColumn("same", F.lit(3.0)), ["same", "credit_score"], "spread_bps")
    assert flat.coefficients[0] == 0 and np.isfinite(flat.intercept)


@pytest.mark.parametrize("reg, elastic", [(0.01, 0.0), (0.1, 0.5), (0.02, 1.0)])
def test_logistic_model_equals_the_library(spark, cards, reg, elastic):
    vectors = VectorAssembler(inputCols=SIGNALS, outputCol="raw").transform(cards)
    scaled = StandardScaler(inputCol="raw", outputCol="x", withMean=True, withStd=True).fit(vectors).transform(vectors)
    old = LogisticRegression(featuresCol="x", labelCol="is_fraud", regParam=reg, elasticNetParam=elastic, maxIter=500, tol=1e-10).fit(scaled)
    model = regression.fit_logistic(cards, SIGNALS, "is_fraud", reg, elastic)
    assert np.allclose(model.coefficients * model.deviation, old.coefficients.toArray(), atol=2e-4)
    p = {r.transaction_id: r.probability for r in regression.predict_logistic(model, cards).collect()}
    for r in old.transform(scaled).select("transaction_id", "probability").limit(200).collect():
        assert p[r.transaction_id] == pytest.approx(r.probability[1], abs=5e-4)


def test_cross_validation_equals_a_fit_for_each_fold(spark, cards):
    grid = {"regParam": [0.01, 0.5], "elasticNetParam": [0.0, 1.0]}
    table, best = regression.cross_validate(cards, SIGNALS, "is_fraud", "n", grid)
    rows = cards.withColumn("f", F.floor(uniform(F.col("n"), 0) * 3).cast("int"))
    rows = VectorAssembler(inputCols=SIGNALS, outputCol="raw").transform(rows)
    got = {(r.regParam, r.elasticNetParam): r for r in table.collect()}
    for (reg, mix), row in got.items():
        areas = []
        for f in range(3):
            train, test = rows.where(f"f <> {f}"), rows.where(f"f = {f}")
            scaler = StandardScaler(inputCol="raw", outputCol="x", withMean=True).fit(train)
            old = LogisticRegression(featuresCol="x", labelCol="is_fraud", regParam=reg, elasticNetParam=mix, maxIter=300, tol=1e-9).fit(scaler.transform(train))
            areas.append(BinaryClassificationEvaluator(labelCol="is_fraud").evaluate(old.transform(scaler.transform(test))))
        assert row.auc == pytest.approx(np.mean(areas), abs=2e-3)
    assert [r.best for r in got.values()].count(True) == 1 and max(got.values(), key=lambda r: r.auc).best
    assert np.isfinite(best.coefficients).all() and np.isfinite(best.intercept)


# ---- layout ----


def test_zorder_of_text_and_dates_inside_partitions(spark, tmp_path):
    rows = spark.range(30_000).select(
        F.concat(F.lit("ACC-"), F.lpad(F.pmod(F.col("id") * 7919, F.lit(5003)).cast("string"), 6, "0")).alias("account"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("id") * 31, F.lit(365)).cast("int")).alias("day"),
        (F.col("id") % 3).alias("region"),
    )
    rows = rows.withColumn("account", F.when(F.length("account") > 3, F.col("account")))
    path = str(tmp_path / "z")
    layout.write_zordered(rows, path, ["account", "day"], 60, partition_by=["region"])
    stored = read_source(spark, path)
    assert stored.count() == 30_000 and stored.exceptAll(rows.select("account", "day", F.col("region").cast("int"))).isEmpty()
    zones = layout.zone_map(spark, path, ["account", "day"]).cache()
    files = zones.count()
    assert 60 <= files <= 80
    by_account = layout.files_for(zones, {"account": ("ACC-002500", "ACC-002500")})
    by_day = layout.files_for(zones, {"day": (dt.date(2024, 6, 1), dt.date(2024, 6, 2))})
    assert 1 <= len(by_account) <= files // 2 and 1 <= len(by_day) <= files // 2


def test_split_points_follow_the_order_of_any_type(spark):
    rows = [(i, f"é{i:03d}" if i % 2 else f"a{i:03d}", float("nan") if i == 5 else i / 3, None) for i in range(200)]
    df = spark.createDataFrame(rows, "n int, s string, d double, none string")
    for c in ("n", "s", "d"):
        points = layout.split_points(df, [c], 8)[0]
        assert len(points) == 7 and points == sorted(points)
        kind = dict(df.dtypes)[c]
        got = {r[0]: r[1] for r in df.select(c, layout.bucket_of(F.col(c), points, kind)).collect()}
        for v, b in got.items():
            assert b == (7 if v != v else sum(p < v for p in points))
    assert layout.split_points(df, ["none"], 8) == [[]]


def test_zone_map_reads_only_the_files_that_can_match(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(1000).select("id", F.when(F.col("id") % 100 != 7, F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 4, "0"))).alias("k"), (F.col("id") % 2).alias("side x"))
    rows.repartitionByRange(10, "id").write.partitionBy("side x").parquet(path)
    zones = layout.zone_map(spark, path, ["id", "k"])
    whole = spark.read.parquet(path)
    for ranges, nulls, most in (({"id": (150, 249)}, [], 6), ({"k": (None, "k0050")}, [], 2), ({"id": (990, None), "k": ("k0995", None)}, [], 2), ({"id": (5000, None)}, [], 0), ({"id": (0, 300)}, ["k"], 4)):
        got = layout.read_zones(spark, path, zones, ranges, nulls)
        want = whole
        for c, (low, high) in ranges.items():
            want = want if low is None else want.where(F.col(f"`{c}`") >= low)
            want = want if high is None else want.where(F.col(f"`{c}`") <= high)
        for c in nulls:
            want = want.where(F.col(c).isNull())
        assert got.columns == whole.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert len(got.inputFiles()) <= most


def files_of(path):
    return {os.path.relpath(f, path): os.path.getsize(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True) if "_compact" not in os.path.relpath(f, path)}


def test_compaction_rewrites_small_files_only(spark, tmp_path):
    path = str(tmp_path / "c d")
    big = spark.range(200_000).select("id", F.lit("a b").alias("p"))
    big.repartition(1).write.partitionBy("p").parquet(path)
    for k in range(6):
        spark.range(k * 10, k * 10 + 10).select("id", F.lit("a b" if k % 2 else "c").alias("p")).repartition(1).write.mode("append").partitionBy("p").parquet(path)
    spark.range(3).select("id", F.lit("alone").alias("p")).repartition(1).write.mode("append").partitionBy("p").parquet(path)
    before, rows = files_of(path), sorted(map(str, spark.read.parquet(path).collect()))
    target = max(before.values())
    groups = layout.compact(spark, path, target)
    after = files_of(path)
    kept = set(before) & set(after)
    assert len(groups) == 2 and len(after) == 4
    assert {f for f in before if before[f] >= target / 2 or "alone" in f} == kept
    assert sorted(map(str, spark.read.parquet(path).collect())) == rows
    assert layout.compact(spark, path, target) == [] and files_of(path) == after


def test_a_stopped_compaction_is_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for k in range(4):
        spark.range(k * 10, k * 10 + 10).repartition(1).write.mode("append").parquet(path)
    real = layout.finish_compaction
    calls = []
    monkeypatch.setattr(layout, "finish_compaction", lambda s, p: calls.append(1) or (real(s, p) if len(calls) == 1 else None))
    layout.compact(spark, path, 1 << 20)
    assert len(files_of(path)) == 4  # written down, nothing moved
    monkeypatch.undo()
    assert layout.compact(spark, path, 1 << 20) == []
    assert len(files_of(path)) == 1 and sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(40))


@pytest.mark.parametrize("seed", range(5))
def test_packing_of_files_respects_the_target(seed):
    rng = random.Random(seed)
    sizes = [(f"d{rng.randrange(3)}/f{i}", rng.randrange(1, 120)) for i in range(80)]
    groups = layout.pack_files(sizes, 100)
    size = dict(sizes)
    flat = [f for g in groups for f in g]
    assert len(flat) == len(set(flat)) and all(size[f] < 50 for f in flat)
    assert all(sum(size[f] for f in g) <= 100 and len(g) > 1 and len({f.split("/")[0] for f in g}) == 1 for g in groups)


# ---- steps that happen once ----

GOOD = [("T1", "A", 1, "10.00"), ("T2", "A", 2, "20.50"), ("T3", "B", 2, "1.00")]
BAD = [*GOOD, ("T4", "A", 3, "0.00"), (None, "A", 3, "7.00")]


def batch(spark, rows):
    rows = [(k, a, dt.date(2024, 1, d), v) for k, a, d, v in rows]
    return spark.createDataFrame(rows, "transaction_id string, account_id string, transaction_date date, amount string").withColumn("amount", F.col("amount").cast("decimal(18,2)"))


def run(spark, rows, paths, batch_id, **more):
    return ld.run_batch(spark, batch(spark, rows), *paths, "transaction_id", ld.standard_rules("amount", "transaction_id"), batch_id, "2024-01-31 00:00:00", partition_by="transaction_date", **more)


class Stop(Exception):
    pass


@pytest.mark.parametrize("rows, status", [(GOOD, "SUCCESS"), (BAD, "FAILURE")])
def test_a_batch_stopped_after_any_step_is_replayed(spark, tmp_path, monkeypatch, rows, status):
    """Stop at every call that changes something, before and after it, run again, and compare with a run in one go."""
    want = None
    for stop_at in (0, 1, 2, 3, 5, 6, 7, 8, 10):
        paths = [str(tmp_path / f"{stop_at}-{n}") for n in ("target", "control", "rejects")]
        with monkeypatch.context() as m:
            count = [0]

            def guarded(real):
                def call(*a, **k):
                    count[0] += 1
                    if count[0] == stop_at:
                        raise Stop
                    out = real(*a, **k)
                    count[0] += 1
                    if count[0] == stop_at:
                        raise Stop
                    return out

                return call

            for place, name in ((ld, "append_once"), (ld, "upsert_table"), (ld.Journal, "mark"), (journal, "make_exclusive")):
                m.setattr(place, name, guarded(getattr(place, name)))
            try:
                run(spark, rows, paths, "b1", run_time="t")
                finished = True
            except Stop:
                finished = journal.Journal(spark, f"{paths[1]}/_steps").done("b1", 0, "control")
        result = run(spark, rows, paths, "b1", run_time="t") if not finished else None
        got = [sorted(str(r) for r in read_source(spark, p).collect()) if path_exists(spark, p) else [] for p in paths]
        if stop_at == 0:
            want = got
        assert got == want, stop_at
        assert result is None or result.status == status


def test_a_failed_batch_can_be_mended_under_its_id(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("target", "control", "rejects")]
    assert run(spark, BAD, paths, "b1").status == "FAILURE"
    control = lambda: read_source(spark, paths[1])
    with pytest.raises(ld.BatchFailed):
        ld.assert_batch_ok(control(), "b1")
    assert run(spark, GOOD, paths, "b1").status == "SUCCESS"
    ld.assert_batch_ok(control(), "b1")
    assert sorted((r.Attempt, r.Status) for r in control().collect()) == [(0, "FAILURE"), (1, "SUCCESS")]
    assert run(spark, BAD, paths, "b1").status == "FAILURE"
    with pytest.raises(ld.BatchFailed):
        ld.assert_batch_ok(control(), "b1")
    with pytest.raises(ld.BatchFailed):
        ld.assert_batch_ok(control(), "never run")
    times = [r.Run_Time for r in control().collect()]
    assert all(len(t.split(" - ")) == 2 and t[2] == ":" for t in times) and sum(t.endswith("FAIL") for t in times) == 2
    old = inline_rows(spark, [("b", "FAILURE"), ("b", "SUCCESS")], "Batch_ID string, Status string")  # rows without attempts
    assert ld.batch_status(old).first().Status == "FAILURE"


def test_append_once_moves_each_row_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    rows = spark.range(30).repartition(4)
    assert journal.append_once(rows, path, "a") and not journal.append_once(rows, path, "a")
    staged = tmp_path / "log" / "_staged-b"
    rows.write.parquet(str(staged))  # a run that stopped with half of its files moved
    part = sorted(staged.glob("part-*"))[0]
    part.rename(tmp_path / "log" / f"b-{part.name}")
    assert journal.append_once(rows, path, "b")
    broken = tmp_path / "log" / "_staged-c"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("half a file")
    assert journal.append_once(rows, path, "c")
    assert collections.Counter(r.id for r in spark.read.parquet(path).collect()) == {i: 3 for i in range(30)}


def test_versions_change_at_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "v")
    with pytest.raises(FileNotFoundError):
        journal.read_published(spark, path)
    assert journal.publish(spark.range(3), path) == 1
    old = journal.read_published(spark, path)
    with pytest.raises(Exception, match="stop"):
        journal.publish(spark.range(10).select(F.raise_error(F.lit("stop")).alias("id")), path)
    assert journal.read_published(spark, path).count() == 3
    # another publisher takes the number in between
    journal.make_exclusive(spark, f"{path}/_number-00000002")
    assert journal.publish(spark.range(5), path) == 3
    assert journal.read_published(spark, path).count() == 5 and old.count() == 3
    assert journal.read_published(spark, path, 1).count() == 3
    journal.publish(journal.read_published(spark, path).union(spark.range(1)), path)
    assert journal.retire(spark, path) == [1] and journal.read_published(spark, path, 3).count() == 5
    assert journal.read_published(spark, path).count() == 6


def test_two_loads_never_draw_one_id(spark, tmp_path):
    folder = str(tmp_path / "seq")
    # the second load claims between two claims of the first, which had looked at the folder before
    first = journal.claim_blocks(spark, folder, 25, 10)
    names = journal.names_in
    seen = names(spark, folder)
    second = journal.claim_blocks(spark, folder, 5, 10)
    try:
        journal.names_in = lambda *a: seen
        late = journal.claim_blocks(spark, folder, 20, 10)
    finally:
        journal.names_in = names
    assert (first, second, late) == ([0, 1, 2], [3], [4, 5])
    a = ld.claim_ids(spark.range(0, 33, 1, 4), folder, "id", block=10, hot_rows=7)
    b = ld.claim_ids(spark.range(0, 8), folder, "id", block=10)
    got_a, got_b = ([r.transaction_id for r in x.orderBy("id").collect()] for x in (a, b))
    assert got_a == [f"TXN-{i}" for i in range(61, 94)] and got_b == [f"TXN-{i}" for i in range(101, 109)]
    used = a.union(b).withColumn("n", F.substring("transaction_id", 5, 9).cast("long"))
    gaps = {r.block: (r.first_id, r.last_id, r.n_used, r.n_gaps) for r in ld.sequence_gaps(spark, folder, used, F.col("n"), 10).collect()}
    assert gaps[6] == (61, 70, 10, 0) and gaps[9] == (91, 100, 3, 7) and gaps[10] == (101, 110, 8, 2) and gaps[0] == (1, 10, 0, 10)
    assert ld.claim_ids(spark.range(0), folder, "id", block=10).count() == 0


def test_the_daily_chain(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("seq", "target", "control", "rejects")]
    rows = lambda n, amount: spark.range(n).select("id", F.lit("A").alias("account_id"), F.lit("2024-01-01").cast("date").alias("transaction_date"), F.lit(amount).cast("decimal(18,2)").alias("amount"))
    rules = ld.standard_rules("amount", "transaction_id")
    for k, n in enumerate((4, 3)):
        assert ld.daily_load(spark, rows(n, 5), "id", *paths, f"d{k}", "2024-01-31 00:00:00", rules, block=10).success_rows == n
    with pytest.raises(ld.BatchFailed):
        ld.daily_load(spark, rows(2, -1), "id", *paths, "d2", "2024-01-31 00:00:00", rules, block=10)
    got = sorted(r.transaction_id for r in read_source(spark, paths[1]).collect())
    assert got == sorted(f"TXN-{i}" for i in (1, 2, 3, 4, 11, 12, 13))


def test_upsert_touches_any_number_of_partitions(spark, tmp_path):
    path = str(tmp_path / "u")
    rows = spark.range(60).select("id", (F.col("id") % 30).cast("string").alias("p"), F.lit(0).alias("v"))
    rows = rows.withColumn("p", F.when(F.col("id") % 30 != 4, F.col("p")))
    write_sink(rows, path, partition_by=["p"])
    new = spark.range(0, 60, 2).select("id", F.when(F.col("id") % 4 == 0, "new").otherwise(F.lit(None)).alias("p"), F.lit(1).alias("v"))
    ld.upsert_table(spark, path, new, ["id"], "p")
    got = {r.id: (r.p, r.v) for r in spark.read.schema("id long, v int, p string").parquet(path).collect()}
    assert len(got) == 60 and got[0] == ("new", 1) and got[2] == (None, 1) and got[3] == ("3", 0) and got[34] == (None, 1)
    assert not path_exists(spark, f"{path}/p=2") and path_exists(spark, f"{path}/p=3")


@pytest.mark.parametrize("part", [40, 1_000_000])
def test_areas_of_held_out_folds_are_exact_in_any_parts(spark, monkeypatch, part):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=600), 1)  # many ties
    rows = [(float(v), int(rng.random() < 1 / (1 + np.exp(-v))), i if i % 50 else None) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "x double, y int, k long").repartition(3)
    monkeypatch.setattr(regression, "PART_ROWS", part)
    monkeypatch.setattr(regression, "FLUSH_ROWS", 70)
    # a row without a key is never held out; it raised before
    table, _ = regression.cross_validate(df, ["x"], "y", "k", {"regParam": [0.01, 9.0], "elasticNetParam": [1.0]})
    got = {r.regParam: r.auc for r in table.collect()}
    fold = F.floor(uniform(F.col("k"), 0) * 3).cast("int")
    parts = df.where("k IS NOT NULL").select("x", "y", fold.alias("f")).toPandas()
    areas = []
    for _, g in parts.groupby("f"):
        pos, neg = g.x[g.y == 1].to_numpy(), g.x[g.y == 0].to_numpy()
        areas.append(((pos[:, None] > neg).mean() + (pos[:, None] == neg).mean() / 2))
    assert got[0.01] == pytest.approx(np.mean(areas), abs=1e-12) and got[9.0] == 0.5


def test_counts_of_a_part_beyond_64_bits(spark):
    n = 2**31 - 1
    packed = [np.array([v] * 3, t).tobytes() for v, t in ((1.5, np.float64), (n, np.int32), (n, np.int32))]
    row = pa.table({"_cell": [0], "_part": [0], **dict(zip(("_score", "_pos", "_neg"), ([b] for b in packed)))})
    assert regression._part_task()(row)["_won"][0].as_py() == (3 * n) ** 2


def test_nulls_are_dropped_from_stored_rows(spark):
    df = spark.createDataFrame([(float(i % 7), None if i == 3 else i % 2) for i in range(40)] + [(None, 1)], "x double, y int")
    plain = regression.fit_logistic(df.dropna(), ["x"], "y")
    assert regression.fit_logistic(df, ["x"], "y").coefficients == pytest.approx(plain.coefficients, abs=1e-12)


def test_a_folder_of_claims_is_looked_up_once(spark, tmp_path, monkeypatch):
    """Not once for each block: a load of many ids waited for that longer than for its rows."""
    calls, real = [], journal._filesystem
    monkeypatch.setattr(journal, "_filesystem", lambda *a: calls.append(a) or real(*a))
    folder = str(tmp_path / "seq")
    assert journal.claim_blocks(spark, folder, 300, 10) == list(range(30)) and len(calls) <= 3
    assert journal.claim_blocks(spark, folder, 11, 10) == [30, 31] and journal.claimed_blocks(spark, folder) == list(range(32))
    assert journal.make_exclusive(spark, f"{folder}/one") and not journal.make_exclusive(spark, f"{folder}/one")
