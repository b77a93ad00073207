"""Heavy keys: the split form must equal the plain window row for row."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bankops.functions.columns import money
from bankops.operators import features, skew, windows

HOT = 40  # rows above which a key is split in these tests


@pytest.fixture(scope="module")
def ledger(spark):
    """400 rows: key A and the NULL key are heavy, with many equal times and NULL amounts."""
    rng = random.Random(7)
    rows = []
    for i in range(400):
        key = rng.choice(["A", "A", "A", None, "B", "C", "D", "E"])
        amount = None if rng.random() < 0.1 else rng.randrange(-500, 5000) / 100
        rows.append((i, key, rng.randrange(0, 60) * 3600, amount, rng.choice("xyz")))
    df = spark.createDataFrame(rows, "id long, key string, sec long, amount double, cat string")
    df = df.withColumn("ts", F.timestamp_seconds("sec")).withColumn("amount", money("amount"))
    return df.repartition(4).cache()


def same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    assert dict(a.dtypes) == dict(b.dtypes)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    left = sorted(map(tuple, a.select(*cols).collect()), key=key)
    right = sorted(map(tuple, b.select(*cols).collect()), key=key)
    assert left == right
    return len(left)


def test_heavy_keys_are_found(ledger):
    rest, hot, chunks = skew.split_hot(ledger, ["key"], HOT)
    names = {r.key for r in hot.select("key").distinct().collect()}
    counts = {r.key: r["count"] for r in ledger.groupBy("key").count().collect()}
    assert names == {k for k, n in counts.items() if n > HOT} and None in names
    assert rest.count() + hot.count() == 400 and chunks >= 4


@pytest.mark.parametrize("kind", ["sum", "count", "min", "max", "last"])
def test_running(ledger, kind):
    order = [F.col("ts"), F.col("id")]
    aggs = {"out": (kind, F.col("amount"))}
    plain = skew.running(ledger, ["key"], order, aggs)
    assert same(skew.running(ledger, ["key"], order, aggs, HOT), plain) == 400


def test_running_without_key_uses_ranges(ledger):
    out = windows.running_sum(ledger, None, "ts", "amount", "id", hot_rows=50)
    w = Window.orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    same(out.withColumn("running_sum", F.col("running_sum").cast("decimal(28,2)")),
         ledger.withColumn("running_sum", F.sum("amount").over(w)))


def test_row_frames_and_neighbours(ledger):
    def build(w):
        return {
            "s": F.sum("amount").over(w.rowsBetween(-2, 0)),
            "m": F.max("amount").over(w.rowsBetween(-2, 1)),
            "prev": F.lag("id", 1).over(w),
            "next": F.lead("id", 1).over(w),
        }

    order = [F.col("ts"), F.col("id")]
    plain = skew.over_rows(ledger, ["key"], order, 2, 1, build)
    same(skew.over_rows(ledger, ["key"], order, 2, 1, build, HOT), plain)


@pytest.mark.parametrize("hours", [1, 5, 200])
def test_range_frames(ledger, hours):
    aggs = {
        "s": ("sum", F.col("amount")),
        "n": ("count", F.col("amount")),
        "lo": ("min", F.col("amount")),
        "hi": ("max", F.col("amount")),
    }
    span = hours * 3600
    plain = skew.over_range(ledger, ["key"], "sec", span, aggs, "id")
    same(skew.over_range(ledger, ["key"], "sec", span, aggs, "id", hot_rows=HOT), plain)


def test_frames_of_several_lengths_share_a_pass(ledger):
    aggs = {"short": ("sum", F.col("amount")), "n": ("count", F.col("amount")), "long": ("sum", F.col("amount"))}
    spans = {"short": 3600, "n": 3600, "long": 36000}
    both = skew.over_range(ledger, ["key"], "sec", spans, aggs, "id")
    for name, span in spans.items():
        one = skew.over_range(ledger, ["key"], "sec", span, {name: aggs[name]}, "id")
        same(both.select("id", name), one.select("id", name))
    same(skew.over_range(ledger, ["key"], "sec", spans, aggs, "id", hot_rows=HOT), both)
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_range_sums_equal_the_sliding_window(ledger):
    frame = Window.partitionBy("key").orderBy("sec").rangeBetween(-7200, 3600)
    want = ledger.withColumns({"s": F.sum("amount").over(frame), "n": F.count("amount").over(frame)})
    aggs = {"s": ("sum", F.col("amount")), "n": ("count", F.col("amount"))}
    for hot in (None, HOT):
        same(skew.over_range(ledger, ["key"], "sec", 7200, aggs, "id", after=3600, hot_rows=hot), want)


@pytest.mark.parametrize("hot", [None, HOT])
def test_floating_sums_equal_the_sums_of_decimals(ledger, hot):
    """Amounts of two digits as doubles: their exact sums, rounded to two digits, are those of the decimals."""
    aggs = {"s": ("sum", F.col("amount").cast("double")), "d": ("sum", F.col("amount"))}
    out = skew.over_range(ledger, ["key"], "sec", 7200, aggs, "id", hot_rows=hot)
    assert out.where(~F.round("s", 2).eqNullSafe(F.col("d").cast("double"))).isEmpty()


@pytest.mark.parametrize("kind", ["row_number", "rank", "dense_rank"])
@pytest.mark.parametrize("descending", [False, True])
def test_ranks(ledger, kind, descending):
    plain = windows.rank_in_group(ledger, "key", "amount", kind, "id", "r", descending)
    same(windows.rank_in_group(ledger, "key", "amount", kind, "id", "r", descending, HOT), plain)


def test_gap_stats_and_cross_matches(ledger):
    same(features.gap_stats(ledger, "key", "ts", 1, "id", HOT), features.gap_stats(ledger, "key", "ts", 1, "id"))
    out = features.cross_key_matches(ledger, "key", "cat", "ts", 3600, "id", hot_rows=HOT)
    rows = [r.asDict() for r in out.collect()]
    for r in rows:
        want = sum(1 for o in rows if o["cat"] == r["cat"] and o["key"] != r["key"] and abs(o["sec"] - r["sec"]) <= 3600)
        assert r["cross_matches"] == want
    assert len(rows) == 400


def test_wrong_frames_are_refused(ledger):
    with pytest.raises(ValueError):
        windows.rolling(ledger, "key", None, "amount", "sum", None, "s", rows=3)
    with pytest.raises(ValueError):
        windows.rolling(ledger, "key", "ts", "amount", "sum", "id", "s", rows=3, days=2)
