"""Operators on small typed-in inputs with known results."""

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankops.functions.columns import band, clamp, fingerprint, map_lookup, money, parse_date, safe_ratio
from bankops.operators import aggregates, features, relational, windows
from bankops.sources.tables import inline_rows, query_view


def values(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


TRIPS = [(11, 7), (12, 9), (13, 9), (14, None), (15, 2), (16, 30), (17, 7), (18, 41)]
DEPOTS = [(2, "north"), (7, "harbour"), (9, "hill"), (12, "mill"), (None, "closed"), (7, "harbour annex")]
CREW = [
    ("ines", "day", 3), ("omar", "night", 8), ("ines", "day", 3), ("lund", "day", 5), ("omar", "day", 2), ("ines", "night", 1), ("omar", "night", 8),
    ("omar", "night", 8), ("rae", "night", 9), ("lund", "day", 4), ("ines", "day", 6),
]


@pytest.fixture(scope="module")
def trips(spark):
    return inline_rows(spark, TRIPS, "trip int, depot int")


@pytest.fixture(scope="module")
def depots(spark):
    return inline_rows(spark, DEPOTS, "number int, place string")


@pytest.fixture(scope="module")
def crew(spark):
    return inline_rows(spark, CREW, "name string, shift string, hours int")


def joined_rows(how):
    """How many rows a join of the two lists has, by its definition."""
    pairs = sum(a == b for _, a in TRIPS for b, _ in DEPOTS if a is not None)
    lone_trips = sum(all(a is None or a != b for b, _ in DEPOTS) for _, a in TRIPS)
    lone_depots = sum(all(b is None or a != b for _, a in TRIPS) for b, _ in DEPOTS)
    return {
        "inner": pairs, "left": pairs + lone_trips, "right": pairs + lone_depots, "fullouter": pairs + lone_trips + lone_depots,
        "left_anti": lone_trips, "left_semi": len(TRIPS) - lone_trips,
    }[how]


@pytest.mark.parametrize("how", ["inner", "left", "right", "fullouter", "left_anti", "left_semi"])
def test_joins(trips, depots, how):
    assert relational.join_on(trips, depots, {"depot": "number"}, how).count() == joined_rows(how)


def test_union_keeps_duplicates_and_matches_names(trips):
    assert relational.union_rows(trips, trips).count() == 2 * len(TRIPS)
    turned = trips.select("depot", "trip")
    assert values(relational.union_rows(trips, turned), "trip")[:2] == [(11,), (11,)]


def test_dedup(crew):
    assert crew.dropDuplicates().count() == len(set(CREW))
    first = {}
    for name, _, hours in sorted(CREW, key=lambda r: r[2]):
        first.setdefault(name, hours)
    by_name = relational.latest_per_key(crew, ["name"], [F.col("hours")])
    assert values(by_name, "name", "hours") == sorted(first.items())
    both = relational.latest_per_key(crew, ["name", "shift"], [F.col("hours")])
    assert both.count() == len({r[:2] for r in CREW})


def test_dedup_cuts_rows_before_the_shuffle(crew):
    plan = relational.latest_per_key(crew, ["name"], [F.col("hours")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def at(day, hour=12):
    return dt.datetime(2025, 1, day, hour)


@pytest.fixture(scope="module")
def window_demo(spark):
    rows = [("T5", at(5), 20), ("T1", at(1), 100), ("T3", at(2), 200), ("T2", at(3), 50), ("T4", at(6), 130)]
    return inline_rows(spark, [("A", *r) for r in rows], "account_id string, txn_id string, txn_ts timestamp, amount long")


def test_sum_of_last_three(window_demo):
    out = windows.rolling(window_demo, "account_id", "txn_ts", "amount", "sum", "txn_id", "s", rows=3)
    assert values(out, "txn_id", "s") == [("T1", 100), ("T2", 350), ("T3", 300), ("T4", 200), ("T5", 270)]


def test_range_frame_includes_both_ends(spark):
    rows = [(i, "A", at(d), 10) for i, d in enumerate((1, 8, 9, 20))]
    df = inline_rows(spark, rows, "id int, account_id string, ts timestamp, amount long")
    out = windows.rolling(df, "account_id", "ts", "amount", "sum", "id", "s", days=7)
    assert [r.s for r in out.orderBy("id").collect()] == [10, 20, 20, 10]
    axis = out.filter("id = 0").select(F.unix_micros("ts")).first()[0]
    assert axis == 1735732800 * 1_000_000


def test_running_sum_with_and_without_key(spark):
    rows = [(1, "A", at(1), 100), (2, "A", at(2), 50), (3, "B", at(3), 1000), (4, "A", at(4), 30)]
    df = inline_rows(spark, rows, "id int, account_id string, ts timestamp, amount long")
    for hot in (None, 1):
        whole = windows.running_sum(df, None, "ts", "amount", "id", hot_rows=hot)
        assert values(whole, "id", "running_sum") == [(1, 100), (2, 150), (3, 1150), (4, 1180)]
        per = windows.running_sum(df, "account_id", "ts", "amount", "id", hot_rows=hot)
        assert values(per, "id", "running_sum") == [(1, 100), (2, 150), (3, 1000), (4, 180)]


def test_night_failure_gap_and_hop(spark):
    rows = [
        (1, "A", dt.datetime(2025, 1, 1, 0, 10), "US", "FAILED"),
        (2, "A", dt.datetime(2025, 1, 1, 0, 40), "UK", "OK"),
        (3, "A", dt.datetime(2025, 1, 1, 6, 0), "US", "OK"),
        (4, "A", dt.datetime(2025, 1, 1, 7, 0), "UK", "FAILED"),
    ]
    df = inline_rows(spark, rows, "id int, acc string, ts timestamp, country string, status string")
    assert values(windows.night_count(df, "acc", "ts", "id"), "id", "night_count") == [(1, 1), (2, 2), (3, 2), (4, 2)]
    assert values(windows.gap_seconds(df, "acc", "ts", "id"), "id", "gap_seconds")[1:] == [(2, 1800.0), (3, 19200.0), (4, 3600.0)]
    # a gap of exactly an hour is not below the limit
    assert values(windows.hop_flag(df, "acc", "ts", "country", "id"), "id", "hop") == [(1, 0), (2, 1), (3, 0), (4, 0)]
    ratio = windows.ratio_in_window(df, "acc", "ts", F.col("status") == "FAILED", 30, "id", "r")
    assert values(ratio, "id", "r") == [(1, 1.0), (2, 0.5), (3, 1 / 3), (4, 0.5)]


@pytest.fixture(scope="module")
def merchants(spark):
    rows = [("t1", "AMAZON", 1), ("t2", "AMAZON", 0), ("t3", "AMAZON", 0), ("t4", "WALMART", 0), ("t5", "LOCAL_STORE", 1), ("t6", "LOCAL_STORE", 0)]
    return inline_rows(spark, rows, "transaction_id string, merchant string, is_fraud int")


def test_target_encoding(spark, merchants):
    plain = {r.merchant: round(r.encoding, 6) for r in aggregates.target_encode_fit(merchants, "merchant", "is_fraud").collect()}
    assert plain == {"AMAZON": 0.333333, "WALMART": 0.0, "LOCAL_STORE": 0.5}
    smooth = aggregates.target_encode_fit(merchants, "merchant", "is_fraud", k=5)
    got = {r.merchant: round(r.encoding, 6) for r in smooth.collect()}
    assert got == {"AMAZON": 0.333333, "WALMART": 0.277778, "LOCAL_STORE": 0.380952}
    fresh = inline_rows(spark, [("KIOSK",), ("WALMART",)], "merchant string")
    out = aggregates.target_encode_apply(fresh, smooth, "merchant", default=aggregates.global_mean(merchants, "is_fraud"))
    assert [round(v, 4) for _, v in values(out, "merchant", "encoding")] == [0.3333, 0.2778]


def test_salted_and_split_equal_plain(crew):
    plain = crew.groupBy("name").agg(F.sum("hours").alias("s"), F.count(F.lit(1)).alias("n"), F.max("hours").alias("hi"))
    aggs = {"s": ("sum", F.col("hours")), "n": ("count", F.lit(1)), "hi": ("max", F.col("hours"))}
    salted = aggregates.salted_agg(crew, ["name"], aggs, ["hours", "shift"], 4)
    assert values(plain, "name", "s", "n", "hi") == values(salted, "name", "s", "n", "hi")
    hot, rest = aggregates.hot_key_split(crew, "name", 3)
    assert {r.name for r in hot.collect()} == {"ines", "omar"} and hot.count() + rest.count() == len(CREW)


def test_text_numbers_and_dates(spark):
    row = inline_rows(spark, [(" new york ", "03-02-2020", 3, 2.5)], "c string, d string, q int, p double")
    got = row.select(
        F.initcap(F.trim("c")).alias("city"), parse_date(F.col("d"), "dd-MM-yyyy").alias("day"),
        parse_date(F.lit("no date"), "dd-MM-yyyy").alias("bad"), safe_ratio(F.col("p"), F.lit(0)).alias("none"),
        band(F.col("p"), [(300, "High"), (20, "Medium")], "Small").alias("size"), clamp(F.col("p"), 0.0, 1.0).alias("clamped"),
        map_lookup(F.lit("x"), {"y": 1.0}).alias("unknown"), money("p").alias("money"),
    ).first()
    assert (got.city, got.day, got.bad, got.none) == ("New York", dt.date(2020, 2, 3), None, None)
    assert (got["size"], got.clamped, got.unknown, str(got.money)) == ("Small", 1.0, None, "2.50")


def test_fingerprint_tells_null_positions_apart(spark):
    df = inline_rows(spark, [("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    assert len({r[0] for r in df.select(fingerprint(["x", "y", "z"])).collect()}) == 2


def test_bad_casts(spark):
    texts = ["12", "x", " +7 ", "-3", "1.5", "99999999999", "", None, "7 7", "\t8\n", "0x1f", "--1", "1e3"]
    df = inline_rows(spark, [(x,) for x in texts], "v string")
    lenient = [r.v for r in relational.cast_columns(df, {"v": "int"}, strict=False).collect()]
    assert lenient == [r.v for r in df.select(F.col("v").try_cast("int").alias("v")).collect()] and lenient[:3] == [12, None, 7]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        relational.cast_columns(df, {"v": "int"}).collect()


def test_inline_rows_in_every_form(spark):
    struct = T.StructType([T.StructField("name", T.StringType(), False), T.StructField("age", T.IntegerType(), False)])
    rows = [("Ann", 30), ("Bob", 40)]
    for given, schema in ((rows, ["name", "age"]), (rows, "name string, age int"), (rows, struct), ([list(r) for r in rows], struct),
                          ([{"name": n, "age": a} for n, a in rows], None), ([Row(name=n, age=a) for n, a in rows], None)):
        assert values(inline_rows(spark, given, schema), "name", "age") == rows
    assert values(inline_rows(spark, [1, 2], "int"), "value") == [(1,), (2,)]


def test_query_parameters_are_values_not_text(spark, crew):
    out = query_view(crew, "crew_view", "SELECT * FROM crew_view WHERE name = :n", {"n": "x' OR '1'='1"})
    assert out.count() == 0


def test_grouped_features(spark):
    rows = [
        (1, "A", dt.datetime(2024, 1, 6, 10), "POS", 10.0), (2, "A", dt.datetime(2024, 1, 7, 11), "ATM", 2000.0),
        (3, "A", dt.datetime(2024, 1, 8, 10), "POS", 30.0), (4, "B", dt.datetime(2024, 1, 8, 10), "ATM", 5.0),
    ]
    df = inline_rows(spark, rows, "id int, acc string, ts timestamp, channel string, amount double")
    assert values(features.weekend_count(df, "acc", "ts"), "acc", "weekend_count") == [("A", 2), ("B", 0)]
    holidays = inline_rows(spark, [("2024-01-08",)], "day string")
    assert values(features.holiday_count(df, "acc", "ts", holidays), "acc", "holiday_count") == [("A", 1), ("B", 1)]
    assert values(features.hourly_frequency(df, "acc", "ts"), "acc", "hour", "n") == [("A", 10, 2), ("A", 11, 1), ("B", 10, 1)]
    assert values(features.modal_share(df, "acc", "channel"), "acc", "modal") == [("A", "POS"), ("B", "ATM")]
    assert values(features.large_count(df, "acc", "amount", 1000), "acc", "large_count") == [("A", 1), ("B", 0)]
    assert values(features.listed_shares(df, "acc", "channel", ["POS"]), "acc", "pos_share") == [("A", 2 / 3), ("B", 0.0)]
    z = {r.id: r.zscore for r in features.zscore(df, "acc", "amount").collect()}
    assert z[4] is None and abs(z[1] + z[2] + z[3]) < 1e-12
    cum = features.cumulative_share_delta(df, "acc", "ts", money("amount"), "id")
    assert values(cum, "id", "cum_share")[2] == (3, 1.0)


def test_labels_of_four_digits_keep_them(spark):
    rows = spark.createDataFrame([("a", 0.001), ("a", 0.004), ("b", 0.25)], "c string, y double")
    got = {r.c: round(r.encoding, 9) for r in aggregates.target_encode_fit(rows, "c", "y").collect()}
    assert got == {"a": 0.0025, "b": 0.25}
    assert round(aggregates.global_mean(rows, "y"), 9) == 0.085
