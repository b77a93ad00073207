"""Point-in-time joins, feature tables and feature lookup."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankops.operators.load import upsert_table
from bankops.operators.relational import keep_known, latest_per_key
from bankops.operators.skew import running
from bankops.session import stored
from bankops.sources.files import read_source, write_sink


@dataclass(frozen=True)
class FeatureSet:
    """Feature rows with the columns to take from them.

    ``tie`` decides between rows of equal time: the greatest wins.
    """

    rows: DataFrame
    cols: Sequence[str]
    ts: str
    tie: str


def training_set(
    labels: DataFrame,
    sets: Sequence[FeatureSet],
    keys: Sequence[str],
    event_ts: str,
    tie: str,
    hot_rows: int | None = None,
) -> DataFrame:
    """Every label row with the features known at its time; NULLs where none were.

    Labels and all feature sets are stacked, sorted once per key, and each set's last row is carried down. The
    work is linear in the rows however many a key has, and one shuffle serves all sets. ``tie`` tells label rows
    apart; all ties have one type.
    """
    both = labels.select(
        *keys,
        F.col(event_ts).alias("_at"),
        F.lit(1).alias("_label"),
        F.col(tie).alias("_tie"),
        F.struct(*labels.columns).alias("_row"),
    )
    for i, s in enumerate(sets):
        known = s.rows.select(
            *keys,
            F.col(s.ts).alias("_at"),
            F.lit(0).alias("_label"),
            F.col(s.tie).alias("_tie"),
            F.struct(*s.cols).alias(f"_known_{i}"),
        )
        both = both.unionByName(known, allowMissingColumns=True)
    order = [F.col("_at"), F.col("_label"), F.col("_tie")]
    last = {f"_last_{i}": ("last", F.col(f"_known_{i}")) for i in range(len(sets))}
    out = running(both, keys, order, last, hot_rows)
    taken = [F.col(f"_last_{i}.{c}").alias(c) for i, s in enumerate(sets) for c in s.cols]
    return out.filter("_label = 1").select("_row.*", *taken)


def point_in_time(
    labels: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    event_ts: str,
    feature_ts: str,
    feature_cols: Sequence[str],
    tie: str,
    feature_tie: str | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """``training_set`` with a single feature set."""
    known = FeatureSet(features, feature_cols, feature_ts, feature_tie or tie)
    return training_set(labels, [known], keys, event_ts, tie, hot_rows)


def write_features(df: DataFrame, path: str, keys: Sequence[str], mode: str = "merge", partition_by: str | None = None) -> None:
    """Create a feature table, or merge rows into it on its key. A key given twice is refused.

    With a partition column a merge rewrites only the partitions that its rows touch. The rows are computed once.
    """
    spark = df.sparkSession
    if mode == "merge":
        upsert_table(spark, path, df, keys, partition_by)
        return
    df = stored(df)
    if not df.groupBy(*keys).count().where("count > 1").limit(1).isEmpty():
        raise ValueError(f"feature rows are not unique on {list(keys)}")
    write_sink(df, path, mode="overwrite", partition_by=[partition_by] if partition_by else ())


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return read_source(spark, path)


def lookup_features(features: DataFrame, wanted: DataFrame, keys: Sequence[str], ts: str, tie: str) -> DataFrame:
    """The latest feature row of each listed key."""
    return latest_per_key(keep_known(features, wanted, keys), keys, [F.col(ts).desc(), F.col(tie).desc()])
