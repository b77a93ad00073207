"""Two-pass external shuffle into shards, with built-in functions only.

First pass: every row goes to a shard that its id and the number of shards decide (the shard with the highest seeded hash for
that id wins, so one more shard takes rows only into itself), and inside the shard to one of its buckets by another seeded
hash. Buckets are sized to fit a task's memory and meet through one exchange. Second pass: each bucket is shuffled by Spark's
``shuffle`` (Fisher-Yates) and written under its shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SHARDS = 16
BUCKET_BYTES = 8 << 20
SEED = 20_240


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard of highest hash: a function of the key and the number of shards."""
    named = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.struct(F.xxhash64(key, s, F.lit(seed)).alias("h"), s.alias("s"))
    )
    return F.array_max(named)["s"]


def write_shards(
    docs: DataFrame,
    path: str,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
    seed: int = SEED,
) -> None:
    """Write all rows, all columns, under ``path``: ``shard=N`` folders with columns ``row``, ``bucket`` and ``place``.

    The bucket of a row is hashed from its id, its text and the input partition it came from: copies of one row, or rows of
    one id, are spread over the buckets of their shard, and a task that runs again deals its rows alike. Null ids share a
    shard. Columns of ``docs`` stay inside ``row``, so their names cannot clash. An empty table gives an empty one.
    """
    key = F.col(id_col).cast("string")
    total = docs.agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)) + 64)).first()[0] or 0
    each = int(max(4, -(-total // (shards * bucket_bytes))))  # buckets of a shard
    mixed = F.xxhash64(F.lit(seed + 1), key, F.col(text_col), F.spark_partition_id())
    rows = docs.select(
        (shard_of(key, shards, seed) * each + F.pmod(mixed, F.lit(each))).cast("int").alias("bucket"),
        F.xxhash64(F.lit(seed + 2), key, F.col(text_col)).alias("mixed"),
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
    )
    rows = rows.repartition(shards * each, "bucket").sortWithinPartitions("bucket", "mixed")
    rows = rows.groupBy("bucket").agg(F.collect_list("row").alias("rows"))
    rows = rows.select("bucket", F.posexplode(F.shuffle("rows", F.lit(seed))).alias("place", "row"))
    rows = rows.withColumn("shard", F.floor(F.col("bucket") / each).cast("int"))
    rows.write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """shard, slot (0, 1, ... in the shard) and row, from the written files."""
    rows = spark.read.parquet(path)
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    firsts = counts.select("shard", "bucket", F.coalesce(before, F.lit(0)).alias("first"))
    return rows.join(firsts, ["shard", "bucket"]).select(
        F.col("shard").cast("int").alias("shard"), (F.col("first") + F.col("place")).alias("slot"), "row"
    )


def digest(spark: SparkSession, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every written row; only ids and digests leave the files."""
    text = F.coalesce(F.col(f"row.{text_col}"), F.lit(""))
    rows = spark.read.parquet(path).select(
        F.col(f"row.{id_col}").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "bucket",
        "place",
        shard_of(F.col(f"row.{id_col}").cast("string"), shards + 1).alias("grown_shard"),
    )
    slots = spark.read.parquet(path).groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    firsts = slots.select(F.col("shard").cast("int"), "bucket", F.coalesce(before, F.lit(0)).alias("first"))
    out = rows.join(firsts, ["shard", "bucket"])
    return out.select(
        "doc_id", "size", "text_crc32", "law", "shard", (F.col("first") + F.col("place")).cast("long").alias("slot"), "grown_shard"
    )
