"""File layout: repartition, coalesce, Z-order clustering, zone maps, compaction, layout advice, skew report."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankops.operators.heavy import heavy_keys
from bankops.sources.files import _filesystem, path_exists, remove_path
from bankops.sources.journal import make_exclusive, names_in


def repartition_by(df: DataFrame, n: int, *cols: str) -> DataFrame:
    return df.repartition(n, *cols)


def fewer_files(df: DataFrame, n: int) -> DataFrame:
    """At most n part files, without a shuffle."""
    return df.coalesce(n)


SAMPLE_ROWS = 20_000  # rows of which the split points are taken, whatever the table's size


def split_points(df: DataFrame, cols: Sequence[str], buckets: int, rows: int = SAMPLE_ROWS) -> list[list]:
    """For each column at most ``buckets`` - 1 values that cut its values, of any type with an order, into about equal parts.

    Taken from the rows with the smallest hashes: every task keeps its own ``rows`` smallest and the smallest of these are a sample of
    all, so the driver sees ``rows`` rows at most.
    """
    spread = F.xxhash64(*cols, F.monotonically_increasing_id())
    sample = df.select(*cols, spread.alias("_h")).orderBy("_h").limit(rows).drop("_h").collect()
    out = []
    for i in range(len(cols)):
        held = sorted(r[i] for r in sample if r[i] is not None and r[i] == r[i])
        cuts = [held[len(held) * k // buckets] for k in range(1, buckets)] if held else []
        out.append([v for k, v in enumerate(cuts) if k == 0 or v != cuts[k - 1]])
    return out


def bucket_of(c: Column, points: Sequence, kind: str) -> Column:
    """How many of the ascending points lie below the value, by halving; 0 for null."""
    if not points:
        return F.lit(0)
    halves = [1 << k for k in reversed(range(len(points).bit_length()))]
    table = F.array(*[F.lit(p).cast(kind) for p in points])
    below = lambda at, step: F.coalesce(F.get(table, at + step - 1) < c, F.lit(False))
    return F.aggregate(F.array(*map(F.lit, halves)), F.lit(0), lambda at, step: at + F.when(below(at, step), step).otherwise(0))


def zorder_value(df: DataFrame, cols: Sequence[str], buckets: int) -> Column:
    """Interleaved bucket numbers of one to three columns of any ordered type: numbers, text, dates."""
    if not 1 <= len(cols) <= 3 or buckets & (buckets - 1):
        raise ValueError("Z-order takes one to three columns and a power of two as bucket count")
    kinds = dict(df.dtypes)
    points = split_points(df, cols, buckets)
    numbers = [bucket_of(F.col(c), p, kinds[c]) for c, p in zip(cols, points)]
    z = F.lit(0).cast("long")
    for bit in range(buckets.bit_length() - 1):
        for i, number in enumerate(numbers):
            one = F.shiftright(number.cast("long"), bit).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.shiftleft(one, bit * len(numbers) + i))
    return z


def zorder_buckets(cols: int, files: int) -> int:
    """Parts of each column so that there are about sixteen Z values for a file."""
    return 1 << max(2, -(-(max(files, 1).bit_length() + 4) // cols))


def zorder(
    df: DataFrame, cols: Sequence[str], files: int, buckets: int | None = None, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Cluster rows so that part files cover narrow ranges of every listed column, within each value of ``partition_by``.

    Equal Z values may span several files: the columns themselves and a row hash break the ties. Written with
    ``write_zordered``, or by a plain write without partitions.
    """
    ordered = df.withColumn("_z", zorder_value(df, cols, buckets or zorder_buckets(len(cols), files)))
    row = F.xxhash64(*df.columns)
    return ordered.repartitionByRange(files, *partition_by, "_z", *cols, row).sortWithinPartitions(*partition_by, "_z", *cols).drop("_z")


def write_zordered(
    df: DataFrame, path: str, cols: Sequence[str], files: int, partition_by: Sequence[str] = (), mode: str = "errorifexists"
) -> None:
    """Write the clustered rows, by folders of ``partition_by`` if given; a folder's rows come from neighbouring ranges."""
    writer = zorder(df, cols, files, partition_by=partition_by).write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


# ---- zone maps ----


def zone_map(spark: SparkSession, path: str, cols: Sequence[str]) -> DataFrame:
    """A row for each file: file, n_rows, and of each column its least and greatest value and its nulls."""
    rows = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), *cols)
    each = [x for c in cols for x in (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"))]
    return rows.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), *each)


def files_for(zones: DataFrame, ranges: Mapping[str, tuple], nulls: Sequence[str] = ()) -> list[str]:
    """Files that can hold a row with every listed column in its closed range (None: open at that end), and nulls in those of ``nulls``."""
    wanted = F.lit(True)
    for c, (low, high) in ranges.items():
        wanted = wanted & F.col(f"{c}_min").isNotNull()
        if low is not None:
            wanted = wanted & (F.col(f"{c}_max") >= F.lit(low))
        if high is not None:
            wanted = wanted & (F.col(f"{c}_min") <= F.lit(high))
    for c in nulls:
        wanted = wanted & (F.col(f"{c}_nulls") > 0)
    return sorted(r["file"] for r in zones.where(wanted).select("file").collect())


def read_zones(spark: SparkSession, path: str, zones: DataFrame, ranges: Mapping[str, tuple], nulls: Sequence[str] = ()) -> DataFrame:
    """The rows of the table that lie in all ranges, read from the files that can hold some.

    Equals a filter over the whole table as long as the zone map was made of the table's present files; no other file is opened. File
    names on the driver are as many as a scan's.
    """
    schema = spark.read.parquet(path).schema
    files = files_for(zones, ranges, nulls)
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*[unquote(f) for f in files])
    for c, (low, high) in ranges.items():
        rows = rows.where(F.col(c).isNotNull() if low is None and high is None else F.lit(True))
        rows = rows if low is None else rows.where(F.col(c) >= F.lit(low))
        rows = rows if high is None else rows.where(F.col(c) <= F.lit(high))
    for c in nulls:
        rows = rows.where(F.col(c).isNull())
    return rows


# ---- compaction ----


def file_sizes(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(file, bytes) of the data files below a table's folder."""
    fs, p = _filesystem(spark, path)
    found, out = fs.listFiles(p, True), []
    while found.hasNext():
        status = found.next()
        name = status.getPath().toString()
        below = name[len(fs.makeQualified(p).toString()) :].strip("/")
        if not any(part.startswith(("_", ".")) for part in below.split("/")):
            out.append((name, status.getLen()))
    return sorted(out)


def pack_files(sizes: Sequence[tuple[str, int]], target_bytes: int, small: float = 0.5) -> list[list[str]]:
    """Groups of small files, of one folder each, that fill a file of ``target_bytes``: largest first, each into the fullest group with room.

    Files of ``small`` of the target or more are left alone, and so is a file that finds no partner.
    """
    folders: dict[str, list[tuple[int, str]]] = {}
    for name, size in sizes:
        if size < small * target_bytes:
            folders.setdefault(name.rsplit("/", 1)[0], []).append((size, name))
    out = []
    for files in folders.values():
        room: list[tuple[int, int]] = []  # (room left, group), ascending
        groups: list[list[str]] = []
        for size, name in sorted(files, reverse=True):
            k = bisect_left(room, (size, -1))
            if k < len(room):
                left, g = room.pop(k)
            else:
                left, g = target_bytes, len(groups)
                groups.append([])
            groups[g].append(name)
            insort(room, (left - size, g))
        out += [sorted(g) for g in groups if len(g) > 1]
    return sorted(out)


def compact(spark: SparkSession, path: str, target_bytes: int, small: float = 0.5) -> list[list[str]]:
    """Rewrite groups of small files as one file each; the other files are not touched. The groups that were rewritten.

    All groups are rewritten by one job, a task for each, in a folder beside the data. What replaces what is written down before the first file
    changes, and a call first finishes a replacement that an earlier one began. Readers may meet both forms while files move.
    """
    folder = path.rstrip("/")
    finish_compaction(spark, path)
    groups = pack_files(file_sizes(spark, path), target_bytes, small)
    if not groups:
        return []
    plan = f"{folder}/_compact"
    jvm, (fs, _) = spark._jvm, _filesystem(spark, path)
    at = jvm.org.apache.hadoop.fs.Path
    named = lambda f: at(f).toUri().toString()  # noqa: E731  as the scan writes names
    listed = spark.createDataFrame([(named(f), f, g) for g, files in enumerate(groups) for f in files], "_uri string, file string, group long")
    rows = spark.read.parquet(*[f for files in groups for f in files])
    rows = rows.withColumn("_uri", F.col("_metadata.file_path")).join(F.broadcast(listed.select("_uri", F.col("group").alias("_group"))), "_uri").drop("_uri")
    rows.repartition(len(groups), "_group").write.partitionBy("_group").parquet(f"{plan}/new")
    listed.select("file", "group").coalesce(1).write.parquet(f"{plan}/old")
    make_exclusive(spark, f"{plan}/_ready")
    finish_compaction(spark, path)
    return groups


def finish_compaction(spark: SparkSession, path: str) -> None:
    """Finish the replacement that is written down, if there is one; forget one whose job had not finished."""
    folder = path.rstrip("/")
    plan = f"{folder}/_compact"
    if path_exists(spark, f"{plan}/_ready"):
        fs, _ = _filesystem(spark, path)
        at = spark._jvm.org.apache.hadoop.fs.Path
        old: dict[int, list[str]] = {}
        for r in spark.read.parquet(f"{plan}/old").collect():  # small files of one call
            old.setdefault(r["group"], []).append(r["file"])
        for group, files in old.items():
            home = files[0].rsplit("/", 1)[0]
            new = f"{plan}/new/_group={group}"
            for part in names_in(spark, new):
                if part.startswith("part-"):
                    fs.rename(at(f"{new}/{part}"), at(f"{home}/{part}"))
            for f in files:
                fs.delete(at(f), False)
    remove_path(spark, plan)
    spark.catalog.refreshByPath(path)


def layout_advice(df: DataFrame, cols: Sequence[str], flag: int = 2, low: int = 1000) -> DataFrame:
    """One row per column: partition by few values, Z-order many, neither for flags. One pass over the data."""
    one = df.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in cols])
    rows = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("distinct_values")) for c in cols])))
    n = F.col("distinct_values")
    advice = F.when(n <= flag, "none").when(n <= low, "partition").otherwise("zorder")
    return rows.withColumn("advice", advice)


def skew_report(df: DataFrame, key: str, factor: float = 1.0) -> DataFrame:
    """Keys with more than ``factor`` times the mean number of rows; null is a key like any other.

    Only rows in counters that such a key can have filled are counted by key.
    """
    rows, keys, nulls = df.agg(F.count(F.lit(1)), F.count_distinct(key), F.count_if(F.col(key).isNull())).first()
    mean = rows / max(keys + (nulls > 0), 1)
    found = heavy_keys(df, [key], factor * mean)
    if found is None:
        found = df.select(key, F.lit(0).cast("long").alias("_rows")).limit(0)
    return found.select(key, F.col("_rows").alias("n"), (F.col("_rows").cast("double") / F.lit(mean)).alias("times_mean"))
