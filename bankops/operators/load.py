"""Strict batch load: fingerprint, validate, reject, upsert, control log."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankops.functions.columns import fingerprint
from bankops.operators.relational import drop_known, latest_per_key
from bankops.operators.skew import running
from bankops.session import stored
from bankops.sources.files import has_data, path_exists, read_source, remove_path, write_sink
from bankops.sources.journal import Journal, append_once, claim_blocks, claimed_blocks, step_name

# Texts and names that stored logs carry.
PASS, REJECT = "PASS", "REJECT"
INVALID_AMOUNT = "[CRITICAL] Invalid Amount"
MISSING_KEY = "[MISSING_KEY] No Transaction ID"
DUPLICATE = "[DUPLICATE] Transaction ID already exists in target"
DUPLICATE_IN_SOURCE = "[DUPLICATE_IN_SOURCE] Transaction ID repeated in source"
CONTROL_SCHEMA = (
    "Batch_ID string, Dataset string, Status string, Count_Summary string, Hash_Status string, Run_Time string, Attempt int"
)

HELPERS = ("validation_status", "error_reason", "row_hash")


@dataclass(frozen=True)
class Rule:
    """A row that meets ``broken`` is rejected with ``reason``."""

    broken: Column
    reason: str


@dataclass(frozen=True)
class BatchResult:
    batch_id: str
    status: str
    source_rows: int
    success_rows: int
    reject_rows: int


def standard_rules(amount: str, key: str) -> list[Rule]:
    return [
        Rule(F.col(amount).isNull() | (F.col(amount) <= 0), INVALID_AMOUNT),
        Rule(F.col(key).isNull(), MISSING_KEY),
    ]


def row_hash(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumn("row_hash", fingerprint(cols))


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add status and reason; the first broken rule in the list counts."""
    reason = F.coalesce(*[F.when(r.broken, F.lit(r.reason)) for r in rules])
    return df.withColumn("error_reason", reason).withColumn(
        "validation_status", F.when(F.col("error_reason").isNull(), PASS).otherwise(REJECT)
    )


def _reject_keys(df: DataFrame, listed: DataFrame, key: str, reason: str) -> DataFrame:
    """Reject passing rows whose key is listed. Only passing rows with a key are looked up: a feed without keys must not meet in the one
    task of the null key.
    """
    marks = listed.select(F.col(key).alias("_seen_key"), F.lit(True).alias("_seen"))
    passing = F.col("validation_status").eqNullSafe(PASS) & F.col(key).isNotNull()
    sought, rest = df.filter(passing), df.filter(~passing)
    joined = sought.join(marks, sought[key] == marks["_seen_key"], "left")
    kept = [c for c in df.columns if c not in ("validation_status", "error_reason")]
    found = joined.select(
        *kept,
        F.when(F.col("_seen"), reason).otherwise(F.col("error_reason")).alias("error_reason"),
        F.when(F.col("_seen"), REJECT).otherwise(F.col("validation_status")).alias("validation_status"),
    )
    return found.unionByName(rest)


def mark_existing(df: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Reject passing rows whose key the target already holds; an earlier reason stays.

    The target gives only its key column, and only keys of the batch survive the semi join.
    """
    batch_keys = df.filter(F.col("validation_status") == PASS).select(key)
    known = target.select(key).join(batch_keys, key, "left_semi").distinct()
    return _reject_keys(df, known, key, DUPLICATE)


def mark_repeated(df: DataFrame, key: str) -> DataFrame:
    """Reject passing rows whose key occurs more than once in the batch."""
    passing = df.filter(F.col("validation_status") == PASS)
    repeated = passing.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return _reject_keys(df, repeated, key, DUPLICATE_IN_SOURCE)


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    status = F.col("validation_status")
    return df.filter(status == PASS), df.filter(status == REJECT)


def reject_rows(bad: DataFrame, batch_id: str, dataset: str, key: str, as_of: str | Column) -> DataFrame:
    """Log rows of the rejects: what was refused, why, and the row itself as JSON."""
    return bad.select(
        F.lit(batch_id).alias("Batch_ID"),
        F.lit(dataset).alias("Dataset"),
        F.col(key).cast("string").alias("Business_Key"),
        F.col("error_reason").alias("Error_Reason"),
        F.to_json(F.struct("*")).alias("Raw_Record"),
        F.lit(as_of).cast("timestamp").alias("Timestamp"),
    )


def control_row(checked: DataFrame, batch_id: str, dataset: str, run_time: str = "") -> DataFrame:
    """The control row of a batch from one counting pass.

    A batch with any reject writes nothing, so its success count is 0.
    """
    rejected = F.count_if(F.col("validation_status") == REJECT)
    counted = checked.agg(F.count(F.lit(1)).alias("_all"), rejected.alias("_bad"))
    failed = F.col("_bad") > 0
    success = F.when(failed, 0).otherwise(F.col("_all"))
    return counted.select(
        F.lit(batch_id).alias("Batch_ID"),
        F.lit(dataset).alias("Dataset"),
        F.when(failed, "FAILURE").otherwise("SUCCESS").alias("Status"),
        F.concat_ws(" / ", F.col("_all").cast("string"), success.cast("string"), F.col("_bad").cast("string")).alias(
            "Count_Summary"
        ),
        F.when(failed, "MISMATCH").otherwise("MATCH").alias("Hash_Status"),
        F.lit(run_time).alias("Run_Time"),
    )


def normalise(
    good: DataFrame, batch_id: str, as_of: str | Column, key: str = "transaction_id", date: str = "transaction_date",
    amount: str = "amount", order: Sequence[Column] | None = None,
) -> DataFrame:
    """The stored form: no helper columns, typed, stamped, one row per key.

    Of rows with the same key the first by ``order`` stays; by default the whole row decides, so reruns agree.
    """
    kept = [c for c in good.columns if c not in HELPERS]
    typed = (
        good.select(*kept)
        .withColumns({date: F.col(date).cast("date"), amount: F.col(amount).cast("decimal(18,2)")})
        .withColumns({"batch_id": F.lit(batch_id), "load_timestamp": F.lit(as_of).cast("timestamp")})
    )
    return latest_per_key(typed, [key], order or [F.col(c).asc_nulls_last() for c in kept])


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key the source lacks, and all source rows."""
    return drop_known(target, source, keys).unionByName(source)


def upsert_table(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition_by: str | None = None) -> None:
    """Upsert into a Parquet folder.

    Source and table must have the same columns, and the source one row for each key; otherwise it raises and changes nothing.
    With a partition column only the partitions are rewritten that the source writes to or takes a key from; they are named by a
    join, whatever their number, and a partition left without rows is removed. The source is computed once, and everything is
    computed before the first file changes.
    """
    source = stored(source)
    if not source.groupBy(*keys).count().where("count > 1").limit(1).isEmpty():
        raise ValueError(f"the source has several rows for one key {list(keys)}")
    parts = [partition_by] if partition_by else []
    if not has_data(spark, path):
        write_sink(source, path, mode="overwrite", partition_by=parts)
        return
    held = spark.read.parquet(path).columns
    if set(held) != set(source.columns):
        raise ValueError(f"the table has columns {sorted(held)}, the source {sorted(source.columns)}")
    target = read_source(spark, path, schema=source.schema)
    if not partition_by:
        write_sink(upsert(target, source, keys), path, mode="overwrite")
        return
    old = target.select(*keys, partition_by).join(source.select(*keys), list(keys), "left_semi")
    touched = stored(old.select(partition_by).union(source.select(partition_by)).distinct())
    here = target[partition_by].eqNullSafe(touched[partition_by])
    result = stored(upsert(target.join(touched, here, "left_semi"), source, keys))
    left = result.select(partition_by).distinct()
    empty = touched.join(left, touched[partition_by].eqNullSafe(left[partition_by]), "left_anti")
    gathered = result.hint("rebalance", F.col(partition_by))
    gathered.write.partitionBy(partition_by).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    for row in empty.toLocalIterator():  # partitions that lost their last row: folders, removed one by one
        remove_path(spark, f"{path.rstrip('/')}/{partition_by}={folder_value(spark, row[0])}")
    spark.catalog.refreshByPath(path)


def folder_value(spark: SparkSession, value) -> str:
    """A partition value as Spark writes it in a folder name: special characters escaped, null by its stand-in."""
    if value is None:
        return "__HIVE_DEFAULT_PARTITION__"
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))


def check_batch(
    source: DataFrame, target: DataFrame | None, key: str, rules: Sequence[Rule], hash_cols: Sequence[str],
    reject_repeated: bool = False,
) -> DataFrame:
    """Hash, validate and look up one batch: the frame every later step reads."""
    checked = validate(row_hash(source, hash_cols), rules)
    if target is not None:
        checked = mark_existing(checked, target, key)
    if reject_repeated:
        checked = mark_repeated(checked, key)
    return checked


def run_batch(
    spark: SparkSession,
    source: DataFrame,
    target: str,
    control: str,
    rejects: str,
    key: str,
    rules: Sequence[Rule],
    batch_id: str,
    as_of: str | Column,
    dataset: str = "bank_accounts",
    hash_cols: Sequence[str] = ("transaction_id", "amount", "transaction_date"),
    partition_by: str | None = None,
    run_time: str | None = None,
    reject_repeated: bool = False,
) -> BatchResult:
    """All or nothing: any reject logs the rejects and writes no target row.

    ``target``, ``control`` and ``rejects`` are Parquet folders. Steps happen once: rejects and the control row are appended under
    the batch's and attempt's name, and a finished target step is recorded beside the control table. A run that stopped anywhere can be
    run again with the same rows: it does what was not done, and skips what was. The control row comes last, so a batch without one
    did not finish, and a batch with one starts its next attempt, whose rows replace those it stored before.
    ``run_time`` is written as given; without it the clock times of start and end are, or FAIL for the end of a refused batch.
    """
    start = time.strftime("%H:%M:%S")
    journal = Journal(spark, f"{control.rstrip('/')}/_steps")
    attempt = 0
    while journal.done(batch_id, attempt, "control"):
        attempt += 1
    name = step_name(batch_id, attempt)
    if path_exists(spark, f"{control.rstrip('/')}/_done-{name}"):  # stopped between the control row and its record
        journal.mark(batch_id, attempt, "control")
        return _result(read_source(spark, control).filter((F.col("Batch_ID") == batch_id) & (F.col("Attempt") == attempt)).first())
    known = None
    if has_data(spark, target):
        known = read_source(spark, target).filter(F.col("batch_id") != batch_id)
    checked = stored(check_batch(source, known, key, rules, hash_cols, reject_repeated))
    row = control_row(checked, batch_id, dataset).first()
    good_rows, bad_rows = split(checked)
    if row.Status == "FAILURE":
        append_once(reject_rows(bad_rows, batch_id, dataset, key, as_of), rejects, name)
    elif not journal.done(batch_id, attempt, "target"):
        upsert_table(spark, target, normalise(good_rows, batch_id, as_of, key), [key], partition_by)
        journal.mark(batch_id, attempt, "target")
    if run_time is None:
        run_time = f"{start} - {'FAIL' if row.Status == 'FAILURE' else time.strftime('%H:%M:%S')}"
    entry = spark.createDataFrame([(*row[:5], run_time, attempt)], CONTROL_SCHEMA)
    append_once(entry, control, name)
    journal.mark(batch_id, attempt, "control")
    return _result(row)


def _result(row) -> BatchResult:
    return BatchResult(row.Batch_ID, row.Status, *(int(n) for n in row.Count_Summary.split(" / ")))


class BatchFailed(RuntimeError):
    pass


def batch_status(control: DataFrame) -> DataFrame:
    """Batch_ID, Status, Attempt: what the latest attempt of each batch came to; of rows without an attempt, FAILURE if there is any."""
    attempt = F.coalesce(F.col("Attempt"), F.lit(0)) if "Attempt" in control.columns else F.lit(0)
    worst = F.when(F.col("Status") == "FAILURE", 1).otherwise(0)
    latest = control.groupBy("Batch_ID").agg(F.max_by("Status", F.struct(attempt, worst)).alias("Status"), F.max(attempt).alias("Attempt"))
    return latest


def assert_batch_ok(control: DataFrame, batch_id: str) -> None:
    """Stop a job chain when the latest attempt of the batch failed, or when the batch never finished."""
    row = batch_status(control.filter(F.col("Batch_ID") == batch_id)).first()
    if row is None:
        raise BatchFailed(f"batch {batch_id} has no control row")
    if row.Status == "FAILURE":
        raise BatchFailed(f"batch {batch_id} failed, see the reject table")


def read_batch(table: DataFrame, batch_id: str, column: str = "batch_id") -> DataFrame:
    return table.filter(F.col(column) == batch_id)


def assign_ids(
    df: DataFrame, last_id: int, order: str, prefix: str = "TXN-", width: int = 0, name: str = "transaction_id",
    hot_rows: int | None = None,
) -> DataFrame:
    """Consecutive ids after ``last_id`` in the order of a unique column; numbered by ranges, not in one task."""
    numbered = running(df, [], [F.col(order)], {"_n": ("count", F.lit(1))}, hot_rows)
    number = (F.col("_n") + last_id).cast("string")
    text = F.lpad(number, width, "0") if width else number
    return numbered.withColumn(name, F.concat(F.lit(prefix), text)).drop("_n")


def claim_ids(
    df: DataFrame, sequence: str, order: str, prefix: str = "TXN-", width: int = 0, name: str = "transaction_id", block: int = 1_000_000,
    hot_rows: int | None = None,
) -> DataFrame:
    """Ids of a sequence shared by several loads, in the order of a unique column.

    ``sequence`` is the folder of the sequence's claims. The rows' number is known before ids are claimed, blocks are claimed by files that only one
    load can make, and row r takes place r of the claimed blocks; so two loads at once never draw one id. Ids ascend within a
    load; unused ones are gaps (see ``sequence_gaps``).
    """
    spark = df.sparkSession
    numbered = stored(running(df, [], [F.col(order)], {"_n": ("count", F.lit(1))}, hot_rows))
    blocks = claim_blocks(spark, sequence, numbered.count(), block)
    held = spark.createDataFrame(list(enumerate(blocks)) or [(0, 0)], "_place long, _block long")
    at = F.col("_n") - 1
    placed = numbered.join(F.broadcast(held), F.floor(at / block) == F.col("_place"))  # a row for each block
    number = (F.col("_block") * block + at % block + 1).cast("string")
    text = F.lpad(number, width, "0") if width else number
    return placed.withColumn(name, F.concat(F.lit(prefix), text)).select(*df.columns, name)


def sequence_gaps(spark: SparkSession, sequence: str, used: DataFrame, number: Column, block: int = 1_000_000) -> DataFrame:
    """block, first_id, last_id, n_used, n_gaps of each claimed block; ``number`` is the whole-number id in the rows of ``used``."""
    blocks = spark.createDataFrame([(b,) for b in claimed_blocks(spark, sequence)], "block long")
    counts = used.groupBy(F.floor((number.cast("long") - 1) / block).alias("block")).agg(F.count(F.lit(1)).alias("n_used"))
    n = F.coalesce("n_used", F.lit(0))
    return blocks.join(counts, "block", "left").select(
        "block", (F.col("block") * block + 1).alias("first_id"), ((F.col("block") + 1) * block).alias("last_id"), n.alias("n_used"), (F.lit(block) - n).alias("n_gaps")
    )


def daily_load(
    spark: SparkSession, rows: DataFrame, order: str, sequence: str, target: str, control: str, rejects: str, batch_id: str, as_of: str | Column,
    rules: Sequence[Rule], key: str = "transaction_id", block: int = 1_000_000, **options,
) -> BatchResult:
    """One day's chain: draw ids for the rows, load them as a batch, and stop the chain if the batch is refused."""
    result = run_batch(spark, claim_ids(rows, sequence, order, name=key, block=block), target, control, rejects, key, rules, batch_id, as_of, **options)
    assert_batch_ok(read_source(spark, control), batch_id)
    return result


def advance_sequence(control: DataFrame, name: str, last_id: Column) -> DataFrame:
    """The sequence table with one row's last id replaced."""
    here = F.col("table_name") == name
    return control.withColumn("last_id", F.when(here, last_id.cast("int")).otherwise(F.col("last_id")))


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus those rows whose key it does not hold yet."""
    return target.unionByName(drop_known(rows, target, keys))


def as_of(df: DataFrame, keys: Sequence[str], stamp: str, at: Column, tie: str) -> DataFrame:
    """Each key's latest row stamped no later than ``at``."""
    return latest_per_key(df.filter(F.col(stamp) <= at), keys, [F.col(stamp).desc(), F.col(tie).desc()])
