"""Steps that happen once: files made exclusively, appends that a repeated run replays, versions behind a pointer, claimed id ranges.

A storage folder offers one thing that cannot happen twice: making a file that must not be there yet. Everything here rests on that and
on names that say what is inside, so a job that stops anywhere can be run again.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

from bankops.sources.files import _filesystem, path_exists, remove_path


def make_exclusive(spark: SparkSession, path: str) -> bool:
    """Make an empty file; False if it is there already. Of several callers exactly one gets True."""
    folder, _, name = path.rpartition("/")
    return exclusive_maker(spark, folder)(name)


def exclusive_maker(spark: SparkSession, folder: str) -> Callable[[str], bool]:
    """``make_exclusive`` for many names in one folder, which is looked up and made once."""
    fs, at = _filesystem(spark, folder)
    fs.mkdirs(at)
    if fs.getUri().getScheme() == "file":  # the local file system of Hadoop looks first and makes it then
        array, java = spark.sparkContext._gateway.new_array, spark._jvm.java
        files, local = java.nio.file.Files, java.nio.file.Paths.get(at.toUri().getPath(), array(java.lang.String, 0))
        plain = array(java.nio.file.attribute.FileAttribute, 0)
        create = lambda name: files.createFile(local.resolve(name), plain)
    else:
        path = spark._jvm.org.apache.hadoop.fs.Path
        create = lambda name: fs.create(path(f"{folder}/{name}"), False).close()

    def make(name: str) -> bool:
        try:
            create(name)
        except Exception as e:
            if "AlreadyExists" in str(e):
                return False
            raise
        return True

    return make


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of a folder's entries in order; none for a folder that is not there."""
    fs, p = _filesystem(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def step_name(*parts) -> str:
    return "-".join(quote(str(x), safe="") for x in parts)


def append_once(df: DataFrame, path: str, name: str) -> bool:
    """Append the frame to a Parquet folder under ``name``; a name that is there already changes nothing and gives False.

    Rows are written beside the readers' files first and moved in under names of their own when the job has finished. A run that
    stops before that leaves nothing to read and is written anew; one that stops while files move goes on moving, so every row is
    there once when the call has returned. Readers may see some of the files while they move.
    """
    spark = df.sparkSession
    folder = path.rstrip("/")
    staged, done = f"{folder}/_staged-{name}", f"{folder}/_done-{name}"
    if path_exists(spark, done):
        return False
    if not path_exists(spark, f"{staged}/_SUCCESS"):
        remove_path(spark, staged)
        df.write.parquet(staged)
    fs, _ = _filesystem(spark, folder)
    at = spark._jvm.org.apache.hadoop.fs.Path
    for part in names_in(spark, staged):
        if part.startswith("part-"):
            fs.rename(at(f"{staged}/{part}"), at(f"{folder}/{name}-{part}"))
    make_exclusive(spark, done)
    remove_path(spark, staged)
    spark.catalog.refreshByPath(path)
    return True


class Journal:
    """Records of steps done, one empty file each; a step runs once however often a job is repeated."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def done(self, *step) -> bool:
        return path_exists(self.spark, f"{self.folder}/{step_name(*step)}")

    def mark(self, *step) -> bool:
        return make_exclusive(self.spark, f"{self.folder}/{step_name(*step)}")

    def steps(self) -> list[str]:
        return names_in(self.spark, self.folder)


# ---- versions behind a pointer ----

_POINTER = re.compile(r"_current-(\d+)-([0-9a-f]{32})$")


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    found = (_POINTER.match(n) for n in names_in(spark, path))
    return sorted((int(m[1]), m[2]) for m in found if m)


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Write the frame as the table's next version and point to it; the number of the version.

    Readers follow the pointer, an empty file whose name holds number and folder, so they see the old version whole until the new one is
    there whole: there is no moment without a table. Of two publishers at once each gets a number, and the higher one counts.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    folder = path.rstrip("/")
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(f"{folder}/data-{mark}")
    number = max([n for n, _ in _versions(spark, path)], default=0) + 1
    while not make_exclusive(spark, f"{folder}/_number-{number:08d}"):
        number += 1
    make_exclusive(spark, f"{folder}/_current-{number:08d}-{mark}")
    return number


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table's newest version, or the one of a number."""
    held = [(n, mark) for n, mark in _versions(spark, path) if version in (None, n)]
    if not held:
        raise FileNotFoundError(f"no version {version or ''} of {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/data-{held[-1][1]}")


def retire(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Remove all but the newest ``keep`` versions, pointer first; their numbers."""
    old = _versions(spark, path)[: -keep or None]
    for n, mark in old:
        remove_path(spark, f"{path.rstrip('/')}/_current-{n:08d}-{mark}")
        remove_path(spark, f"{path.rstrip('/')}/data-{mark}")
    return [n for n, _ in old]


# ---- id ranges ----


def claim_blocks(spark: SparkSession, folder: str, rows: int, block: int = 1_000_000) -> list[int]:
    """Claim so many blocks of ``block`` ids that ``rows`` ids fit; block b holds the ids b * block + 1 to (b + 1) * block.

    A claim is a file made exclusively, so no block goes to two loads, whenever they run. What a load does not use of its last block, or
    claimed and did not finish, is a gap, never an id given twice. All loads of a sequence must use one size of block.
    """
    taken = [int(n.split("-")[1]) for n in names_in(spark, folder) if n.startswith("block-")]
    at, out = max(taken, default=-1) + 1, []
    make = exclusive_maker(spark, folder.rstrip("/"))
    while len(out) * block < rows:
        if make(f"block-{at:012d}"):
            out.append(at)
        at += 1
    return out


def claimed_blocks(spark: SparkSession, folder: str) -> list[int]:
    return [int(n.split("-")[1]) for n in names_in(spark, folder) if n.startswith("block-")]
