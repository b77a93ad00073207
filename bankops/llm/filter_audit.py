"""Filter interaction audit: what each of five filters removes, alone and in every order of the five.

1. One pass over the texts gives each document its failures of the filters that look at one text, as bits of a mask, and the
   text's hash.
2. A counting Bloom filter of the hashes: tasks count cells, sparse and saturating at two, and the partial sketches are added up
   by region. A text with a cell counted once stands once in the table. The filter has eight cells for a document, in blocks of
   ``BLOCK`` cells; a text's two cells lie in one block, so one lookup tests it.
3. Only texts that pass the test are shuffled, grouped by the whole text for the smallest id. Every group gives one row, that of
   its smallest id, so a text that a third of all documents share joins like any other. A document that passes the test and is not
   the smallest of its text fails the filter for copies.
4. Masks are counted for each part. Counts of masks add up, so every number for every order follows from at most 32 of them.

Merged blocks are broadcast while they take ``SKETCH_BYTES`` or less (64 million documents); beyond that the hashes meet the
blocks by a join, and the texts of possible repeats are taken by a semi-join on (id, hash). Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankops.llm.text import SPACE, UPPER, hash_runs, rows_of, runs, table, text_slices
from bankops.session import stored

FILTERS = "ABCDE"  # the last one is that for copies
LEAST_WORDS, LEAST_DISTINCT, MOST_UPPER = 200, 50, 3
SYMBOLS = table(b"#$%&*|")
CELLS = 8  # for a document
BLOCK = 1 << 16  # cells of a block, 8 KB once merged
REGION = 64  # blocks that one task merges
HELD = 1 << 20  # hashes that a task holds before it hands on a partial sketch
SKETCH_BYTES = 64 << 20


def failures(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The bits A to D of each row's text."""
    body, n = data[:-8], len(offs) - 1

    def total(flags: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(flags, dtype=np.int64))
        return sums[offs[1:]] - sums[offs[:-1]]

    starts, ends = runs(~SPACE[body], offs)
    row = rows_of(starts, offs)
    words = np.bincount(row, minlength=n)
    h = hash_runs(data, starts, ends)
    order = np.lexsort((h, row))
    h, by = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (by[1:] != by[:-1])
    distinct = np.bincount(by[new], minlength=n)
    points = total((body & 0xC0) != 0x80)
    bits = (words < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * words, 100 * total(UPPER[body]) > MOST_UPPER * points, total(SYMBOLS[body]) > 0)
    return sum(b.astype(np.int32) << k for k, b in enumerate(bits))


def _flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offs in text_slices(batch.column(3)):
            kept = [batch.column(k).slice(lo, hi - lo) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(failures(data, offs))], ["doc_id", "part", "h", "mask"])


def _place(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The block of each hash and its two cells there."""
    u = h.view(np.uint64)
    cell = lambda by: ((u >> np.uint64(by)) & np.uint64(BLOCK - 1)).astype(np.int64)
    return ((u >> np.uint64(40)) & np.uint64(blocks - 1)).astype(np.int64), cell(0), cell(16)


def _partial(blocks: int):
    """Partial sketches: of each region the cells met, and of each whether once or more often."""

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        block, one, two = _place(np.concatenate(held), blocks)
        cells = np.concatenate([block * BLOCK + one, (block * BLOCK + two)[one != two]])
        cells, n = np.unique(cells, return_counts=True)
        region = cells // (REGION * BLOCK)
        edge = np.flatnonzero(np.append(True, region[1:] != region[:-1]))
        packed = ((cells % (REGION * BLOCK)) * 2 + (n > 1)).astype("<u4")
        blobs = [packed[i:j].tobytes() for i, j in zip(edge, np.append(edge[1:], len(cells)))]
        return pa.RecordBatch.from_arrays([pa.array(region[edge]), pa.array(blobs, pa.binary())], ["region", "cells"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy())
            n += batch.num_rows
            if n >= HELD:
                yield flush(held)
                held, n = [], 0
        if n:
            yield flush(held)

    return partial


def _merged(table: pa.Table) -> pa.Table:
    """Of one region the blocks with cells counted twice or more, as bits."""
    region = table.column("region")[0].as_py()
    count = np.zeros(REGION * BLOCK, np.uint8)
    for blob in table.column("cells"):
        packed = np.frombuffer(blob.as_buffer(), "<u4")
        cells = packed >> 1
        count[cells] = np.minimum(count[cells] + 1 + (packed & 1), 2)  # cells of one partial sketch are distinct
    bits = np.packbits(count > 1, bitorder="little").view("<i8").reshape(REGION, -1)
    has = np.flatnonzero(bits.any(axis=1))
    words = pa.ListArray.from_arrays(np.arange(len(has) + 1, dtype=np.int32) * bits.shape[1], pa.array(bits[has].ravel()))
    return pa.table({"block": pa.array(region * REGION + has), "bits": words})


def repeat_sketch(hashes: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """((block, bits) of the cells that two hashes or more fall into, number of blocks) of the long column ``hashes``."""
    blocks = 1 << max(0, (-(-rows * CELLS // BLOCK) - 1).bit_length())
    blocks = min(blocks, 1 << 24)
    parts = hashes.mapInArrow(_partial(blocks), "region long, cells binary")
    return stored(parts.groupBy("region").applyInArrow(_merged, "block long, bits array<long>")), blocks


def block_of(h: Column, blocks: int) -> Column:
    return F.shiftrightunsigned(h, 40).bitwiseAND(F.lit(blocks - 1))


def may_repeat(h: Column, bits: Column) -> Column:
    """Whether both cells of the hash are set; false for a block without repeats."""

    def on(by: int) -> Column:
        cell = F.shiftrightunsigned(h, by).bitwiseAND(F.lit(BLOCK - 1)).cast("int")
        return F.getbit(F.get(bits, F.shiftright(cell, 6)), cell.bitwiseAND(F.lit(63))) == 1

    return F.coalesce(on(0) & on(16), F.lit(False))


def flag(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """doc_id, part, mask of every row: bit k of the mask is set if the document fails filter k of ``FILTERS``.

    A null text is an empty one, a null part the empty string. A row with a null id is nobody's copy and makes nobody a copy; rows of
    one id are no copies of each other, for neither id is smaller. Each repeated row is a row. Other columns are not read. An empty
    table gives no rows. Words of a text count as distinct by 64-bit hashes; a long text is held whole by one task.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    hashed = rows.select("doc_id", "part", F.xxhash64("text").alias("h"), "text")
    kinds = [T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("part", T.StringType()), T.StructField("h", T.LongType()), T.StructField("mask", T.IntegerType())]
    flags = stored(hashed.mapInArrow(_flagged, T.StructType(kinds)))
    sketch, blocks = repeat_sketch(flags.select("h"), flags.count())
    small = sketch.count() * BLOCK // 8 <= SKETCH_BYTES
    if small:
        sketch = F.broadcast(sketch)

    tested = flags.withColumn("block", block_of(F.col("h"), blocks)).join(sketch, "block", "left")
    tested = tested.select("doc_id", "part", "h", "mask", may_repeat(F.col("h"), F.col("bits")).alias("maybe"))
    if small:
        maybe = hashed.select("doc_id", "text", "h", block_of(F.col("h"), blocks).alias("block")).join(sketch, "block")
        maybe = maybe.where(may_repeat(F.col("h"), F.col("bits")))
    else:
        tested = stored(tested)
        maybe = hashed.join(tested.where("maybe").select("doc_id", "h"), ["doc_id", "h"], "left_semi")
    first = maybe.where("doc_id is not null").groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    first = first.select("doc_id", F.xxhash64("text").alias("h"), F.lit(True).alias("first"))

    known = tested.where("doc_id is not null").join(first, ["doc_id", "h"], "left")
    copy = F.when(F.col("maybe") & F.col("first").isNull(), 1 << len(FILTERS) - 1).otherwise(0)
    known = known.select("doc_id", "part", F.col("mask").bitwiseOR(copy).alias("mask"))
    return known.union(tested.where("doc_id is null").select("doc_id", "part", "mask"))


def mask_counts(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents of each part and mask, and those that ``labels`` calls good or toxic.

    Several label rows of one id are one: good or toxic if any says so. Documents without a label row, or with a null id, are neither.
    """
    said = labels.where("doc_id is not null").groupBy("doc_id")
    said = said.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = flags.where("doc_id is not null").join(said, "doc_id", "left").select("part", "mask", "good", "toxic")
    rest = flags.where("doc_id is null").select("part", "mask", F.lit(None).cast("int").alias("good"), F.lit(None).cast("int").alias("toxic"))
    total = lambda c: F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(c)
    return known.union(rest).groupBy("part", "mask").agg(F.count("*").alias("n"), total("good"), total("toxic"))


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Of each part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    k = len(filters)
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))  # 2^k at most
    orders = F.array(*(F.lit("".join(p)) for p in permutations(filters)))
    rows = parts.select("part", "masks", F.explode(orders).alias("filter_order"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step"))
    place = lambda order: reduce(lambda a, b: a + b, (F.when(F.instr(order, x) > 0, 1 << i).otherwise(0) for i, x in enumerate(filters)))
    rows = rows.withColumn("bit", place(F.substring("filter_order", F.col("step"), F.lit(1))))
    rows = rows.withColumn("before", place(F.substring("filter_order", F.lit(1), F.col("step") - 1)))

    def total(of: str | Column, when) -> Column:
        value = (lambda m: m[of]) if isinstance(of, str) else (lambda m: m["n"] * of)
        return F.aggregate("masks", F.lit(0).cast("long"), lambda acc, m: acc + F.when(when(m["mask"]), value(m)).otherwise(0))

    bit, before = F.col("bit"), F.col("before")
    fails = lambda m: m.bitwiseAND(bit) != 0
    gone = lambda m: m.bitwiseAND(before) != 0
    here = lambda m: fails(m) & ~gone(m)
    every = F.size(orders)
    # of all orders, the filter comes first among the s filters that a document fails in one of s
    share = lambda m: m["n"] * F.floor(every / F.bit_count(m["mask"]))
    shapley = F.aggregate("masks", F.lit(0).cast("long"), lambda acc, m: acc + F.when(fails(m["mask"]), share(m)).otherwise(0))
    return rows.select(
        "part", "filter_order", "step",
        total("n", lambda m: m.bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda m: fails(m) & gone(m)).alias("redundant"),
        total("n", lambda m: m == bit).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        shapley.alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The interactions of the filters over whole ``docs``; ``labels`` has doc_id, quality and toxic. See ``flag`` and ``mask_counts``."""
    return interactions(mask_counts(flag(docs), labels))
