"""Packing by minimum bin slack: documents cut into windows of a fixed number of tokens.

Whole windows are cut off each document; what remains of it is shorter than a window. Only the number of remainders of
each length matters for the plan, and there are fewer lengths than a window has tokens, so the plan is made from that
histogram whatever the size of the corpus. For each window, subset-sum dynamic programming over a bitset (an integer whose
bit s says that the sum s can be reached) finds the multiset of lengths that fills it best, starting with the longest
remainder there is; the counts are backtracked through the bitsets, and the same multiset is used as often as the
histogram allows. Each repetition of that uses up a length, so there are at most as many multisets as lengths.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankops.llm.text import text_slices
from bankops.llm.tokens import piece_encoder
from bankops.session import stored

WINDOW = 2048
END_ID = 1


def best_fill(counts: dict[int, int], window: int) -> dict[int, int]:
    """The multiset with the longest length whose sum comes closest to the window: length to number."""
    longest = max(counts)
    room = window - longest
    left = dict(counts)
    left[longest] -= 1
    lengths = sorted(x for x, n in left.items() if n and x <= room)
    full = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for x in lengths:
        steps.append(reach)
        n, k = min(left[x], room // x), 1
        while n > 0:
            k = min(k, n)
            reach |= (reach << (k * x)) & full
            n -= k
            k *= 2
    target, chosen = reach.bit_length() - 1, {longest: 1}
    for x, before in zip(reversed(lengths), reversed(steps)):
        if not target:
            break
        n = min(left[x], target // x)
        while n and not (before >> (target - n * x)) & 1:
            n -= 1
        if n:
            chosen[x] = chosen.get(x, 0) + n
            target -= n * x
    return chosen


def fill_plan(counts: dict[int, int], window: int) -> np.ndarray:
    """Rows (length, first rank, pieces, pieces a window, first window, offset): where the pieces of a length go.

    Ranks number the pieces of one length. Sorted by length and first rank.
    """
    left, used, rows, at = {x: n for x, n in counts.items() if n}, {}, [], 0
    while left:
        chosen = best_fill(left, window)
        times = min(left[x] // n for x, n in chosen.items())
        offset = 0
        for x in sorted(chosen, reverse=True):
            n = chosen[x]
            rows.append((x, used.get(x, 0), n * times, n, at, offset))
            used[x] = used.get(x, 0) + n * times
            left[x] -= n * times
            if not left[x]:
                del left[x]
            offset += n * x
        at += times
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


def _cut(window: int, tokenizer: str, end_id: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = piece_encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for batch in batches:
            for lo, hi, data, offs in text_slices(batch.column(1)):
                ids, sizes = encoder.encode(data, offs)
                total = sizes + 1
                ends = np.cumsum(total)
                every = np.full(ends[-1], end_id, "<u4")
                body = np.ones(len(every), bool)
                body[ends - 1] = False
                every[body] = ids
                pieces = -(-total // window)
                row = np.repeat(np.arange(hi - lo), pieces)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
                length = np.minimum(total[row] - start, window)
                at = (ends - total)[row] + start
                view = memoryview(every).cast("B")
                crc = np.fromiter(
                    (zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())),
                    np.int64,
                    len(at),
                )
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                first = np.searchsorted(ordered, ordered)
                rank = np.empty(len(order), np.int64)
                rank[order] = seen[ordered] + np.arange(len(order)) - first
                seen += np.bincount(length, minlength=window + 1)
                out = [
                    batch.column(0).slice(lo, hi - lo).take(pa.array(row)),
                    pa.array(start), pa.array(length), pa.array(crc), pa.array(total[row]),
                    pa.array(np.full(len(row), task, np.int64)), pa.array(rank),
                ]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "task_rank"]
                if with_ids:
                    names.append("ids")
                    bounds = np.append(at, ends[-1]).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(every.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(out, names)

    return cut


def _place(plan: np.ndarray, names: list[str]):
    keys = plan[:, 0] << 40 | plan[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            step = np.searchsorted(keys, length << 40 | rank, "right") - 1
            _, first, _, each, window, offset = plan[step].T
            k = rank - first
            out = [batch.column(c) for c in names]
            out += [pa.array(window + k // each), pa.array(offset + k % each * length)]
            yield pa.RecordBatch.from_arrays(out, [*names, "sequence_id", "offset"])

    return place


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    tokenizer: str = "word_bpe_49k.json",
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids if asked for.

    A null text is an empty one and gives the end id alone; a null id is kept; rows that repeat are packed once each. Other
    columns of ``docs`` are not read. An empty table gives no rows. Windows of 2048 tokens; an id is in one piece only.

    Pieces are written to the shared folder once, with their rank among the pieces of the same length in the same task, so a
    lost executor cannot change a rank that was used already. The histogram (``window`` numbers) and the plan are all that
    the driver holds.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    fields = [T.StructField("doc_id", id_type)]
    fields += [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "task", "task_rank")]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))
    cut = _cut(window, tokenizer, end_id, with_ids)
    pieces = stored(docs.select(id_col, text_col).mapInArrow(cut, T.StructType(fields)))

    by_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    firsts = by_task.select("task", "length", F.coalesce(before, F.lit(0)).alias("first"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranked = pieces.join(firsts, ["task", "length"]).withColumn("rank", F.col("first") + F.col("task_rank"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]
    kept = [f for f in fields if f.name in names]
    schema = T.StructType([*kept, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    plan = fill_plan(counts, window)
    if not len(plan):
        return spark.createDataFrame([], schema)
    return ranked.select(*names, "rank").mapInArrow(_place(plan, names), schema)
