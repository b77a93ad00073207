"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked at a small Hamming distance, by vantage-point trees.

Fingerprints are points of a Hamming space. Two that differ in at most ``bits`` places differ in at most ``bits // 2`` places of one of
their halves, so there is a tree for each half. A level of a tree measures the distance to the vantage point, a fingerprint of
the table, on a part of the half that no other level measures; by the triangle inequality two fingerprints differ on the part at least
by the difference of their distances, and these bounds add up over the levels. A branch is left when the sum exceeds the
half's share.

1. One pass makes the fingerprints; rows of one fingerprint are one point.
2. The upper levels cut the points into shards by their distances. A point lives in one shard and asks those whose bound its half's share
   reaches: of two shards within the bound only one side asks.
3. In a shard, lower levels measure parts of two bits, and what is left is compared in full. Only edges that connect come out.
4. A shard of more than ``SHARD_ROWS`` points, which is a cluster once levels fit the number of points, is dealt to blocks. A block is
   compared with itself; then points outside the shard's largest component are compared with every block.

The tree decides cost, not results: every pair within the distance meets in some shard or is joined through others.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankops.llm.components import components, id_edges, union_min
from bankops.llm.text import LOWERED, SPACE, U, rows_of, runs, spread, text_slices
from bankops.session import stored

WORDS, BITS, SEED = 4, 4, 42
SHARD_ROWS = 100_000  # points that live in one shard, or one block of it
TASK_ENTRIES = 400_000  # points that live in or ask the shards of one task, on average
DIRECT = 1 << 18  # pairs that are compared without more levels
PAIRS = 1 << 22  # pairs that are compared at once
HUBS = 12
# each byte value's bits as the bytes of a long
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(data: np.ndarray, offs: np.ndarray, words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """The fingerprint of each row's text: the bits that are set in over half of its shingles' hashes."""
    body, n = LOWERED[data], len(offs) - 1
    starts, ends = runs(~SPACE[body[:-8]], offs)
    out = np.zeros(n, U)
    if not len(starts):
        return out
    row = rows_of(starts, offs)
    # the words with one space between them
    size = ends - starts
    flat = body[spread(starts, size + 1)]
    last = np.cumsum(size + 1) - 1
    flat[last] = 32
    first = last - size
    at = np.flatnonzero(row[: max(len(row) - words + 1, 0)] == row[words - 1 :])
    a, b, owner = first[at], last[at + words - 1], row[at]
    count = np.bincount(row, minlength=n)
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        edge = np.searchsorted(row, short)
        a, b = np.append(a, first[edge]), np.append(b, last[edge + count[short] - 1])
        owner = np.append(owner, short)
        order = np.argsort(owner, kind="stable")
        a, b, owner = a[order], b[order], owner[order]
    blob, digest = flat.tobytes(), xxhash.xxh64_intdigest
    h = np.fromiter((digest(blob[i:j], seed) for i, j in zip(a.tolist(), b.tolist())), U, len(a))
    # bytes count to 255, so a row's shingles are added up in runs of that length first
    lanes = _LANES[h.view(np.uint8)].reshape(-1, 8)
    total = np.bincount(owner, minlength=n)
    place = np.arange(len(h)) - (np.cumsum(total) - total)[owner]
    cut = np.flatnonzero(place % 255 == 0)
    sums = np.add.reduceat(lanes, cut, axis=0).view(np.uint8).astype(np.int64)
    has = np.flatnonzero(total)
    sums = np.add.reduceat(sums, np.searchsorted(owner[cut], has), axis=0)
    major = 2 * sums > total[has][:, None]
    out[has] = np.packbits(major, axis=1, bitorder="little").view(U).ravel()
    return out


def _printed(words: int, seed: int):
    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in text_slices(batch.column(1), 1 << 20):
                fp = fingerprints(data, offs, words, seed).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(fp)], ["doc_id", "fp"])

    return printed


def distances(points: np.ndarray, vantage: int, parts: int) -> np.ndarray:
    """(half, point, part): differing bits of each point and the vantage point on ``parts`` equal parts of each half."""
    x, width = points.view(U) ^ U(vantage), 32 // parts
    mask = U((1 << width) - 1)
    out = [[np.bitwise_count((x >> U(32 * half + width * k)) & mask) for k in range(parts)] for half in range(2)]
    return np.array(out, np.int8).transpose(0, 2, 1)


def offsets(parts: int, share: int) -> np.ndarray:
    """The steps from a shard to those it asks: all within the share whose first step off zero goes up, and no step."""
    out = {(0,) * parts}
    for n in range(1, share + 1):
        for where in combinations([k for k in range(parts) for _ in range(n)], n):
            for signs in range(1 << n):
                v = [0] * parts
                for k, p in enumerate(where):
                    v[p] += 1 if signs >> k & 1 else -1
                out.add(tuple(v))
    lead = lambda v: next((x for x in v if x), 0)
    return np.array(sorted((v for v in out if lead(v) >= 0), key=lambda v: (any(v), v)), np.int8)


def routes(points: np.ndarray, vantage: int, parts: int, share: int, ask: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, place of the point, does it live there) of all shards in which points live or which they ask."""
    width = 32 // parts
    scale = (width + 1) ** np.arange(parts, dtype=np.int64)
    steps = offsets(parts, share) if ask else np.zeros((1, parts), np.int8)
    shard, place, lives = [], [], []
    for half, d in enumerate(distances(points, vantage, parts)):
        base = half * (width + 1) ** parts + d @ scale
        for k, step in enumerate(steps):
            moved = d + step
            at = np.flatnonzero(((moved >= 0) & (moved <= width)).all(axis=1)) if k else np.arange(len(d))
            shard.append(base[at] + int(step @ scale))
            place.append(at)
            lives.append(np.full(len(at), k == 0))
    return np.concatenate(shard), np.concatenate(place), np.concatenate(lives)


class Edges:
    """Pairs of linked points, kept as edges to the smallest point that each is known to be linked with."""

    def __init__(self):
        self.held, self.n = [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.held.append((a, b))
        self.n += len(a)
        if self.n > PAIRS:
            self.held = [self.contracted()]
            self.n = len(self.held[0][0])

    def contracted(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.held:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        node, low = union_min(np.concatenate([a for a, _ in self.held]), np.concatenate([b for _, b in self.held]))
        return node[node != low], low[node != low]


def compare(q: np.ndarray, h: np.ndarray, bits: int, edges: Edges, hubs: int = HUBS) -> None:
    """Edges that join all linked pairs of the two sets of points.

    Two points near one hub are joined through it and are not compared, so a dense set costs little more than its size.
    """
    if len(q) * len(h) > PAIRS and hubs:
        hub = h[len(h) // 2]
        near_q, near_h = (np.bitwise_count((x ^ hub).view(U)) <= bits for x in (q, h))
        if near_h.sum() > 1:
            edges.add(np.append(q[near_q], h[near_h]), np.full(near_q.sum() + near_h.sum(), hub))
            compare(q[~near_q], h, bits, edges, hubs - 1)
            compare(q[near_q], h[~near_h], bits, edges, hubs - 1)
            return
    step = max(1, PAIRS // max(len(h), 1))
    for lo in range(0, len(q), step):
        i, j = np.nonzero(np.bitwise_count((q[lo : lo + step, None] ^ h[None, :]).view(U)) <= bits)
        edges.add(q[lo + i], h[j])


def descend(q: np.ndarray, dq: np.ndarray, left: np.ndarray, h: np.ndarray, dh: np.ndarray, level: int, bits: int, edges: Edges) -> None:
    """Join points ``h`` of a subtree and points ``q`` that ask it, ``left`` of each one's share unused by the levels above."""
    if not len(q) or not len(h):
        return
    if len(q) * len(h) <= DIRECT or level == dh.shape[1]:
        compare(q, h, bits, edges)
        return
    for d in np.unique(dh[:, level]):
        mine = dh[:, level] == d
        rest = left - np.abs(dq[:, level] - d)
        to = rest >= 0
        descend(q[to], dq[to], rest[to], h[mine], dh[mine], level + 1, bits, edges)


def _joined(vantage: int, bits: int, shards_of_half: int):
    """Edges of the shards of one task: of points that live there, with each other and with those that ask."""

    def joined(table: pa.Table) -> pa.Table:
        blobs = [np.frombuffer(x.as_buffer(), "<i8").reshape(-1, 2) for x in table.column("packed")]
        both = np.concatenate(blobs)
        shard, lives, points = both[:, 0] >> 1, (both[:, 0] & 1).astype(bool), both[:, 1]
        order = np.lexsort((~lives, shard))
        shard, lives, points = shard[order], lives[order], points[order]
        d = distances(points, vantage, 16)
        edges = Edges()
        edge = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
        for lo, hi in zip(edge, np.append(edge[1:], len(shard))):
            n = int(lives[lo:hi].sum())
            half = int(shard[lo] % (2 * shards_of_half) >= shards_of_half)
            if n and hi - lo > 1:
                near, p = d[half, lo:hi], points[lo:hi]
                descend(p, near, np.full(len(p), bits // 2, np.int8), p[:n], near[:n], 0, bits, edges)
        a, b = edges.contracted()
        return pa.table({"a": a, "b": b})

    return joined


def _entries(vantage: int, parts: int, share: int, tasks: int, hot: np.ndarray, blocks: np.ndarray):
    """Entries (shard, lives, point) of all points, packed by task; shards of very many points are dealt to blocks."""
    every = 2 * (32 // parts + 1) ** parts

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy()
            for lo in range(0, len(points), 4096):
                some = points[lo : lo + 4096]
                shard, place, lives = routes(some, vantage, parts, share)
                if len(hot):
                    k = np.minimum(np.searchsorted(hot, shard), len(hot) - 1)
                    block = np.where(hot[k] == shard, _dealt(some)[place] % blocks[k], 0)
                    shard = shard + every * block
                task = ((shard * 0x9E3779B1) & 0x7FFFFFFFFFFF) // 127 % tasks
                order = np.argsort(task, kind="stable")
                both = np.stack([shard[order] * 2 + lives[order], some[place[order]]], axis=1).astype("<i8")
                numbers, edge = np.unique(task[order], return_index=True)
                packed = [both[i:j].tobytes() for i, j in zip(edge, np.append(edge[1:], len(both)))]
                yield pa.RecordBatch.from_arrays([pa.array(numbers.astype(np.int64)), pa.array(packed, pa.binary())], ["task", "packed"])

    return entries


def _dealt(points: np.ndarray) -> np.ndarray:
    return ((points.view(U) * U(0x9E3779B97F4A7C15)) >> U(33)).astype(np.int64)


def _shards(vantage: int, parts: int, share: int, ask: bool, only: np.ndarray | None = None):
    """Rows (shard, point) of where points live, or also of what they ask, of all shards or those listed."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy()
            shard, place, _ = routes(points, vantage, parts, share, ask)
            keep = np.isin(shard, only) if only is not None else np.ones(len(shard), bool)
            yield pa.RecordBatch.from_arrays([pa.array(shard[keep]), pa.array(points[place[keep]])], ["shard", "fp"])

    return shards


def _met(bits: int):
    def met(table: pa.Table) -> pa.Table:
        points, rest = table.column("fp").to_numpy(), table.column("probe").to_numpy(zero_copy_only=False)
        edges = Edges()
        compare(points[rest], points[~rest], bits, edges)
        a, b = edges.contracted()
        return pa.table({"a": a, "b": b})

    return met


def near_edges(points: DataFrame, rows: int, bits: int = BITS) -> DataFrame:
    """Edges (a, b) that connect all points of the one-column long frame within ``bits`` differing bits; points are distinct."""
    if not rows:
        return points.select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    share = bits // 2
    vantage = points.agg(F.min_by("fp", F.xxhash64("fp"))).first()[0] & 0xFFFFFFFFFFFFFFFF
    # more levels for more points: the fullest shard of evenly spread points holds the largest binomial share of each part
    peak = {4: (70 / 256) ** 4, 8: (6 / 16) ** 8, 16: 0.5**16}
    parts = next((p for p in peak if rows * peak[p] <= SHARD_ROWS), 16)
    live = points.mapInArrow(_shards(vantage, parts, share, False), "shard long, fp long")
    full = live.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > SHARD_ROWS).toArrow()  # 2 rows / SHARD_ROWS of them
    hot, size = full.column("shard").to_numpy(), full.column("n").to_numpy()
    order = np.argsort(hot)
    hot, blocks = hot[order], -(-size[order] // SHARD_ROWS)

    tasks = int(max(32, 2 * rows * len(offsets(parts, share)) // TASK_ENTRIES))
    entries = points.mapInArrow(_entries(vantage, parts, share, tasks, hot, blocks), "task long, packed binary")
    every = (32 // parts + 1) ** parts
    edges = stored(entries.groupBy("task").applyInArrow(_joined(vantage, bits, every), "a long, b long"))
    if len(hot):
        spark = points.sparkSession
        of = F.broadcast(spark.createDataFrame(list(zip(hot.tolist(), blocks.tolist())), "shard long, blocks long"))
        there = points.mapInArrow(_shards(vantage, parts, share, True, hot), "shard long, fp long").join(of, "shard")
        there = there.join(components(edges).withColumnsRenamed({"node": "fp"}), "fp", "left")
        there = there.withColumn("component", F.coalesce("component", "fp"))
        by = there.groupBy("shard", "component").agg(F.count("*").alias("n"))
        largest = by.groupBy("shard").agg(F.max_by("component", F.struct("n", "component")).alias("largest"))
        there = stored(there.join(F.broadcast(largest), "shard"))
        block = F.pmod(F.xxhash64("fp"), F.col("blocks"))
        home = there.select("shard", "fp", F.lit(False).alias("probe"), block.alias("block"))
        rest = there.where("component != largest")
        rest = rest.select("shard", "fp", F.lit(True).alias("probe"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        more = home.union(rest).groupBy("shard", "block").applyInArrow(_met(bits), "a long, b long")
        edges = edges.union(stored(more))
    return edges


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, bits: int = BITS, seed: int = SEED
) -> DataFrame:
    """doc_id, fingerprint, component_id (smallest id reachable by links) of every row.

    Rows link when their fingerprints differ in at most ``bits`` places. A text of fewer than ``words`` words has its whole sequence as one
    shingle; a null text, or one without words, has fingerprint zero and links like any other. Rows of one id are one document with
    several texts: links of each count for all. A row with a null id links too, gets the smallest id that it reaches, null if there
    is none, and passes links on. Repeated rows are rows of the result. Other columns are not read. An empty table gives no rows.
    """
    kinds = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = stored(rows.mapInArrow(_printed(words, seed), kinds))
    points = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    edges = near_edges(points.select("fp"), points.count(), bits).union(id_edges(rows, "doc_id", "fp"))

    linked = components(edges).withColumnsRenamed({"node": "fp"})
    smallest = linked.join(points, "fp").groupBy("component").agg(F.min("first").alias("smallest"))
    ends = linked.join(smallest, "component").select("fp", "smallest")
    ids = points.join(ends, "fp", "left").select("fp", F.coalesce("smallest", "first").alias("component_id"))
    out = rows.join(ids, "fp", "left")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
