"""Target-distribution importance resampling: draw the documents whose hashed n-grams look most like a target's.

A text's features are its runs of one to ``max_words`` words, and a feature falls into the bucket that the CRC-32 of its bytes
names. Words of a corpus are few and frequent for the most part, so:

1. One pass counts words of up to 16 bytes; the ``HEAD`` most frequent ones go to every task with the state of the CRC after them,
   and, for runs of two words or more, the ``PAIRS`` most frequent pairs of them with their states.
2. A word is looked up by its bytes, compared whole. The states of words that are not there are computed from their bytes. A run's
   state is its first words' state shifted by the next word's length, plus the next word's own (the CRC is linear), so no
   run of words is put together.
3. Bucket totals of the corpus and of the target give each bucket's gain; a document's weight is the mean gain of its features. With
   Gumbel noise by id, the highest scores are a draw without replacement.

The head decides cost, not results. Ranks come from counts of scores, of which there are at most some hundred thousand, and the
order of ids within a score.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankops.llm.text import LOWERED, HashTable, U, mixed, rows_of, runs, table, text_slices
from bankops.session import stored

BUCKETS = 10_000
LEAST_WORDS, PERCENT, SEED = 20, 10, 2024
HEAD = 1 << 16  # words, 24 bytes each
PAIRS = 1 << 18
SECOND = 1 << 20  # a pair is the first word's number times this, plus the second's; above any HEAD
WORD = table(b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)))
LONG = 64  # bytes of a word from which the library computes its CRC
ONES = np.uint32(0xFFFFFFFF)
_LOW = np.array([0] + [(1 << (8 * k)) - 1 for k in range(1, 9)], dtype=U)


def _steps() -> np.ndarray:
    """The CRC-32 state that each byte value leaves."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


STEP = _steps()
SPACE_FIRST = np.uint32(STEP[32])  # the state after a space from state 0


def crc_states(start: int, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The state after each run's bytes, from the state ``start``."""
    length = ends - starts
    state = np.full(len(starts), start, np.uint32)
    k, at = 0, np.flatnonzero((length > 0) & (length <= LONG))
    while len(at):
        state[at] = STEP[(state[at] ^ data[starts[at] + k]) & 255] ^ (state[at] >> np.uint32(8))
        k += 1
        at = at[length[at] > k]
    for i in np.flatnonzero(length > LONG):
        state[i] = zlib.crc32(data[starts[i] : ends[i]], start ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return state


@lru_cache(4096)
def _shift(length: int) -> np.ndarray:
    """What ``length`` zero bytes make of a state: for each of its bytes, a table of 256."""
    def apply(m: np.ndarray, v: np.ndarray) -> np.ndarray:
        out = np.zeros_like(v)
        for i in range(32):
            out ^= np.where((v >> np.uint32(i)) & 1, m[i], 0).astype(np.uint32)
        return out

    one = np.uint32(1) << np.arange(32, dtype=np.uint32)
    out, power, left = one.copy(), STEP[one & 255] ^ (one >> np.uint32(8)), length
    while left:
        if left & 1:
            out = apply(power, out)
        power, left = apply(power, power), left >> 1
    values = np.arange(256, dtype=np.uint32)
    return np.stack([apply(out, values << np.uint32(8 * b)) for b in range(4)])


def shifted(state: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each state after as many zero bytes as its length says."""
    out = np.empty_like(state)
    for n in np.unique(length):
        at = np.flatnonzero(length == n)
        s, t = state[at], _shift(int(n))
        out[at] = t[0][s & 255] ^ t[1][(s >> np.uint32(8)) & 255] ^ t[2][(s >> np.uint32(16)) & 255] ^ t[3][s >> np.uint32(24)]
    return out


def words_of(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Lowered bytes, starts, ends and rows of the words."""
    body = LOWERED[data]
    starts, ends = runs(WORD[body[:-8]], offs)
    return body, starts, ends, rows_of(starts, offs)


def word_keys(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions of words of up to 16 bytes, their first and next eight bytes); no word holds a zero byte, so these are the word."""
    at = np.flatnonzero(ends - starts <= 16)
    s, n = starts[at], (ends - starts)[at]
    eights = np.ndarray(len(body) - 7, dtype="<u8", buffer=body, strides=(1,))
    return at, eights[s] & _LOW[np.minimum(n, 8)], eights[np.where(n > 8, s + 8, 0)] & _LOW[np.maximum(n - 8, 0)]


def _hash(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return mixed(low ^ mixed(high + U(0x9E3779B97F4A7C15)))


class Head:
    """The frequent words and pairs: their states, and how to find them."""

    def __init__(self, low: np.ndarray, high: np.ndarray, pairs: np.ndarray | None = None):
        self.low, self.high = low.view(U), high.view(U)
        raw = np.stack([self.low, self.high], axis=1).view(np.uint8).reshape(len(low), 16)
        size = (raw != 0).sum(axis=1) if len(low) else np.zeros(0, np.int64)
        flat, first = np.append(raw.ravel(), np.zeros(8, np.uint8)), 16 * np.arange(len(low))
        self.alone, self.after = (crc_states(int(s), flat, first, first + size) for s in (ONES, SPACE_FIRST))
        self.table = HashTable()
        h, one = np.unique(_hash(self.low, self.high), return_index=True)
        self.table.add(h, one.astype(np.int32))
        self.pairs = self.pair_state = None
        if pairs is not None and len(pairs):
            a, b = pairs // SECOND, pairs % SECOND
            self.pair_state = shifted(self.alone[a], size[b] + 1) ^ self.after[b]
            self.pairs = HashTable()
            self.pairs.add(mixed(pairs.view(U)), np.arange(len(pairs), dtype=np.int32))
            self.pair_codes = pairs

    def find(self, body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each word in the head, or -1."""
        out = np.full(len(starts), -1, np.int64)
        if len(starts) and len(self.low):
            at, low, high = word_keys(body, starts, ends)
            k = self.table.find(_hash(low, high)).astype(np.int64)
            k[(k >= 0) & ((self.low[k] != low) | (self.high[k] != high))] = -1
            out[at] = k
        return out


def features(data: np.ndarray, offs: np.ndarray, max_words: int, buckets: int, head: Head) -> tuple[np.ndarray, list, list]:
    """(words of each row, then for runs of 1, 2, ... words: their buckets, and their rows)."""
    body, starts, ends, row = words_of(data, offs)
    number = head.find(body, starts, ends)
    tail = np.flatnonzero(number < 0)
    state = head.alone[number] if len(head.low) else np.zeros(len(starts), np.uint32)
    state[tail] = crc_states(int(ONES), body, starts[tail], ends[tail])
    bucket = lambda s: ((s ^ ONES) % np.uint32(buckets)).astype(np.int32)
    out, rows = [bucket(state)], [row]
    if max_words > 1:
        after = head.after[number] if len(head.low) else np.zeros(len(starts), np.uint32)
        after[tail] = crc_states(int(SPACE_FIRST), body, starts[tail], ends[tail])
    for n in range(2, max_words + 1):
        m = max(len(starts) - n + 1, 0)
        at = np.flatnonzero(row[:m] == row[n - 1 :][:m])
        last = at + n - 1
        known = np.full(len(at), -1, np.int64)
        if n == 2 and head.pairs is not None:
            both = np.flatnonzero((number[at] >= 0) & (number[last] >= 0))
            code = number[at[both]] * SECOND + number[last[both]]
            k = head.pairs.find(mixed(code.view(U))).astype(np.int64)
            k[(k >= 0) & (head.pair_codes[k] != code)] = -1
            known[both] = k
        new = np.zeros(len(starts), np.uint32)
        hit, miss = np.flatnonzero(known >= 0), np.flatnonzero(known < 0)
        if len(hit):
            new[at[hit]] = head.pair_state[known[hit]]
        i, j = at[miss], last[miss]
        new[i] = shifted(state[i], (ends - starts)[j] + 1) ^ after[j]
        state = new
        out.append(bucket(state[at]))
        rows.append(row[at])
    return np.bincount(row, minlength=len(offs) - 1), out, rows


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first place, value, times) of values that stand there twice or more."""
    found, first, n = np.unique(values, return_index=True, return_counts=True)
    return first[n > 1], found[n > 1], n[n > 1]


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, offs in text_slices(batch.column(0)):
            body, starts, ends, _ = words_of(data, offs)
            if not len(starts):
                continue
            _, low, high = word_keys(body, starts, ends)
            first, _, n = _counted(_hash(low, high))
            yield pa.RecordBatch.from_arrays([pa.array(low[first].view(np.int64)), pa.array(high[first].view(np.int64)), pa.array(n)], ["low", "high", "n"])


def _pair_counts(low: np.ndarray, high: np.ndarray):
    def pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = Head(low, high)
        for batch in batches:
            for _, _, data, offs in text_slices(batch.column(0)):
                body, starts, ends, row = words_of(data, offs)
                number = head.find(body, starts, ends)
                both = (row[1:] == row[:-1]) & (number[1:] >= 0) & (number[:-1] >= 0)
                _, code, n = _counted((number[:-1] * SECOND + number[1:])[both])
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], ["code", "n"])

    return pair_counts


def frequent(texts: DataFrame, max_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Bytes of the head's words, and the head's pairs; counted over all texts, at most ``HEAD`` and ``PAIRS`` of them."""
    words = texts.mapInArrow(_word_counts, "low long, high long, n long").groupBy("low", "high").agg(F.sum("n").alias("n"))
    got = words.orderBy(F.desc("n"), "low", "high").limit(HEAD).toArrow()
    low, high = (got.column(c).to_numpy() for c in ("low", "high"))
    if max_words < 2:
        return low, high, None
    pairs = texts.mapInArrow(_pair_counts(low, high), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    return low, high, pairs.orderBy(F.desc("n"), "code").limit(PAIRS).toArrow().column("code").to_numpy()


def _totals(max_words: int, buckets: int, listed: tuple):
    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, n = Head(*listed), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offs in text_slices(batch.column(0)):
                for b in features(data, offs, max_words, buckets, head)[1]:
                    n += np.bincount(b, minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])], ["bucket", "n"])

    return totals


def bucket_totals(texts: DataFrame, max_words: int, buckets: int, listed: tuple) -> np.ndarray:
    """Features of all texts in each bucket; tasks add up their own first and hand on a row for each bucket."""
    rows = texts.mapInArrow(_totals(max_words, buckets, listed), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in rows.collect():  # a row for each bucket at most
        out[r["bucket"]] = r["n"]
    return out


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """The floor of 1000 times the log of the smoothed ratio of shares, of each bucket."""
    more, less, k = int(corpus.sum()) + len(corpus), int(target.sum()) + len(target), 1000
    ratio = lambda t, s: float((int(t) + 1) * more) / float((int(s) + 1) * less)
    return np.array([math.floor(k * math.log(ratio(t, s))) for t, s in zip(target, corpus)], np.int64)


def _weighed(max_words: int, buckets: int, listed: tuple, gain: np.ndarray):
    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = Head(*listed)
        for batch in batches:
            for lo, hi, data, offs in text_slices(batch.column(1)):
                words, found, rows = features(data, offs, max_words, buckets, head)
                n, total = np.zeros(hi - lo, np.int64), np.zeros(hi - lo, np.int64)
                for b, r in zip(found, rows):
                    n += np.bincount(r, minlength=hi - lo)
                    sums = np.append(0, np.cumsum(gain[b]))
                    edge = np.searchsorted(r, np.arange(hi - lo + 1))
                    total += sums[edge[1:]] - sums[edge[:-1]]
                out = [batch.column(0).slice(lo, hi - lo), pa.array(words.astype(np.int64)), pa.array(n), pa.array(np.where(n > 0, total // np.maximum(n, 1), 0))]
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "n_words", "n_features", "weight"])

    return weighed


def noise(doc_id: Column, seed: int) -> Column:
    """1000 times Gumbel noise, rounded down, by the id alone."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame, target: DataFrame, max_words: int = 2, buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS,
    seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row; ``rank`` is null for rows that are not drawn.

    Of the rows with ``least_words`` words or more, ``percent`` of a hundred are drawn, rounded down: those of the highest scores, ties
    to the smaller id, then to the fewer features and the lower weight; rows that are equal in all of these are alike. A null or empty text
    has no features and weight 0. A null id takes the noise of an empty one and comes after other ids. Rows of one id have one noise
    and each its own weight. Other columns of either table are not read. Empty tables give no rows, or weights from smoothing alone.
    """
    texts, of_target = docs.select(F.col(text_col).alias("text")), target.select(F.col(text_col).alias("text"))
    listed = frequent(texts, max_words)
    gain = gains(bucket_totals(of_target, max_words, buckets, listed), bucket_totals(texts, max_words, buckets, listed))
    fields = [T.StructField("doc_id", docs.schema[id_col].dataType)] + [T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.mapInArrow(_weighed(max_words, buckets, listed, gain), T.StructType(fields))
    rows = stored(rows.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))

    # scores lie within 1000 times the logs of what a long can count, so this table and its one ordered pass are bounded
    able = F.col("n_words") >= least_words
    scores = rows.where(able).groupBy("score").agg(F.count("*").alias("n"))
    above = F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1))
    draw = rows.where(able).count() * percent // 100
    scores = scores.select("score", F.coalesce(above, F.lit(0)).alias("above")).where(F.col("above") < draw)
    near = rows.join(F.broadcast(scores), "score", "left")
    out = ["doc_id", "n_features", "weight", "score"]
    in_score = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_features", "weight")
    ranked = near.where(able & F.col("above").isNotNull()).withColumn("rank", (F.col("above") + F.row_number().over(in_score)).cast("long"))
    ranked = ranked.select(*out, F.when(F.col("rank") <= draw, F.col("rank")).alias("rank"))
    return ranked.union(near.where(~able | F.col("above").isNull()).select(*out, F.lit(None).cast("long").alias("rank")))
