"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

An alignment scores +2 for an equal word and -1 for another word or a gap; a given share of the best score possible is a hit. Of the
steps from one equal word to the next, those that pass over two words or more cost at least two. So a hit of score s has at least
s/2 - 1 steps that pass over one word at most, in the item and in the document: word pairs, next to each other or with one word between.
Each starts at a place of the item of its own, so a hit misses at most the item's places less that many.

1. One pass over the documents counts how often each pair of the items occurs.
2. An item's seeds are its rarest places that occur, so many that no hit can miss all of them, however often they occur. A second pass
   finds seeds in the documents; enough of one item's seeds close together propose a window, and the item is aligned with it.

Items are a stated set of queries: they are made into blocks of bounded size, sent to the executors as files, and every batch of
documents meets the blocks in turn, so there are two passes whatever the number of items. Everything happens where a document is
read; nothing but counts and hits is moved.
"""

from __future__ import annotations

import pickle
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from bankops.llm.text import LETTER, LOWERED, U, HashTable, hash_runs, mixed, rows_of, runs, spread, table, text_slices
from bankops.session import stored

WHOLE_WORDS = 4  # a hit scores as much as so many equal words, or all words of a shorter item
ITEM_BYTES = 4 << 20  # of item text in one block
PAIRS, CELLS = 2 << 20, 1 << 20  # seeds found and cells of windows that are worked on at once
LEAST_SCORE = 0.5
MATCH, MISS = 2, 1
_WORD = LETTER | table(b"0123456789") | table(bytes(range(128, 256)))


def words_of(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and rows of all words: runs of letters, digits and characters outside ASCII, A-Z lower-cased."""
    body = LOWERED[data]
    starts, ends = runs(_WORD[body[:-8]], offs)
    return hash_runs(body, starts, ends), rows_of(starts, offs)


def align(items: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of each pair of rows and the column where it ends; both are padded with values that match nothing."""
    n, width = windows.shape
    before = np.zeros((n, width + 1), np.int32)
    steps = np.arange(width + 1, dtype=np.int32) * MISS
    best, end = np.zeros(n, np.int32), np.zeros(n, np.int64)
    for k in range(items.shape[1]):
        same = np.where(windows == items[:, k : k + 1], MATCH, -MISS)
        now = np.zeros_like(before)
        np.maximum(before[:, :-1] + same, before[:, 1:] - MISS, out=now[:, 1:])
        np.maximum(now, 0, out=now)
        # a gap in the item costs MISS a word: the best cell to the left less the way from there
        now = np.maximum.accumulate(now + steps, axis=1) - steps
        at = now.argmax(axis=1)
        top = now[np.arange(n), at]
        better = top > best
        best[better], end[better] = top[better], at[better]
        before = now
    return best, end


PAIR_STEPS = (1, 2)  # a pair's words are next to each other, or have one word between


def pair_codes(h: np.ndarray, row: np.ndarray, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first word, code) of the pairs of each row, and of single words; of pairs, only those of two known words."""
    everywhere = np.ones(len(h), bool) if known is None else known
    at, code = [np.flatnonzero(everywhere)], [mixed(h[everywhere] + U(0x51ED270B))]
    for d in PAIR_STEPS:
        if len(h) > d:
            i = np.flatnonzero((row[:-d] == row[d:]) & everywhere[:-d] & everywhere[d:])
            at.append(i)
            code.append(mixed(mixed(h[i]) + h[i + d] * U(0x9E3779B97F4A7C15)))  # alike for both distances
    return np.concatenate(at), np.concatenate(code)


class Items:
    """One block of items: their words, and the word pairs that are seeds of each."""

    def __init__(self, texts: list[str], least: float = LEAST_SCORE):
        column = pa.array(texts, pa.large_string())
        held = [words_of(d, o) for _, _, d, o in text_slices(column, 1 << 40)]
        self.hash, self.row = held[0] if held else (np.zeros(0, U), np.zeros(0, np.int64))
        self.size = np.bincount(self.row, minlength=len(texts))
        self.start = np.cumsum(self.size) - self.size
        self.words = np.unique(self.hash)
        at, code = pair_codes(self.hash, self.row)
        # a single word is a seed of an item of one word only
        keep = (self.size[self.row[at]] == 1) | (np.arange(len(at)) >= len(self.hash))
        self.place, code = at[keep], code[keep]
        self.codes, self.code = np.unique(code, return_inverse=True)
        self.pairs = np.unique(self._pair(self.row, self.hash))
        # the smallest score of a hit, the words it matches at least and the most words of a document it covers
        self.score = np.maximum(np.ceil(MATCH * self.size * least - 1e-9), MATCH * np.minimum(self.size, WHOLE_WORDS)).astype(np.int64)
        self.match = -(-self.score // MATCH)
        self.span = self.size + (MATCH * self.size - self.score) // MISS

    def seeds(self, counts: np.ndarray) -> "Items":
        """Keep the rarest places of each item: a hit has at least ``match`` - 1 of those whose pairs occur (the only word of an item of one), so
        of ``some`` more than it can miss it has ``some``, whichever they are. Their pairs are the seeds."""
        n = np.bincount(self.place, counts[self.code], minlength=len(self.hash)).astype(np.int64)
        there = np.flatnonzero(n > 0)
        there = there[np.lexsort((n[there], self.row[there]))]
        total = np.bincount(self.row[there], minlength=len(self.size))
        rank = np.arange(len(there)) - (np.cumsum(total) - total)[self.row[there]]
        sure = np.maximum(1, self.match - 1)
        self.some = np.maximum(1, sure // 2)
        chosen = np.zeros(len(self.hash), bool)
        chosen[there[rank < np.where(total >= sure, total - sure + self.some, 0)[self.row[there]]]] = True
        keep = chosen[self.place] & (counts[self.code] > 0)
        pairs = np.unique(self.code[keep] * len(self.size) + self.row[self.place[keep]])
        self.gram, self.item = np.divmod(pairs, max(1, len(self.size)))
        return self

    @staticmethod
    def _pair(item: np.ndarray, word: np.ndarray) -> np.ndarray:
        """A hash for each item and word."""
        return mixed(word + item.astype(U) * U(0x9E3779B97F4A7C15))

    def lookup(self) -> tuple[HashTable, HashTable, HashTable]:
        """The items' words, the pairs of an item and a word of it, and the codes of word pairs."""
        words, pairs, codes = HashTable(), HashTable(), HashTable()
        words.add(self.words, np.arange(len(self.words), dtype=np.int32))
        pairs.add(self.pairs, np.zeros(len(self.pairs), np.int32))
        codes.add(self.codes, np.arange(len(self.codes), dtype=np.int32))
        return words, pairs, codes

    @staticmethod
    def met(found: tuple[HashTable, ...], h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, number of the code) of the items' word pairs in documents, by place."""
        at, code = pair_codes(h, row, found[0].find(h) >= 0)
        number = found[2].find(code)
        at, number = at[number >= 0], number[number >= 0].astype(np.int64)
        order = np.argsort(at, kind="stable")
        return at[order], number[order]

    def windows(self, known: np.ndarray, word: np.ndarray, row: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(item, row, first word, word after the last, seeds) of the windows where an item can stand, some items at a time."""
        occur = np.bincount(word, minlength=len(self.codes))
        load = np.cumsum(np.bincount(self.item, occur[self.gram], minlength=len(self.size)).astype(np.int64))
        part = load // PAIRS
        for p in np.unique(part[self.item]):
            chosen = part[self.item] == p
            gram, owner = self.gram[chosen], self.item[chosen]
            first = np.searchsorted(gram, np.arange(len(self.codes) + 1))
            times = first[word + 1] - first[word]
            key = owner[spread(first[word], times)] * len(row) + np.repeat(known, times)
            key.sort()
            item, at = np.divmod(key, max(1, len(row)))
            # so many seeds of one item in one row on as many words as a hit can cover
            last = np.arange(len(at)) + self.some[item] - 1
            begin = np.flatnonzero(last < len(at))
            last = last[begin]
            good = (item[last] == item[begin]) & (row[at[last]] == row[at[begin]]) & (at[last] - at[begin] < self.span[item[begin]])
            begin, last = begin[good], last[good]
            if not len(begin):
                continue
            item, low, high = item[begin], at[last] - self.span[item[begin]] + 1, at[begin] + self.span[item[begin]]
            owner, place = row[at[begin]], at[begin] // self.span[item]
            new = np.ones(len(begin), bool)
            new[1:] = (item[1:] != item[:-1]) | (owner[1:] != owner[:-1]) | (place[1:] != place[:-1])
            edge = np.flatnonzero(new)
            end = np.append(edge[1:], len(begin)) - 1
            yield item[edge], owner[edge], low[edge], high[end], last[end] - begin[edge] + 1

    def hits(self, found: tuple[HashTable, HashTable], data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
        """The best alignment of each (row, item) that is a hit."""
        h, row = words_of(data, offs)
        first_word = np.searchsorted(row, np.arange(len(offs)))
        names = ("row", "item", "start", "end", "score", "seeds")
        out = [[np.zeros(0, np.int64)] * 4 + [np.zeros(0), np.zeros(0, np.int64)]]
        for item, owner, lo, hi, seeds in self.windows(*self.met(found, h, row), row):
            lo, hi = np.maximum(lo, first_word[owner]), np.minimum(hi, first_word[owner + 1])
            order, p = np.argsort(self.size[item], kind="stable"), 0
            while p < len(order):
                q = min(len(order), p + 256)
                while q > p + 1 and (q - p) * int((hi - lo)[order[p:q]].max()) > CELLS:
                    q = p + (q - p) // 2
                out.append(self._aligned(found[1], h, item, owner, lo, hi, seeds, order[p:q], first_word))
                p = q
        row, item, start, end, score, seeds = (np.concatenate(x) for x in zip(*out))
        keep = np.lexsort((start, -score, item, row))
        one = np.ones(len(keep), bool)
        one[1:] = (row[keep][1:] != row[keep][:-1]) | (item[keep][1:] != item[keep][:-1])
        keep = keep[one]
        return {k: x[keep] for k, x in zip(names, (row, item, start, end, score, seeds))}

    def _aligned(self, pairs: HashTable, h, item, owner, lo, hi, seeds, part, first_word) -> list[np.ndarray]:
        """Row, item, start, end, score and seeds of the hits among the windows ``part``."""
        item, owner, lo, hi, seeds = (x[part] for x in (item, owner, lo, hi, seeds))
        j = np.arange(int((hi - lo).max()))
        b = np.where(j < (hi - lo)[:, None], h[np.minimum(lo[:, None] + j, len(h) - 1)], U(2))
        # words of the item on as many words as a hit can cover: fewer than it must match are none
        same = np.zeros((len(item), len(j) + 1), np.int64)
        np.cumsum(pairs.find(self._pair(np.repeat(item, len(j)), b.ravel())).reshape(b.shape) >= 0, axis=1, out=same[:, 1:])
        over = np.minimum(np.arange(len(j) + 1) + self.span[item, None], len(j))
        most = (np.take_along_axis(same, over, axis=1) - same).max(axis=1)
        good = np.flatnonzero(most >= self.match[item])
        item, owner, lo, seeds, b = item[good], owner[good], lo[good], seeds[good], b[good]
        if not len(item):
            return [item] * 4 + [np.zeros(0), item]
        size = self.size[item]
        k = np.arange(int(size.max()))
        a = np.where(k < size[:, None], self.hash[np.minimum(self.start[item, None] + k, len(self.hash) - 1)], U(1))
        best, stop = align(a, b)
        good = np.flatnonzero(best >= self.score[item])
        if not len(good):
            return [item[good]] * 4 + [np.zeros(0), item[good]]
        # the same from right to left, up to where it ended, tells where it began
        c = b[good].copy()
        c[j[None, :] >= stop[good, None]] = U(2)
        _, back = align(a[good][:, ::-1], c[:, ::-1])
        base = lo[good] - first_word[owner[good]]
        return [owner[good], item[good], base + len(j) - back, base + stop[good], best[good] / (MATCH * size[good]), seeds[good]]


class Blocks:
    """Blocks of items as files that Spark hands to every executor; a task reads one at a time."""

    def __init__(self, spark: SparkSession):
        self.context, self.folder = spark.sparkContext, tempfile.mkdtemp(prefix="bankops-items-")
        self.names: list[str] = []

    def add(self, ids: list, items: Items) -> None:
        name = f"items-{uuid.uuid4().hex}.pickle"
        with open(f"{self.folder}/{name}", "wb") as f:
            pickle.dump((ids, items), f, protocol=5)
        self.names.append(name)

    def own(self) -> Iterator[tuple[list, Items]]:
        """The blocks, read by the driver."""
        for name in self.names:
            with open(f"{self.folder}/{name}", "rb") as f:
                yield pickle.load(f)

    def send(self) -> list[str]:
        for name in self.names:
            self.context.addFile(f"{self.folder}/{name}")
        return self.names


def _in_turn(names: list[str]):
    """A function that gives (number, ids, items, lookup) of each block; a single block stays loaded."""
    held = []

    def load(name: str):
        with open(SparkFiles.get(name), "rb") as f:
            ids, items = pickle.load(f)
        return ids, items, items.lookup()

    def blocks() -> Iterator[tuple]:
        for b, name in enumerate(names):
            if len(names) > 1:
                yield b, *load(name)
            else:
                if not held:
                    held.append(load(name))
                yield b, *held[0]

    return blocks


def seeded_blocks(docs: DataFrame, benchmark: DataFrame, item_col: str, item_text: str, text_col: str, least: float) -> list[str]:
    """File names of the blocks of items with their seeds. A block's text is about ITEM_BYTES; the driver holds one block at a time."""
    spark = docs.sparkSession
    named = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).where("text is not null")
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, plain, seeded = max(1, -(-total // ITEM_BYTES)), Blocks(spark), Blocks(spark)
    for b in range(blocks):
        rows = named.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        items = Items([r["text"] for r in rows], least)
        if len(items.words):
            plain.add([r["item_id"] for r in rows], items)
    if not plain.names:
        return []
    names = plain.send()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _in_turn(names)
        for batch in batches:
            hashed = [words_of(data, offs) for _, _, data, offs in text_slices(batch.column(0))]
            for b, _, items, found in blocks():
                n = np.zeros(len(items.codes), np.int64)
                for h, row in hashed:
                    n += np.bincount(items.met(found, h, row)[1], minlength=len(n))
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), b)), pa.array(at), pa.array(n[at])], ["block", "code", "n"])

    counted = stored(docs.select(text_col).mapInArrow(count, "block long, code long, n long").groupBy("block", "code").agg(F.sum("n").alias("n")))
    for b, (ids, items) in enumerate(plain.own()):
        counts = np.zeros(len(items.codes), np.int64)
        for r in counted.where(F.col("block") == b).collect():  # at most one number for each pair of the block
            counts[r["code"]] = r["n"]
        seeded.add(ids, items.seeds(counts))
    return seeded.send()


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    least: float = LEAST_SCORE,
) -> DataFrame:
    """doc_id, item_id, start_word, end_word (words of the document from 0, end exclusive), score, seeds: one row for each
    document row and item whose best alignment reaches ``least`` and scores as much as WHOLE_WORDS equal words, or as the whole
    item if that is shorter. ``seeds`` are those in the window it was found in.

    Null and empty texts and items have no hits. Null ids are kept. Repeated rows have their own hits; items with equal texts each have
    theirs. Of equally good places of an item in a text the first found counts. Long texts are searched whole; other columns are not
    read. Empty tables give no rows.
    """
    spark = docs.sparkSession
    id_type, item_type = docs.schema[id_col].dataType, benchmark.schema[item_col].dataType
    fields = [T.StructField("doc_id", id_type), T.StructField("item_id", item_type)]
    fields += [T.StructField("start_word", T.LongType()), T.StructField("end_word", T.LongType())]
    fields += [T.StructField("score", T.DoubleType()), T.StructField("seeds", T.LongType())]
    schema = T.StructType(fields)
    files = seeded_blocks(docs, benchmark, item_col, item_text, text_col, least)
    if not files:
        return spark.createDataFrame([], schema)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _in_turn(files)
        for batch in batches:
            for _, ids, items, found in blocks():
                names = pa.array(ids, to_arrow_type(item_type))
                for lo, hi, data, offs in text_slices(batch.column(1)):
                    x = items.hits(found, data, offs)
                    rest = [pa.array(x[k]) for k in ("start", "end", "score", "seeds")]
                    doc = batch.column(0).slice(lo, hi - lo).take(pa.array(x["row"]))
                    yield pa.RecordBatch.from_arrays([doc, names.take(pa.array(x["item"])), *rest], schema.names)

    return docs.select(id_col, text_col).mapInArrow(hits, schema)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    least: float = LEAST_SCORE,
) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item; rows are judged one by one, whatever their ids."""
    at = docs.columns.index(text_col)
    files = seeded_blocks(docs, benchmark, item_col, item_text, text_col, least)
    if not files:
        return docs

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _in_turn(files)
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for _, _, items, found in blocks():
                for lo, _, data, offs in text_slices(batch.column(at)):
                    keep[lo + items.hits(found, data, offs)["row"]] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(clean, docs.schema)
