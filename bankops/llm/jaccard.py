"""N-gram Jaccard join: documents whose sets of word n-grams overlap by a given share, and the components they form.

The product of the document by n-gram matrix with its transpose gives the overlaps. It is made in blocks of n-grams, on the
part of each row that can decide: with all n-grams in one order, a document of n distinct ones need only show its first
n - ceil(t n) + 1, because any partner shares one of these. N-grams known to be frequent come last in the order, the most
frequent ones at the end, so passages that many documents share are shown only by documents made of little else. The others are
ordered by how rare their words are: n-grams of common words repeat by chance, the more often the larger the table, and would
make pairs of strangers whose number grows with its square.

1. One pass finds common words. A second one counts over the whole table how many rows have an n-gram in the first half of
   their own order, 32 bits of hash and a block for each, and lists the frequent ones. An n-gram in a passage that is spread thinly
   over a large table is found like any other. Results do not depend on these lists, only cost does.
2. One pass makes the sets. Documents with equal sets are one class. The n-grams shown go, packed, to blocks by hash.
3. Each block counts, for pairs of classes, the n-grams shown by both. An n-gram shown by very many classes gives no pairs
   but ties its classes to the smallest one.
4. The counts of a pair are added up over the blocks. A pair is discarded when its count and all it could still share beyond
   what both show stay below the overlap its sizes demand. Each document says where in the order the last one it shows is, and
   some before, so what is left beyond the place up to which both show all is known for the one and bounded for the other.
5. What is left falls into groups. The whole sets of a group meet in a task, and overlaps are counted by products of
   blocks of the matrix, exactly. Groups beyond a block are compared with some of their members first; after that only classes
   outside the largest component are compared with the rest, block by block, so a large group of copies costs its size. Blocks
   hold classes of about one size, and only blocks whose sizes can link meet.

Hashes of n-grams have 60 bits and those of sets 64, over all documents; two different sets of one hash would be taken for
copies (expected number: documents squared over 2^65).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankops.llm.components import components, id_edges, union_min
from bankops.llm.text import LOWERED, SPACE, HashTable, U, hash_runs, mixed, rows_of, runs, text_slices, window_hashes
from bankops.session import stored

WORDS = 5
PERCENT = 75
FREQUENT = 16  # rows beyond which an n-gram is frequent
STEP = 4  # times the rows from one level of frequent ones to the next
MOST_FREQUENT = 1_000_000  # longest list (12 MB); shorter lists cost time, not results
COUNT_BYTES = 32 << 20  # of text whose n-grams are counted in one block, on average
MOST_SHOWN_BY = 32  # classes; an n-gram shown by more gives ties to one class, not pairs
BLOCK_ROWS = 256
WORD_BITS = 16  # a word is common if it is more than one of 2^16; its bits are the logarithm of its share
LEVELS = 12  # of 16, of n-grams by the bits of their words, rare ones first; the levels of frequent ones come after these
LEVEL_BITS = 6  # of words, from one level to the next
TIED = LEVELS + 1  # the level from which on an n-gram gives ties within a batch
MARKS = 8  # equal parts of what a document shows, of which it says where they end
BLOCK_BYTES = 4 << 20  # of text whose n-grams go to one block, on average
COLUMNS = 4096
HASH = U((1 << 60) - 1)


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all rows in order, and their rows."""
    body = LOWERED[data]
    starts, ends = runs(~SPACE[body[:-8]], offs)
    return hash_runs(body, starts, ends), rows_of(starts, offs)


def ngrams(
    h: np.ndarray, row: np.ndarray, offs: np.ndarray, words: int = WORDS, common: HashTable | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """60-bit hashes of the n-grams of each row and their rows; a row with fewer words has its whole sequence as one.

    With the bits of common words, the bits from 60 on are the level of the n-gram, 0 for the rarest words.
    """
    grams, at = window_hashes(h, row, words)
    owner = row[at]
    count = np.bincount(row, minlength=len(offs) - 1)
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        first = np.searchsorted(row, short)
        whole = np.full(len(short), U(12345))
        for k in range(words - 1):
            has = count[short] > k
            whole[has] = mixed(whole[has] + h[first[has] + k] * U(2 * k + 1))
        grams, owner = np.append(grams, mixed(whole + count[short].astype(U))), np.append(owner, short)
    grams >>= U(4)
    if common is not None and len(grams):
        known = common.find(h)
        bits = np.append(0, np.cumsum(np.where(known < 0, WORD_BITS, known)))
        first_word = np.append(at, first) if len(short) else at
        held = np.append(np.full(len(at), words), count[short]) if len(short) else words
        level = (WORD_BITS * words - bits[first_word + held] + bits[first_word]) // LEVEL_BITS
        grams |= np.clip(level, 0, LEVELS - 1).astype(U) << U(60)
    return grams, owner


def count_keys(codes: np.ndarray, blocks: int) -> np.ndarray:
    """The block in which an n-gram is counted, and 32 bits more."""
    return ((codes & HASH) >> U(32)) % U(blocks) << U(32) | codes & U(0xFFFFFFFF)


def distinct_sets(grams: np.ndarray, row: np.ndarray, frequent: tuple[HashTable, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of each row in order, by row. The bits from 60 on are the level; those of frequent n-grams are last."""
    if frequent is not None and len(grams):
        known = frequent[0].find(count_keys(grams, frequent[1]))
        at = np.flatnonzero(known >= 0)
        grams[at] = (grams[at] & HASH) | (known[at] + LEVELS).astype(U) << U(60)
    order = np.argsort(grams)
    order = order[np.argsort(row[order].astype(np.uint16 if len(row) and row.max() < 65536 else np.int64), kind="stable")]
    grams, row = grams[order], row[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    return grams[new], row[new]


def set_sums(codes: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row: size, start in ``codes``, and the set's hash as a signed long."""
    size = np.bincount(row, minlength=n)
    start = np.cumsum(size) - size
    sums = np.zeros(n, U)
    has = size > 0
    if has.any():
        sums[has] = np.add.reduceat(mixed((codes & HASH) ^ U(0x5BD1E995)), start[has])
    return size, start, mixed(sums + size.astype(U)).view(np.int64)


def in_order(codes: np.ndarray) -> np.ndarray:
    """Codes as signed longs of the same order."""
    return (codes ^ U(1 << 63)).view(np.int64)


def _run_lengths(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and how often each is there."""
    h = np.sort(h)
    edge = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
    return h[edge], np.diff(np.append(edge, len(h)))


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with about the share of a common one in a batch and their counts; without a word, the number of all words."""
    for batch in batches:
        held = [word_hashes(data, offs)[0] for _, _, data, offs in text_slices(batch.column(0))]
        if not held:
            continue
        h, n = _run_lengths(np.concatenate(held))
        keep = n > n.sum() >> (WORD_BITS + 1)
        word = pa.array(np.append(h[keep].view(np.int64), 0), mask=np.append(np.zeros(keep.sum(), bool), True))
        yield pa.RecordBatch.from_arrays([word, pa.array(np.append(n[keep], n.sum()))], ["word", "n"])


def _first_half(words: int, blocks: int, common: tuple[np.ndarray, np.ndarray]):
    """Of each batch and block, 32 bits of each n-gram in the first half of a row's order."""

    def first_half(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = HashTable()
        known.add(*common)
        for batch in batches:
            held = []
            for lo, hi, data, offs in text_slices(batch.column(0)):
                codes, row = distinct_sets(*ngrams(*word_hashes(data, offs), offs, words, known))
                size, start, _ = set_sums(codes, row, hi - lo)
                held.append(count_keys(codes[2 * (np.arange(len(codes)) - start[row]) <= size[row]], blocks))
            if held:
                keys = np.sort(np.concatenate(held))
                edges = np.searchsorted(keys, np.arange(blocks + 1).astype(U) << U(32))
                rest = keys.astype(np.uint32)
                packed = [rest[i:j].tobytes() for i, j in zip(edges[:-1], edges[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(blocks, dtype=np.int32)), pa.array(packed, pa.binary())], ["block", "packed"])

    return first_half


def _frequent(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys that more rows than that have in their first half, and the number of rows."""
    held: dict[int, list[bytes]] = {}
    for batch in batches:
        for block, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held.setdefault(block, []).append(blob)
    for block, blobs in held.items():
        rest, n = _run_lengths(np.frombuffer(b"".join(blobs), np.uint32))
        keys = rest[n > least].astype(np.int64) | block << 32
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n[n > least])], ["key", "n"])


def _shown(words: int, percent: int, blocks: int, listed: tuple[np.ndarray, np.ndarray], count_blocks: int, common: tuple[np.ndarray, np.ndarray]):
    """Rows for documents (set's hash, size, last place of the order that is shown, ends of parts before it), and packed codes."""

    def shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, known = HashTable(), HashTable()
        frequent.add(*listed)
        known.add(*common)
        names = ["block", "doc_id", "text_hash", "a", "n", "edge", "marks", "packed"]
        for batch in batches:
            codes_held, sums_held, size_held = [], [], []
            for lo, hi, data, offs in text_slices(batch.column(2)):
                codes, row = distinct_sets(*ngrams(*word_hashes(data, offs), offs, words, known), (frequent, count_blocks))
                size, start, sums = set_sums(codes, row, hi - lo)
                show = size - -(-percent * size // 100) + 1
                n = hi - lo
                edge, has = np.zeros(n, np.int64), size > 0
                edge[has] = in_order(codes[(start + show - 1)[has]])
                ends = show[:, None] * np.arange(1, MARKS) // MARKS
                marks = np.full((n, MARKS - 1), -(1 << 31))  # where the first parts of short documents are empty
                marks[ends > 0] = in_order(codes[(start[:, None] + ends - 1)[ends > 0]]) >> 32
                keep = np.arange(len(codes)) - start[row] < show[row]
                codes, row = codes[keep], row[keep]
                out = [
                    pa.array(np.mod(sums, blocks).astype(np.int32)), batch.column(0).slice(lo, n), batch.column(1).slice(lo, n), pa.array(sums),
                    pa.array(size.astype(np.int32)),
                    pa.array(edge),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(n + 1, dtype=np.int32) * (MARKS - 1)), pa.array(marks.ravel().astype(np.int32))
                    ),
                    pa.nulls(n, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(out, names)
                codes_held.append(codes)
                sums_held.append(sums[row])
                size_held.append(size[row].astype(np.uint32))
            if not codes_held:
                continue
            codes, sums, sizes = np.concatenate(codes_held), np.concatenate(sums_held), np.concatenate(size_held)
            # of the classes that show a frequent n-gram in this batch only the smallest goes on; the others are tied to it
            order = np.lexsort((sums, codes))
            codes, sums, sizes = codes[order], sums[order], sizes[order]
            new = np.append(True, (codes[1:] != codes[:-1]) | (sums[1:] != sums[:-1])) if len(codes) else np.zeros(0, bool)
            codes, sums, sizes = codes[new], sums[new], sizes[new]
            first = np.append(True, codes[1:] != codes[:-1]) if len(codes) else np.zeros(0, bool)
            lead = sums[np.maximum.accumulate(np.where(first, np.arange(len(codes)), 0))]
            tie = (codes >> U(60) >= TIED) & ~first
            pairs = np.unique(np.stack([sums[tie], lead[tie]], axis=1), axis=0)
            codes, sums, sizes = codes[~tie], sums[~tie], sizes[~tie]
            where = (codes % U(blocks)).astype(np.int64)
            order = np.argsort(where, kind="stable")
            edges = np.searchsorted(where[order], np.arange(blocks + 1))
            rest = (codes // U(blocks)).astype(np.uint32)[order]  # 32 bits more tell codes of a block apart
            flag = (codes >> U(60) >= TIED).astype(np.uint8)[order]
            sums, sizes = sums[order], sizes[order]
            packed = [
                b"".join(x[i:j].tobytes() for x in (rest, sums, sizes, flag)) for i, j in zip(edges[:-1], edges[1:])
            ]
            packed.append(pairs.astype("<i8").tobytes())
            number = np.append(np.arange(blocks), -1 - int(codes[0] % U(blocks)) if len(codes) else -1)
            m = blocks + 1
            out = [
                pa.array(number.astype(np.int32)), pa.nulls(m, batch.column(0).type), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()),
                pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.list_(pa.int32())), pa.array(packed, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(out, names)

    return shown


def _pairs_of(
    code: np.ndarray, sums: np.ndarray, sizes: np.ndarray, flag: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, of sizes that can link, with the number of n-grams both show, ties) of one block."""
    order = np.lexsort((sums, code))
    code, sums, sizes, flag = code[order], sums[order], sizes[order].astype(np.int64), flag[order]
    new = np.append(True, (code[1:] != code[:-1]) | (sums[1:] != sums[:-1])) if len(code) else np.zeros(0, bool)
    code, sums, sizes, flag = code[new], sums[new], sizes[new], flag[new]
    edge = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
    size = np.diff(np.append(edge, len(code)))
    hot = (size > MOST_SHOWN_BY) | (np.maximum.reduceat(flag, edge) > 0 if len(edge) else False)
    run = np.repeat(np.arange(len(edge)), size)
    lead = sums[edge][run]
    tie = hot[run] & (sums != lead)
    ties = np.unique(np.stack([sums[tie], lead[tie]], axis=1), axis=0)
    found = []
    end = (edge + size)[run]
    for k in range(1, MOST_SHOWN_BY):
        i = np.arange(len(code) - k) if len(code) > k else np.zeros(0, np.int64)
        i = i[(i + k < end[i]) & ~hot[run[i]]]
        if not len(i):
            break
        a, b = sizes[i], sizes[i + k]
        i = i[100 * np.minimum(a, b) >= percent * np.maximum(a, b)]
        found.append(np.stack([sums[i], sums[i + k]], axis=1))
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    pairs, n = np.unique(pairs, axis=0, return_counts=True)
    return np.column_stack([pairs, n]), ties


def _count_block(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents as they are; of each block the pairs with counts, and ties with count 0."""
    names = ["kind", "doc_id", "text_hash", "a", "b", "n", "edge", "marks"]
    held: dict[int, list[bytes]] = {}
    kind = None
    for batch in batches:
        kind = batch.schema.field("doc_id").type
        is_doc = batch.column("packed").is_null()
        docs = batch.filter(is_doc)
        if docs.num_rows:
            out = [pa.array(["doc"] * docs.num_rows), docs.column("doc_id"), docs.column("text_hash"), docs.column("a"), pa.nulls(docs.num_rows, pa.int64()), docs.column("n"), docs.column("edge"), docs.column("marks")]
            yield pa.RecordBatch.from_arrays(out, names)
        packed = batch.filter(pa.compute.invert(is_doc))
        for number, blob in zip(packed.column("block").to_pylist(), packed.column("packed").to_pylist()):
            held.setdefault(min(number, -1) if number < 0 else number, []).append(blob)

    def rows(word: str, pairs: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        m = len(pairs)
        out = [pa.array([word] * m, pa.string()), pa.nulls(m, kind), pa.nulls(m, pa.int64()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(n.astype(np.int32)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays(out, names)

    for number, blobs in held.items():
        if number < 0:
            for blob in blobs:
                ties = np.frombuffer(blob, "<i8").reshape(-1, 2)
                yield rows("tie", ties, np.zeros(len(ties)))
            continue
        size = [len(x) // 17 for x in blobs]
        code = np.concatenate([np.frombuffer(x, np.uint32, m) for x, m in zip(blobs, size)])
        sums = np.concatenate([np.frombuffer(x, np.int64, m, 4 * m) for x, m in zip(blobs, size)])
        sizes = np.concatenate([np.frombuffer(x, np.uint32, m, 12 * m) for x, m in zip(blobs, size)])
        flag = np.concatenate([np.frombuffer(x, np.uint8, m, 16 * m) for x, m in zip(blobs, size)])
        pairs, ties = _pairs_of(code, sums, sizes, flag, percent)
        yield rows("pair", pairs[:, :2], pairs[:, 2])
        yield rows("tie", ties, np.zeros(len(ties)))


def links(codes: np.ndarray, row: np.ndarray, size: np.ndarray, percent: int, left: np.ndarray) -> tuple:
    """Pairs (i, j) of rows that link, i among the rows marked ``left``; products of column blocks of the matrix.

    ``codes`` of a row are distinct. Columns are the codes of two rows or more; a pair's overlap grows block by block, and the
    product ends early when no pair can still reach what its sizes demand.
    """
    m = len(size)
    _, column, times = np.unique(codes, return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1
    keep = times[column] > 1
    column, row = number[column[keep]], row[keep]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    need = -(-percent * (size[left][:, None] + size[None, :]) // (100 + percent))
    need[np.arange(len(left)), left] = np.iinfo(np.int64).max
    overlap = np.zeros((len(left), m), np.float32)
    rest = np.bincount(row, minlength=m)
    total = int(column[-1]) + 1 if len(column) else 0
    for lo in range(0, total, COLUMNS):
        i, j = np.searchsorted(column, [lo, lo + COLUMNS])
        block = np.zeros((m, COLUMNS), np.float32)
        block[row[i:j], column[i:j] - lo] = 1
        overlap += block[left] @ block.T
        rest -= np.bincount(row[i:j], minlength=m)
        if (overlap + np.minimum(rest[left][:, None], rest[None, :]) < need).all():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j = np.nonzero(overlap >= need)
    return left[i], j


def _verify(words: int, percent: int):
    def verify(table: pa.Table) -> pa.Table:
        """Edges that connect the linked classes of each group of one task; rows with ``side`` false only answer."""
        table = table.combine_chunks()
        grp, sums = table.column("grp").to_numpy(), table.column("a").to_numpy()
        side = table.column("side").to_numpy(zero_copy_only=False)
        codes, row, size = [], [], np.zeros(len(sums), np.int64)
        for lo, hi, data, offs in text_slices(table.column("text")):
            c, r = distinct_sets(*ngrams(*word_hashes(data, offs), offs, words))
            n, _, s = set_sums(c, r, hi - lo)
            n[s != sums[lo:hi]] = -1  # another text under a repeated id
            size[lo:hi] = n
            codes.append(c)
            row.append(r + lo)
        codes, row = np.concatenate(codes), np.concatenate(row)
        first = np.searchsorted(row, np.arange(len(sums) + 1))
        found_a, found_b = [], []
        order = np.lexsort((~side, sums, grp))
        cuts = np.flatnonzero(np.append(True, grp[order][1:] != grp[order][:-1]))
        for lo, hi in zip(cuts, np.append(cuts[1:], len(order))):
            at = order[lo:hi]
            at = at[size[at] > 0]
            at = at[np.append(True, sums[at][1:] != sums[at][:-1])] if len(at) else at
            left = np.flatnonzero(side[at])
            if len(at) < 2 or not len(left):
                continue
            n = size[at]
            mine = np.concatenate([codes[first[x] : first[x + 1]] for x in at])
            i, j = links(mine, np.repeat(np.arange(len(at)), n), n, percent, left)
            if len(i):
                nodes, low = union_min(sums[at[i]], sums[at[j]])
                found_a.append(nodes)
                found_b.append(low)
        a = np.concatenate(found_a) if found_a else np.zeros(0, np.int64)
        b = np.concatenate(found_b) if found_b else np.zeros(0, np.int64)
        return pa.table({"a": a, "b": b})

    return verify


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links) of every row.

    Two documents link when 100 * overlap >= percent * union of their sets. A null text or one without words has an empty set,
    links with nothing and is its own component. Rows that repeat an id are one document: each row has the set of its own text, links
    of each count for all, and all get the same component. A row with a null id gets its size, a null component, and takes no part
    in links. Very long texts are read whole. Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(max(16, -(-total // BLOCK_BYTES)))

    common = stored(rows.select("text").mapInArrow(_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    every = common.where("word is null").agg(F.sum("n")).first()[0] or 0
    common = common.where(F.col("word").isNotNull() & (F.col("n") > every >> WORD_BITS)).toArrow()
    bits = np.log2(every / common.column("n").to_numpy()).astype(np.int32)
    common = common.column("word").to_numpy().view(U), bits

    count_blocks = int(max(16, -(-total // COUNT_BYTES)))
    halves = rows.select("text").mapInArrow(_first_half(words, count_blocks, common), "block int, packed binary")
    often = stored(halves.repartition(count_blocks, "block").mapInArrow(partial(_frequent, FREQUENT), "key long, n long"))
    often = often.orderBy(F.desc("n"), "key").limit(MOST_FREQUENT).toArrow()
    level = np.searchsorted([FREQUENT * STEP**k for k in range(1, 16 - LEVELS)], often.column("n").to_numpy()).astype(np.int32)
    listed = often.column("key").to_numpy().view(U), level

    packed = T.StructType([
        T.StructField("block", T.IntegerType()), T.StructField("doc_id", id_type), T.StructField("text_hash", T.LongType()), T.StructField("a", T.LongType()),
        T.StructField("n", T.IntegerType()), T.StructField("edge", T.LongType()),
        T.StructField("marks", T.ArrayType(T.IntegerType())), T.StructField("packed", T.BinaryType()),
    ])
    counted = T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("doc_id", id_type), T.StructField("text_hash", T.LongType()), T.StructField("a", T.LongType()),
        T.StructField("b", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("edge", T.LongType()),
        T.StructField("marks", T.ArrayType(T.IntegerType())),
    ])
    shown = rows.mapInArrow(_shown(words, percent, blocks, listed, count_blocks, common), packed)
    found = stored(shown.repartition(blocks, "block").mapInArrow(partial(_count_block, percent), counted))

    sets = found.where("kind = 'doc'").select("doc_id", "a", "n")
    classes = found.where("kind = 'doc' and doc_id is not null and n > 0").groupBy("a")
    largest = [F.max(c).alias(c) for c in ("n", "edge", "marks")]  # equal in a class
    # a class takes its text from one row: of the rows of its smallest id, which may have several texts, one of the class
    first = F.min(F.struct("doc_id", "text_hash")).alias("first")
    classes = stored(classes.agg(first, *largest).select("a", "first.*", "n", "edge", "marks").withColumnsRenamed({"doc_id": "first_id", "text_hash": "first_hash"}))

    # discard pairs that cannot reach the overlap their sizes demand
    p = F.lit(percent)
    pairs = found.where("kind = 'pair'").groupBy("a", "b").agg(F.sum("n").alias("both"))
    of = classes.select("a", "n", "edge", "marks")
    pairs = pairs.join(of.withColumnsRenamed({"n": "na", "edge": "ea", "marks": "ma"}), "a")
    pairs = pairs.join(of.withColumnsRenamed({"a": "b", "n": "nb", "edge": "eb", "marks": "mb"}), "b")
    # both show all up to the earlier edge; of the other set the parts that end before it are shown
    up_to = F.least("ea", "eb")
    high = F.shiftright(up_to, 32).cast("int")
    show = lambda n: F.col(n) - F.ceil(F.col(n) * p / 100) + 1
    parts = lambda m: F.size(F.filter(m, lambda x: x < high))
    after = lambda n, e, m: F.col(n) - F.when(F.col(e) == up_to, show(n)).otherwise(F.floor(show(n) * parts(m) / MARKS))
    pairs = pairs.where(
        (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * p)
        & ((F.col("both") + F.least(after("na", "ea", "ma"), after("nb", "eb", "mb"))) * (100 + p) >= (F.col("na") + F.col("nb")) * p)
    )
    ties = found.where("kind = 'tie'").select("a", "b")
    groups = components(pairs.select("a", "b").union(ties))
    groups = groups.withColumnsRenamed({"node": "a", "component": "grp"})
    sizes = groups.groupBy("grp").agg(F.count("*").alias("members"))
    # sets that link differ in size by the band's width at most, so they lie in one band or in neighbouring ones
    width = 1.001 * max(math.log(100 / percent), 1e-6)
    members = groups.join(sizes, "grp").join(classes.select("a", "first_id", "first_hash", F.floor(F.log("n") / width).alias("band")), "a")
    alike = members.groupBy("grp", "band").agg(F.count("*").alias("alike"))
    members = members.join(alike, ["grp", "band"])
    with_text = members.join(rows.withColumnsRenamed({"doc_id": "first_id", "text_hash": "first_hash"}), ["first_id", "first_hash"])
    with_text = stored(with_text.select("grp", "members", "band", "alike", "a", "text"))

    spread_ = F.xxhash64("a", F.lit(7))
    few = with_text.where(F.col("members") <= BLOCK_ROWS)
    few = few.select("grp", "a", "text", F.lit(True).alias("side"), F.concat_ws(":", F.lit("s"), F.pmod(F.xxhash64("grp"), F.lit(blocks))).alias("task"))
    many = with_text.where(F.col("members") > BLOCK_ROWS)
    pieces = F.ceil(F.col("members") / (BLOCK_ROWS - 64)).cast("int")
    asked = F.pmod(spread_, F.col("members")) < 64
    first_round = many.select(
        "grp", "a", "text", F.lit(True).alias("side"),
        F.explode(F.when(asked, F.sequence(F.lit(0), pieces - 1)).otherwise(F.array(F.pmod(F.xxhash64("a"), pieces).cast("int")))).alias("piece"),
    ).select("grp", "a", "text", "side", F.concat_ws(":", F.lit("m"), "grp", "piece").alias("task"))
    verify = _verify(words, percent)
    edges = few.union(first_round).groupBy("task").applyInArrow(verify, "a long, b long")
    edges = stored(edges)

    if not many.limit(1).isEmpty():
        joined = components(edges).withColumnsRenamed({"node": "a"})
        state = many.join(joined, "a", "left").withColumn("component", F.coalesce("component", "a"))
        by = state.groupBy("grp", "component").agg(F.count("*").alias("n"))
        largest = by.groupBy("grp").agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.count("*").alias("parts"))
        state = state.join(largest.where("parts > 1"), "grp").withColumn("rest", F.col("component") != F.col("largest"))
        state = stored(state.withColumn("piece", F.pmod(F.xxhash64("a"), F.ceil(F.col("alike") / BLOCK_ROWS))))
        # two blocks of sizes that can link meet when one of them has classes outside the largest component; a block without
        # them sends nothing to another one without
        pieces = state.groupBy("grp", F.col("band").alias("other_band"), F.col("piece").alias("other_piece")).agg(F.max("rest").alias("open"))
        near = pieces.withColumn("band", F.explode(F.array(*(F.col("other_band") + k for k in (-1, 0, 1)))))
        near = near.groupBy("grp", "band").agg(F.collect_list(F.struct("other_band", "other_piece", "open")).alias("near"))
        both = state.join(near, ["grp", "band"])
        both = both.withColumn("other", F.explode(F.filter("near", lambda x: F.col("rest") | x["open"])))
        ends = F.concat_ws(".", "band", "piece"), F.concat_ws(".", "other.other_band", "other.other_piece")
        both = both.select("grp", "a", "text", F.col("rest").alias("side"), F.concat_ws(":", "grp", F.least(*ends), F.greatest(*ends)).alias("task"))
        more = both.groupBy("task").applyInArrow(verify, "a long, b long")
        edges = stored(edges.union(more))

    # rows of one id are one document, whose links are those of all its texts
    own = sets.where("n > 0")
    linked = components(edges.union(id_edges(own, "doc_id", "a"))).withColumnsRenamed({"node": "a"})
    smallest = linked.join(classes.select("a", "first_id"), "a").groupBy("component").agg(F.min("first_id").alias("smallest"))
    ends = linked.join(smallest, "component").select("a", "smallest")
    ids = classes.join(ends, "a", "left").select("a", F.coalesce("smallest", "first_id").alias("smallest"))
    out = own.join(ids, "a", "left").select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("smallest")).alias("component_id"))
    # a row without words is its own component, unless its id has another row with words
    empty = sets.where("n = 0")
    other = own.join(empty.select("doc_id").distinct(), "doc_id", "left_semi").join(ids, "a").groupBy("doc_id").agg(F.min("smallest").alias("smallest"))
    empty = empty.join(other, "doc_id", "left").select("doc_id", "n", F.coalesce("smallest", "doc_id").alias("component_id"))
    return out.union(empty).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")
