"""Token counts by a compiled finite-state tokenizer.

The splitting pattern of the vocabulary (contractions, runs of letters, single numbers, runs of other signs) is compiled to a
deterministic transducer over character classes. A text is cut into chunks of equal length; for each chunk the map from
every start state to its end state is made, all chunks side by side; the maps are composed by a parallel prefix scan, which
gives each chunk its true start state, and a second sweep reads the emissions: "a piece begins here". The end of a piece
emits the number of tokens that the vocabulary gives for it. That part of the transducer grows as pieces are met: the library
compiles each distinct piece once, and the transition is kept under the piece's hash.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from bankops.llm.text import HashTable, hash_runs, rows_of, text_slices
from bankops.llm.tokens import byte_symbols

MOST_PIECES = 2_000_000
CHUNK = 512

# character classes; letters that take part in contractions have their own
SPACE, LETTER, NUMBER, SIGN, QUOTE, CS, CT, CM, CD, CR, CE, CV, CL, INNER = range(14)
_LETTERS = dict(zip("stmdrevl", (CS, CT, CM, CD, CR, CE, CV, CL)))
# states: between pieces, in letters, after a number, in signs, after a quote that may begin a contraction (then with
# r, v or l), after a contraction
BETWEEN, LETTERS, NUMBERS, SIGNS, QUOTED, QUOTED_R, QUOTED_V, QUOTED_L, CONTRACTED = range(9)
STATES, CLASSES = 9, 14
HERE, BEFORE = 1, 2  # a piece begins at this byte; one began at the byte before


def transducer() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emission by class and state; classes from CLASSES on stand for the first byte of a row."""
    step, emit = np.zeros((2 * CLASSES, STATES), np.uint8), np.zeros((2 * CLASSES, STATES), np.uint8)
    letters = {LETTER, *_LETTERS.values()}
    for c in range(CLASSES):
        for s in range(STATES):
            if c == INNER:  # a byte within a character
                step[c, s] = s
                continue
            # the quote stood alone and its letter begins a run
            failed = s in (QUOTED_R, QUOTED_V, QUOTED_L)
            if failed and (s, c) in ((QUOTED_R, CE), (QUOTED_V, CE), (QUOTED_L, CL)):
                step[c, s] = CONTRACTED
            elif s == QUOTED and c in (CS, CT, CM, CD):
                step[c, s] = CONTRACTED
            elif s == QUOTED and c in (CR, CV, CL):
                step[c, s] = {CR: QUOTED_R, CV: QUOTED_V, CL: QUOTED_L}[c]
            elif c in letters:
                step[c, s], emit[c, s] = LETTERS, BEFORE if failed else 0 if s == LETTERS else HERE
            elif c in (SIGN, QUOTE) and s in (SIGNS, QUOTED):
                step[c, s] = SIGNS
            else:
                step[c, s] = {SPACE: BETWEEN, NUMBER: NUMBERS, SIGN: SIGNS, QUOTE: QUOTED}[c]
                emit[c, s] = (BEFORE if failed else 0) | (0 if c == SPACE else HERE)
    for c in range(CLASSES):  # the row before has ended
        step[CLASSES + c] = step[c, BETWEEN]
        emit[CLASSES + c] = emit[c, BETWEEN] | emit[SPACE] & BEFORE
    return step, emit


_STEP, _EMIT = transducer()
_ASCII = np.full(256, SIGN, np.uint8)
for _b in range(128):
    _ASCII[_b] = _LETTERS.get(chr(_b)) or (
        SPACE if chr(_b) in "\t\n\x0b\x0c\r " else LETTER if chr(_b).isalpha() else NUMBER if chr(_b).isdigit() else SIGN
    )
_ASCII[39] = QUOTE
_ASCII[0x80:0xC0] = INNER


UNKNOWN, BLOCK = 255, 256


class CodePoints:
    """The class of each code point, as the vocabulary's own splitting tells them apart, asked for 256 at a time when met.

    Between two letters, white space leaves a gap, a letter joins them, and of two equal numbers or signs numbers stand alone. The
    library's tables of characters may be newer or older than Python's.
    """

    def __init__(self, library: Tokenizer):
        self.split = library.pre_tokenizer.pre_tokenize_str
        self.table = np.full(0x110000, UNKNOWN, np.uint8)

    def learn(self, block: int) -> None:
        points = [c for c in range(block * BLOCK, (block + 1) * BLOCK) if not 0xD800 <= c < 0xE000]
        pieces = self.split("".join(f"x{chr(c)}{chr(c)}" for c in points) + "x")
        begins = np.zeros(3 * len(points) + 1, bool)
        covered = np.zeros(3 * len(points) + 1, bool)
        for _, (lo, hi) in pieces:
            begins[lo] = True
            covered[lo:hi] = True
        for i, c in enumerate(points):
            first = 3 * i + 1
            kind = SPACE if not covered[first] else LETTER if not begins[first] else NUMBER if begins[first + 1] else SIGN
            self.table[c] = kind

    def __getitem__(self, code: np.ndarray) -> np.ndarray:
        out = self.table[code]
        missing = out == UNKNOWN
        if missing.any():
            for block in np.unique(code[missing] // BLOCK):
                self.learn(int(block))
            out = self.table[code]
        return out


def classes(data: np.ndarray, offs: np.ndarray, points: CodePoints) -> np.ndarray:
    """The class of each byte of UTF-8 text; ``data`` is padded by 8."""
    body = data[:-8]
    out = _ASCII[body]
    lead = np.flatnonzero(body >= 0xC2)
    if len(lead):
        b0, b1, b2, b3 = (data[lead + k].astype(np.int32) for k in range(4))
        two, three = b0 < 0xE0, b0 < 0xF0
        code = np.where(
            two,
            (b0 & 0x1F) << 6 | b1 & 0x3F,
            np.where(
                three,
                (b0 & 0x0F) << 12 | (b1 & 0x3F) << 6 | b2 & 0x3F,
                (b0 & 0x07) << 18 | (b1 & 0x3F) << 12 | (b2 & 0x3F) << 6 | b3 & 0x3F,
            ),
        )
        out[lead] = points[code]
    first = offs[:-1][np.diff(offs) > 0]
    out[first] += CLASSES
    return out


def composed(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of maps (one a row): row i of the result applies maps 0 to i."""
    out, d = maps.copy(), 1
    while d < len(out):
        out[d:] = np.take_along_axis(out[d:], out[:-d].astype(np.int64), axis=1)
        d *= 2
    return out


def emissions(kinds: np.ndarray) -> np.ndarray:
    """What the transducer emits at each byte, and one more for the end."""
    n = len(kinds)
    rows = max(1, -(-n // CHUNK))
    padded = np.full(rows * CHUNK, INNER, np.uint8)
    padded[:n] = kinds
    steps = np.ascontiguousarray(padded.reshape(rows, CHUNK).T)
    state = np.tile(np.arange(STATES, dtype=np.uint8), (rows, 1))
    flat, flat_emit = _STEP.ravel(), _EMIT.ravel()
    for c in steps:
        state = flat[(c.astype(np.int16) * STATES)[:, None] + state]
    ends = composed(state)[:, BETWEEN]
    now = np.append(np.uint8(BETWEEN), ends[:-1])
    out = np.empty((CHUNK, rows), np.uint8)
    for k, c in enumerate(steps):
        at = c.astype(np.int16) * STATES + now
        out[k] = flat_emit[at]
        now = flat[at]
    return np.append(out.T.reshape(-1)[:n], _EMIT[SPACE, ends[-1]])


def piece_starts(data: np.ndarray, offs: np.ndarray, points: CodePoints) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of all rows."""
    kinds = classes(data, offs, points)
    if not len(kinds):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    said = emissions(kinds)
    first = (said[:-1] & HERE).astype(bool) | (said[1:] & BEFORE).astype(bool)
    starts = np.flatnonzero(first)
    # a piece ends where the next begins, or where white space or the row ends it
    inside = kinds % CLASSES != SPACE
    for _ in range(2):  # the bytes within a white space character
        inside[1:] &= inside[:-1] | (kinds[1:] != INNER)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    return starts, np.flatnonzero(last) + 1


@cache
def counting_tokenizer(name: str) -> "CountingTokenizer":
    return CountingTokenizer(name)


class CountingTokenizer:
    def __init__(self, name: str):
        path = public_tokenizers.path(name)
        self.library = Tokenizer.from_file(path)
        spec = json.load(open(path))
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))))
        self.symbols = byte_symbols()
        self.points = CodePoints(self.library)
        self._clear()

    def _clear(self) -> None:
        self.table, self.counts, self.n = HashTable(16), np.zeros(1 << 16, np.int32), 0

    def rows(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Token counts of the rows."""
        n = len(offs) - 1
        raw = data[:-8].tobytes()
        extra = np.zeros(n, np.int64)
        owner = np.arange(n)
        if raw.isascii() and b"<|" not in raw:
            padded = np.frombuffer(raw.lower() + bytes(8), np.uint8)
        else:
            parts, owner = [], []
            for r in range(n):
                text = raw[offs[r] : offs[r + 1]].decode()
                # special tokens are found before the text is normalized, and count as one each
                pieces = self.special.split(text) if "<|" in text else [text]
                extra[r] = len(pieces) - 1
                parts += [self.library.normalizer.normalize_str(p).encode() for p in pieces]
                owner += [r] * len(pieces)
            owner = np.array(owner)
            offs = np.append(0, np.cumsum([len(p) for p in parts]))
            padded = np.frombuffer(b"".join(parts) + bytes(8), np.uint8)
        starts, ends = piece_starts(padded, offs, self.points)
        emitted = self._emitted(padded, starts, ends)
        sums = np.bincount(rows_of(starts, offs), weights=emitted, minlength=len(offs) - 1)
        return extra + np.bincount(owner, weights=sums, minlength=n).astype(np.int64)

    def _emitted(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = hash_runs(data, starts, ends)
        index = self.table.find(h)
        missing = np.flatnonzero(index < 0)
        if len(missing):
            keys, pick = np.unique(h[missing], return_index=True)
            if self.n + len(keys) > MOST_PIECES and self.n:
                self._clear()
                return self._emitted(data, starts, ends)
            raw, at = data.tobytes(), missing[pick]
            found = [
                len(self.library.model.tokenize("".join([self.symbols[b] for b in raw[a:b]])))
                for a, b in zip(starts[at].tolist(), ends[at].tolist())
            ]
            n = self.n + len(keys)
            if n > len(self.counts):
                self.counts = np.append(self.counts[: self.n], np.zeros(2 * n, np.int32))
            self.counts[self.n : n] = found
            self.table.add(keys, np.arange(self.n, n, dtype=np.int32))
            self.n = n
            index[missing] = self.table.find(h[missing])
        return self.counts[index]


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = "word_bpe_49k.json",
    limit: int = 2048,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row, in one pass without a shuffle.

    A null text is an empty one with no tokens; a null id is kept; repeated rows give a row each; other columns are not read, whatever
    their names. A long text is counted whole, by one task. An empty table gives no rows.
    """
    fields = [T.StructField("doc_id", docs.schema[id_col].dataType)]
    fields += [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = counting_tokenizer(tokenizer)
        for batch in batches:
            for lo, hi, data, offs in text_slices(batch.column(1)):
                out = [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(offs)), pa.array(machine.rows(data, offs))]
                yield pa.RecordBatch.from_arrays(out, [f.name for f in fields])

    counted = docs.select(id_col, text_col).mapInArrow(count, T.StructType(fields))
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
