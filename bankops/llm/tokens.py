"""Token ids of whole texts, each distinct piece of text encoded once per task process.

The library needs 15 to 20 microseconds for a call on one word. A text is cut where no token can span (white space, a
letter beside ASCII punctuation), pieces are looked up by hash, and only pieces not met before go to the library. The ids
are those the library gives for the whole text; tests compare them.
"""

from __future__ import annotations

import json
import re
from functools import cache

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from bankops.llm.text import LETTER, LOWERED, SPACE, HashTable, hash_runs, inner_starts, rows_of, runs, spread, table

MOST_PIECES = 2_000_000  # the table starts anew beyond this, so a task's memory is bounded
_PUNCT = table(bytes(b for b in range(33, 127) if not chr(b).isalnum() and b != 39))
# white space outside ASCII
BLANKS = "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_ODD = re.compile(rf"<\||[{BLANKS}]")


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if visible, else from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    shown = set(seen)
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


_SYMBOLS = byte_symbols()
_TO_SYMBOL = {b: s for b, s in enumerate(_SYMBOLS)}


@cache
def piece_encoder(name: str) -> "PieceEncoder":
    """One encoder for each vocabulary file and process."""
    return PieceEncoder(name)


def latin_letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Does a letter of ASCII or Latin-1 start, or end, at each byte; and where are lead bytes C3."""
    lead = np.flatnonzero(data[:-8] == 0xC3)
    tail = data[lead + 1]
    good = (tail != 0x97) & (tail != 0xB7)
    starts, ends = LETTER[data[:-8]], LETTER[data[:-8]]
    starts[lead], ends[lead + 1] = good, good
    return starts, ends, lead


class PieceEncoder:
    def __init__(self, name: str):
        path = public_tokenizers.path(name)
        self.library = Tokenizer.from_file(path)
        self.words = json.load(open(path))["model"]["end_of_word_suffix"] is not None
        self.model = self.library.model
        self._clear()

    def _clear(self) -> None:
        self.table = HashTable(16)
        self.flat = np.zeros(1 << 16, np.uint32)
        self.at = np.zeros(1 << 16, np.int64)
        self.length = np.zeros(1 << 16, np.int64)
        self.n = self.used = 0

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and the number of ids of each row."""
        whole = self._whole(data, offs)
        starts, ends, folded = self._pieces(data, offs, plain=not whole)
        row = rows_of(starts, offs)
        if whole and not self.words:  # rows that the cuts do not cover go to the library as they are
            keep = ~np.isin(row, list(whole))
            starts, ends, row = starts[keep], ends[keep], row[keep]
        index = self._index(folded, starts, ends)
        sizes = self.length[index]
        ids = self.flat[spread(self.at[index], sizes)]
        counts = np.bincount(row, weights=sizes, minlength=len(offs) - 1).astype(np.int64)
        if whole and not self.words:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for r in whole:
                text = data[offs[r] : offs[r + 1]].tobytes().decode()
                parts[r] = np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
                counts[r] = len(parts[r])
            ids = np.concatenate(parts)
        return ids, counts

    def _whole(self, data: np.ndarray, offs: np.ndarray) -> set[int]:
        """Rows with a special token's mark or white space outside ASCII."""
        lead = data[:-8]
        if not ((lead == 0x7C) | (lead == 0xC2) | ((lead >= 0xE1) & (lead <= 0xE3))).any():
            return set()
        text = data[:-8].tobytes()
        return {r for r in range(len(offs) - 1) if _ODD.search(text[offs[r] : offs[r + 1]].decode())}

    def _pieces(self, data: np.ndarray, offs: np.ndarray, plain: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        body = data[:-8]
        space = SPACE[body]
        cut = np.zeros(len(body), bool)
        first_letter, last_letter, lead = latin_letters(data)
        punct = _PUNCT[body]
        if plain or not self.words:
            cut[1:] = (last_letter[:-1] & punct[1:]) | (punct[:-1] & first_letter[1:])
        if self.words:
            folded = data
            if plain:
                folded = LOWERED[data]
                tail = data[lead + 1]
                upper = (tail >= 0x80) & (tail <= 0x9E) & (tail != 0x97)
                folded[lead[upper] + 1] += 32
            return *runs(~space, offs, cut), folded
        # the last white space before a word is that word's if it is a blank, else a piece of its own
        edge = np.zeros(len(body) + 1, bool)
        edge[offs[:-1]] = True
        edge[-1] = True
        cut[1:] |= space[1:] & ~space[:-1]
        cut[:-1] |= space[:-1] & ~space[1:] & ~edge[1:-1]
        cut[1:] |= ~space[1:] & space[:-1] & (body[:-1] != 0x20)
        return *runs(np.ones(len(body), bool), offs, cut), data

    def _index(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = hash_runs(data, starts, ends)
        index = self.table.find(h)
        missing = np.flatnonzero(index < 0)
        if len(missing):
            keys, pick = np.unique(h[missing], return_index=True)
            if self.n + len(keys) > MOST_PIECES and self.n:
                self._clear()
                return self._index(data, starts, ends)
            at = missing[pick]
            raw = data.tobytes()
            self._learn(keys, [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            index[missing] = self.table.find(h[missing])
        return index

    def _learn(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        found: list[list[int] | None] = [None] * len(pieces)
        rest = []
        for i, p in enumerate(pieces):
            word = p.decode()
            bare = word if self.words else word.removeprefix(" ")
            if bare.isalpha() and (bare.isascii() or max(bare) < "Ā") and not (self.words and bare != bare.lower()):
                shown = word if word.isascii() and self.words else "".join([_SYMBOLS[b] for b in p])
                found[i] = [t.id for t in self.model.tokenize(shown)]
            else:
                rest.append((i, word))
        for (i, _), e in zip(rest, self.library.encode_batch([w for _, w in rest], add_special_tokens=False)):
            found[i] = e.ids
        sizes = np.array([len(x) for x in found], np.int64)
        ids = np.fromiter((t for x in found for t in x), np.uint32, int(sizes.sum()))
        n, used = self.n + len(keys), self.used + len(ids)
        for name, size in (("flat", used), ("at", n), ("length", n)):
            old = getattr(self, name)
            if size > len(old):
                new = np.zeros(2 * size, old.dtype)
                new[: len(old)] = old
                setattr(self, name, new)
        self.flat[self.used : used] = ids
        self.at[self.n : n] = self.used + np.cumsum(sizes) - sizes
        self.length[self.n : n] = sizes
        self.table.add(keys, np.arange(self.n, n, dtype=np.int32))
        self.n, self.used = n, used
