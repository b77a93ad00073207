"""Language of words and documents by a linear-chain conditional random field.

Features of a word are its affixes, character n-grams, and what a lexicon made from other training documents says of it; weights
and the transitions between the languages of neighbouring words are learned together, on sequences that switch language.
Words of a text are labelled by forward-backward; a document takes the language with the largest mean posterior.

Forward-backward runs over all words of a slice side by side: the words are cut into rows of equal length, each row's product of
transition matrices is made step by step for all rows at once, the products are carried from row to row, and the messages
inside the rows follow. A document's first word has a matrix that forgets what came before.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankops.llm.text import LETTER, LOWERED, U, HashTable, hash_runs, rows_of, runs, spread, table, text_slices
from bankops.llm.tokens import latin_letters

TRAIN_DOCS = 2000  # bound of the training sample, in documents
TRAIN_CHARS = 20_000  # longest piece of a text in it
MOST_LANGUAGES = 500
FEATURES = 1 << 15
SEQUENCES, SEQUENCE_WORDS, SPAN_WORDS = 3000, 64, 16
ROUNDS, BATCH, RATE, RIDGE = 4, 200, 0.5, 1e-5
MOST_WORDS = 1_000_000
UNKNOWN = "und"
PIECE_CHARS, PIECE_BYTES = 4, 64  # of a word in scripts without spaces, of any other long word
_IN_WORD = LETTER | table(bytes(range(128, 256)))
# first and last characters: punctuation outside ASCII, and scripts that set no spaces between words
MARKS = [(0x2000, 0x200A), (0x2010, 0x206F), (0x3000, 0x3004), (0x3008, 0x3030), (0xFE30, 0xFE4F), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65)]
SPACELESS = [(0xE00, 0xFFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF)]


def _pieces(body: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes are in words, and where a word is cut before its end so that long ones are consecutive pieces."""
    inside, cut = _IN_WORD[body[:-8]], np.zeros(len(body) - 8, bool)
    at = np.flatnonzero(body[:-8] >= 0xE0)
    if len(at):
        a, b, c, d = (body[at + k].astype(np.int64) for k in range(4))
        three = (a & 15) << 12 | (b & 63) << 6 | c & 63
        code = np.where(a < 0xF0, three, (a & 7) << 18 | (b & 63) << 12 | (c & 63) << 6 | d & 63)
        size = np.where(a < 0xF0, 3, 4)
        among = lambda ranges: np.any([(code >= lo) & (code <= hi) for lo, hi in ranges], axis=0)
        mark = at[among(MARKS)]
        for k in range(3):
            inside[mark + k] = False
        chosen = among(SPACELESS)
        at, end = at[chosen], (at + size)[chosen]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != end[:-1]) | np.isin(at[1:], offs)
        first = np.flatnonzero(new)
        place = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        cut[at[place % PIECE_CHARS == 0]] = True
        cut[end[end < len(cut)]] |= ~np.isin(end[end < len(cut)], at)
    starts, ends = runs(inside, offs, cut)
    long = np.flatnonzero(ends - starts > PIECE_BYTES)
    times = (ends[long] - starts[long] - 1) // PIECE_BYTES
    more = np.repeat(starts[long], times) + PIECE_BYTES * (1 + spread(np.zeros(len(long), np.int64), times))
    for _ in range(3):  # to where a character begins
        more[(body[more] & 0xC0) == 0x80] += 1
    cut[more[more < np.repeat(ends[long], times)]] = True
    return inside, cut


def words_of(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, starts, ends and rows of the words: runs of ASCII letters and characters outside ASCII.

    Punctuation outside ASCII ends a word; a long word, or one of a script without spaces, is cut into pieces.
    """
    body = LOWERED[data]
    lead = latin_letters(data)[2]
    tail = data[lead + 1]
    upper = (tail >= 0x80) & (tail <= 0x9E) & (tail != 0x97)
    body[lead[upper] + 1] += 32
    inside, cut = _pieces(body, offs)
    starts, ends = runs(inside, offs, cut)
    return body, starts, ends, rows_of(starts, offs)


def word_features(word: bytes, lexicon: dict[bytes, int]) -> list[int]:
    """Hashed features of one word."""
    w = b"<" + word + b">"
    named = [b"p" + w[:k] for k in (2, 3, 4)] + [b"s" + w[-k:] for k in (2, 3, 4)]
    named += [w[i : i + 2] for i in range(len(w) - 1)] + [w[i : i + 3] for i in range(len(w) - 2)]
    named.append(b"l%d" % lexicon.get(word, -1))
    return [zlib.crc32(x) % FEATURES for x in named]


def marginals(scores: np.ndarray, first: np.ndarray, initial: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, ...]:
    """Posteriors of the labels of each word (forward-backward), and the forward and backward messages.

    ``scores``: words by labels; ``first`` marks the first word of each sequence; ``initial`` and ``trans`` are logarithms.
    """
    n, labels = scores.shape
    width = max(1, int(n**0.5))
    rows = -(-n // width)
    e = np.ones((rows * width, labels))
    e[:n] = np.exp(scores - scores.max(axis=1, keepdims=True))
    new = np.ones(rows * width, bool)  # padding starts sequences of its own, so the last one ends where it ends
    new[:n] = first
    e, new = e.reshape(rows, width, labels).transpose(1, 0, 2).copy(), new.reshape(rows, width).T.copy()
    pi, a = np.exp(initial), np.exp(trans)

    def forward(m: np.ndarray, k: int) -> np.ndarray:
        out = m @ a
        x = new[k]
        if x.any():
            out[x] = m[x].sum(axis=-1, keepdims=True) * pi
        return out * (e[k] if m.ndim == 2 else e[k][:, None, :])

    product = np.tile(np.eye(labels), (rows, 1, 1))
    for k in range(width):
        product = forward(product, k)
        product /= product.max(axis=(1, 2), keepdims=True)
    left, right = np.empty((rows, labels)), np.empty((rows, labels))
    now = pi / pi.sum()
    for r in range(rows):
        left[r] = now
        now = now @ product[r]
        now = now / now.sum()
    now = np.ones(labels)
    for r in range(rows - 1, -1, -1):
        right[r] = now
        now = product[r] @ now
        now = now / now.sum()
    alpha, beta = np.empty_like(e), np.empty_like(e)
    now = left
    for k in range(width):
        now = forward(now, k)
        now /= now.sum(axis=1, keepdims=True)
        alpha[k] = now
    now = right
    for k in range(width - 1, -1, -1):
        beta[k] = now
        back = e[k] * now
        now = back @ a.T
        x = new[k]
        if x.any():
            now[x] = 1.0
        now /= now.sum(axis=1, keepdims=True)
    alpha = alpha.transpose(1, 0, 2).reshape(-1, labels)[:n]
    beta = beta.transpose(1, 0, 2).reshape(-1, labels)[:n]
    post = alpha * beta
    return post / post.sum(axis=1, keepdims=True), alpha, beta


class Model:
    """Weights, transitions, lexicon and labels; pickled to the tasks (about 10 MB at most)."""

    def __init__(self, labels: list[str], weights: np.ndarray, initial: np.ndarray, trans: np.ndarray, lexicon: dict):
        self.labels, self.weights, self.initial, self.trans, self.lexicon = labels, weights, initial, trans, lexicon
        self.key = uuid.uuid4().hex

    def scores(self, words: list[bytes]) -> np.ndarray:
        found = [word_features(w, self.lexicon) for w in words]
        size = np.array([len(x) for x in found], np.int64)
        flat = np.fromiter((i for x in found for i in x), np.int64, int(size.sum()))
        return np.add.reduceat(self.weights[flat], np.cumsum(size) - size) if len(found) else np.zeros((0, len(self.labels)))


def fit(texts: list[str], langs: list[str], seed: int = 7) -> Model:
    """Fit on labelled texts: of each language every second one for the lexicon, the others for weights and transitions.

    A language's only text serves for both. Sequences draw the language of each span first, then a text, so rare languages are learned
    like frequent ones (adaptive gradient).
    """
    labels = sorted(set(langs))
    code, rng = {x: i for i, x in enumerate(labels)}, np.random.default_rng(seed)
    held: list[tuple[list[bytes], int]] = []
    for text, lang in zip(texts, langs):
        (_, _, data, offs), = text_slices(pa.array([text]), 1 << 40)
        body, a, b, _ = words_of(data, offs)
        raw = body.tobytes()
        held.append(([raw[i:j] for i, j in zip(a.tolist(), b.tolist())], code[lang]))
    counts: dict[bytes, np.ndarray] = {}
    by_label = [[words for words, y in held if y == k and words] for k in range(len(labels))]
    for y, words in ((y, words) for y, of in enumerate(by_label) for words in of[::2]):
        for w in words:
            counts.setdefault(w, np.zeros(len(labels)))[y] += 1
    # what the lexicon says: the language, and how sure it is
    lexicon = {w: int(c.argmax()) * 4 + min(3, int(np.log2(c.max()))) + 1000 * int(c.max() < 0.9 * c.sum()) for w, c in counts.items() if c.sum() > 1}
    pool = [(of[1::2] or of, y) for y, of in enumerate(by_label) if of]
    if not pool:
        return Model(labels, np.zeros((FEATURES, len(labels)), np.float32), np.zeros(len(labels)), np.zeros((len(labels),) * 2), lexicon)
    number: dict[bytes, int] = {}
    seqs, ys = np.zeros((SEQUENCES, SEQUENCE_WORDS), np.int64), np.zeros((SEQUENCES, SEQUENCE_WORDS), np.int64)
    for s in range(SEQUENCES):
        k = 0
        while k < SEQUENCE_WORDS:  # spans of several documents: text that switches language
            of, y = pool[rng.integers(len(pool))]
            words = of[rng.integers(len(of))]
            at = rng.integers(max(1, len(words) - SPAN_WORDS))
            for w in words[at : at + SPAN_WORDS][: SEQUENCE_WORDS - k]:
                seqs[s, k], ys[s, k] = number.setdefault(w, len(number)), y
                k += 1
    found = [word_features(w, lexicon) for w in number]
    size = np.array([len(x) for x in found])
    flat, start = np.array([i for x in found for i in x]), np.cumsum(size) - size
    n_labels = len(labels)
    weights, trans, initial = np.zeros((FEATURES, n_labels)), np.zeros((n_labels,) * 2), np.zeros(n_labels)
    seen_w, seen_t, seen_i = np.full(weights.shape, 1e-3), np.full(trans.shape, 1e-3), np.full(n_labels, 1e-3)
    first = np.zeros(BATCH * SEQUENCE_WORDS, bool)
    first[::SEQUENCE_WORDS] = True
    for _ in range(ROUNDS):
        order = rng.permutation(SEQUENCES)
        for lo in range(0, SEQUENCES - BATCH + 1, BATCH):
            x, y = seqs[order[lo : lo + BATCH]].ravel(), ys[order[lo : lo + BATCH]].ravel()
            word, index = np.unique(x, return_inverse=True)
            feats = np.concatenate([flat[start[w] : start[w] + size[w]] for w in word])
            score = np.add.reduceat(weights[feats], np.cumsum(size[word]) - size[word])
            post, alpha, beta = marginals(score[index], first, initial, trans)
            truth = np.zeros_like(post)
            truth[np.arange(len(y)), y] = 1
            by_word = np.zeros((len(word), n_labels))
            np.add.at(by_word, index, truth - post)
            by_feature = np.repeat(by_word, size[word], axis=0)
            grad = np.stack([np.bincount(feats, by_feature[:, k], FEATURES) for k in range(n_labels)], axis=1)
            # expected transitions from the messages on both sides
            inner = np.flatnonzero(~first)
            e = np.exp(score[index] - score[index].max(axis=1, keepdims=True))
            pair = alpha[inner - 1][:, :, None] * np.exp(trans) * (e[inner] * beta[inner])[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            real = np.zeros((n_labels, n_labels))
            np.add.at(real, (y[inner - 1], y[inner]), 1)
            for value, g, seen in (
                (weights, grad / BATCH - RIDGE * weights, seen_w),
                (trans, (real - pair.sum(axis=0)) / BATCH, seen_t),
                (initial, (truth - post)[first].sum(axis=0) / BATCH, seen_i),
            ):
                seen += g * g
                value += RATE * g / np.sqrt(seen) * 0.2
    return Model(labels, weights.astype(np.float32), initial, trans, lexicon)


def learn(docs: DataFrame, id_col: str, text_col: str, lang_col: str, most_docs: int = TRAIN_DOCS) -> Model:
    """Fit on a sample of the rows with a language and a text, spread evenly over languages.

    Each language gives its ``most_docs / languages`` rows of the smallest hashes of id and text, so every language is learned, and the
    sample does not depend on partitions. Of a text over ``TRAIN_CHARS`` it takes a piece of that length from a place that the hash
    names. More than ``MOST_LANGUAGES`` languages are an error.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).agg(F.count("*")).limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not counts:
        return Model([], np.zeros((FEATURES, 0), np.float32), np.zeros(0), np.zeros((0, 0)), {})
    each = max(2, most_docs // len(counts))
    # hashes up to a share that holds twice as many rows as are taken; a language of few rows gives all to the ranking
    share = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, 1.0 if n < 100 * each else 2 * each / n)))
    hashed = rows.withColumn("_h", F.xxhash64(F.col(id_col).cast("string"), text_col))
    picked = hashed.where(F.shiftrightunsigned("_h", 11).cast("double") <= share[F.col(lang_col)] * F.lit(2.0**53))
    spare = F.greatest(F.length(text_col) - TRAIN_CHARS, F.lit(0))
    piece = F.substr(F.col(text_col), (F.pmod("_h", spare + 1) + 1).cast("int"), F.lit(TRAIN_CHARS))
    picked = picked.select("_h", F.col(lang_col).alias("lang"), piece.alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("_h", "text"))
    sample = picked.withColumn("_place", place).where(F.col("_place") <= each).select("_h", "lang", "text").collect()
    sample.sort(key=lambda r: (r[1], r[0], r[2]))
    return fit([r[2] for r in sample], [r[1] for r in sample])


_known: dict[str, tuple[HashTable, list]] = {}


def _labelled(model: Model, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Posteriors of the words of a slice, the words' rows, starts and ends; scores of words met before are kept in the process."""
    body, starts, ends, row = words_of(data, offs)
    if model.key not in _known:
        _known.clear()
    found, held = _known.setdefault(model.key, (HashTable(16), [np.zeros((0, len(model.labels)), np.float32)]))
    h = hash_runs(body, starts, ends)
    index = found.find(h)
    missing = np.flatnonzero(index < 0)
    if len(missing):
        keys, pick = np.unique(h[missing], return_index=True)
        if found.n and found.n + len(keys) > MOST_WORDS:
            _known.clear()
            return _labelled(model, data, offs)
        raw, at = body.tobytes(), missing[pick]
        new = model.scores([raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
        n = found.n
        if n + len(keys) > len(held[0]):
            held[0] = np.concatenate([held[0][:n], np.zeros((2 * (n + len(keys)), held[0].shape[1]), np.float32)])
        held[0][n : n + len(keys)] = new
        found.add(keys, np.arange(n, n + len(keys), dtype=np.int32))
        index[missing] = found.find(h[missing])
    first = np.ones(len(row), bool)
    first[1:] = row[1:] != row[:-1]
    return marginals(held[0][index].astype(np.float64), first, model.initial, model.trans)[0], row, starts, ends


def _spans(post: np.ndarray, row: np.ndarray, starts: np.ndarray, ends: np.ndarray, data: np.ndarray, offs: np.ndarray, names: np.ndarray, lettered: np.ndarray) -> pa.Array:
    """Of each row the runs of consecutive words of one language: start, end (code points), lang, score."""
    best = post.argmax(axis=1) if len(row) else np.zeros(0, np.int64)
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (best[1:] != best[:-1])
    edge = np.flatnonzero(new)
    size = np.diff(np.append(edge, len(row)))
    mean = np.add.reduceat(post[np.arange(len(row)), best], edge) / size if len(edge) else np.zeros(0)
    keep = lettered[row[edge]] if len(edge) else np.zeros(0, bool)
    edge, size, mean = edge[keep], size[keep], mean[keep]
    points = np.append(0, np.cumsum((data[:-8] & 0xC0) != 0x80))
    at = lambda x: pa.array((points[x] - points[offs[row[edge]]]).astype(np.int32))
    each = pa.StructArray.from_arrays(
        [at(starts[edge]), at(ends[edge + size - 1]), pa.array(names[best[edge]], pa.string()), pa.array(np.clip(mean, 0, 1))],
        ["start", "end", "lang", "score"],
    )
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row[edge], np.arange(len(offs))).astype(np.int32)), each)


def predict(docs: DataFrame, model: Model, keep: dict[str, str], text_col: str = "text", spans: bool = False) -> DataFrame:
    """The columns ``keep`` (new name: column), lang_pred and score of every row; reads nothing but the text to predict.

    With ``spans`` also the runs of words of one language, as array<struct<start, end, lang, score>> in code points, end
    exclusive, score the words' mean posterior: the parts of a text that switches language. A text without letters has none.
    """
    fields = [T.StructField(new, docs.schema[old].dataType) for new, old in keep.items()]
    fields += [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    if spans:
        span = [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())]
        fields.append(T.StructField("spans", T.ArrayType(T.StructType(span))))
    n_labels = len(model.labels)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.labels, UNKNOWN], object)
        for batch in batches:
            for lo, hi, data, offs in text_slices(batch.column(0)):
                best, score = np.full(hi - lo, n_labels), np.zeros(hi - lo)
                ascii_letters = np.append(0, np.cumsum(LETTER[data[:-8]], dtype=np.int64))
                lettered = ascii_letters[offs[1:]] > ascii_letters[offs[:-1]]
                for r in np.flatnonzero(~lettered & (offs[1:] > offs[:-1])):
                    lettered[r] = any(c.isalpha() for c in data[offs[r] : offs[r + 1]].tobytes().decode())
                none = np.zeros(0, np.int64)
                post, row, starts, ends = np.zeros((0, n_labels)), none, none, none
                if n_labels and lettered.any():
                    post, row, starts, ends = _labelled(model, data, offs)
                    total = np.stack([np.bincount(row, post[:, k], hi - lo) for k in range(n_labels)], axis=1)
                    share = total / np.maximum(total.sum(axis=1, keepdims=True), 1e-12)
                    best[lettered] = share.argmax(axis=1)[lettered]
                    score[lettered] = np.clip(share.max(axis=1)[lettered], 0, 1)
                rest = [batch.column(k + 1).slice(lo, hi - lo) for k in range(len(keep))]
                out = [*rest, pa.array(names[best], pa.string()), pa.array(score)]
                if spans:
                    out.append(_spans(post, row, starts, ends, data, offs, names, lettered))
                yield pa.RecordBatch.from_arrays(out, [f.name for f in fields])

    rows = docs.select(text_col, *(F.col(old).alias(new) for new, old in keep.items()))
    return rows.mapInArrow(label, T.StructType(fields))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", spans: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, and with ``spans`` the parts of its text by language (see ``predict``).

    Learns from rows whose crc32 of the id (as text) mod 4 is not 2; a null id counts as held out. A text that is null or has no
    letter is ``und`` with score 0 and no parts; so is every text when no row has a language. Repeated rows are predicted each, and
    equal texts alike. Long texts are read whole. Other columns are not read. An empty table gives no rows.
    """
    held_out = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(True))
    model = learn(docs.where(~held_out), id_col, text_col, lang_col)
    out = predict(docs, model, {"doc_id": id_col}, text_col, spans)
    again = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))
    return out.select("doc_id", again.alias("held_out"), "lang_pred", "score", *(["spans"] if spans else []))
