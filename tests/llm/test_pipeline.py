"""Each stage of the corpus pipeline against brute force over its own input: nulls, empty texts, repeated rows, clashing names."""

import collections
import math
import random
import re
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as pipeline
from bankops.llm import decontamination, pii, quality

SPACED = r"[^\x20\x09-\x0D]+"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _text_hash string, row string, rows int, key int, kept boolean"


def lowered(t):
    return (t or "").translate({i: i + 32 for i in range(65, 91)})


@pytest.fixture(scope="module")
def rows(texts):
    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choice("stone river light under copper window garden letter".split()) + str(rng.randrange(40)) for _ in range(n))
    more = [(500 + k, prose(60 + k)) for k in range(80)]
    more += [(600, more[0][1]), (601, more[0][1] + " tail"), (602, more[1][1] + " # " * 60), (603, "same line here again\n" * 30), (604, None), (604, "")]
    more += [(605, more[2][1]), (605, more[3][1]), (605, more[3][1]), (None, more[4][1]), (606, more[5][1] + " write to ann@mail.org or +49 30 1234567")]
    more += [(607, prose(30) + " rare items stand in this very passage that leaked from the test set today " + prose(30))]
    out = []
    for k, (i, t) in enumerate(texts + more):
        out.append((i, t, [None, "en", "fr"][k % 3], f"s{k % 2}" if k % 5 else None, len(t or ""), f"h{k % 4}", "r", k, 1, None))
    return out + [out[3], out[70]]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS).repartition(4)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    items = [(1, "Rare items stand in this very passage that leaked from the test set"), (2, None), (3, ""), (4, "nothing of this kind stands anywhere in the texts")]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path)


def same(got, want):
    key = lambda rs: collections.Counter(tuple(r) for r in rs)
    assert key(got) == key(want)


def brute_counts(t):
    w, seen, dup, lines = re.findall(SPACED, t), set(), 0, 0
    for line in t.split("\n"):
        if re.search(SPACED, line):
            lines += 1
            dup += line in seen
            seen.add(line)
    n = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    hit = {k + d for k in range(len(w) - 7) if n[tuple(w[k : k + 8])] > 1 for d in range(8)}
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)), "n_upper": len(re.findall("[A-Z]", t)),
        "n_dup_lines": dup, "n_lines": lines, "n_repeat_words": len(hit), "n_stutter": sum(a == b for a, b in zip(w, w[1:])),
    }


def brute_kept(rows):
    """The quality verdicts by sorted values instead of merged sketches: values rounded up to their buckets' edges."""
    edge = lambda x: 0.0 if x < 1 else math.exp((math.floor(math.log(x) / quality.GROWTH) + 1) * quality.GROWTH)
    counts = [brute_counts(r[1] or "") for r in rows]
    failed = [c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"] for c in counts]
    value = lambda c, m: 1000 * c[quality.MEASURES[m][0]] / c[quality.MEASURES[m][1]] if c[quality.MEASURES[m][1]] else None

    def quantile(values, q):
        held = sorted(map(edge, values))
        return held[math.ceil(q * len(held)) - 1]

    def fence(group, m):
        mine = [c for c, f, r in zip(counts, failed, rows) if not f and group(r)]
        x = [v for v in (value(c, m) for c in mine) if v is not None]
        low, high = quantile(x, 0.25), quantile(x, 0.75)
        half = quantile([c[quality.MEASURES[m][1]] for c in mine], 0.5)
        return len(mine), high + max(quality.SPREAD * (high - low), 1000 * quality.MEASURES[m][2] / half)

    out = []
    for c, f, r in zip(counts, failed, rows):
        keep = not f
        for m in quality.MEASURES if keep else []:
            limit = fence(lambda x: True, m)[1]
            for group in (lambda x: x[2] == r[2], lambda x: x[2:4] == r[2:4]):  # noqa: B023
                n, own = fence(group, m)
                limit = (n * own + quality.PRIOR * limit) / (n + quality.PRIOR)
            keep &= value(c, m) is None or value(c, m) <= limit
        out.append(keep)
    return out


def test_drop_poor(spark, rows, frame):
    kept = brute_kept(rows)
    got = pipeline.drop_poor(spark, frame, "").collect()
    same(got, [r for r, k in zip(rows, kept) if k])
    assert not any(r[0] in (602, 603) for r in got) and sum(kept) > 80


def brute_first(rows):
    sets = []
    for r in rows:
        w = re.findall(SPACED, lowered(r[1]))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    up = {r[0]: r[0] for r in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, r in enumerate(rows):
        for j in range(i):
            a, b = r[0], rows[j][0]
            if sets[i] and a is not None and b is not None and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {i for i in up if i is not None and root(i) == i}


def test_drop_copies(spark, rows, frame):
    first = brute_first(rows)
    got = pipeline.drop_copies(spark, frame, "")
    assert got.columns == frame.columns
    got = [tuple(r) for r in got.collect()]
    texts = collections.Counter((r[0], r[1]) for r in got if r[0] is not None)
    assert texts == collections.Counter({(r[0], r[1]) for r in rows if r[0] in first})
    assert set(got) <= set(rows)
    same([r for r in got if r[0] is None], [r for r in rows if r[0] is None])
    again = [tuple(r) for r in pipeline.drop_copies(spark, frame.coalesce(1), "").collect()]
    same(again, got)  # which row of equal ids and texts stays does not depend on partitions


def test_drop_copies_chains_over_many_tasks(spark):
    """Long chains of near copies whose links lie in many tasks: one document of each stays, with all its columns."""
    rng = random.Random(8)
    words = [f"w{rng.randrange(10**9)}" for _ in range(4000)]
    # neighbours share 50 of 62 n-grams, so 100 x 50 / 62 = 80; the next but one share 44 of 68
    rows = [(s, " ".join(words[400 * c + 6 * s : 400 * c + 6 * s + 60])) for c in range(10) for s in range(40)]
    ids = list(range(1, 1 + len(rows)))
    rng.shuffle(ids)
    docs = spark.createDataFrame([(i, t, s) for i, (s, t) in zip(ids, rows)], "doc_id long, text string, n int").repartition(7)
    held = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "13"}
    old = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got = sorted(r["doc_id"] for r in pipeline.drop_copies(spark, docs, "").collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == sorted(min(ids[40 * c : 40 * c + 40]) for c in range(10))


def alignment(item, text):
    """The best local score of two word lists."""
    best, before = 0, [0] * (len(text) + 1)
    for x in item:
        now = [0]
        for j, y in enumerate(text):
            now.append(max(0, before[j] + (2 if x == y else -1), before[j + 1] - 1, now[j] - 1))
        best, before = max(best, *now), now
    return best


WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")


def test_all_pairs_of_items_and_texts(spark, rows):
    """Seeds lose no hit: every pair of an item and a text is aligned in full by brute force."""
    rng = np.random.default_rng(13)
    short = [(k, r[1]) for k, r in enumerate(rows) if r[1] and len(r[1]) < 3000][:110]
    items = []
    for k in range(24):  # pieces of texts, with words put in, left out, changed and doubled
        w = WORD.findall(short[int(rng.integers(len(short)))][1])
        at = int(rng.integers(max(1, len(w) - 30)))
        piece = [x for x in w[at : at + int(rng.integers(1, 40))]]
        for _ in range(int(rng.integers(0, 1 + len(piece) // 3))):
            j = int(rng.integers(len(piece)))
            piece[j : j + int(rng.integers(0, 2))] = [["other"], [], [piece[j]] * 2][int(rng.integers(3))] if len(piece) > 1 else piece
        items.append((k, " ".join(piece).title()))
    docs = spark.createDataFrame(short, "doc_id int, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id int, text string")
    got = {(r.doc_id, r.item_id): r for r in decontamination.find_leaks(docs, bench).collect()}
    want = {}
    for i, t in short:
        w = WORD.findall(lowered(t))
        for k, item in items:
            x = WORD.findall(lowered(item))
            score = alignment(x, w) if set(x) & set(w) else 0
            if x and score >= max(math.ceil(len(x) * 2 * decontamination.LEAST_SCORE), 2 * min(len(x), decontamination.WHOLE_WORDS)):
                want[i, k] = score / (2 * len(x))
    assert {k: r.score for k, r in got.items()} == want and len(want) > 24
    for (i, k), r in got.items():
        w = WORD.findall(lowered(dict(short)[i]))[r.start_word : r.end_word]
        x = WORD.findall(lowered(items[k][1]))
        assert alignment(x, w) / (2 * len(x)) == r.score


def test_drop_leaks(spark, rows, frame, folder):
    got = pipeline.drop_leaks(spark, frame, folder)
    assert got.columns == frame.columns
    same(got.collect(), [r for r in rows if r[0] != 607])


def test_redact(spark, rows, frame):
    got = pipeline.redact(spark, frame, "")
    assert got.columns == frame.columns
    report = {r.doc_id: r.spans for r in pii.pii_report(spark.createDataFrame([(k, r[1]) for k, r in enumerate(rows)], "doc_id long, text string")).collect()}
    want = []
    for k, r in enumerate(rows):
        text, out, at = r[1], "", 0
        for kind, lo, hi in sorted((x.split(":") for x in report[k].split(",") if x), key=lambda x: (int(x[1]), int(x[2]))):
            if int(lo) >= at:
                out += text[at : int(lo)] + f"[{kind.upper()}]"
            at = max(at, int(hi))
        new = out + text[at:] if report[k] else text
        want.append((r[0], new, *r[2:4], len(new) if report[k] else r[4], *r[5:]))
    same(got.collect(), want)
    assert [r.text for r in got.where("doc_id = 606").collect()][0].endswith("write to [EMAIL] or [PHONE]")
    few = frame.select("text", "doc_id")  # reads nothing else
    same(pipeline.redact(spark, few, "").collect(), [(w[1], w[0]) for w in want])


def test_pack(spark, rows, frame):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    size = collections.Counter((r[0], len(library.encode(r[1] or "", add_special_tokens=False).ids) + 1) for r in rows)
    pieces = pipeline.pack(spark, frame, "").collect()
    assert collections.Counter((p.doc_id, p.doc_tokens) for p in pieces if p.start == 0) == size
    assert sum(p.length for p in pieces) == sum(n * k for (_, n), k in size.items())


def test_empty_and_whole_run(spark, frame, folder):
    none = frame.where("false")
    for _, stage in pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0
    docs = frame
    for _, stage in pipeline.STAGES[:-1]:
        before = docs.count()
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), COLUMNS)
        assert docs.columns == frame.columns and 0 < docs.count() <= before
    assert pipeline.STAGES[-1][1](spark, docs, folder).count() > 0
