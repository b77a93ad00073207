"""Each operator against a brute-force version on a small fixture with the awkward rows, and on an empty table."""

import collections
import hashlib
import itertools
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from bankops.llm import (
    binary_ids, decontamination, jaccard, language, licenses, packing, pii, quality, sharding, token_counts,
)

SPACED = r"[^\x20\x09-\x0D]+"


def lowered(t):
    return (t or "").translate({i: i + 32 for i in range(65, 91)})


def library(name, text):
    return Tokenizer.from_file(public_tokenizers.path(name)).encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoded(texts):
    words, bytes_ = (Tokenizer.from_file(public_tokenizers.path(n)) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
    ids = lambda t: [e.ids for e in t.encode_batch([x or "" for _, x in texts], add_special_tokens=False)]
    return ids(words), ids(bytes_)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_counts(docs, texts, encoded):
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs).collect())
    want = collections.Counter((i, len((t or "").encode()), len(x), len(x) > 2048) for (i, t), x in zip(texts, encoded[0]))
    assert got == want


def test_binary_ids(spark, docs, texts, encoded, tmp_path):
    binary_ids.write_ids(docs, str(tmp_path / "ids"))
    rows = sorted(binary_ids.read_ids(spark, str(tmp_path / "ids")).collect(), key=lambda r: r.start)
    want = collections.Counter((i, tuple(x + [2])) for (i, _), x in zip(texts, encoded[1]))
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in rows) == want
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), crc(r.ids))
        at += r.n_tokens
    known = [r.doc_id for r in rows if r.doc_id is not None]
    assert known == sorted(known) and rows[0].doc_id is None


def test_values_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 1000):
        v = (rng.integers(0, 2**32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        assert (binary_ids.decode_values(*binary_ids.encode_values(v), n) == v).all()


def test_packing(docs, texts, encoded):
    rows = packing.pack(docs, with_ids=True).collect()
    by = collections.defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) <= 2048 and r.ids_crc32 == crc(r.ids)
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(len(x) + 1 for x in encoded[0])
    assert sum(r.length for r in rows) == total and len(by) <= -(-total // 2048) + 1
    want = collections.Counter((i, len(x) + 1) for (i, _), x in zip(texts, encoded[0]))
    assert collections.Counter((r.doc_id, r.doc_tokens) for r in rows if r.start == 0) == want


def test_best_fill_is_the_best():
    rng = np.random.default_rng(2)
    for _ in range(20):
        items = rng.integers(1, 30, 8).tolist()
        chosen = packing.best_fill(dict(collections.Counter(items)), 40)
        sums = {max(items)}
        rest = sorted(items)[:-1]
        for x in rest:
            sums |= {s + x for s in sums}
        assert sum(k * n for k, n in chosen.items()) == max(s for s in sums if s <= 40)


def test_jaccard(docs, texts):
    sets = []
    for _, t in texts:
        w = re.findall(SPACED, lowered(t))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    up = {i: i for i, _ in texts}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, _) in enumerate(texts):
        for j in range(i):
            b = texts[j][0]
            if sets[i] and a is not None and b is not None and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    want = collections.Counter((i, len(s), None if i is None else root(i)) for (i, _), s in zip(texts, sets))
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect())
    assert got == want


def test_jaccard_meets_in_the_id(spark):
    """Links of all texts of an id count for all its rows; an id's empty row goes with its others; the SQL twin says the same."""
    import duckdb

    from bankops.llm import sql

    a, b, c = ("one two three four five six seven " * 2 + x for x in ("a", "b and more of it " * 9, "c or other words here " * 9))
    rows = [(3, a), (5, a), (5, b), (9, b), (9, c), (11, c), (9, None), (12, ""), (13, None), (5, b), (20, "w x y z " * 4), (20, "quite other words " * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = collections.Counter(map(tuple, jaccard.jaccard_components(docs).collect()))
    assert {(i, x) for i, _, x in got} == {(3, 3), (5, 3), (9, 3), (11, 3), (12, 12), (13, 13), (20, 20)}
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    assert collections.Counter((i, n, x) for i, n, x in con.execute(sql.JACCARD).fetchall()) == got


def test_jaccard_large_groups(spark, monkeypatch):
    """Groups beyond a block, n-grams shown by more classes than a limit: the same components."""
    for name, value in (("BLOCK_ROWS", 80), ("MOST_SHOWN_BY", 6), ("FREQUENT", 8)):
        monkeypatch.setattr(jaccard, name, value)
    base = [f"w{i}" for i in range(60)]
    rows = [(k, " ".join(base[: 58 - k % 7] + [f"x{k}"])) for k in range(150)]
    rows += [(1000 + k, " ".join(base[:30] + [f"y{k}_{i}" for i in range(30)])) for k in range(100)]
    # a chain over many sizes, each linked with its neighbours only
    rows += [(2000 + k, " ".join(f"z{i}" for i in range(20 + int(16 * 1.2**k)))) for k in range(18)]
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[2000 + k] == 2000 for k in range(18))
    assert all(got[k] == 0 for k in range(150)) and all(got[k] == k for k in range(1000, 1100))


def test_components_over_many_tasks(spark):
    """Nodes and their smallest ones in different tasks: what joins two components reaches all nodes of both."""
    from bankops.llm.components import components

    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        # stars around their middle nodes, chained by their last members, in no order; a node alone
        edges = [(100 * s + 50, 100 * s + k) for s in range(1, 30) for k in range(40, 60)] + [(100 * s + 59, 100 * s + 159) for s in range(1, 29) if s % 10]
        rows = spark.createDataFrame([*edges, (7, 7), (None, 3)], "a long, b long").repartition(11)
        got = sorted(map(tuple, components(rows).collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = [(7, 7)] + [(100 * s + k, 100 * (1 if s <= 10 else 11 if s <= 20 else 21) + 40) for s in range(1, 30) for k in range(40, 60)]
    assert got == sorted(want)


def test_jaccard_shared_passages(spark, monkeypatch):
    """A passage that many strangers share, in one row of any batch, and n-grams of common words: no pairs, no large group."""
    import random

    rng = random.Random(5)
    names = iter(range(10**6))
    fresh = lambda n: [f"w{next(names)}" for _ in range(n)]
    passages = [fresh(12) for _ in range(6)]
    # strangers with two passages each, so that these connect them all, and a run of common words
    rows = [(k, " ".join(fresh(20) + passages[k % 6] + fresh(20) + "of the to and in a is it".split() + passages[(k + 1) % 6])) for k in range(300)]
    rows += [(1000 + k, rows[k][1] + " end") for k in range(20)]
    rng.shuffle(rows)
    made = []
    components = jaccard.components
    monkeypatch.setattr(jaccard, "components", lambda edges: made.append(edges.count()) or components(edges))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()}
    finally:
        spark.conf.set(key, old)
    assert got == {i: i % 1000 for i in got} and len(got) == 320
    assert made[0] == 20


def test_quality(docs, texts):
    want = collections.Counter()
    for i, t in texts:
        t = t or ""
        w, seen, dup = re.findall(SPACED, t), set(), 0
        for line in t.split("\n"):
            if re.search(SPACED, line):
                dup += line in seen
                seen.add(line)
        n = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        hit = {k + d for k in range(len(w) - 7) if n[tuple(w[k : k + 8])] > 1 for d in range(8)}
        want[(i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w))] += 1
    rows = quality.quality_rules(docs).collect()
    assert collections.Counter(tuple(r)[:7] for r in rows) == want
    assert not any(r.kept and r.base_failed for r in rows) and any(r.kept for r in rows)


def test_decontamination(spark, docs, texts):
    long = texts[[i for i, _ in texts].index(304)][1].split(" ")
    edited = long[500:540]
    edited[7], edited[20] = "other", "else"
    items = [(1, " ".join(long[100:130]).upper()), (2, " ".join(edited)), (3, None), (4, ""), (5, "one two"), (6, "nothing like this is in any of the texts at all")]
    bench = spark.createDataFrame(items, "item_id int, text string")
    rows = decontamination.find_leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(304, 1), (304, 2)}
    first = next(r for r in rows if r.item_id == 1)
    assert (first.start_word, first.end_word, first.score) == (100, 130, 1.0)
    left = decontamination.decontaminate(docs, bench)
    assert left.columns == docs.columns and left.count() == len(texts) - 1


def test_decontamination_of_common_and_short_items(spark):
    """Edited items in many copies, edits at every third word, words put in between, items of fewer than four words."""
    item = [f"q{i}" for i in range(40)]
    edited = " ".join("edit" if i % 5 == 4 else w for i, w in enumerate(item))
    dense = " ".join("edit" if i % 3 == 2 else w for i, w in enumerate(item[:39]))
    wide = " ".join(w + " more" for w in item)
    rows = [(k, f"some words before {edited} and behind") for k in range(250)]
    rows += [(300, f"a {dense} b"), (301, wide), (302, "then Rare Thing came"), (303, "rare but no thing"), (304, " ".join(item[:15]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "rare thing")], "item_id int, text string")
    got = {(r.doc_id, r.item_id): r for r in decontamination.find_leaks(docs, bench).collect()}
    assert set(got) == {(k, 1) for k in [*range(250), 300, 301]} | {(302, 2)}
    assert got[0, 1].score == (2 * 32 - 8 + 1) / 80 and got[0, 1].start_word == 3
    assert sorted(r.doc_id for r in decontamination.decontaminate(docs, bench).collect()) == [303, 304]


def enumerated(scores, first, initial, trans):
    """Posteriors by the sum over all paths of labels of each sequence."""
    out, cuts = np.zeros(scores.shape), [*np.flatnonzero(first), len(scores)]
    for lo, hi in zip(cuts, cuts[1:]):
        for path in itertools.product(range(scores.shape[1]), repeat=hi - lo):
            w = initial[path[0]] + sum(trans[x, y] for x, y in zip(path, path[1:])) + sum(scores[lo + k, y] for k, y in enumerate(path))
            out[np.arange(lo, hi), path] += np.exp(w)
    return out / out.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("cuts", [[0], [0, 1], [0, 3], [0, 2, 5], [0, 1, 2, 3]])
def test_posteriors_equal_all_paths(cuts):
    rng = np.random.default_rng(9)
    for n in range(1, 11):
        scores, initial, trans = rng.normal(0, 2, (n, 3)), rng.normal(0, 1, 3), rng.normal(0, 1, (3, 3))
        first = np.isin(np.arange(n), cuts)
        assert np.abs(language.marginals(scores, first, initial, trans)[0] - enumerated(scores, first, initial, trans)).max() < 1e-9


def test_language_of_long_texts_and_parts(spark):
    """A language that stands only in long texts, and one with a single row, are learned; switching texts come apart by words."""
    en, de, fr = "the of and stone river light".split(), "der und nicht fluss haus licht".split(), "le et pas rivière maison lumière".split()
    rng = np.random.default_rng(10)
    made = lambda words, n: " ".join(rng.choice(words, n))
    rows = [(k, made((en, de)[k % 2], 30), ("en", "de")[k % 2]) for k in range(120)]
    rows += [(200 + k, made(fr, 6000), "fr") for k in range(12)] + [(1, made("uno dos tres casa luz rio".split(), 200), "es")]
    mixed = made(en, 12) + " " + made(fr, 12) + ". " + made(de, 12)
    rows += [(300, mixed, None), (301, None, "en"), (302, "12 + 3", None), (303, "casa rio luz tres", None)]
    from bankops.llm.registry import ship

    ship(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = {r.doc_id: r for r in language.identify(docs, spans=True).collect()}
    assert all(got[k].lang_pred == lang for k, _, lang in rows[:132] if k != 1) and got[303].lang_pred == "es"
    assert got[301].spans == [] and got[302].spans == []
    parts = got[300].spans
    assert [p.lang for p in parts] == ["en", "fr", "de"] and all(0 <= p.score <= 1 for p in parts)
    assert [set(mixed[p.start : p.end].replace(".", "").split()) <= set(w) for p, w in zip(parts, (en, fr, de))] == [True] * 3
    # neither partitions nor other rows in the batch change a row's result
    again = {r.doc_id: r for r in language.identify(docs.coalesce(1), spans=True).collect()}
    assert all(again[k].lang_pred == r.lang_pred and abs(again[k].score - r.score) < 1e-6 for k, r in got.items())


def test_language(spark):
    a, b = "the of and stone river light".split(), "der und nicht fluss haus licht".split()
    rows = [(k, " ".join((a, b)[k % 2][(k + j * j) % 6] for j in range(30)), ("en", "de")[k % 2]) for k in range(200)]
    rows += [(500, None, None), (501, "123 ?!", "en"), (502, "", "de")]
    from bankops.llm.registry import ship

    ship(spark)
    got = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[k].lang_pred == lang for k, _, lang in rows[:200]) and all(got[k].lang_pred == "und" for k in (500, 501, 502))
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2) and 0 <= r.score <= 1 for k, r in got.items())


def test_language_of_long_runs(spark):
    """All characters of a text without spaces are in words of a bounded size, and its middle decides its language."""
    from bankops.llm.registry import ship
    from bankops.llm.text import text_slices

    rng = np.random.default_rng(4)
    zh, ja = "的一是不了人我在有他这中大来上国", "のにはをたがでてとしれさあいうえ"
    made = lambda letters, n: "".join(rng.choice(list(letters), n))
    texts = [made(zh, 999), "y" * 500, "x日本語です、テスト。", "é" * 200, "", "ภาษาไทย𠀀𠀁"]
    (_, _, data, offs), = text_slices(__import__("pyarrow").array(texts))
    body, a, b, row = language.words_of(data, offs)
    pieces = [body[i:j].tobytes().decode() for i, j in zip(a, b)]
    assert max(j - i for i, j in zip(a, b)) <= language.PIECE_BYTES + 3
    for r, t in enumerate(texts):
        assert "".join(p for p, q in zip(pieces, row) if q == r) == t.replace("、", "").replace("。", "")
    rows = [(k, made((zh, ja)[k % 2], 60), ("zh", "ja")[k % 2]) for k in range(200)]
    rows += [(1000 + k, made(zh, 20) + made(ja, 900) + made(zh, 20), None) for k in range(4)]
    ship(spark)
    got = {r.doc_id: r.lang_pred for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[k] == lang for k, _, lang in rows[:200]) and all(got[1000 + k] == "ja" for k in range(4))


def test_sharding(spark, docs, texts, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "s"), bucket_bytes=1 << 14)
    rows = sharding.digest(spark, str(tmp_path / "s")).collect()
    want = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 16) and 0 <= r.shard < 16
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    back = sharding.read_shards(spark, str(tmp_path / "s")).select("row.*")
    assert back.columns == docs.columns and back.count() == len(texts)


def test_licenses(docs, texts):
    rows = {}
    for r in licenses.license_scan(docs).collect():
        rows.setdefault(r.doc_id, []).append(r)
    r = max(rows[309], key=lambda x: x.n_words)
    assert (r.n_base, r.first_word, r.last_word, r.base_labels) == (3, 3, 14, "apache,gpl,mit")
    assert "apache-2.0" in r.labels.split(",") and r.score == 0.95
    words = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    assert collections.Counter(len(re.findall(words, lowered(t))) for _, t in texts) == collections.Counter(x.n_words for y in rows.values() for x in y)


PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def test_base_places_of_licenses(spark, texts):
    """Every place of a base phrase, wherever words end, against a search of the word lists."""
    rng = np.random.default_rng(14)
    bits = "MIT mit license License apache general public GNU é under -- , \n 's mit-license apache_license licenses 7".split(" ") + [" ", "\t", "the"]
    made = [rng.choice([" ", "  ", "-", "\n"]).join(rng.choice(bits, int(rng.integers(0, 25)))) for _ in range(800)]
    rows = [(k, t) for k, t in enumerate([*(t for _, t in texts), *made, "mit license " * 3000])]
    for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id int, text string").repartition(3)).collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(rows[r.doc_id][1]))
        at = [(i, label) for phrase, label in PHRASES.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
        starts = [i for i, _ in at]
        want = (len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at})))
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want, rows[r.doc_id]
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_repeated_rows_are_scanned_alike(spark, docs):
    """A doubled table gives every row of the result twice."""
    docs = docs.where("doc_id > 50")
    twice = docs.union(docs).repartition(5)
    for f in (licenses.license_scan, pii.pii_report, token_counts.count_tokens):
        once = collections.Counter(tuple(r) for r in f(docs).collect())
        assert collections.Counter(tuple(r) for r in f(twice).collect()) == collections.Counter({k: 2 * n for k, n in once.items()})


def test_counts_equal_the_library_on_every_character(spark):
    """All code points, alone and between letters and numbers, and texts that mix them."""
    library_ = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    points = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"{x} a{x}a 1{x}1 {x}{x}" for x in points[i : i + 40]) for i in range(0, len(points), 40)]
    rng = np.random.default_rng(15)
    near = [*"abcXYZ019 '.,-\n\té§٣", "'s", "'LL", "Σ", "İ", "ß", "中文", "한국", "\u0301", "\u200d", "\ua7cb", "\ua7dc", "<|endoftext|>", "<|", "→"]
    texts += ["".join(rng.choice(near, int(rng.integers(0, 60)))) for _ in range(20_000)]
    want = [len(e.ids) for e in library_.encode_batch(texts, add_special_tokens=False)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4)
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(rows).collect()}
    wrong = [(k, texts[k][:60]) for k, n in enumerate(want) if got[k] != n]
    assert not wrong, (len(wrong), wrong[:5])


def shortest(pattern):
    """Texts of every way through a pattern's alternatives, optional parts left out."""
    import re._parser as parser

    def texts(nodes):
        out = [""]
        for kind, value in nodes:
            name = str(kind)
            if name == "LITERAL":
                here = [chr(value)]
            elif name == "IN":
                here = [chr(v) for k, v in value if str(k) == "LITERAL"] or [chr(value[0][1][0])]
            elif name == "BRANCH":
                here = [t for branch in value[1] for t in texts(branch)]
            elif name == "MAX_REPEAT":
                here = [t * value[0] for t in texts(value[2])]
            else:
                here = texts(value[3])
            out = [a + b for a in out for b in dict.fromkeys(here)]
        return out

    return texts(parser.parse(pattern))


def test_license_keywords(spark):
    """Each way through a rule's pattern holds both keywords and a root, so no gate drops a name that a rule lists."""
    for keyword, second, pattern, label, _ in licenses.rules():
        for text in shortest(pattern):
            assert keyword in text and second in text and any(x in text for x in licenses.ROOTS), (label, text)
    names = [("cc0-1.0", "Creative Commons Zero 1.0"), ("wtfpl", "do what the fuck you want to public license"), ("mit", "Expat License")]
    rows = [(k, f"{before} {name} here") for k, (_, name) in enumerate(names) for before in ("this is", "released under the")]
    for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id int, text string")).collect():
        assert r.labels == names[r.doc_id][0]


def test_pii(docs, texts):
    rows = [r for r in pii.pii_report(docs).collect() if r.doc_id == 308]
    text = dict(texts)[308]
    at = lambda x: (text.index(x), text.index(x) + len(x))
    spans = [("email", "ann.b@mail.example.com"), ("ip", "10.0.0.255"), ("card", "4539578763621486"), ("phone", "+1 (555) 123-4567")]
    line = ",".join(f"{k}:{at(x)[0]}:{at(x)[1]}" for k, x in spans)
    assert [(r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows] == [(1, 1, 1, 1, hashlib.sha256(line.encode()).hexdigest())]
    assert set(line.split(",")) <= set(rows[0].spans.split(","))


def test_pii_forms_alone(spark):
    """Each generator proposes its form in a text with nothing else that a generator asks for; written-out addresses go."""
    forms = [
        ("email", "Please write to ann [at] mail.org today"), ("email", "write to ann (at) mail.org"), ("email", "PLEASE WRITE TO ANN AT MAIL DOT COM"), ("email", "ANN [AT] mail.org"),
        ("phone", "555-123-4567"), ("phone", "(555) 123.4567"), ("phone", "555.123.4567"), ("ip", "a:b:c:d:e:f:a:b"), ("card", "1234.5678.1234.5678"),
        ("iban", "DE44500105175407324931"), ("ssn", "123-12-1234"), ("secret", "password = abcdefgh"), ("secret", "abcdef" * 6),
    ]
    rows = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(forms)], "doc_id long, text string")
    found = {r.doc_id: {c.kind for c in r.c} for r in rows.select("doc_id", pii.candidates(rows.text).alias("c")).collect()}
    assert [t for k, (kind, t) in enumerate(forms) if kind not in found[k]] == []
    spans = {r.doc_id: r.spans for r in pii.pii_report(rows).collect()}
    assert [forms[k][1] for k in range(4) if "email:" not in spans[k]] == []


CONTRACT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(map(int, reversed(number)))) % 10 == 0


def contract_spans(text):
    out = []
    for kind, pattern in CONTRACT.items():
        for m in re.finditer(pattern, text, re.ASCII):
            number = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda number=number: 16 <= len(number) <= 19 and luhn(number),
                "phone": lambda number=number: 8 <= len(number) <= 15,
            }[kind]()
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans_equal_the_contract(spark, texts):
    """The linear patterns against the plain ones, on the awkward rows and on texts made of the pieces that patterns turn on."""
    rng = np.random.default_rng(12)
    bits = ["a", "é", "@", ".", "-", "+", "1", "22", "255", "256", "4539578763621486", " ", "(", ")", "_", "%", "x.y", "10.0.0.1", "+1 555", "\n", "𝒳", "007"]
    made = ["".join(rng.choice(bits, int(rng.integers(1, 30)))) for _ in range(1500)]
    rows = [(k, t) for k, t in enumerate([*(t for _, t in texts), *made, "x" * 300 + "@" + "y." * 200 + "z", "9" * 5000, "+1" + "2 " * 3000 + "3"])]
    got = pii.pii_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in got:
        want = contract_spans(rows[r.doc_id][1] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), rows[r.doc_id]
        assert set(want) <= set(filter(None, r.spans.split(",")))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(x.startswith(k + ":") for x in want) for k in CONTRACT)


def test_secrets_go_whole(spark):
    """No character of a long secret is left, whatever its length and case."""
    hexes = "0123456789abcdef" * 40
    secrets = [(f"set token = {hexes[:n]} there", hexes[:n]) for n in (40, 200, 201, 400, 640)]
    secrets += [(f"the secret key {x} here", x) for n in (32, 64, 65, 128, 600) for x in (hexes[:n], hexes[:n].upper())]
    rows = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(secrets)], "doc_id long, text string")
    found = pii.find_pii(rows, {"doc_id": "doc_id"})
    for r in found.select("doc_id", pii.redacted(found["_text"], found["spans"]).alias("text")).collect():
        text, secret = secrets[r.doc_id]
        assert not any(secret[i : i + 8] in r.text for i in range(0, len(secret) - 7)), (text[:60], r.text)


def test_empty_tables(spark, docs, tmp_path):
    none = docs.where("false")
    for f in (token_counts.count_tokens, packing.pack, jaccard.jaccard_components, quality.quality_rules, language.identify, licenses.license_scan, pii.pii_report):
        assert f(none).count() == 0, f
    binary_ids.write_ids(none, str(tmp_path / "ids"))
    assert binary_ids.read_ids(spark, str(tmp_path / "ids")).count() == 0
    sharding.write_shards(none, str(tmp_path / "s"))
    bench = spark.createDataFrame([(1, "one two three four five")], "item_id int, text string")
    assert decontamination.find_leaks(none, bench).count() == 0 and decontamination.find_leaks(docs, bench.where("false")).count() == 0
