"""Filter audit, importance resampling and SimHash against brute force, over the awkward rows and forms of any size."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pytest
import xxhash

from bankops.llm import components, filter_audit, importance, simhash

SPACED = r"[^\x20\x09-\x0D]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(t):
    return (t or "").translate({i: i + 32 for i in range(65, 91)})


@pytest.fixture(scope="module")
def many(spark, texts):
    """The awkward rows, copies over and under the word limit, shouting, odd characters, nulls in any column."""
    prose = " ".join(f"w{i}" for i in range(230))
    more = [(400 + k, prose) for k in range(40)] + [(450, prose + " #"), (451, prose.upper()), (452, "a " * 300), (453, "É" * 3 + "A"), (454, prose)]
    more += [(None, prose), (None, None), (402, prose), (402, "other text of this id")]
    rows = [(i, t, [None, "en", "fr", ""][k % 4], k) for k, (i, t) in enumerate(texts + more)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, block int").repartition(5)


def brute_masks(rows):
    out = []
    for i, t, part, _ in rows:
        t = t or ""
        w = re.findall(SPACED, t)
        copy = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _, _ in rows)
        fails = (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search(r"[#$%&*|]", t)), copy)
        out.append((i, part or "", sum(1 << k for k, f in enumerate(fails) if f)))
    return out


@pytest.mark.parametrize("broadcast", [True, False])
def test_audit(spark, many, monkeypatch, broadcast):
    rows, docs = many
    if not broadcast:
        monkeypatch.setattr(filter_audit, "SKETCH_BYTES", -1)
    masks = brute_masks(rows)
    assert collections.Counter(map(tuple, filter_audit.flag(docs).collect())) == collections.Counter(masks)
    said = [(400, 1, 0), (401, 0, 1), (402, 1, 1), (402, 0, None), (0, None, 1), (None, 1, 1), (9999, 1, 1)]
    labels = spark.createDataFrame(said, "doc_id long, quality int, toxic int")
    good, toxic = ({i for i, *x in said if i is not None and x[k] == 1} for k in (0, 1))
    want, shapley = {}, collections.Counter()
    for part in {p for _, p, _ in masks}:
        here = [(i, m) for i, p, m in masks if p == part]
        for order in itertools.permutations("ABCDE"):
            alive = here
            for step, f in enumerate(order, 1):
                bit = 1 << "ABCDE".index(f)
                gone = [(i, m) for i, m in alive if m & bit]
                alive = [(i, m) for i, m in alive if not m & bit]
                fails = sum(m & bit > 0 for _, m in here)
                shapley[part, f] += len(gone)
                lost = [sum(i in s for i, _ in gone) for s in (good, toxic)]
                want[part, "".join(order), step] = (len(alive), len(gone), fails - len(gone), sum(m == bit for _, m in here), *lost)
    got = filter_audit.audit(docs, labels).collect()
    assert len(got) == len(want)
    for r in got:
        key = r.part, r.filter_order, r.step
        assert want[key] == (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost)
        assert r.shapley == shapley[r.part, r.filter_order[r.step - 1]]


def test_sketch_clears_unique_texts_only(spark):
    """A hash that stands twice always passes, wherever its copies are; most of those that stand once do not."""
    rng = np.random.default_rng(5)
    once, twice = rng.integers(-(2**63), 2**63 - 1, 20_000), rng.integers(-(2**63), 2**63 - 1, 500)
    frame = spark.createDataFrame([(int(x),) for x in [*once, *twice, *twice]], "h long").repartition(7)
    sketch, blocks = filter_audit.repeat_sketch(frame, 21_000)
    sketch = frame.distinct().withColumn("block", filter_audit.block_of(frame.h, blocks)).join(sketch, "block", "left")
    passed = {r.h for r in sketch.where(filter_audit.may_repeat(sketch.h, sketch.bits)).collect()}
    assert set(twice.tolist()) <= passed and len(passed) < 500 + 0.1 * len(once)


def brute_resample(rows, bench, max_words):
    def found(t):
        w = re.findall(WORD, lowered(t))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10_000 for n in range(1, max_words + 1) for i in range(len(w) - n + 1)]

    all_, target = [found(t) for _, t in rows], [found(t) for t in bench]
    s, t = (collections.Counter(b for _, x in y for b in x) for y in (all_, target))
    S, T = sum(s.values()), sum(t.values())
    out = []
    for (i, _), (n, x) in zip(rows, all_):
        gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in x]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, n])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for k, r in enumerate(able[: 10 * len(able) // 100], 1):
        r[4] = k
    return collections.Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize("max_words, head", [(1, 1 << 16), (1, 0), (2, 1 << 16), (3, 12)])
def test_importance(spark, many, monkeypatch, max_words, head):
    rows, docs = many
    monkeypatch.setattr(importance, "HEAD", max(head, 1))
    monkeypatch.setattr(importance, "PAIRS", 1 << 10)
    if not head:
        none = np.zeros(0, np.int64)
        monkeypatch.setattr(importance, "frequent", lambda *_: (none, none, None))
    bench = ["The River stone of light under", None, "", "w1 w2 w3 w4 morning7 paper8 " * 3, "été 日本 " + "long" * 40]
    target = spark.createDataFrame([(k, t) for k, t in enumerate(bench)], "item_id int, text string")
    got = importance.resample(docs, target, max_words=max_words).collect()
    assert collections.Counter(map(tuple, got)) == brute_resample([r[:2] for r in rows], bench, max_words)


def test_crc_of_runs_is_linear():
    rng = np.random.default_rng(6)
    for _ in range(50):
        a, b = (rng.integers(1, 256, int(n)).astype(np.uint8).tobytes() for n in rng.integers(0, 200, 2))
        data = np.frombuffer(a + b, np.uint8)
        one = importance.crc_states(int(importance.ONES), data, np.array([0]), np.array([len(a)]))
        two = importance.crc_states(0, data, np.array([len(a)]), np.array([len(a + b)]))
        assert int((importance.shifted(one, np.array([len(b)])) ^ two)[0]) ^ 0xFFFFFFFF == zlib.crc32(a + b)


def brute_print(t, words=4):
    w = re.findall(SPACED, lowered(t))
    grams = [" ".join(w[i : i + words]) for i in range(len(w) - words + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, bits=4):
    """Smallest id that each row reaches; rows meet by links of their prints and by equal ids."""
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    prints = np.array([p for _, p in rows], np.uint64)
    ids = np.array([-1 - k if i is None else i for k, (i, _) in enumerate(rows)])
    for k in range(len(rows)):
        for j in np.flatnonzero((np.bitwise_count(prints[:k] ^ prints[k]) <= bits) | (ids[:k] == ids[k])):
            up[root(int(j))] = root(k)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return [least.get(root(k)) for k in range(len(rows))]


def test_simhash(many):
    rows, docs = many
    prints = [(i, brute_print(t)) for i, t, *_ in rows]
    want = collections.Counter((i, f"{p:016x}", c) for (i, p), c in zip(prints, brute_components(prints)))
    assert collections.Counter(map(tuple, simhash.simhash_components(docs).collect())) == want


def test_simhash_chains_through_an_id(spark):
    texts = [" ".join(f"{x}{i}" for i in range(30)) for x in "abc"]
    rows = [(3, texts[0]), (5, texts[0]), (5, texts[1]), (9, texts[1]), (9, texts[2]), (11, texts[2]), (12, None), (13, " "), (None, texts[2])]
    got = simhash.simhash_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in got) == [(0, 3), (3, 3), (5, 3), (5, 3), (9, 3), (9, 3), (11, 3), (12, 12), (13, 12)]


def cloud(rng, far, near, chains):
    """Points of all kinds: spread out, clusters around centres, chains of small steps, ends of the scale."""
    out = set(rng.integers(0, 2**64, far, np.uint64).tolist()) | {0, 2**64 - 1, 15, 31}
    for centre in rng.integers(0, 2**64, 3, np.uint64).tolist():
        for _ in range(near):
            x = centre
            for b in rng.integers(0, 64, rng.integers(0, 7)).tolist():
                x ^= 1 << b
            out.add(x)
    for x in rng.integers(0, 2**64, chains, np.uint64).tolist():
        for _ in range(6):
            for b in rng.integers(0, 64, 4).tolist():
                x ^= 1 << b
            out.add(x)
    return np.array(sorted(out), np.uint64)


def same_groups(points, edges, bits):
    """Do the edges join just what chains of links join?"""
    signed, label = points.view(np.int64).tolist(), {}
    for k, c in enumerate(brute_components([(k, int(p)) for k, p in enumerate(points)], bits)):
        label.setdefault(c, []).append(signed[k])
    return all({edges.get(m, m) for m in members} == {min(members)} for members in label.values())


@pytest.mark.parametrize("shard_rows, bits", [(100_000, 4), (40, 4), (3, 4), (100_000, 5), (40, 3)])
def test_near_edges_find_every_link(spark, monkeypatch, shard_rows, bits):
    """Whole trees, many levels, shards in blocks, odd distances: components equal those of all pairs."""
    monkeypatch.setattr(simhash, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(simhash, "TASK_ENTRIES", 2000)
    points = cloud(np.random.default_rng(7), 300, 150, 20)
    frame = spark.createDataFrame([(int(x),) for x in points.view(np.int64)], "fp long").repartition(3)
    found = components.components(simhash.near_edges(frame, len(points), bits)).collect()
    assert same_groups(points, {r.node: r.component for r in found}, bits)


@pytest.mark.parametrize("direct, pairs", [(16, 1 << 22), (16, 64), (1 << 18, 64), (1, 1)])
def test_levels_and_hubs_find_every_link(monkeypatch, direct, pairs):
    """One half's tree over points that agree on the other half, cut down to its lowest levels."""
    monkeypatch.setattr(simhash, "DIRECT", direct)
    monkeypatch.setattr(simhash, "PAIRS", pairs)
    points = cloud(np.random.default_rng(8), 60, 120, 10) & np.uint64(0xFFFFFFFF)
    points = np.unique(points)
    d = simhash.distances(points, 0x123456789ABCDEF, 16)[0]
    edges, p = simhash.Edges(), points.view(np.int64)
    simhash.descend(p, d, np.full(len(p), 2, np.int8), p, d, 0, 2, edges)
    node, low = components.union_min(*edges.contracted())
    assert same_groups(points, dict(zip(node.tolist(), low.tolist())), 2)


def test_empty_tables_and_missing_texts(spark, many):
    _, docs = many
    none = docs.where("false")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(none, labels).count() == 0 and simhash.simhash_components(none).count() == 0
    assert importance.resample(none, none).count() == 0
    blank = spark.createDataFrame([(k, None, None) for k in range(30)], "doc_id long, text string, lang string")
    assert {r.mask for r in filter_audit.flag(blank).collect()} == {1, 17}
    assert {tuple(r)[1:3] for r in importance.resample(blank, blank).collect()} == {(0, 0)}
    assert {r.component_id for r in simhash.simhash_components(blank).collect()} == {0}
