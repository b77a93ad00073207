"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from itertools import permutations

from bankops.llm import filter_audit, importance, jaccard, quality

_WORDS = r"[^\x20\x09-\x0D]+"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# shingles of each row, pairs of rows that share one, links between ids, and what can be reached by links
JACCARD = rf"""
WITH RECURSIVE w AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS ws
    FROM documents),
p AS (SELECT rid, ws, unnest(range(1, greatest(len(ws) - {jaccard.WORDS} + 2, 2))) AS i FROM w WHERE len(ws) > 0),
s AS (SELECT DISTINCT rid, array_to_string(list_slice(ws, i, i + {jaccard.WORDS - 1}), ' ') AS gram FROM p),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
o AS (SELECT x.rid AS a, y.rid AS b, count(*) AS common FROM s x JOIN s y ON x.gram = y.gram AND x.rid < y.rid GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE 100 * common >= {jaccard.PERCENT} * (x.n + y.n - common)),
i AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM l JOIN w x ON x.rid = l.a JOIN w y ON y.rid = l.b WHERE x.doc_id <> y.doc_id),
e AS (SELECT a, b FROM i UNION SELECT b, a FROM i),
r AS (SELECT DISTINCT doc_id AS id, doc_id AS seen FROM documents WHERE doc_id IS NOT NULL UNION SELECT r.id, e.b FROM r JOIN e ON r.seen = e.a),
c AS (SELECT id, min(seen) AS component_id FROM r GROUP BY id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM w LEFT JOIN c ON c.id = w.doc_id LEFT JOIN n ON n.rid = w.rid"""

_EACH = " UNION ALL ".join(
    [f"SELECT rid, lang, source, base_failed, '{m}' AS measure, 1000.0::DOUBLE * {over} / nullif({under}, 0) AS x FROM f" for m, (over, under, _) in quality.MEASURES.items()]
    + [f"SELECT rid, lang, source, base_failed, '{c}', CAST({c} AS DOUBLE) FROM f" for c in quality.SIZES]
)


def _fences(keys: list[str]) -> str:
    """Rows and fences of each group, from the sketch's buckets."""
    by = "".join(f"{k}, " for k in keys)
    part = f"PARTITION BY {by}measure"
    at = lambda q, m, tag: f"min(CASE WHEN measure = '{m}' AND upto >= total * {q} THEN edge END) AS {m}_{tag}"
    found = [at(q, m, tag) for m in quality.MEASURES for q, tag in ((0.25, "low"), (0.75, "high"))] + [at(0.5, c, "half") for c in quality.SIZES]
    fence = [
        f"{m}_high + greatest({quality.SPREAD}::DOUBLE * ({m}_high - {m}_low), coalesce({1000.0 * few}::DOUBLE / nullif({under}_half, 0), 0.0)) AS {m}"
        for m, (_, under, few) in quality.MEASURES.items()
    ]
    return f"""SELECT {by}n, {", ".join(fence)} FROM (
        SELECT {by}max(total) AS n, {", ".join(found)}
        FROM (SELECT {by}measure, CASE WHEN bucket = 0 THEN CAST(0 AS DOUBLE) ELSE exp(bucket * growth) END AS edge,
                sum(n) OVER ({part} ORDER BY bucket NULLS FIRST ROWS UNBOUNDED PRECEDING) AS upto, sum(n) OVER ({part}) AS total
              FROM (SELECT {by}measure, bucket, growth, count(*) AS n FROM k GROUP BY ALL))
        {f"GROUP BY {', '.join(keys)}" if keys else ""})"""


def _blended(m: str) -> str:
    """A group's fence leans on its language's, and that on the one of all rows."""
    out = f"every.{m}"
    for of in ("by_lang", "own"):
        n = f"CASE WHEN {of}.{m} IS NULL THEN 0 ELSE {of}.n END"
        out = f"({n} * coalesce({of}.{m}, 0.0) + {quality.PRIOR} * {out}) / ({n} + {quality.PRIOR})"
    return out


QUALITY = rf"""
WITH w AS (
    SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS ws,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORDS}')) AS lines FROM documents),
g AS (SELECT rid, unnest(range(1, len(ws) - {quality.WINDOW} + 2)) AS i, ws FROM w WHERE len(ws) >= {quality.WINDOW}),
h AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, array_to_string(list_slice(ws, i, i + {quality.WINDOW - 1}), ' ')) AS times FROM g),
repeated AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + {quality.WINDOW})) AS j FROM h WHERE times > 1) GROUP BY rid),
c AS (
    SELECT w.rid, doc_id, lang, source, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
        len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
        len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_stutter
    FROM w LEFT JOIN repeated ON repeated.rid = w.rid),
f AS (SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words AS base_failed FROM c),
m AS ({_EACH}),
k AS (SELECT lang, source, measure, growth, CASE WHEN x < 1 THEN 0 ELSE CAST(floor(ln(x) / growth) AS BIGINT) + 1 END AS bucket
      FROM m, (SELECT CAST('{quality.GROWTH!r}' AS DOUBLE) AS growth) WHERE NOT base_failed),
own AS ({_fences(["lang", "source"])}),
by_lang AS ({_fences(["lang"])}),
every AS ({_fences([])}),
limits AS (
    SELECT own.lang, own.source, {", ".join(f"{_blended(m)} AS {m}" for m in quality.MEASURES)}
    FROM own JOIN by_lang ON by_lang.lang IS NOT DISTINCT FROM own.lang, every),
beyond AS (
    SELECT DISTINCT m.rid FROM m JOIN limits t ON t.lang IS NOT DISTINCT FROM m.lang AND t.source IS NOT DISTINCT FROM m.source
    WHERE m.x > CASE m.measure {" ".join(f"WHEN '{m}' THEN t.{m}" for m in quality.MEASURES)} END)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND beyond.rid IS NULL AS kept
FROM f LEFT JOIN beyond ON beyond.rid = f.rid"""


_ORDERS = " ".join(f"SELECT '{''.join(o)}' AS filter_order UNION ALL" for o in permutations(filter_audit.FILTERS)).removesuffix(" UNION ALL")
_BIT = lambda letters: "(" + " + ".join(f"CASE WHEN contains({letters}, '{x}') THEN {1 << i} ELSE 0 END" for i, x in enumerate(filter_audit.FILTERS)) + ")"

AUDIT = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_WORDS}') AS ws, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
m AS (
    SELECT part, doc_id, CASE WHEN len(ws) < {filter_audit.LEAST_WORDS} THEN 1 ELSE 0 END
        + CASE WHEN 100 * len(list_distinct(ws)) < {filter_audit.LEAST_DISTINCT} * len(ws) THEN 2 ELSE 0 END
        + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {filter_audit.MOST_UPPER} * length(t) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
        + CASE WHEN doc_id > first_id THEN 16 ELSE 0 END AS mask FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM m LEFT JOIN l ON l.doc_id = m.doc_id GROUP BY ALL),
o AS (SELECT filter_order, step, {_BIT("substr(filter_order, step, 1)")} AS bit, {_BIT("substr(filter_order, 1, step - 1)")} AS before
      FROM ({_ORDERS}), (SELECT CAST(unnest(range(1, {len(filter_audit.FILTERS) + 1})) AS INTEGER) AS step))
SELECT part, filter_order, step,
    CAST(sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
    CAST(sum(CASE WHEN mask & bit <> 0 THEN n * 120 // bit_count(mask) ELSE 0 END) AS BIGINT) AS shapley
FROM c, o GROUP BY part, filter_order, step"""

# CRC-32 of the distinct words, byte by byte
IMPORTANCE = rf"""
WITH step AS (
    SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
    FROM (SELECT unnest(range(256)) AS b)),
d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS ws
    FROM documents),
q AS (
    SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}')) AS w
    FROM benchmark),
v AS (SELECT DISTINCT w, hex(encode(w)) AS x FROM (SELECT unnest(ws) AS w FROM d UNION ALL SELECT w FROM q)),
k AS (
    SELECT w, xor(list_reduce(
        list_prepend(4294967295, list_transform(range(1, length(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT))),
        lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % {importance.BUCKETS} AS bucket
    FROM v, step),
s AS (SELECT bucket, count(*) AS n FROM (SELECT unnest(ws) AS w FROM d) JOIN k USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM q JOIN k USING (w) GROUP BY bucket),
g AS (
    SELECT b.bucket, CAST(floor(1000 * ln(
        CAST((coalesce(t.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM s) + {importance.BUCKETS}) AS DOUBLE)
        / CAST((coalesce(s.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM t) + {importance.BUCKETS}) AS DOUBLE))) AS BIGINT) AS gain
    FROM (SELECT unnest(range({importance.BUCKETS})) AS bucket) b LEFT JOIN s ON s.bucket = b.bucket LEFT JOIN t ON t.bucket = b.bucket),
r AS (SELECT row_number() OVER () AS rid, doc_id, ws FROM d),
m AS (
    SELECT rid, sum(gain) AS total FROM (SELECT rid, unnest(ws) AS w FROM r) JOIN k USING (w) JOIN g USING (bucket) GROUP BY rid),
e AS (
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features,
        CASE WHEN len(ws) = 0 THEN 0 ELSE CAST((total - ((total % len(ws)) + len(ws)) % len(ws)) // len(ws) AS BIGINT) END AS weight,
        CAST('0x' || substr(sha256('{importance.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
    FROM r LEFT JOIN m ON m.rid = r.rid),
f AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM e),
a AS (
    SELECT *, CASE WHEN n_features >= {importance.LEAST_WORDS} THEN
        row_number() OVER (PARTITION BY n_features >= {importance.LEAST_WORDS} ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) END AS rank,
        (SELECT count(*) FROM f WHERE n_features >= {importance.LEAST_WORDS}) * {importance.PERCENT} // 100 AS draw FROM f)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= draw THEN rank END AS rank FROM a"""
