"""Quality rules with thresholds that adapt to each language and source.

Measures of each text are made in one pass. Their distribution in each (language, source) is kept as a mergeable quantile
sketch: counts of logarithmic buckets, a few hundred at most for a measure, so partial sketches add up in any order to the
same result, and a quantile is right within 2 percent. A language's sketch is the sum of its groups', that of all rows the sum of the
languages'.

A measure's fence stands above its upper quartile by ``SPREAD`` times the quartiles' distance, or, where most texts show nothing and the
quartiles lie together, by what a few events are in a text of the group's median size. Both come from the group's own sketch. A group's fence
is blended with its language's, and that with the one of all rows, by numbers of documents, so small groups lean on larger ones.
Thresholds are joined to the documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankops.llm.text import SPACE, hash_runs, rows_of, runs, table, text_slices, window_hashes
from bankops.session import stored

WINDOW = 8
SYMBOLS = table(b"#*$%&|<>")
# fixed base rules
LEAST_WORDS, MOST_REPEATED = 20, 30
# the method's own
GROWTH = math.log(1.02)
PRIOR = 200  # documents that the wider group's fence counts for
SPREAD = 6.0  # fences stand above the upper quartile by so many times the quartiles' distance
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# measure: (counted, among, counted units that are few in a text); in thousandths
MEASURES = {
    "symbol_share": ("n_symbols", "n_words", 8),
    "word_length": ("word_chars", "n_words", 0),
    "upper_share": ("n_upper", "word_chars", 20),
    "dup_line_share": ("n_dup_lines", "n_lines", 3),
    "repeat_share": ("n_repeat_words", "n_words", 6 * WINDOW),
    "stutter_share": ("n_stutter", "n_words", 8),
}
SIZES = ["n_words", "word_chars", "n_lines"]


def counts(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each row's text."""
    body, n = data[:-8], len(offs) - 1
    first = offs[:-1]

    def total(flags: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(flags, dtype=np.int64))
        return sums[offs[1:]] - sums[first]

    space = SPACE[body]
    starts, ends = runs(~space, offs)
    row = rows_of(starts, offs)
    out = {"n_words": np.bincount(row, minlength=n)}
    out["word_chars"] = total(~space & ((body & 0xC0) != 0x80))
    out["n_symbols"] = total(SYMBOLS[body])
    out["n_upper"] = total((body >= 65) & (body <= 90))

    # lines with a word, equal to an earlier one of their row
    a, b = runs(body != 10, offs)
    if len(a):
        words_before = np.append(0, np.cumsum(~space, dtype=np.int64))
        full = words_before[b] > words_before[a]
        a, b = a[full], b[full]
    line_row = rows_of(a, offs)
    h = hash_runs(data, a, b)
    order = np.lexsort((h, line_row))
    same = np.zeros(len(h), bool)
    same[1:] = (h[order][1:] == h[order][:-1]) & (line_row[order][1:] == line_row[order][:-1])
    out["n_dup_lines"] = np.bincount(line_row[order][same], minlength=n)
    out["n_lines"] = np.bincount(line_row, minlength=n)

    # words equal to the one before
    h = hash_runs(data, starts, ends)
    stutter = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    out["n_stutter"] = np.bincount(row[1:][stutter], minlength=n)

    # words that lie in a window found twice or more in their row
    w, at = window_hashes(h, row, WINDOW)
    owner = row[at]
    order = np.argsort(w)
    order = order[np.argsort(owner[order].astype(np.uint16 if n < 65536 else np.int64), kind="stable")]
    equal = np.zeros(len(w) + 1, bool)
    equal[1:-1] = (w[order][1:] == w[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = at[order[equal[1:] | equal[:-1]]]
    step = np.zeros(len(row) + 1, np.int64)
    np.add.at(step, twice, 1)
    np.add.at(step, twice + WINDOW, -1)
    covered = np.cumsum(step)[:-1] > 0
    out["n_repeat_words"] = np.bincount(row[covered], minlength=n)
    return out


def _measured(columns: list[str]):
    names = ["n_words", "word_chars", "n_symbols", "n_upper", "n_dup_lines", "n_lines", "n_repeat_words", "n_stutter"]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in text_slices(batch.column(0)):
                found = counts(data, offs)
                rest = [batch.column(k + 1).slice(lo, hi - lo) for k in range(len(columns))]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(found[x].astype(np.int64)) for x in names), *rest], [*names, *columns]
                )

    return measured, names


def measure(docs: DataFrame, keep: dict[str, str], text_col: str = "text") -> DataFrame:
    """The counts of every row beside the columns ``keep`` (new name: column of ``docs``)."""
    columns = list(keep)
    measured, names = _measured(columns)
    fields = [T.StructField(x, T.LongType()) for x in names]
    fields += [T.StructField(new, docs.schema[old].dataType) for new, old in keep.items()]
    rows = docs.select(text_col, *(F.col(old).alias(new) for new, old in keep.items()))
    return rows.mapInArrow(measured, T.StructType(fields))


def _bucket(value: Column) -> Column:
    return F.when(value < 1, 0).otherwise(F.floor(F.log(value) / GROWTH) + 1).cast("int")


def _value(name: str) -> Column:
    over, under, _ = MEASURES[name]
    return F.try_divide(1000.0 * F.col(over), F.col(under))


def _measures(rows: DataFrame) -> DataFrame:
    """A row for each document and measure or size: group columns, name, bucket; documents that the base rules reject are not counted."""
    values = {m: _value(m) for m in MEASURES} | {c: F.col(c).cast("double") for c in SIZES}
    named = [F.struct(F.lit(name).alias("measure"), _bucket(value).alias("bucket")) for name, value in values.items()]
    return rows.where("not base_failed").select("lang", "source", F.explode(F.array(*named)).alias("m")).select("lang", "source", "m.*")


def sketches(rows: DataFrame) -> DataFrame:
    """lang, source, measure, bucket, n: the mergeable sketch of every group. Buckets are counted in each task first."""
    return _measures(rows).groupBy("lang", "source", "measure", "bucket").agg(F.count("*").alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """For each group: its rows, and of each measure the fence and ``{measure}_spread``: did the quartiles' distance decide it?

    The window holds one group's buckets of one measure, some hundreds whatever the corpus.
    """
    merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "measure")
    upto = F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    merged = merged.withColumns({"upto": upto, "rows": F.sum("n").over(group)})
    # the bucket's upper edge
    value = F.when(F.col("bucket") == 0, 0.0).otherwise(F.exp(F.col("bucket") * F.lit(GROWTH)))
    quantile = lambda q, m: F.min(F.when((F.col("measure") == m) & (F.col("upto") >= F.col("rows") * q), value))
    found = [quantile(q, m).alias(f"{m}_{tag}") for m in MEASURES for q, tag in ((0.25, "low"), (0.75, "high"))]
    found += [quantile(0.5, c).alias(f"{c}_half") for c in SIZES]
    out = merged.groupBy(*keys).agg(F.max("rows").alias("rows"), *found)
    wide, few = {}, {}
    for m, (_, under, events) in MEASURES.items():
        wide[m] = F.lit(SPREAD) * (F.col(f"{m}_high") - F.col(f"{m}_low"))
        few[m] = F.coalesce(F.try_divide(F.lit(1000.0 * events), F.col(f"{under}_half")), F.lit(0.0))
    fence = [(F.col(f"{m}_high") + F.greatest(wide[m], few[m])).alias(m) for m in MEASURES]
    return out.select(*keys, "rows", *fence, *((wide[m] >= few[m]).alias(f"{m}_spread") for m in MEASURES))


def thresholds(sketch: DataFrame) -> DataFrame:
    """Fences of every (lang, source) that has a sketch, blended with its language's and that of all rows by numbers of documents."""
    tagged = lambda keys, tag: fences(sketch, keys).select(*keys, *(F.col(c).alias(f"{c}_{tag}") for c in ["rows", *MEASURES]))
    own, by_lang, every = tagged(["lang", "source"], "own"), tagged(["lang"], "lang"), tagged([], "all")
    own = own.alias("o").join(by_lang.alias("l"), F.expr("o.lang <=> l.lang"), "left").drop(F.col("l.lang"))
    own = own.join(F.broadcast(every))  # one row

    def blended(m: str) -> Column:
        of = lambda tag: (F.coalesce(F.col(f"{m}_{tag}"), F.lit(0.0)), F.when(F.col(f"{m}_{tag}").isNotNull(), F.col(f"rows_{tag}")).otherwise(0))
        out = F.col(f"{m}_all")
        for value, n in (of("lang"), of("own")):
            out = (n * value + PRIOR * out) / (n + PRIOR)
        return out

    return own.select("lang", "source", *(blended(m).alias(f"{m}_fence") for m in MEASURES))


def judge(
    docs: DataFrame,
    keep: dict[str, str],
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    materialize=None,
) -> DataFrame:
    """The columns ``keep``, the counts, ``base_failed`` and ``kept`` of every row.

    A null text is an empty one: no words, so the base rules reject it. A null language or source is a group of its own. A
    measure that has no value (no lines, say) does not reject; a value on the fence is kept. Repeated rows are judged each, and equal
    texts of one group alike. Long texts are measured whole. Only ``keep``, the text and the group columns are read, under names of
    their own. An empty table gives no rows. ``materialize`` stores the measured rows, which are used twice; without it they are made twice.
    """
    rows = measure(docs, {**keep, "lang": lang_col, "source": source_col}, text_col)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    if materialize:
        rows = materialize(rows)
    limits = thresholds(sketches(rows)).withColumnsRenamed({"lang": "t_lang", "source": "t_source"})
    joined = rows.join(limits, F.expr("lang <=> t_lang and source <=> t_source"), "left")
    beyond = F.lit(False)
    for name in MEASURES:
        beyond = beyond | F.coalesce(_value(name) > F.col(f"{name}_fence"), F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~beyond).select(*keep, *COUNTS, "base_failed", "kept")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the counts, base_failed and kept of every row of ``docs`` (columns lang and source)."""
    return judge(docs, {"doc_id": id_col}, text_col, materialize=stored)
