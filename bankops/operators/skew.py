"""Ordered computations that stay spread out when one key holds a large part of the rows.

A plain window puts every row of a key into one task. The functions here keep that plain form for
ordinary keys and treat the heavy ones apart:

* the heavy rows are range-partitioned by (key, order), so one key covers many tasks;
* each range ("chunk") computes its own running value;
* the few per-chunk totals are carried forward and added.

Sums, counts, minima, maxima and last values merge exactly, so results equal the plain window's.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankops.operators.exact import as_limbs
from bankops.operators.heavy import carry_search, find_heavy
from bankops.session import stored

HOT_ROWS_CONF = "spark.bankops.hotRows"
DEFAULT_HOT_ROWS = 2_000_000
# Spark moves a sliding frame by reading it anew for each row, which is quadratic in busy keys.
SLIDING_ROWS = 20_000

# name -> (kind, input column); kinds are listed in _LOCAL
Aggs = dict[str, tuple[str, Column]]

_LOCAL = {
    "sum": F.sum,
    "count": F.count,
    "min": F.min,
    "max": F.max,
    "last": lambda c: F.last(c, ignorenulls=True),
}
_MERGE = {
    "sum": lambda before, own: F.coalesce(before + own, own, before),
    "count": lambda before, own: own + F.coalesce(before, F.lit(0)),
    "min": F.least,
    "max": F.greatest,
    "last": lambda before, own: F.coalesce(own, before),
}


def hot_limit(df: DataFrame, hot_rows: int | None) -> int:
    """Rows of one key that one task may hold: the argument, else the session setting, else the default."""
    if hot_rows is not None:
        return hot_rows
    return int(df.sparkSession.conf.get(HOT_ROWS_CONF, str(DEFAULT_HOT_ROWS)))


def fits_one_task(df: DataFrame, limit: int) -> bool:
    """Whether the whole input has at most ``limit`` rows by a bound that Spark's plan proves; runs no job.

    A size estimate will not do: compressed files hold any number of rows.
    """
    most = df._jdf.queryExecution().optimizedPlan().maxRows()
    return most.isDefined() and most.get() <= limit


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of ``keys`` with the prefixed copies on the right."""
    pairs = [left[k].eqNullSafe(right[prefix + k]) for k in keys]
    return reduce(lambda a, b: a & b, pairs)


def part_by(df: DataFrame, names: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of other keys, rows of the listed keys)."""
    on = same_keys(df, names, keys, "_hot_")
    return df.join(names, on, "left_anti"), df.join(names, on, "left_semi")


def split_hot(
    df: DataFrame, keys: Sequence[str], hot_rows: int | None = None
) -> tuple[DataFrame, DataFrame | None, int]:
    """(ordinary rows, rows of heavy keys or None, number of chunks for the latter).

    An input that fits one task is not searched at all; frames with the same keys in the same rows share a search.
    """
    limit = hot_limit(df, hot_rows)
    if fits_one_task(df, limit):
        return df, None, 0
    names, n_rows = find_heavy(df, keys, limit)
    if names is None:
        return df, None, 0
    return *part_by(df, names, keys), ceil(n_rows / limit)


def assign_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[Column], chunks: int) -> DataFrame:
    """Add ``_chunk``: equal-sized ranges of (keys, order), ascending within a key.

    Range bounds come from a sample, so the result is written down once before it is read twice.
    """
    ranged = df.repartitionByRange(max(chunks, 2), *[F.col(k) for k in keys], *order)
    return stored(ranged.withColumn("_chunk", F.spark_partition_id()))


def running_hot(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], aggs: Aggs, chunks: int
) -> DataFrame:
    """Running aggregates with every key spread over chunks; ``order`` must be total."""
    work = df.withColumns({f"_in_{n}": c for n, (_, c) in aggs.items()})
    work = assign_chunks(work, keys, order, chunks)

    ordered = [F.col(f"_in_{n}") for n in aggs]
    totals = work.groupBy(*[F.col(k).alias(f"_c_{k}") for k in keys], F.col("_chunk").alias("_c_chunk")).agg(
        *[
            # the chunk's last value is the one at its highest position
            F.max_by(c, F.when(c.isNotNull(), F.struct(*order))).alias(f"_tot_{n}")
            if kind == "last"
            else _LOCAL[kind](c).alias(f"_tot_{n}")
            for c, (n, (kind, _)) in zip(ordered, aggs.items())
        ]
    )
    # at most one row per chunk and key: a few thousand rows, never the data itself
    earlier = (
        Window.partitionBy(*[f"_c_{k}" for k in keys] or [F.lit(0)])
        .orderBy("_c_chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    kinds = {n: ("sum" if kind == "count" else kind) for n, (kind, _) in aggs.items()}
    carry = totals.select(
        *[f"_c_{k}" for k in keys],
        "_c_chunk",
        *[_LOCAL[kinds[n]](F.col(f"_tot_{n}")).over(earlier).alias(f"_carry_{n}") for n in aggs],
    )
    own = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = work.withColumns(
        {f"_own_{n}": _LOCAL[kind](F.col(f"_in_{n}")).over(own) for n, (kind, _) in aggs.items()}
    )
    on = local["_chunk"] == carry["_c_chunk"]
    if keys:
        on = on & same_keys(local, carry, keys, "_c_")
    merged = local.join(carry, on, "left")
    return merged.select(
        *df.columns,
        *[
            _MERGE[kind](F.col(f"_carry_{n}"), F.col(f"_own_{n}")).alias(n)
            for n, (kind, _) in aggs.items()
        ],
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    aggs: Aggs,
    hot_rows: int | None = None,
) -> DataFrame:
    """Running aggregates from the first row of a key to the current one.

    ``order`` must be total. With no keys the whole table is one running sequence: counted first, and
    computed by range chunks once it exceeds what one task may hold.
    """
    if keys:
        rest, hot, chunks = split_hot(df, keys, hot_rows)
    else:
        chunks = ceil(df.count() / hot_limit(df, hot_rows))
        rest, hot = (df, None) if chunks <= 1 else (df.limit(0), df)
    frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    plain = rest.withColumns({n: _LOCAL[kind](c).over(frame) for n, (kind, c) in aggs.items()})
    if hot is None:
        return plain
    return plain.unionByName(as_types(running_hot(hot, keys, order, aggs, chunks), plain))


def as_types(df: DataFrame, like: DataFrame) -> DataFrame:
    """Columns in the order and types of ``like`` (summed sums widen decimals); nullability is left alone."""
    own = {f.name: f.dataType.simpleString() for f in df.schema}
    return df.select(
        *[
            F.col(f.name) if own[f.name] == f.dataType.simpleString() else F.col(f.name).cast(f.dataType)
            for f in like.schema
        ]
    )


def over_rows_hot(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    before: int,
    after: int,
    build: Callable[[Window], dict[str, Column]],
    chunks: int,
    block: int,
) -> DataFrame:
    """Row frames over heavy keys: blocks of consecutive rows, each with copies of its neighbours.

    Rows are numbered without gaps, so a block needs exactly ``before`` rows of the block in front and
    ``after`` rows of the one behind.
    """
    block = max(block, before, after, 1)
    numbered = running_hot(df, keys, order, {"_pos": ("count", F.lit(1))}, chunks)
    at = F.pmod(F.col("_pos"), F.lit(block))
    home = F.floor(F.col("_pos") / block)
    copies = F.array_compact(
        F.array(
            home,
            F.when(at >= block - before, home + 1),
            F.when(at < after, home - 1),
        )
    )
    spread = numbered.withColumn("_home", home).withColumn("_block", F.explode(copies))
    out = build(Window.partitionBy(*keys, "_block").orderBy(*order))
    return spread.withColumns(out).filter("_home = _block").select(*df.columns, *out)


def over_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    before: int,
    after: int,
    build: Callable[[Window], dict[str, Column]],
    hot_rows: int | None = None,
) -> DataFrame:
    """Columns that look at most ``before`` rows back and ``after`` rows ahead within a key."""
    rest, hot, chunks = split_hot(df, keys, hot_rows)
    plain = rest.withColumns(build(Window.partitionBy(*keys).orderBy(*order)))
    if hot is None:
        return plain
    limit = hot_limit(df, hot_rows)
    out = plain.unionByName(as_types(over_rows_hot(hot, keys, order, before, after, build, chunks, limit), plain))
    return carry_search(out, df, keys, limit)


def _range_sums_hot(
    df: DataFrame,
    keys: Sequence[str],
    axis: str,
    spans: dict[int, Aggs],
    after: int,
    tie: str,
    chunks: int,
) -> DataFrame:
    """Sums and counts over range frames, as one running sum of entries and exits.

    A row enters the frame of every position from ``axis - after`` on and leaves it past ``axis`` plus the
    frame's length. Summing entries less exits up to a row's own position gives its frame exactly. Frames of
    several lengths share the entries and the pass.
    """
    all_aggs = {n: agg for aggs in spans.values() for n, agg in aggs.items()}
    values = {}
    for n, (kind, c) in all_aggs.items():
        one = F.when(c.isNotNull(), 1).otherwise(0).cast("long")
        values[f"_v_{n}"] = one if kind == "count" else c
        values[f"_n_{n}"] = one
    row = F.struct(*df.columns)
    row_type = df.select(row.alias("r")).schema["r"].dataType
    kept = df.withColumns(values)
    types = {v: kept.schema[v].dataType for v in values}
    step = ["_at", "_step", "_tie"]

    def event(at: Column, kind: int, signs: Mapping[str, int], payload: Column) -> DataFrame:
        return kept.select(
            *[F.col(k).alias(f"_k_{k}") for k in keys],
            at.alias("_at"),
            F.lit(kind).alias("_step"),
            F.col(tie).alias("_tie"),
            payload.cast(row_type).alias("_row"),
            *[
                (F.col(v) * signs[v] if v in signs else F.lit(None)).cast(t).alias(v)
                for v, t in types.items()
            ],
        )

    nothing = F.lit(None)
    steps = event(F.col(axis) - after, 0, dict.fromkeys(values, 1), nothing).unionByName(
        event(F.col(axis), 1, {}, row)
    )
    for span, aggs in spans.items():
        out_of_frame = {v: -1 for n in aggs for v in (f"_v_{n}", f"_n_{n}")}
        steps = steps.unionByName(event(F.col(axis) + span, 2, out_of_frame, nothing))
    sums = {f"_s{v}": ("sum", F.col(v)) for v in values}
    order = [F.col(s) for s in step]
    done = running_hot(steps, [f"_k_{k}" for k in keys], order, sums, (2 + len(spans)) * chunks).filter("_step = 1")
    out = []
    for n, (kind, _) in all_aggs.items():
        total, seen = F.col(f"_s_v_{n}"), F.col(f"_s_n_{n}")
        out.append(F.coalesce(total, F.lit(0)).alias(n) if kind == "count" else F.when(seen > 0, total).alias(n))
    return done.select("_row.*", *out)


def _range_extremes_busy(
    df: DataFrame, keys: Sequence[str], axis: str, before: int, aggs: Aggs, tie: str, hot_rows: int | None
) -> DataFrame:
    """Minima and maxima over the frame [axis - before, axis], in linear time.

    Time is cut into blocks as long as the frame. A frame then is the tail of one block plus the head of
    the next, and both are running extremes, which merge over chunks.
    """
    width = before + 1
    row = F.struct(*df.columns)
    row_type = df.select(row.alias("r")).schema["r"].dataType
    names = [f"_v_{n}" for n in aggs]
    kept = df.withColumns({f"_v_{n}": c for n, (_, c) in aggs.items()})
    key_cols = [F.col(k).alias(f"_k_{k}") for k in keys]
    group = [f"_k_{k}" for k in keys] + ["_part"]

    def pass_over(data: DataFrame, probes: DataFrame, at: Column, descending: bool, label: str) -> DataFrame:
        cols = [F.floor(at / width).alias("_part"), at.alias("_at"), F.col(tie).alias("_tie")]
        carried = [c for c in probes.columns if c.startswith("_tail_")]
        real = data.select(
            *key_cols, F.floor(F.col(axis) / width).alias("_part"), F.col(axis).alias("_at"),
            F.col(tie).alias("_tie"), F.lit(0).alias("_step"), F.lit(None).cast(row_type).alias("_row"),
            *[F.lit(None).cast(probes.schema[c].dataType).alias(c) for c in carried], *names,
        )
        ask = probes.select(
            *key_cols, *cols, F.lit(1).alias("_step"), row.alias("_row"), *carried,
            *[F.lit(None).cast(data.schema[n].dataType).alias(n) for n in names],
        )
        order = [F.col("_at").desc() if descending else F.col("_at").asc(), F.col("_step"), F.col("_tie")]
        found = running(
            real.unionByName(ask), group, order,
            {f"{label}{n}": (kind, F.col(f"_v_{n}")) for n, (kind, _) in aggs.items()}, hot_rows,
        )
        return found.filter("_step = 1").select("_row.*", *carried, *[f"{label}{n}" for n in aggs])

    # a frame of `width` whole positions starts in the block before, or exactly at a block's first position
    tails = pass_over(kept, df, F.col(axis) - before, True, "_tail_")
    both = pass_over(kept, tails, F.col(axis), False, "_head_")
    return both.select(
        *df.columns,
        *[(F.least if kind == "min" else F.greatest)(f"_tail_{n}", f"_head_{n}").alias(n) for n, (kind, _) in aggs.items()],
    )


def _by_span(aggs: Aggs, before: int | Mapping[str, int]) -> dict[int, Aggs]:
    """The aggregates grouped by the length of their frame."""
    groups: dict[int, Aggs] = {}
    for n, agg in aggs.items():
        groups.setdefault(before if isinstance(before, int) else before[n], {})[n] = agg
    return groups


def _range_sums(
    df: DataFrame, keys: Sequence[str], axis: str, spans: dict[int, Aggs], after: int, tie: str, hot_rows: int | None
) -> DataFrame:
    rest, hot, chunks = split_hot(df, keys, hot_rows)
    ordered = Window.partitionBy(*keys).orderBy(axis)
    upto = ordered.rangeBetween(Window.unboundedPreceding, after)
    # all up to the frame's end less all before its start: both only ever grow, so time is linear
    out = {}
    for span, aggs in spans.items():
        left = ordered.rangeBetween(Window.unboundedPreceding, -span - 1)
        for n, (kind, c) in aggs.items():
            seen = F.count(c).over(upto) - F.count(c).over(left)
            total = F.sum(c).over(upto) - F.coalesce(F.sum(c).over(left), F.lit(0))
            out[n] = seen if kind == "count" else F.when(seen > 0, total)
    types = {
        n: rest.select(_LOCAL[kind](c).alias(n)).schema[n].dataType for aggs in spans.values() for n, (kind, c) in aggs.items()
    }
    plain = rest.withColumns({n: c.cast(types[n]) for n, c in out.items()})
    if hot is None:
        return plain
    done = _range_sums_hot(hot, keys, axis, spans, after, tie, chunks)
    return plain.unionByName(as_types(done.select(*plain.columns), plain))


def _range_extremes(
    df: DataFrame, keys: Sequence[str], axis: str, spans: dict[int, Aggs], tie: str, hot_rows: int | None
) -> DataFrame:
    rest, busy, _ = split_hot(df, keys, min(hot_limit(df, hot_rows), SLIDING_ROWS))
    ordered = Window.partitionBy(*keys).orderBy(axis)
    plain = rest.withColumns(
        {n: _LOCAL[kind](c).over(ordered.rangeBetween(-span, 0)) for span, aggs in spans.items() for n, (kind, c) in aggs.items()}
    )
    if busy is None:
        return plain
    for span, aggs in spans.items():
        busy = _range_extremes_busy(busy, keys, axis, span, aggs, tie, hot_rows)
    return plain.unionByName(as_types(busy, plain))


def over_range(
    df: DataFrame,
    keys: Sequence[str],
    axis: str,
    before: int | Mapping[str, int],
    aggs: Aggs,
    tie: str,
    after: int = 0,
    hot_rows: int | None = None,
) -> DataFrame:
    """Aggregates over the rows of a key with ``axis`` within [axis - before, axis + after].

    ``axis`` is a long column; both ends belong to the frame and so do rows of equal axis. ``before`` is one
    length or one per aggregate; frames of all lengths share one shuffle and one sort. Kinds are sum and count,
    which are exact, floating numbers included (see ``bankops.operators.exact``), and (with ``after`` 0) min and max.
    """
    floating = {n: c for n, (kind, c) in aggs.items() if kind == "sum" and df.select(c.alias("c")).schema["c"].dataType.typeName() in ("double", "float")}
    if floating:
        limbs, work = {}, df
        for i, (n, c) in enumerate(floating.items()):
            limbs[n] = as_limbs(work, c, f"_x{i}_")
            work = limbs[n].rows
        more = {part: ("sum", c) for x in limbs.values() for part, c in x.parts.items()}
        spans = before if isinstance(before, int) else {k: before[n] for n in aggs for k in (limbs[n].parts if n in limbs else [n])}
        rest = {n: a for n, a in aggs.items() if n not in floating}
        out = over_range(work, keys, axis, spans, {**rest, **more}, tie, after, hot_rows)
        return out.select(*df.columns, *(limbs[n].total().alias(n) if n in limbs else F.col(n) for n in aggs))
    extremes = {n: a for n, a in aggs.items() if a[0] in ("min", "max")}
    sums = {n: a for n, a in aggs.items() if a[0] in ("sum", "count")}
    if len(extremes) + len(sums) != len(aggs) or (extremes and after):
        raise ValueError("over_range takes sum and count, or min and max looking back only")
    if sums:
        df = _range_sums(df, keys, axis, _by_span(sums, before), after, tie, hot_rows)
    if extremes:
        df = _range_extremes(df, keys, axis, _by_span(extremes, before), tie, hot_rows)
    return df
