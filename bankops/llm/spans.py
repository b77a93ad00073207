"""Positions of regular-expression matches, with built-in functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def match_spans(text: Column, pattern: str | Column, size: Callable[[Column], Column] = F.length, more: Column | None = None) -> Column:
    """array<struct<s, e, m>> of all matches from left to right: start, end and text.

    The pieces between matches and the matches alternate, so positions are running sums of their sizes. ``size`` measures a
    piece: code points by default. The pattern must not match empty text.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.split(text, pattern, -1)
    both = F.arrays_zip(matches.alias("m"), F.slice(pieces, F.lit(1), F.size(matches)).alias("p"))
    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast("array<struct<s:int,e:int,m:string>>").alias("out"))
    empty = F.array().cast("array<struct<s:int,e:int,m:string>>")

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + size(x["p"])
        e = s + size(x["m"])
        one = F.array(F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m")))
        return F.struct(e.alias("at"), F.concat(F.coalesce(acc["out"], empty), one).alias("out"))

    return F.coalesce(F.aggregate(both, start, step)["out"], empty)


def no_spans() -> Column:
    return F.array().cast("array<struct<s:int,e:int,m:string>>")
