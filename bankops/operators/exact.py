"""Exact sums of floating numbers: each number as a few whole numbers on a common grid, which add up in any order.

A double is a whole number of some power of two. Between the highest bit of the greatest and the lowest bit of the least of a column lie so many
bits; cut into limbs of 31, every value is one long per limb, without a remainder. Limbs are summed like any whole numbers, over windows,
ranges and partial results, up to 2^32 rows; only the total is rounded.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMB = 31


@dataclass
class Limbs:
    """``parts``: a long column for each limb, highest first, and for values that are not finite their counts. ``rows``: the frame they are of."""

    rows: DataFrame
    parts: dict[str, Column]
    names: list[str]
    grid: int
    odd: list[str]

    def _scales(self, k: int) -> tuple[float, float]:
        """Two factors whose product is the unit of the k-th limb from the lowest: one alone may be too small or too great for a double."""
        exponent = self.grid + LIMB * k
        return math.ldexp(1.0, exponent // 2), math.ldexp(1.0, exponent - exponent // 2)

    def _added(self, limbs: Column) -> Column:
        """The value of limbs, lowest first, that lie in their range and above zero: nothing cancels."""
        scales = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in map(self._scales, range(len(self.names)))])
        each = F.zip_with(limbs, scales, lambda x, s: x.cast("double") * s["a"] * s["b"])
        return F.aggregate(each, F.lit(0.0), lambda acc, x: acc + x)

    def total(self) -> Column:
        """The sum, from the summed parts: null if there was no value."""
        limbs = [F.col(n) for n in self.names]
        if len(limbs) <= 3:  # up to 38 digits: one rounding
            whole = F.lit(0).cast("decimal(38,0)")
            for k, limb in enumerate(reversed(limbs)):
                whole = whole + (limb.cast("decimal(19,0)") * F.lit(1 << LIMB * k).cast("decimal(19,0)")).cast("decimal(38,0)")
            low, high = self._scales(0)
            out = whole.cast("decimal(38,0)").cast("double") * F.lit(low) * F.lit(high)
        else:
            # what goes beyond a limb is carried to the next, for the sum and for its negative; the one that is not below zero is added up
            lowest = F.array(*reversed(limbs))
            up, down = _carried(lowest), _carried(F.transform(lowest, lambda x: -x))
            out = F.when(F.element_at(up, -1) < 0, -self._added(down)).otherwise(self._added(up))
            out = F.when(limbs[0].isNotNull(), out)
        if self.odd:
            nan, up, down = (F.coalesce(F.col(n), F.lit(0)) > 0 for n in self.odd)
            out = F.when(nan | (up & down), float("nan")).when(up, float("inf")).when(down, float("-inf")).otherwise(out)
        return out


def _carried(limbs: Column) -> Column:
    """Limbs, lowest first, with all but the last in 0 to 2^31 - 1."""
    start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<long>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        x = x + acc["carry"]
        return F.struct(F.shiftright(x, LIMB).alias("carry"), F.concat(acc["out"], F.array(F.pmod(x, F.lit(1 << LIMB)))).alias("out"))

    # the highest keeps what would be carried on
    def done(acc: Column) -> Column:
        last = F.element_at(acc["out"], -1) + F.shiftleft(acc["carry"], LIMB)
        return F.concat(F.slice(acc["out"], 1, F.size(acc["out"]) - 1), F.array(last))

    return F.aggregate(limbs, start, step, done)


def as_limbs(df: DataFrame, c: Column, prefix: str) -> Limbs:
    """The limbs of a floating column, after one pass for its range; columns are named from the prefix."""
    c = c.cast("double")
    finite = c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    size = F.when(finite & (c != 0), F.abs(c))
    low, high, odd = df.agg(F.min(size), F.max(size), F.count_if(c.isNotNull() & ~finite)).first()
    if high is None:
        low = high = 1.0
    top = math.frexp(high)[1]  # values are below 2^top
    bottom = max(math.frexp(low)[1] - 53, -1074)
    count = max(1, -(-(top - bottom) // LIMB))
    out = Limbs(df, {}, [f"{prefix}{k}" for k in range(count)], top - LIMB * count, [])
    value = F.when(finite, c).when(c.isNotNull(), 0.0) if odd else c
    units = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in map(out._scales, reversed(range(count)))])
    start = F.struct(value.alias("rest"), F.array().cast("array<long>").alias("out"))

    def step(acc: Column, u: Column) -> Column:
        # powers of two scale without rounding; cut toward zero, so the remainder keeps its sign and all bits below the unit
        limb = (acc["rest"] / u["a"] / u["b"]).cast("long")
        return F.struct((acc["rest"] - limb.cast("double") * u["a"] * u["b"]).alias("rest"), F.concat(acc["out"], F.array(limb)).alias("out"))

    out.rows = df.withColumn(f"{prefix}all", F.aggregate(units, start, step, lambda acc: acc["out"]))
    out.parts = {n: F.get(f"{prefix}all", k) for k, n in enumerate(out.names)}
    if odd:
        for kind, is_kind in {"nan": F.isnan(c), "up": c == float("inf"), "down": c == float("-inf")}.items():
            out.parts[f"{prefix}{kind}"] = F.when(is_kind, 1).otherwise(0).cast("long")
            out.odd.append(f"{prefix}{kind}")
    return out
