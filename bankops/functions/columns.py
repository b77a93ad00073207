"""Column expressions: ratios, clamping, banding, lookups, time axis, text clean-up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000
MICROS_PER_SECOND = 1_000_000


def money(c: str | Column) -> Column:
    """Exact two-digit amount; summing it does not depend on row order."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def micros(ts: str) -> Column:
    """Microseconds since 1970 of a date or timestamp, with or without zone."""
    return F.unix_micros(F.col(ts).cast("timestamp"))


def safe_ratio(num: Column, den: Column) -> Column:
    """Quotient, NULL when the denominator is zero or NULL."""
    return F.try_divide(num, den)


def share(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def clamp(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def map_lookup(c: Column, weights: Mapping[str, float]) -> Column:
    """Weight of a category; NULL for a category without one."""
    pairs = [F.lit(x) for pair in weights.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), c)


def band(c: Column, bounds: Sequence[tuple[float, str]], other: str | None = None) -> Column:
    """Label of the first bound the value exceeds, in the order given."""
    (limit, label), *more = bounds
    out = F.when(c > limit, label)
    for limit, label in more:
        out = out.when(c > limit, label)
    return out if other is None else out.otherwise(other)


def fingerprint(cols: Sequence[str], null: str = "\\N") -> Column:
    """SHA-256 over the columns' text, joined by a double pipe.

    NULL gets a text of its own, so that moving a value into the next column changes the result.
    """
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(null)) for c in cols]
    return F.sha2(F.concat_ws("||", *texts), 256)


def parse_date(c: Column, pattern: str) -> Column:
    """Date of a text; NULL, not an error, when the text does not fit the pattern."""
    return F.try_to_timestamp(c, F.lit(pattern)).cast("date")


def is_night(ts: str, start: int = 0, end: int = 6) -> Column:
    return (F.hour(ts) >= start) & (F.hour(ts) < end)


def is_weekend(ts: str) -> Column:
    return F.dayofweek(ts).isin(1, 7)


def count_where(condition: Column) -> Column:
    """Conditional count as a long, 0 when nothing matches."""
    return F.count_if(condition)
