"""SQL text shared by the DuckDB twins."""

from __future__ import annotations

from math import pi

from bankops.ml.synth import PRIMES, multipliers


def sql_uniform(key: str, stream: int) -> str:
    """The number ``bankops.ml.synth.uniform`` draws."""
    (p, q, r), (a, b, c) = PRIMES, multipliers(stream)
    x = f"((({key} % {p}) * {a} + ({key} >> 31) * 48271 + {stream + 1}) % {p})"
    x = f"((({x} * ({x} + {b % 2**30})) % {q}) * {c} % {r})"
    return f"((CAST({x} AS DOUBLE) + 0.5) / {float(r)!r})"


def sql_normal(key: str, stream: int, mean: float, sd: float) -> str:
    radius = f"sqrt(ln({sql_uniform(key, 1000 + stream)}) * -2.0)"
    return f"({radius} * cos({sql_uniform(key, 2000 + stream)} * {2 * pi!r}) * {sd!r} + {mean!r})"
