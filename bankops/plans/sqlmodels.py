"""SQL text of fitted models: moments, elimination and Newton steps as common table expressions."""

from __future__ import annotations

from collections.abc import Sequence


def eliminated(name: str, start: str, k: int) -> str:
    """``name`` holds the solution ``v`` of the k by k+1 matrix ``m`` of ``start``: one pivot after the other."""
    return f"""{name}_steps AS (
        SELECT 0 AS step, m FROM {start}
        UNION ALL
        SELECT step + 1, list_transform(range(1, {k + 1}), lambda i: list_transform(range(1, {k + 2}), lambda j:
            CASE WHEN i = step + 1 THEN m[i][j] / m[i][i] ELSE m[i][j] - m[i][step + 1] * m[step + 1][j] / m[step + 1][step + 1] END))
        FROM {name}_steps WHERE step < {k}),
    {name} AS (SELECT list_transform(m, lambda r: r[{k + 1}]) AS v FROM {name}_steps WHERE step = {k})"""


def _listed(items) -> str:
    return "[" + ", ".join(items) + "]"


def moments(rows: str, cols: Sequence[str], digits: int = 6) -> str:
    """``moments``: rows, means, covariances (of all rows) and sample deviations of the columns of ``rows``."""
    k = len(cols)
    exact = ", ".join(f"CAST({c} AS DECIMAL(19,{digits})) AS x{i}" for i, c in enumerate(cols))
    sums = _listed(f"CAST(sum(x{i}) AS DOUBLE)" for i in range(k))
    products = _listed(_listed(f"CAST(sum(x{i} * x{j}) AS DOUBLE)" for j in range(k)) for i in range(k))
    return f"""sums AS (SELECT CAST(count(*) AS DOUBLE) AS n, {sums} AS s, {products} AS p FROM (SELECT {exact} FROM {rows})),
    moments AS (
        SELECT n, list_transform(s, lambda x: x / n) AS mean,
            list_transform(range(1, {k + 1}), lambda i: list_transform(range(1, {k + 1}), lambda j: (p[i][j] - s[i] * s[j] / n) / n)) AS c,
            list_transform(range(1, {k + 1}), lambda i: sqrt((p[i][i] - s[i] * s[i] / n) / (n - 1))) AS sample
        FROM sums)"""


def linear(rows: str, features: Sequence[str], label: str, reg: float) -> str:
    """``fit``: slopes per original unit, intercept, means and sample deviations of the features. Starts a recursive WITH."""
    k = len(features)
    y = k + 1
    return f"""{moments(rows, [*features, label])},
    scaled AS (SELECT *, list_transform(range(1, {y + 1}), lambda i: sqrt(c[i][i])) AS dev FROM moments),
    normal AS (
        SELECT list_transform(range(1, {y}), lambda i: list_append(
            list_transform(range(1, {y}), lambda j: c[i][j] / (dev[i] * dev[j]) + CASE WHEN i = j THEN {reg!r}::DOUBLE / dev[{y}] ELSE 0 END),
            c[i][{y}] / (dev[i] * dev[{y}]))) AS m
        FROM scaled),
    {eliminated("solved", "normal", k)},
    slopes AS (SELECT list_transform(range(1, {y}), lambda i: v[i] * dev[{y}] / dev[i]) AS b, mean, sample FROM solved, scaled),
    fit AS (SELECT b, mean[{y}] - list_sum(list_transform(range(1, {y}), lambda i: b[i] * mean[i])) AS a, mean, sample FROM slopes)"""


def margin(features: Sequence[str], of: str = "fit") -> str:
    return f"({of}.a + " + " + ".join(f"{of}.b[{i}] * {c}" for i, c in enumerate(features, 1)) + ")"


def coefficient_rows(features: Sequence[str], raw: bool, digits: int) -> str:
    """A row for each feature and one for the intercept, from ``fit``."""
    k = len(features)
    value = "b[{i}]" if raw else "b[{i}] * sample[{i}]"
    first = "a" if raw else f"a + list_sum(list_transform(range(1, {k + 1}), lambda i: b[i] * mean[i]))"
    rows = [f"SELECT '{c}' AS feature, round({value.format(i=i)}, {digits}) AS coefficient FROM fit" for i, c in enumerate(features, 1)]
    return " UNION ALL ".join([*rows, f"SELECT '(intercept)', round({first}, {digits}) FROM fit"])


def logistic(rows: str, features: Sequence[str], label: str, reg: float, steps: int = 9) -> str:
    """``fit`` as in ``linear``, by so many Newton steps from zero with a ridge on features in units of their sample deviation."""
    k = len(features) + 1
    scaled = ", ".join(f"(CAST({c} AS DOUBLE) - mean[{i}]) / sample[{i}] AS z{i}" for i, c in enumerate(features, 1))
    z = ["1.0::DOUBLE"] + [f"z{i}" for i in range(1, k)]
    out = [f"{moments(rows, features)}, scaled AS MATERIALIZED (SELECT {scaled}, CAST({label} AS DOUBLE) AS y FROM {rows}, moments)"]
    out.append(f"newton0 AS (SELECT {_listed(['0.0::DOUBLE'] * k)} AS v)")
    for t in range(steps):
        chance = "1 / (1 + exp(-(" + " + ".join(f"v[{i + 1}] * {x}" for i, x in enumerate(z)) + ")))"
        grad = _listed(f"sum((p - y) * {x}) / count(*)" for x in z)
        curve = _listed(_listed(f"sum(p * (1 - p) * {a} * {b}) / count(*)" for b in z) for a in z)
        ridge = f"CASE WHEN i > 1 THEN {reg!r}::DOUBLE ELSE 0 END"
        out.append(f"sums{t} AS MATERIALIZED (SELECT {grad} AS g, {curve} AS h FROM (SELECT *, {chance} AS p FROM scaled, newton{t}))")
        out.append(f"""system{t} AS (SELECT list_transform(range(1, {k + 1}), lambda i: list_append(
            list_transform(range(1, {k + 1}), lambda j: h[i][j] + CASE WHEN i = j THEN {ridge} ELSE 0 END), g[i] + {ridge} * v[i])) AS m FROM sums{t}, newton{t})""")
        out.append(eliminated(f"change{t}", f"system{t}", k))
        out.append(f"newton{t + 1} AS MATERIALIZED (SELECT list_transform(range(1, {k + 1}), lambda i: n.v[i] - c.v[i]) AS v FROM newton{t} n, change{t} c)")
    out.append(f"""slopes AS (SELECT list_transform(range(1, {k}), lambda i: v[i + 1] / sample[i]) AS b, v[1] AS first, mean, sample FROM newton{steps}, moments),
    fit AS (SELECT b, first - list_sum(list_transform(range(1, {k}), lambda i: b[i] * mean[i])) AS a, mean, sample FROM slopes)""")
    return ",\n".join(out)
