"""Linear and logistic regression from sums that tasks make and add up; the driver solves systems of one row per feature.

Linear: one pass gives counts, sums and products of all columns, as decimals, so they add up to the same numbers in any order. What is
fitted from them (coefficients, intercept, several penalties) needs no other pass.

Logistic: each Newton step is one pass that gives gradient and curvature of every model asked for, so a grid over folds costs as many
passes as one model.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankops.ml.synth import uniform
from bankops.session import stored

INTERCEPT = "(intercept)"
STEPS, TOLERANCE = 40, 1e-9
# rows whose scores a task sorts at once, evenly spaced scores it gives of them, and scores that are counted together
FLUSH_ROWS, SPACED, PART_ROWS = 250_000, 256, 250_000
# The penalties and mixes tried.
GRID = {"regParam": [0.01, 0.1, 0.5], "elasticNetParam": [0.0, 0.5, 1.0]}


@dataclass
class Moments:
    """Rows, sums and sums of products of some columns, exact."""

    names: list[str]
    rows: int
    sums: list[Fraction]
    products: list[list[Fraction]]

    def __add__(self, other: Moments) -> Moments:
        both = [[a + b for a, b in zip(x, y)] for x, y in zip(self.products, other.products)]
        return Moments(self.names, self.rows + other.rows, [a + b for a, b in zip(self.sums, other.sums)], both)

    def __sub__(self, other: Moments) -> Moments:
        both = [[a - b for a, b in zip(x, y)] for x, y in zip(self.products, other.products)]
        return Moments(self.names, self.rows - other.rows, [a - b for a, b in zip(self.sums, other.sums)], both)

    def mean(self) -> np.ndarray:
        return np.array([float(s / self.rows) for s in self.sums])

    def covariance(self, of_sample: bool = False) -> np.ndarray:
        """Subtracted before it is rounded to floating numbers, so columns far from zero lose nothing."""
        n, less = self.rows, 1 if of_sample else 0
        k = len(self.names)
        return np.array([[float((self.products[i][j] - self.sums[i] * self.sums[j] / n) / (n - less)) for j in range(k)] for i in range(k)])


def moments(df: DataFrame, cols: Sequence[str], digits: int = 6, by: str | None = None):
    """Moments of the columns, or one for each value of ``by`` (few): in one pass. Rows with a null in any of them are left out.

    Values count to ``digits`` places after the point, and to 18 - ``digits`` before it.
    """
    work = df.select(*[F.col(c).cast(f"decimal(18,{digits})").alias(f"_{i}") for i, c in enumerate(cols)], *([F.col(by).alias("_by")] if by else []))
    work = work.dropna(subset=[f"_{i}" for i in range(len(cols))])
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    aggs = [F.count(F.lit(1)), *[F.sum(f"_{i}") for i in range(len(cols))], *[F.sum(F.col(f"_{i}") * F.col(f"_{j}")) for i, j in pairs]]
    aggs = [a.alias(f"a{i}") for i, a in enumerate(aggs)]

    def read(row) -> Moments:
        n, values = row["a0"], [Fraction(row[f"a{i}"] or 0) for i in range(1, len(aggs))]
        products = [[Fraction(0)] * len(cols) for _ in cols]
        for (i, j), v in zip(pairs, values[len(cols) :]):
            products[i][j] = products[j][i] = v
        return Moments(list(cols), n, values[: len(cols)], products)

    if by is None:
        return read(work.agg(*aggs).first())
    return {r["_by"]: read(r) for r in work.groupBy("_by").agg(*aggs).collect()}


@dataclass
class Model:
    """Coefficients per original unit, intercept, and the deviations that turn them into coefficients of scaled features."""

    names: list[str]
    coefficients: np.ndarray
    intercept: float
    deviation: np.ndarray
    centre: np.ndarray

    def margin(self) -> Column:
        out = F.lit(float(self.intercept))
        for name, c in zip(self.names, self.coefficients):
            out = out + F.col(name) * float(c)
        return out

    def table(self, df: DataFrame, raw: bool = True) -> DataFrame:
        """feature, coefficient by absolute size, and the intercept: per original unit, or of centred features in units of their deviation."""
        values = self.coefficients if raw else self.coefficients * self.deviation
        first = self.intercept if raw else self.intercept + float(self.coefficients @ self.centre)
        rows = [(n, float(v)) for n, v in zip([*self.names, INTERCEPT], [*values, first])]
        out = df.sparkSession.createDataFrame(rows, "feature string, coefficient double")
        return out.orderBy(F.abs("coefficient").desc(), "feature")


def solve_linear(m: Moments, reg: float = 0.0) -> Model:
    """The last column of the moments on the others: least squares with a ridge on scaled features, the intercept free.

    The penalty is that of half the mean squared error in units of the label's deviation. A feature without spread gets 0.
    """
    cov, mean = m.covariance(), m.mean()
    dev = np.sqrt(np.diag(cov))
    live = np.flatnonzero(dev[:-1] > 0)
    slopes = np.zeros(len(dev) - 1)
    if len(live) and dev[-1] > 0:
        scale = dev[live]
        corr = cov[np.ix_(live, live)] / np.outer(scale, scale)
        right = cov[live, -1] / (scale * dev[-1])
        slopes[live] = np.linalg.solve(corr + reg / dev[-1] * np.eye(len(live)), right) * dev[-1] / scale
    sample = np.sqrt(np.diag(m.covariance(True)))[:-1] if m.rows > 1 else dev[:-1]
    return Model(m.names[:-1], slopes, float(mean[-1] - slopes @ mean[:-1]), sample, mean[:-1])


def fit_linear(df: DataFrame, features: Sequence[str], label: str, reg: float = 0.05, digits: int = 6) -> Model:
    return solve_linear(moments(df, [*features, label], digits), reg)


def predict_linear(model: Model, df: DataFrame, name: str = "prediction", derived: Mapping[str, Column] | None = None) -> DataFrame:
    """Predict rows; inputs such as a logarithm are derived here, from the same raw columns."""
    return df.withColumns(dict(derived or {})).withColumn(name, model.margin())


# ---- logistic ----


def _sums(centre: np.ndarray, scale: np.ndarray, beta: np.ndarray, held: np.ndarray):
    """Of each model (a column of ``beta``) loss, gradient and curvature over the rows whose fold it does not hold out."""
    k, models = beta.shape
    upper = np.triu_indices(k)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 + k + len(upper[0]), models))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:-2]], axis=1)
            x = np.column_stack([np.ones(len(x)), (x - centre) / scale])
            y, fold = (c.to_numpy(zero_copy_only=False) for c in batch.columns[-2:])
            z = x @ beta
            use = (fold[:, None] != held[None, :]).astype(float)
            p = 1 / (1 + np.exp(-z))
            total[0] += ((np.logaddexp(0, z) - y[:, None] * z) * use).sum(axis=0)
            total[1 : 1 + k] += x.T @ ((p - y[:, None]) * use)
            total[1 + k :] += (x[:, upper[0]] * x[:, upper[1]]).T @ (p * (1 - p) * use)
        at, model = (a.ravel() for a in np.indices(total.shape))
        out = [pa.array(model.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(out, ["model", "at", "v"])

    return sums


def _step(beta: np.ndarray, grad: np.ndarray, curve: np.ndarray, l1: float, l2: float) -> np.ndarray:
    """The minimum of the quadratic form around ``beta`` plus the penalties, the first entry free of them."""
    k = len(beta)
    ridge = np.diag([0.0] + [l2] * (k - 1))
    if l1 == 0:
        return beta - np.linalg.solve(curve + ridge, grad + ridge @ beta)
    new = beta.copy()
    for _ in range(1000):  # one coordinate at a time
        before = new.copy()
        for i in range(k):
            rest = grad[i] + curve[i] @ (new - beta) - curve[i, i] * (new[i] - beta[i])
            pull = curve[i, i] * beta[i] - rest
            # the curvature's own share of coordinate i is centred at beta
            new[i] = pull / curve[i, i] if i == 0 else np.sign(pull) * max(abs(pull) - l1, 0) / (curve[i, i] + l2)
        if np.abs(new - before).max() < 1e-13:
            break
    return new


def fit_logistic_grid(
    df: DataFrame, features: Sequence[str], label: str, settings: Sequence[tuple[float, float]], fold: str | None = None, folds: int = 0, digits: int = 6
) -> dict[tuple[int, int], Model]:
    """A model for each (setting, held-out fold), and with held-out fold -1 none held out if ``folds`` is 0; all in the same passes.

    A setting is (penalty, share of the absolute part) on features in units of their sample deviation over the model's own rows;
    the intercept is free. Rows with a null feature or label are left out. The loss is the mean; steps that do not lower it are halved.
    """
    rows = _fit_rows(df, features, label, F.col(fold) if fold else F.lit(-2))
    own = moments(rows, [f"_{i}" for i in range(len(features))], digits, "_fold")
    return _fit(rows, own, features, settings, list(range(folds)) or [-1])


def _fit_rows(df: DataFrame, features: Sequence[str], label: str, fold: Column) -> DataFrame:
    """``_0``, ``_1`` ... (features), ``_y`` and ``_fold`` of the rows without a null; stored, as each step reads them.

    Nulls are looked for in the stored rows: a filter on derived columns would work them out twice, and without sharing their parts.
    """
    cols = [F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(features)]
    return stored(df.select(*cols, F.col(label).cast("double").alias("_y"), fold.cast("int").alias("_fold"))).dropna()


def _fit(
    rows: DataFrame, own: Mapping[int, Moments], features: Sequence[str], settings: Sequence[tuple[float, float]], held: Sequence[int]
) -> dict[tuple[int, int], Model]:
    """The models of ``fit_logistic_grid`` from ``_fit_rows`` and their moments by fold; held-out fold -1 holds out none."""
    every = sum(list(own.values())[1:], next(iter(own.values())))
    centre, scale = every.mean(), np.sqrt(np.diag(every.covariance(True)))
    scale[scale == 0] = 1.0
    jobs = [(s, f) for s in range(len(settings)) for f in held]
    parts = {f: every - own[f] if f in own else every for f in held}
    k, n = len(features) + 1, np.array([parts[f].rows for _, f in jobs], float)
    # each model's own scale, in units of the common one
    ratio = {}
    for f in held:
        own_scale = np.sqrt(np.diag(parts[f].covariance(True)))
        ratio[f] = np.where(own_scale > 0, own_scale, 1.0) / scale
    l1 = np.array([settings[s][0] * settings[s][1] for s, _ in jobs])
    l2 = np.array([settings[s][0] * (1 - settings[s][1]) for s, _ in jobs])
    beta, step = np.zeros((k, len(jobs))), np.zeros((k, len(jobs)))
    best = np.full(len(jobs), np.inf)
    open_ = np.ones(len(jobs), bool)
    upper = np.triu_indices(k)
    for _ in range(STEPS):
        at = np.flatnonzero(open_)
        asked = np.array([jobs[j][1] for j in at])
        got = np.zeros((1 + k + len(upper[0]), len(at)))
        tasks = rows.mapInArrow(_sums(centre, scale, beta[:, at], asked), "model int, at int, v double")
        for r in tasks.groupBy("model", "at").agg(F.sum("v").alias("v")).collect():  # models times k squared
            got[r["at"], r["model"]] = r["v"]
        for c, j in enumerate(at):
            w = np.append(1.0, ratio[jobs[j][1]])  # coefficients of the model's own scale are beta times these
            b = beta[:, j] * w
            loss = got[0, c] / n[j] + l1[j] * np.abs(b[1:]).sum() + l2[j] / 2 * (b[1:] ** 2).sum()
            if loss > best[j] + 1e-12 and np.abs(step[:, j]).max() > TOLERANCE:
                step[:, j] /= 2
                beta[:, j] -= step[:, j]
                continue
            best[j] = min(loss, best[j])
            curve = np.zeros((k, k))
            curve[upper] = got[1 + k :, c] / n[j]
            curve = curve + np.triu(curve, 1).T
            new = _step(b, got[1 : 1 + k, c] / n[j] / w, curve / np.outer(w, w), l1[j], l2[j]) / w
            step[:, j] = new - beta[:, j]
            beta[:, j] = new
            open_[j] = np.abs(step[:, j]).max() > TOLERANCE
        if not open_.any():
            break
    out = {}
    for j, (s, f) in enumerate(jobs):
        raw = beta[1:, j] / scale
        out[s, f] = Model(list(features), raw, float(beta[0, j] - raw @ centre), scale * ratio[f], parts[f].mean())
    return out


def fit_logistic(df: DataFrame, features: Sequence[str], label: str, reg: float = 0.01, elastic: float = 0.0, digits: int = 6) -> Model:
    return fit_logistic_grid(df, features, label, [(reg, elastic)], digits=digits)[0, -1]


def predict_logistic(model: Model, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``probability`` of label 1, and ``prediction``."""
    p = F.lit(1.0) / (F.exp(-model.margin()) + 1.0)
    return df.withColumn("probability", p).withColumn("prediction", (F.col("probability") > threshold).cast("double"))


def _score_tasks(models: Mapping[tuple[int, int], Model], bounds: Mapping[int, np.ndarray] | None = None):
    """What a task gives for its rows' scores by each model that did not see their fold; ``_cell`` is the model's place.

    Without bounds: evenly spaced scores and how many each stands for. With them: of each part between bounds its distinct scores and their
    counts of positives and negatives, packed.
    """
    plain = [(f, float(m.intercept), [float(c) for c in m.coefficients]) for (_, f), m in models.items()]
    most, spaced = FLUSH_ROWS, SPACED

    def scored(batches: Iterator[pa.RecordBatch]):
        """(cell, scores, whether positive) of some ten thousand rows at once."""
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= most:
                yield from cells(held)
                held, n = [], 0
        if n:
            yield from cells(held)

    def cells(held: list[pa.RecordBatch]):
        *x, y, fold = (c.to_numpy() for c in pa.Table.from_batches(held).columns)
        of = {f: np.flatnonzero(fold == f) for f in {f for f, _, _ in plain}}
        for cell, (f, intercept, slopes) in enumerate(plain):
            at = of[f]
            if not len(at):
                continue
            z = np.full(len(at), intercept)
            for c, slope in zip(x, slopes):
                z = z + c[at] * slope
            # noise of the last bits must not order rows that tie
            yield cell, np.round(z, 9) + 0.0, y[at] == 1

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, z, _ in scored(batches):
            edges = np.linspace(0, len(z), min(spaced, len(z)) + 1).astype(np.int64)
            out = [np.full(len(edges) - 1, cell, np.int32), np.sort(z)[edges[:-1]], np.diff(edges)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["_cell", "_score", "_rows"])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, z, hit in scored(batches):
            score, place = np.unique(z, return_inverse=True)
            pos = np.bincount(place[hit], minlength=len(score))
            neg = np.bincount(place[~hit], minlength=len(score))
            part = np.searchsorted(bounds[cell], score, side="right")
            starts = np.flatnonzero(np.diff(part, prepend=-1))
            ends = np.append(starts[1:], len(score))
            packed = [pa.array([c[i:j].tobytes() for i, j in zip(starts, ends)], pa.binary()) for c in (score, pos.astype(np.int32), neg.astype(np.int32))]
            cols = [pa.array(np.full(len(starts), cell, np.int32)), pa.array(part[starts].astype(np.int32)), *packed]
            yield pa.RecordBatch.from_arrays(cols, ["_cell", "_part", "_score", "_pos", "_neg"])

    return spread if bounds is None else parts


def _part_task():
    """Positives, negatives and twice the pairs in the right order (ties counting one) of one part of one model's scores."""

    def count(table: pa.Table) -> pa.Table:
        score, pos, neg = (np.frombuffer(b"".join(table[c].to_pylist()), t) for c, t in (("_score", np.float64), ("_pos", np.int32), ("_neg", np.int32)))
        at, place = np.unique(score, return_inverse=True)
        order = np.argsort(place, kind="stable")
        first = np.searchsorted(place[order], np.arange(len(at)))
        pos, neg = (np.add.reduceat(c[order].astype(np.int64), first) for c in (pos, neg))
        times = 2 * np.cumsum(neg) - neg
        # whole numbers beyond 64 bits are added as such
        won = int(pos @ times) if int(pos.sum()) * 2 * int(neg.sum()) < 2**63 else sum(int(p) * int(t) for p, t in zip(pos, times))
        row = [pa.array([table[c][0].as_py()], pa.int32()) for c in ("_cell", "_part")]
        row += [pa.array([int(pos.sum())], pa.int64()), pa.array([int(neg.sum())], pa.int64()), pa.array([Decimal(won)], pa.decimal128(38, 0))]
        return pa.Table.from_arrays(row, ["_cell", "_part", "_pos", "_neg", "_won"])

    return count


def held_out_areas(rows: DataFrame, models: Mapping[tuple[int, int], Model]) -> DataFrame:
    """_setting, _fold, auc: the area of each model under the ROC curve of the fold it did not see, exact, ties counting as half.

    Scores are cut into parts of about ``PART_ROWS`` by bounds from evenly spaced scores of all rows. Tasks count equal scores first and send each
    part's as packed numbers, so rows of all models cross one shuffle without becoming rows of a table; a part is counted by itself, and
    the negatives of the parts below it are added.
    """
    spaced = rows.mapInArrow(_score_tasks(models), "_cell int, _score double, _rows long").groupBy("_cell", "_score").agg(F.sum("_rows").alias("_rows"))
    upto = F.sum("_rows").over(Window.partitionBy("_cell").orderBy("_score").rowsBetween(Window.unboundedPreceding, -1))
    part = F.floor(F.coalesce(upto, F.lit(0)) / PART_ROWS)
    cuts = spaced.select("_cell", "_score", part.alias("_part")).groupBy("_cell", "_part").agg(F.min("_score").alias("_score"))
    found: dict[int, list[float]] = {c: [] for c in range(len(models))}
    for r in cuts.where("_part > 0").collect():  # a number for each PART_ROWS scores
        found[r["_cell"]].append(r["_score"])
    bounds = {c: np.sort(np.array(v, float)) for c, v in found.items()}
    parts = rows.mapInArrow(_score_tasks(models, bounds), "_cell int, _part int, _score binary, _pos binary, _neg binary")
    counted = parts.groupBy("_cell", "_part").applyInArrow(
        _part_task(), "_cell int, _part int, _pos long, _neg long, _won decimal(38,0)"
    )
    below = F.sum("_neg").over(Window.partitionBy("_cell").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    won = F.col("_won") + F.col("_pos").cast("decimal(38,0)") * (F.coalesce(below, F.lit(0)) * 2)
    area = F.try_divide(F.sum("_all").cast("double"), F.sum("_pos").cast("double") * F.sum("_neg").cast("double") * 2.0)
    areas = counted.select("_cell", "_pos", "_neg", won.alias("_all")).groupBy("_cell").agg(area.alias("auc"))
    names = rows.sparkSession.createDataFrame([(c, s, f) for c, (s, f) in enumerate(models)], "_cell int, _setting int, _fold int")
    return areas.join(F.broadcast(names), "_cell").select("_setting", "_fold", "auc")


def cross_validate(
    df: DataFrame, features: Sequence[str], label: str, key: str, grid: Mapping[str, Sequence[float]] = GRID, folds: int = 3, stream: int = 0, digits: int = 6
) -> tuple[DataFrame, Model]:
    """(a row for each setting with its mean AUC over the folds and whether it is the best, the best setting's model of all rows).

    A row's fold is drawn from its whole-number ``key``. Among equal settings the first is best. AUCs count ties as half.
    """
    settings = [(r, e) for r in grid["regParam"] for e in grid["elasticNetParam"]]
    fold = F.coalesce(F.floor(uniform(F.col(key), stream) * folds).cast("int"), F.lit(-2))  # a row without key is never held out
    rows = _fit_rows(df, features, label, fold)
    own = moments(rows, [f"_{i}" for i in range(len(features))], digits, "_fold")
    models = _fit(rows, own, features, settings, list(range(folds)))
    found = held_out_areas(rows, models).collect()  # settings times folds
    mean = [float(np.mean([r["auc"] for r in sorted(found) if r["_setting"] == s])) for s in range(len(settings))]
    best = int(np.argmax(np.round(mean, 12)))
    table = df.sparkSession.createDataFrame(
        [(float(e), float(r), a, i == best) for i, ((r, e), a) in enumerate(zip(settings, mean))],
        "elasticNetParam double, regParam double, auc double, best boolean",
    )
    return table, _fit(rows, own, features, [settings[best]], [-1])[0, -1]
