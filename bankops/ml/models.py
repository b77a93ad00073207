"""Splits, feature stages, models, grid search, coefficients and scoring on Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankops.ml.synth import uniform


def split_hash(df: DataFrame, key: str, frac: float, stream: int = 0) -> tuple[DataFrame, DataFrame]:
    """Split by a number drawn from the key: the same rows on any cluster, in any run."""
    draw = uniform(F.col(key), stream)
    return df.filter(draw < frac), df.filter(draw >= frac)


def split_random(df: DataFrame, frac: float, seed: int) -> tuple[DataFrame, DataFrame]:
    train, test = df.randomSplit([frac, 1 - frac], seed=seed)
    return train, test


def split_stratified(df: DataFrame, label: str, key: str, frac: Mapping, seed: int) -> tuple[DataFrame, DataFrame]:
    """Draw each class at its own fraction; the rest is every row not drawn, other classes included.

    The draw depends on the key alone. A retried task, or the second reading of the frame for the rest,
    therefore decides alike, and no join is needed to find the rest.
    """
    numeric = df.schema[key].dataType.typeName() in ("long", "integer", "short", "byte")
    draw = uniform(F.col(key) if numeric else F.xxhash64(key), seed)
    share_of = F.lit(0.0)
    for value, fraction in frac.items():
        share_of = F.when(F.col(label) == value, float(fraction)).otherwise(share_of)
    return df.filter(draw < share_of), df.filter(draw >= share_of)


def assemble(df: DataFrame, cols: Sequence[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=name).transform(df)


def expand(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """The vector's entries as columns."""
    parts = vector_to_array(F.col(vector))
    return df.withColumns({n: parts[i] for i, n in enumerate(names)})


def regression_stages(
    features: Sequence[str], label: str, reg: float = 0.05, elastic: float = 0.0, with_mean: bool = False
) -> Pipeline:
    """Assemble, scale and fit; scaling belongs to the fit, so test rows never enter it."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=with_mean, withStd=True),
            LinearRegression(featuresCol="features", labelCol=label, regParam=reg, elasticNetParam=elastic),
        ]
    )


def classification_stages(numeric: Sequence[str], categorical: Sequence[str], label: str, reg: float = 0.01) -> Pipeline:
    """Index and one-hot the categories, scale the numbers, fit a logistic model."""
    indexed = [f"{c}_index" for c in categorical]
    coded = [f"{c}_vec" for c in categorical]
    stages = []
    if categorical:
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=coded))
    stages += [
        VectorAssembler(inputCols=list(numeric), outputCol="raw_numbers"),
        StandardScaler(inputCol="raw_numbers", outputCol="numbers", withMean=True, withStd=True),
        VectorAssembler(inputCols=["numbers", *coded], outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol=label, regParam=reg),
    ]
    return Pipeline(stages=stages)


# The penalties and mixes tried.
GRID = {"regParam": [0.01, 0.1, 0.5], "elasticNetParam": [0.0, 0.5, 1.0]}


def grid_search(
    stages: Pipeline, train: DataFrame, label: str, grid: Mapping[str, Sequence[float]] = GRID, folds: int = 3,
    seed: int = 42, parallelism: int = 4,
):
    """Cross-validated choice of the last stage's parameters by ROC AUC, fitted once."""
    model = stages.getStages()[-1]
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(getattr(model, name), list(values))
    search = CrossValidator(
        estimator=stages,
        estimatorParamMaps=builder.build(),
        evaluator=BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC"),
        numFolds=folds,
        seed=seed,
        parallelism=parallelism,
    )
    return search.fit(train)


def grid_results(df: DataFrame, fitted) -> DataFrame:
    """One row per parameter setting with its mean AUC."""
    rows = [
        (*[float(v) for _, v in sorted((p.name, v) for p, v in params.items())], float(score))
        for params, score in zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics)
    ]
    names = sorted(p.name for p in fitted.getEstimatorParamMaps()[0])
    return df.sparkSession.createDataFrame(rows, ", ".join(f"{n} double" for n in [*names, "auc"]))


def coefficients(model: PipelineModel, features: Sequence[str], df: DataFrame, raw: bool = False) -> DataFrame:
    """Coefficient per feature, by absolute size; ``raw`` gives them per original unit.

    The frame only lends its session; there is one row per feature.
    """
    values = model.stages[-1].coefficients.toArray()
    if raw:
        values = values / model.stages[-2].std.toArray()
    rows = [(n, float(v)) for n, v in zip(features, values)]
    out = df.sparkSession.createDataFrame(rows, "feature string, coefficient double")
    return out.orderBy(F.abs("coefficient").desc(), "feature")


def score(model: PipelineModel, df: DataFrame, derived: Mapping[str, Column] | None = None) -> DataFrame:
    """Predict new rows; inputs such as a logarithm are derived here, from the same raw columns."""
    return model.transform(df.withColumns(dict(derived or {})))


def score_logistic(
    df: DataFrame, weights: Mapping[str, float], bias: float, threshold: float = 0.5, base: float = 2.71828
) -> DataFrame:
    """Probability and label from fixed weights, as one column expression."""
    s = F.lit(bias)
    for name, w in weights.items():
        s = s + F.col(name) * w
    p = F.lit(1.0) / (F.pow(F.lit(base), -s) + 1.0)
    return df.withColumn("probability", F.round(p, 4)).withColumn("label", (p >= threshold).cast("int"))
