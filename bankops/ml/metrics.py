"""Model metrics as plain aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankops.functions.columns import share
from bankops.operators.relational import top_k
from bankops.operators.skew import running


def residuals(df: DataFrame, label: str, pred: str, name: str = "residual") -> DataFrame:
    return df.withColumn(name, F.col(label) - F.col(pred))


def largest_residuals(df: DataFrame, label: str, pred: str, key: str, n: int = 20) -> DataFrame:
    return top_k(residuals(df, label, pred), [F.abs("residual").desc(), F.col(key)], n)


def _fit_metrics(label: str, pred: str) -> list[Column]:
    e = F.col(label) - F.col(pred)
    return [
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (1 - F.try_divide(F.sum(e * e), F.var_pop(label) * F.count(label))).alias("r2"),
    ]


def regression_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """rmse, mae and r2 from one pass."""
    return df.agg(*_fit_metrics(label, pred))


def residual_summary(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Count, mean, sample deviation and range of the residuals beside the regression metrics, from one pass."""
    e = F.col(label) - F.col(pred)
    spread = [F.count(e).alias("n"), F.avg(e).alias("mean"), F.stddev(e).alias("stddev"), F.min(e).alias("min"), F.max(e).alias("max")]
    return df.agg(*spread, *_fit_metrics(label, pred))


def auc(df: DataFrame, label: str, score: str, hot_rows: int | None = None) -> DataFrame:
    """Area under the ROC curve, exact with ties.

    Rows are first reduced to counts per distinct score; the running count of negatives below each score is
    computed over score ranges, not in one task.
    """
    by_score = df.groupBy(F.col(score).alias("_score")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg")
    )
    ranked = running(by_score, [], [F.col("_score")], {"_below": ("sum", F.col("_neg"))}, hot_rows)
    # twice the number of (positive, negative) pairs in the right order, ties counting one
    won = F.col("_pos").cast("decimal(38,0)") * (F.col("_below") * 2 - F.col("_neg"))
    pairs = F.sum("_pos").cast("double") * F.sum("_neg").cast("double") * 2.0
    return ranked.agg(F.try_divide(F.sum(won).cast("double"), pairs).alias("auc"))


def class_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Accuracy and precision, recall and F1 weighted by class size, from the confusion counts."""
    cells = df.groupBy(F.col(label).cast("double").alias("_y"), F.col(pred).cast("double").alias("_p")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    actual = cells.groupBy("_y").agg(
        F.sum("_n").alias("_size"), F.sum(F.when(F.col("_y") == F.col("_p"), F.col("_n")).otherwise(0)).alias("_hit")
    )
    guessed = cells.groupBy("_p").agg(F.sum("_n").alias("_guessed"))
    per = actual.join(guessed, F.col("_y") == F.col("_p"), "left")
    p = F.coalesce(share(F.col("_hit"), F.col("_guessed")), F.lit(0.0))
    r = share(F.col("_hit"), F.col("_size"))
    f = F.coalesce(F.try_divide(p * r * 2, p + r), F.lit(0.0))
    weigh = lambda c: F.sum(c * F.col("_size")) / F.sum("_size")
    return per.agg(
        share(F.sum("_hit"), F.sum("_size")).alias("accuracy"),
        weigh(p).alias("weighted_precision"),
        weigh(r).alias("weighted_recall"),
        weigh(f).alias("f1"),
    )
