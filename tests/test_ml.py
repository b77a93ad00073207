"""Synthetic data, splits, models and metrics."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import functions as F

from bankops.ml import metrics, models
from bankops.ml.synth import normal, synth_fraud, synth_loans, uniform
from bankops.sources.tables import inline_rows

DRIVERS = ["credit_score", "log_revenue", "industry_risk", "tenor_years", "secured", "utilization", "relationship_years"]


@pytest.fixture(scope="module")
def loans(spark):
    return synth_loans(spark.range(4000), "id").cache()


@pytest.fixture(scope="module")
def cards(spark):
    return synth_fraud(spark.range(4000), "id").cache()


def test_random_numbers_follow_the_key_only(spark):
    draws = [spark.range(0, 5000, 1, n).select("id", uniform(F.col("id"), 3).alias("u")) for n in (1, 7)]
    assert draws[0].exceptAll(draws[1]).isEmpty()
    pdf = spark.range(20000).select(uniform(F.col("id"), 0).alias("a"), uniform(F.col("id"), 1).alias("b"), normal(F.col("id"), 0).alias("n")).toPandas()
    assert abs(pdf.a.mean() - 0.5) < 0.01 and abs(pdf.a.corr(pdf.b)) < 0.03 and pdf.a.between(0, 1).all()
    assert abs(pdf.n.mean()) < 0.03 and abs(pdf.n.std() - 1) < 0.03
    large = spark.range(2**40, 2**40 + 1000).select(uniform(F.col("id"), 0)).distinct().count()
    assert large == 1000


def test_loans_and_cards_have_the_stated_shape(loans, cards):
    pdf = loans.toPandas()
    assert pdf.spread_bps.between(40, 900).all() and pdf.credit_score.between(520, 820).all()
    assert abs(pdf.credit_score.mean() - 680) < 4 and abs(pdf.secured.mean() - 0.55) < 0.03
    assert set(pdf.industry) == {"Tech", "Healthcare", "Manufacturing", "Retail", "RealEstate", "Energy"}
    fraud = cards.toPandas()
    assert 0.11 < fraud.is_fraud.mean() < 0.17 and fraud.amount.min() >= 1


def test_splits_are_disjoint_and_complete(loans, cards):
    for train, test, key in (
        (*models.split_hash(loans.withColumn("n", F.substring("loan_id", 3, 8).cast("long")), "n", 0.8), "loan_id"),
        (*models.split_random(loans, 0.8, 1), "loan_id"),
        (*models.split_stratified(cards, "is_fraud", "transaction_id", {0: 0.8, 1: 0.8}, 1), "transaction_id"),
    ):
        a, b = ({r[0] for r in side.select(key).collect()} for side in (train, test))
        assert not a & b and len(a | b) == 4000 and abs(len(a) / 4000 - 0.8) < 0.03


def test_regression_matches_ridge_by_hand(loans):
    model = models.regression_stages(DRIVERS, "spread_bps").fit(loans)
    pdf = loans.toPandas()
    x, y = pdf[DRIVERS].to_numpy(), pdf.spread_bps.to_numpy()
    std, n = x.std(0, ddof=1), len(y)
    z = (x - x.mean(0)) / std
    # the penalty applies to standardised inputs and a standardised target
    lam = 0.05 / y.std(ddof=1)
    beta = np.linalg.solve(z.T @ z / n + lam * np.eye(len(DRIVERS)), z.T @ (y - y.mean()) / n)
    got = {r.feature: r.coefficient for r in models.coefficients(model, DRIVERS, loans, raw=True).collect()}
    assert np.allclose([got[d] for d in DRIVERS], beta / std, rtol=1e-2)
    rmse = metrics.regression_metrics(model.transform(loans), "spread_bps", "prediction").first().rmse
    assert 45 < rmse < 55
    order = [abs(r.coefficient) for r in models.coefficients(model, DRIVERS, loans).collect()]
    assert order == sorted(order, reverse=True)


def test_unseen_category_is_kept(spark):
    rows = inline_rows(spark, [("DEBIT",)] * 2 + [("CREDIT",), ("TRANSFER",), ("REVERSAL",)], "t string")
    index = StringIndexer(inputCol="t", outputCol="i", handleInvalid="keep").fit(rows)
    got = {r.t: r.i for r in index.transform(rows).collect()}
    assert got == {"DEBIT": 0, "CREDIT": 1, "REVERSAL": 2, "TRANSFER": 3}
    coded = OneHotEncoder(inputCols=["i"], outputCols=["v"]).fit(index.transform(rows)).transform(index.transform(rows))
    names = ["s0", "s1", "s2", "s3"]
    assert tuple(models.expand(coded, "v", names).filter("t = 'DEBIT'").select(*names).first()) == (1.0, 0.0, 0.0, 0.0)
    fresh = inline_rows(spark, [("FEE",)], "t string")
    assert index.transform(fresh).first().i == 4.0


@pytest.mark.parametrize("hot", [None, 5])
def test_auc_and_class_metrics_equal_spark_ml(spark, cards, hot):
    scored = cards.select("is_fraud", (F.round(F.col("amount") / 100) / 20).alias("score"), (F.col("amount") > 500).cast("double").alias("pred"))
    want = BinaryClassificationEvaluator(labelCol="is_fraud", rawPredictionCol="score", numBins=0).evaluate(scored)
    assert abs(metrics.auc(scored, "is_fraud", "score", hot).first().auc - want) < 1e-12
    row = metrics.class_metrics(scored, "is_fraud", "pred").first().asDict()
    names = {"accuracy": "accuracy", "weighted_precision": "weightedPrecision", "weighted_recall": "weightedRecall", "f1": "f1"}
    for ours, theirs in names.items():
        e = MulticlassClassificationEvaluator(labelCol="is_fraud", predictionCol="pred", metricName=theirs)
        assert abs(row[ours] - e.evaluate(scored)) < 1e-12


def test_grid_search_and_scoring(cards):
    train, test = models.split_stratified(cards, "is_fraud", "transaction_id", {0: 0.8, 1: 0.8}, 1)
    signals = ["amount", "night_txn", "cross_border", "device_change"]
    fitted = models.grid_search(models.classification_stages(signals, [], "is_fraud"), train, "is_fraud", {"regParam": [0.01, 0.5]}, folds=2)
    rows = models.grid_results(cards, fitted).collect()
    assert len(rows) == 2 and all(0.6 < r.auc < 1 for r in rows)
    assert models.score(fitted.bestModel, test).count() == test.count()


def test_fixed_logistic_score(spark):
    df = inline_rows(spark, [(1200.0, 0.8)], "amount double, risk double")
    row = models.score_logistic(df, {"amount": 0.002, "risk": 1.2}, -0.3).first()
    assert (row.probability, row.label) == (0.9552, 1)


def test_largest_residuals(spark):
    df = inline_rows(spark, [(i, float(i), 5.0) for i in range(10)], "id int, y double, p double")
    assert [r.id for r in metrics.largest_residuals(df, "y", "p", "id", 3).collect()] == [0, 1, 9]
