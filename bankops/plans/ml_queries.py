"""Queries for synthetic data, splits, feature stages, models, metrics and scoring.

Loans and card transactions are drawn for the ids of ``orders``, so they grow with it.
"""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from bankops.functions.columns import share
from bankops.ml import metrics, models, regression
from bankops.ml.frequency import frequency_index, join_categories, one_hot_table
from bankops.ml.synth import INDUSTRY_RISK, synth_fraud, synth_loans, synth_txn
from bankops.plans import sqlmodels
from bankops.plans.registry import query
from bankops.plans.sqltext import sql_normal, sql_uniform

DRIVERS = ["credit_score", "log_revenue", "industry_risk", "tenor_years", "secured", "utilization", "relationship_years"]
SIGNALS = ["amount", "night_txn", "cross_border", "device_change"]
SEED = 42


def rounded(df, digits: int, *cols: str):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def loans(t):
    return synth_loans(t.orders.select("o_orderkey"), "o_orderkey", SEED)


def cards(t):
    return synth_fraud(t.orders.select("o_orderkey"), "o_orderkey", SEED)


# ---- synthetic rows ----

def loans_sql(key: str = "o_orderkey", rows: str = "orders", seed: int = SEED) -> str:
    n, u = (lambda s, m, d: sql_normal(key, 100 * seed + s, m, d)), (lambda s: sql_uniform(key, 100 * seed + s))
    industry = f"({list(INDUSTRY_RISK)!r})[CAST(floor({u(2)} * 6) + 1 AS INTEGER)]"
    risk = "CASE industry " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in INDUSTRY_RISK.items()) + " END"
    drawn = f"""SELECT {key}, 'LN' || lpad(CAST({key} AS VARCHAR), 8, '0') AS loan_id,
    least(greatest({n(0, 680.0, 55.0)}, 520.0), 820.0) AS credit_score,
    least(greatest(exp({n(1, 14.2, 1.0)}), 2e5), 5e9) AS revenue, {industry} AS industry,
    least(greatest({n(3, 3.0, 1.5)}, 1.0), 10.0) AS tenor_years,
    CASE WHEN {u(4)} < 0.55 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS secured,
    least(greatest(pow({u(5)}, 0.7), 0.05), 0.98) AS utilization,
    least(greatest({n(6, 4.0, 3.0)}, 0.0), 20.0) AS relationship_years, {n(7, 0.0, 50.0)} AS noise FROM {rows}"""
    return f"""SELECT *, CAST({risk} AS DOUBLE) AS industry_risk, ln(revenue) AS log_revenue,
        least(greatest(320.0 - 0.55 * (credit_score - 650.0) - 12.0 * (ln(revenue) - 14.0)
          + 45.0 * (CAST({risk} AS DOUBLE) - 1.0) + 9.0 * (tenor_years - 3.0) - 28.0 * secured
          + 70.0 * (utilization - 0.5) - 3.5 * relationship_years + noise, 40.0), 900.0) AS spread_bps FROM ({drawn})"""


LOANS = loans_sql()


@query(
    "synth_loans",
    f"""SELECT loan_id, industry, secured, industry_risk, round(credit_score, 4) AS credit_score,
        round(revenue, 1) AS revenue, round(log_revenue, 4) AS log_revenue, round(tenor_years, 4) AS tenor_years,
        round(utilization, 4) AS utilization, round(relationship_years, 4) AS relationship_years,
        round(spread_bps, 4) AS spread_bps FROM ({LOANS})""",
)
def synth_loans_query(t):
    fine = ["credit_score", "log_revenue", "tenor_years", "utilization", "relationship_years", "spread_bps"]
    return rounded(rounded(loans(t), 4, *fine), 1, "revenue")


def _flag(i: int, yes: float, no: float) -> str:
    seen = f"({sql_uniform('o_orderkey', 4254 + i)} < CASE WHEN fraud THEN {yes} ELSE {no} END)"
    return f"CAST({seen} <> ({sql_uniform('o_orderkey', 4264 + i)} < 0.15) AS INTEGER)"


N, U = (lambda s, m, d: sql_normal("o_orderkey", 4200 + s, m, d)), (lambda s: sql_uniform("o_orderkey", 4200 + s))
CARDS = f"""SELECT o_orderkey, 'TXN' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS transaction_id,
        greatest(CASE WHEN fraud THEN {N(51, 700.0, 350.0)} ELSE {N(52, 250.0, 180.0)} END + {N(53, 0.0, 120.0)}, 1.0) AS amount,
        {_flag(0, 0.55, 0.25)} AS night_txn, {_flag(1, 0.45, 0.20)} AS cross_border, {_flag(2, 0.35, 0.15)} AS device_change,
        CAST(fraud <> ({U(80)} < 0.05) AS INTEGER) AS is_fraud FROM (SELECT o_orderkey, {U(50)} < 0.10 AS fraud FROM orders)"""


@query(
    "synth_fraud",
    f"SELECT transaction_id, round(amount, 4) AS amount, night_txn, cross_border, device_change, is_fraud FROM ({CARDS})",
)
def synth_fraud_query(t):
    return rounded(cards(t), 4, "amount")


@query(
    "synth_txn",
    f"""SELECT 'TXN-' || (o_orderkey + 1000) AS transaction_id,
        'ACC-' || lpad(CAST(CAST(floor({sql_uniform('o_orderkey', 42)} * 10000) AS BIGINT) AS VARCHAR), 4, '0') AS account_id,
        '2024-02-01' AS transaction_date, '2024-02-02' AS posting_date,
        CAST(CAST({sql_uniform('o_orderkey', 43)} * 1000 + 1 AS DECIMAL(18,2)) AS DOUBLE) AS amount,
        'Payment ' || o_orderkey AS description FROM orders""",
)
def synth_txn_query(t):
    out = synth_txn(t.orders.select("o_orderkey"), "o_orderkey", 1000, "2024-02-01")
    types = {"transaction_date": "string", "posting_date": "string", "amount": "double"}
    return out.withColumns({c: F.col(c).cast(k) for c, k in types.items()})


# ---- splits ----


def sides(train, test):
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@query("split_random")
def split_random(t):
    return sides(*models.split_random(t.orders.select("o_orderkey", "o_orderstatus"), 0.8, SEED))


@query("split_hash", f"SELECT o_orderkey, CASE WHEN {sql_uniform('o_orderkey', 0)} < 0.8 THEN 'train' ELSE 'test' END AS side FROM orders")
def split_hash(t):
    return sides(*models.split_hash(t.orders.select("o_orderkey"), "o_orderkey", 0.8))


@query(
    "split_stratified",
    f"""SELECT o_orderkey, o_orderstatus, CASE WHEN {sql_uniform('o_orderkey', SEED)} < CASE o_orderstatus WHEN 'F' THEN 0.8
        WHEN 'O' THEN 0.5 ELSE 0 END THEN 'train' ELSE 'test' END AS side FROM orders""",
)
def split_stratified(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    return sides(*models.split_stratified(rows, "o_orderstatus", "o_orderkey", {"F": 0.8, "O": 0.5}, SEED))


# ---- feature stages ----

MEASURES = ["l_quantity", "l_discount", "l_tax"]


@query("ml_assemble", "SELECT l_orderkey, l_quantity AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem")
def ml_assemble(t):
    vectors = models.assemble(t.lineitem.select("l_orderkey", *MEASURES), MEASURES)
    return models.expand(vectors, "features", ["f0", "f1", "f2"]).select("l_orderkey", "f0", "f1", "f2")


@query(
    "ml_scale",
    "SELECT l_orderkey, "
    + ", ".join(f"round((l.{c} - s.m{i}) / s.d{i}, 6) AS f{i}" for i, c in enumerate(MEASURES))
    + " FROM lineitem l, (SELECT "
    + ", ".join(f"avg({c}) AS m{i}, stddev_samp({c}) AS d{i}" for i, c in enumerate(MEASURES))
    + " FROM lineitem) s",
)
def ml_scale(t):
    vectors = models.assemble(t.lineitem.select("l_orderkey", *MEASURES), MEASURES, "raw")
    scaler = StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True)
    out = models.expand(scaler.fit(vectors).transform(vectors), "scaled", ["f0", "f1", "f2"])
    return rounded(out, 6, "f0", "f1", "f2").select("l_orderkey", "f0", "f1", "f2")


INDEXED = """(SELECT event_type, CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS DOUBLE) AS idx
              FROM events GROUP BY event_type) i"""


def indexed(t):
    """Rows and the table of categories: each category's number and vector."""
    rows = t.events.select("event_id", "event_type")
    return rows, one_hot_table(frequency_index(rows, "event_type"), "event_type", drop_last=False)


@query("ml_index", f"SELECT event_id, i.idx FROM events e JOIN {INDEXED} ON e.event_type = i.event_type")
def ml_index(t):
    rows, table = indexed(t)
    return join_categories(rows, table.drop("vec"), "event_type").select("event_id", "idx")


@query(
    "ml_onehot",
    "SELECT event_id, "
    + ", ".join(f"CAST(CASE WHEN i.idx = {n} THEN 1 ELSE 0 END AS DOUBLE) AS slot_{n}" for n in range(5))
    + f" FROM events e JOIN {INDEXED} ON e.event_type = i.event_type",
)
def ml_onehot(t):
    names = [f"slot_{n}" for n in range(5)]
    return models.expand(join_categories(*indexed(t), "event_type"), "vec", names).select("event_id", *names)


# ---- models ----


REG, FRAUD_REG = 0.05, 0.01
TRAIN, TEST = (f"(SELECT * FROM ({LOANS}) WHERE {sql_uniform('o_orderkey', 0)} {sign} 0.8)" for sign in ("<", ">="))
FITTED = "WITH RECURSIVE " + sqlmodels.linear(TRAIN, DRIVERS, "spread_bps", REG)


def priced(t):
    """A model of the spread, and the loans held out."""
    train, test = models.split_hash(t.orders.select("o_orderkey"), "o_orderkey", 0.8)
    train, test = (synth_loans(side, "o_orderkey", SEED) for side in (train, test))
    return regression.fit_linear(train, DRIVERS, "spread_bps", REG), test


@query("ml_stages")
def ml_stages(t):
    """Line status and numbers to the probability of a return through index, one-hot, scaling and a logistic model; on rows held out."""
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_linestatus", (F.col("l_returnflag") == "R").cast("int").alias("label")
    )
    train, test = models.split_hash(rows, "l_orderkey", 0.8)
    fitted = models.classification_stages(["l_quantity", "l_discount"], ["l_linestatus"], "label").fit(train)
    return fitted.transform(test).select("l_orderkey", "l_linenumber", "label", "prediction")


@query(
    "ml_linreg",
    f"{FITTED} SELECT loan_id, round(spread_bps, 4) AS spread_bps, round({sqlmodels.margin(DRIVERS)}, 4) AS prediction FROM {TEST}, fit",
)
def ml_linreg(t):
    model, test = priced(t)
    return rounded(regression.predict_linear(model, test), 4, "spread_bps", "prediction").select("loan_id", "spread_bps", "prediction")


@query(
    "ml_linreg_simple",
    """SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept
       FROM lineitem""",
)
def ml_linreg_simple(t):
    rows = models.assemble(t.lineitem.select("l_quantity", "l_extendedprice"), ["l_quantity"])
    fitted = LinearRegression(featuresCol="features", labelCol="l_extendedprice", regParam=0.0, solver="normal").fit(rows)
    row = (round(float(fitted.coefficients[0]), 4), round(float(fitted.intercept), 4))
    return t.spark.createDataFrame([row], "slope double, intercept double")


@query("ml_coefficients", f"{FITTED} {sqlmodels.coefficient_rows(DRIVERS, False, 6)}")
def ml_coefficients(t):
    model, test = priced(t)
    return rounded(model.table(test, raw=False), 6, "coefficient")


@query("ml_coefficients_raw", f"{FITTED} {sqlmodels.coefficient_rows(DRIVERS, True, 6)}")
def ml_coefficients_raw(t):
    model, test = priced(t)
    return rounded(model.table(test), 6, "coefficient")


@query(
    "ml_score",
    f"{FITTED} SELECT loan_id, round({sqlmodels.margin(DRIVERS)}, 4) AS prediction FROM ({loans_sql('c_custkey', 'customer', SEED + 1)}), fit",
)
def ml_score(t):
    """Later loans, known by their revenue; the logarithm is derived in the scoring job."""
    model, _ = priced(t)
    fresh = synth_loans(t.customer.select("c_custkey"), "c_custkey", SEED + 1).drop("log_revenue", "spread_bps")
    scored = regression.predict_linear(model, fresh, derived={"log_revenue": F.log("revenue")})
    return rounded(scored, 4, "prediction").select("loan_id", "prediction")


@query(
    "ml_residual_summary",
    f"""{FITTED} SELECT count(*) AS n, round(avg(e), 4) AS mean, round(stddev_samp(e), 4) AS stddev, round(min(e), 4) AS min, round(max(e), 4) AS max,
        round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae, round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2
        FROM (SELECT spread_bps AS y, spread_bps - {sqlmodels.margin(DRIVERS)} AS e FROM {TEST}, fit)""",
)
def ml_residual_summary(t):
    model, test = priced(t)
    out = metrics.residual_summary(regression.predict_linear(model, test), "spread_bps", "prediction")
    return rounded(rounded(out, 4, "mean", "stddev", "min", "max", "rmse", "mae"), 6, "r2")


FRAUD_TRAIN, FRAUD_TEST = (f"(SELECT * FROM ({CARDS}) WHERE {sql_uniform('o_orderkey', SEED)} {sign} 0.8)" for sign in ("<", ">="))
FRAUD_FITTED = "WITH RECURSIVE " + sqlmodels.logistic(FRAUD_TRAIN, SIGNALS, "is_fraud", FRAUD_REG)


def fraud_split(t):
    rows = cards(t).withColumn("number", F.substring("transaction_id", 4, 12).cast("long"))
    return models.split_stratified(rows, "is_fraud", "number", {0: 0.8, 1: 0.8}, SEED)


@query(
    "ml_logreg",
    f"""{FRAUD_FITTED} SELECT transaction_id, is_fraud, round(p, 6) AS probability, CAST(p > 0.5 AS DOUBLE) AS prediction
        FROM (SELECT *, 1 / (1 + exp(-{sqlmodels.margin(SIGNALS)})) AS p FROM {FRAUD_TEST}, fit)""",
)
def ml_logreg(t):
    train, test = fraud_split(t)
    scored = regression.predict_logistic(regression.fit_logistic(train, SIGNALS, "is_fraud", FRAUD_REG), test)
    return rounded(scored, 6, "probability").select("transaction_id", "is_fraud", "probability", "prediction")


@query("ml_logreg_coefficients", f"{FRAUD_FITTED} {sqlmodels.coefficient_rows(SIGNALS, False, 6)}")
def ml_logreg_coefficients(t):
    train, _ = fraud_split(t)
    return rounded(regression.fit_logistic(train, SIGNALS, "is_fraud", FRAUD_REG).table(train, raw=False), 6, "coefficient")


@query("ml_crossval")
def ml_crossval(t):
    train, _ = fraud_split(t)
    return rounded(regression.cross_validate(train, SIGNALS, "is_fraud", "number")[0], 6, "auc")


@query("ml_crossval_score")
def ml_crossval_score(t):
    """The held-out transactions, scored by the best setting of the grid."""
    train, test = fraud_split(t)
    _, best = regression.cross_validate(train, SIGNALS, "is_fraud", "number")
    return rounded(regression.predict_logistic(best, test), 6, "probability").select("transaction_id", "is_fraud", "probability", "prediction")


# ---- metrics on a fixed prediction ----

GUESS = "l_quantity * 1500"


def guessed(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", F.expr(GUESS).alias("guess"))


@query(
    "eval_regression",
    f"""SELECT round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae,
        round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2
        FROM (SELECT l_extendedprice AS y, l_extendedprice - {GUESS} AS e FROM lineitem)""",
)
def eval_regression(t):
    out = metrics.regression_metrics(guessed(t), "l_extendedprice", "guess")
    return rounded(rounded(out, 4, "rmse", "mae"), 6, "r2")


@query(
    "eval_auc",
    """SELECT CAST(sum(pos * (2 * below - neg)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE) * 2.0) AS auc
       FROM (SELECT pos, neg, sum(neg) OVER (ORDER BY l_extendedprice) AS below FROM (
         SELECT l_extendedprice, count(*) FILTER (WHERE l_returnflag = 'R') AS pos,
         count(*) FILTER (WHERE l_returnflag <> 'R') AS neg FROM lineitem GROUP BY 1))""",
)
def eval_auc(t):
    rows = t.lineitem.select("l_extendedprice", (F.col("l_returnflag") == "R").cast("int").alias("label"))
    return metrics.auc(rows, "label", "l_extendedprice")


@query(
    "eval_classification",
    """WITH d AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, CAST(l_quantity > 25 AS INTEGER) AS p FROM lineitem),
       m AS (SELECT c, (SELECT CAST(count(*) AS DOUBLE) FROM d WHERE y = c) AS size,
         (SELECT CAST(count(*) AS DOUBLE) FROM d WHERE p = c) AS guessed,
         (SELECT CAST(count(*) AS DOUBLE) FROM d WHERE y = c AND p = c) AS hit FROM (VALUES (0), (1)) v(c))
       SELECT round(sum(hit) / sum(size), 6) AS accuracy, round(sum(size * hit / guessed) / sum(size), 6) AS weighted_precision,
         round(sum(hit) / sum(size), 6) AS weighted_recall,
         round(sum(size * 2 * (hit / guessed) * (hit / size) / (hit / guessed + hit / size)) / sum(size), 6) AS f1 FROM m""",
)
def eval_classification(t):
    rows = t.lineitem.select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"), (F.col("l_quantity") > 25).cast("int").alias("p")
    )
    return rounded(metrics.class_metrics(rows, "y", "p"), 6, "accuracy", "weighted_precision", "weighted_recall", "f1")


@query(
    "eval_residuals",
    f"""SELECT o_orderkey, o_totalprice - 150000 AS residual FROM orders
        ORDER BY abs(o_totalprice - 150000) DESC, o_orderkey LIMIT 20""",
)
def eval_residuals(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", F.lit(150000).alias("guess"))
    return metrics.largest_residuals(rows, "o_totalprice", "guess", "o_orderkey").select("o_orderkey", "residual")


@query(
    "score_logistic",
    """SELECT event_id, round(1 / (1 + pow(2.71828, -s)), 4) AS probability, CAST(1 / (1 + pow(2.71828, -s)) >= 0.5 AS INTEGER) AS label
       FROM (SELECT event_id, -0.3 + value * 0.002 + risk * 1.2 AS s FROM (
         SELECT event_id, value, CAST(hour(ts) AS DOUBLE) / 24.0 AS risk FROM events))""",
)
def score_logistic(t):
    rows = t.events.select("event_id", "value", share(F.hour("ts"), F.lit(24)).alias("risk"))
    return models.score_logistic(rows, {"value": 0.002, "risk": 1.2}, -0.3).select("event_id", "probability", "label")
