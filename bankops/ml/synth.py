"""Synthetic rows over the ids of a frame.

Random numbers are integer arithmetic on the id, so they depend neither on partitioning nor on retries.
"""

from __future__ import annotations

from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankops.functions.columns import clamp, map_lookup

# Three primes just below 2^31.
PRIMES = (2_147_483_647, 2_147_483_629, 2_147_483_587)


def multipliers(stream: int) -> tuple[int, int, int]:
    """Factors of a stream, one per prime: powers of small primitive elements, far apart for each stream."""
    return tuple(pow(g, 7919 * (stream + 1) + 13, p) for g, p in zip((16807, 48271, 69621), PRIMES))


# Industries and their risk weights.
INDUSTRY_RISK = {
    "Tech": 0.9,
    "Healthcare": 0.8,
    "Manufacturing": 1.0,
    "Retail": 1.1,
    "RealEstate": 1.2,
    "Energy": 1.4,
}


def uniform(key: Column, stream: int) -> Column:
    """A number in (0, 1) for the key; streams are independent of each other.

    A product, a square and a product, modulo three different primes: a short expression, evaluated in codegen.
    """
    key = key.cast("long")
    (p, q, r), (a, b, c) = PRIMES, multipliers(stream)
    x = F.pmod(F.pmod(key, F.lit(p)) * F.lit(a).cast("long") + F.shiftright(key, 31) * 48271 + stream + 1, F.lit(p))
    x = F.pmod(x * (x + F.lit(b % 2**30)), F.lit(q))
    x = F.pmod(x * F.lit(c).cast("long"), F.lit(r))
    return (x.cast("double") + 0.5) / float(r)


def normal(key: Column, stream: int, mean: float = 0.0, sd: float = 1.0) -> Column:
    radius = F.sqrt(F.log(uniform(key, 1000 + stream)) * -2.0)
    return radius * F.cos(uniform(key, 2000 + stream) * (2 * pi)) * sd + mean


def chance(key: Column, stream: int, p: float | Column) -> Column:
    return uniform(key, stream) < p


def synth_loans(ids: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """One loan per id: seven price drivers and a noisy linear spread between 40 and 900 basis points."""
    k, s = F.col(id_col), seed * 100
    names = F.array(*[F.lit(x) for x in INDUSTRY_RISK])
    drawn = ids.select(
        F.concat(F.lit("LN"), F.lpad(k.cast("string"), 8, "0")).alias("loan_id"),
        clamp(normal(k, s, 680.0, 55.0), 520.0, 820.0).alias("credit_score"),
        clamp(F.exp(normal(k, s + 1, 14.2, 1.0)), 2e5, 5e9).alias("revenue"),
        F.element_at(names, (F.floor(uniform(k, s + 2) * len(INDUSTRY_RISK)) + 1).cast("int")).alias("industry"),
        clamp(normal(k, s + 3, 3.0, 1.5), 1.0, 10.0).alias("tenor_years"),
        F.when(chance(k, s + 4, 0.55), 1.0).otherwise(0.0).alias("secured"),
        clamp(F.pow(uniform(k, s + 5), 0.7), 0.05, 0.98).alias("utilization"),
        clamp(normal(k, s + 6, 4.0, 3.0), 0.0, 20.0).alias("relationship_years"),
        normal(k, s + 7, 0.0, 50.0).alias("_noise"),
    )
    rated = drawn.withColumns(
        {"log_revenue": F.log("revenue"), "industry_risk": map_lookup(F.col("industry"), INDUSTRY_RISK)}
    )
    # Effect of each driver on the spread, as (column, centre, basis points per unit).
    effects = [
        ("credit_score", 650.0, -0.55),
        ("log_revenue", 14.0, -12.0),
        ("industry_risk", 1.0, 45.0),
        ("tenor_years", 3.0, 9.0),
        ("secured", 0.0, -28.0),
        ("utilization", 0.5, 70.0),
        ("relationship_years", 0.0, -3.5),
    ]
    spread = F.lit(320.0)
    for name, centre, weight in effects:
        spread = spread + (F.col(name) - centre) * weight
    return rated.withColumn("spread_bps", clamp(spread + F.col("_noise"), 40.0, 900.0)).drop("_noise")


def synth_fraud(ids: DataFrame, id_col: str, seed: int = 42, rate: float = 0.10) -> DataFrame:
    """One transaction per id with overlapping amounts, noisy behaviour flags and noisy labels."""
    k, s = F.col(id_col), seed * 100 + 50
    fraud = F.col("_fraud")
    # Amount (mean, deviation) and flag probabilities for fraud and for the rest.
    amount = F.when(fraud, normal(k, s + 1, 700.0, 350.0)).otherwise(normal(k, s + 2, 250.0, 180.0))
    flags = {"night_txn": (0.55, 0.25), "cross_border": (0.45, 0.20), "device_change": (0.35, 0.15)}

    def flag(stream: int, with_fraud: float, without: float) -> Column:
        seen = chance(k, stream, F.when(fraud, with_fraud).otherwise(without))
        return (seen != chance(k, stream + 10, 0.15)).cast("int")

    marked = ids.withColumn("_fraud", chance(k, s, rate))
    return marked.select(
        F.concat(F.lit("TXN"), F.lpad(k.cast("string"), 12, "0")).alias("transaction_id"),
        F.greatest(amount + normal(k, s + 3, 0.0, 120.0), F.lit(1.0)).alias("amount"),
        *[flag(s + 4 + i, *p).alias(name) for i, (name, p) in enumerate(flags.items())],
        (fraud != chance(k, s + 30, 0.05)).cast("int").alias("is_fraud"),
    )


def synth_txn(ids: DataFrame, id_col: str, last_id: int, as_of: str, seed: int = 42) -> DataFrame:
    """One source row of the daily load per id, dated ``as_of`` and posted a day later."""
    k, day = F.col(id_col), F.lit(as_of).cast("date")
    account = F.floor(uniform(k, seed) * 10000).cast("string")
    return ids.select(
        F.concat(F.lit("TXN-"), (k + last_id).cast("string")).alias("transaction_id"),
        F.concat(F.lit("ACC-"), F.lpad(account, 4, "0")).alias("account_id"),
        day.alias("transaction_date"),
        F.date_add(day, 1).alias("posting_date"),
        (uniform(k, seed + 1) * 1000 + 1).cast("decimal(18,2)").alias("amount"),
        F.concat(F.lit("Payment "), k.cast("string")).alias("description"),
    )
