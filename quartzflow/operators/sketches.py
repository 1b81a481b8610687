"""Approximate counts, decayed counts, samples and noisy aggregates."""

from __future__ import annotations

import math
import secrets

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def approx_counterparties(sides: DataFrame, lg_k: int = 13) -> DataFrame:
    """HyperLogLog estimate of distinct counterparties of each wallet."""
    return sides.filter("cp is not null").groupBy("wallet").agg(F.hll_sketch_estimate(F.hll_sketch_agg("cp", lg_k)).alias("estimate"))


def amount_mode(sides: DataFrame, bins: int = 32, low: float = 0.01, high: float = 1e9) -> DataFrame:
    """Middle of the most frequent of ``bins`` logarithmic bins of each wallet's amounts, the lowest of equals."""
    step = (math.log(high) - math.log(low)) / bins
    x = F.greatest(F.lit(low), F.least(F.lit(high * 0.999999), F.col("amount").cast("double")))
    b = F.floor((F.ln(x) - math.log(low)) / step)
    c = sides.filter("amount > 0").groupBy("wallet", b.alias("b")).agg(F.count("*").alias("n"))
    top = c.groupBy("wallet").agg(F.min(F.struct((-F.col("n")).alias("n"), "b")).alias("m"))
    return top.select("wallet", F.col("m.b").alias("bin"), F.round(F.exp(math.log(low) + (F.col("m.b") + 0.5) * step), 6).alias("mode"))


def decayed_digits(sides: DataFrame, digit, seconds: int) -> DataFrame:
    """First-digit shares of each wallet with weights exp(-age / seconds), ages from the wallet's last trade."""
    d = sides.filter("amount > 0").select("wallet", "ts", digit(F.col("amount")).alias("d"))
    ref = d.groupBy("wallet").agg(F.max("ts").alias("ref"))
    weight = F.exp(-(F.unix_micros("ref") - F.unix_micros("ts")) / (seconds * 1e6))
    g = d.join(ref, "wallet").groupBy("wallet").agg(*[F.sum(F.when(F.col("d") == k, weight).otherwise(0.0)).alias(f"w{k}") for k in range(1, 10)])
    total = sum((F.col(f"w{k}") for k in range(1, 10)), F.lit(0.0))
    return g.select("wallet", *[F.round(F.col(f"w{k}") / total, 6).alias(f"p{k}") for k in range(1, 10)])


def reservoir(df: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """A uniform sample of k rows that is the same on every run: the k smallest hashes."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(k)


def private_counts(df: DataFrame, by: str, epsilon: float, seed: int | None = None) -> DataFrame:
    """Counts with Laplace noise of scale 1 / epsilon by inverse distribution, cut at 0.

    The noise is drawn from group and seed, so a retry gives the same release. Without a seed each release draws a
    secret one; who knows the seed can take the noise off.
    """
    seed = secrets.randbits(63) if seed is None else seed
    c = df.groupBy(by).agg(F.count("*").alias("n"))
    u = (F.pmod(F.xxhash64(F.col(by), F.lit(seed)), F.lit(2**40)) + 0.5) / 2.0**40 - 0.5
    noise = -F.signum(u) * F.ln(1 - 2 * F.abs(u)) / epsilon
    return c.select(by, F.greatest(F.lit(0.0), F.round(F.col("n") + noise, 3)).alias("n"))
