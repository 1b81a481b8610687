"""Statistics of first and second digits."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FIRST = {d: math.log10(1 + 1 / d) for d in range(1, 10)}
SECOND = {d: sum(math.log10(1 + 1 / (10 * k + d)) for k in range(1, 10)) for d in range(10)}
WINDOW_HOURS = (1, 4, 24, 168, 720)
MIN_TRADES = 20
NONCONFORMING = 0.015


def leading_digit(amount: Column) -> Column:
    """First digit of a positive decimal, exact, from its decimal form; null for others."""
    return F.when(amount > 0, F.regexp_extract(amount.cast("string"), "[1-9]", 0).cast("int"))


def second_digit(amount: Column) -> Column:
    """Second significant digit of a positive decimal, 0 where none is written; null for others."""
    found = F.regexp_extract(amount.cast("string"), r"[1-9]\.?([0-9])", 1)
    return F.when(amount > 0, F.coalesce(F.nullif(found, F.lit("")).cast("int"), F.lit(0)))


def metrics(counts: dict[int, Column], expected: dict[int, float]) -> dict[str, Column]:
    """chi2, mad and z_max of counts by digit; null without counts."""
    n = sum(counts.values(), F.lit(0))
    share = {d: counts[d] / n for d in expected}
    z = [F.greatest(F.lit(0.0), (F.abs(share[d] - p) - 1 / (2 * n)) / F.sqrt(F.lit(p * (1 - p)) / n)) for d, p in expected.items()]
    some = n > 0
    return {
        "chi2": F.when(some, sum(((share[d] - p) * (share[d] - p) / p for d, p in expected.items()), F.lit(0.0)) * n),
        "mad": F.when(some, sum((F.abs(share[d] - p) for d, p in expected.items()), F.lit(0.0)) / len(expected)),
        "z_max": F.when(some, F.greatest(*z)),
    }


def digit_counts(df: DataFrame, by: Sequence[str], amount: str = "amount", digit=leading_digit, digits: Sequence[int] = tuple(FIRST)) -> DataFrame:
    """Counts c1..c9 (or by the digits given) per group."""
    d = df.withColumn("__d", digit(F.col(amount)))
    return d.groupBy(*by).agg(*[F.count_if(F.col("__d") == k).alias(f"c{k}") for k in digits])


def windowed_metrics(sides: DataFrame, key: str = "wallet", hours: Sequence[int] = WINDOW_HOURS, min_trades: int = MIN_TRADES) -> DataFrame:
    """First-digit metrics of each key over trailing windows (ref - h, ref], ref being the key's last time.

    One pass: the windows nest, so their counts accumulate. Below ``min_trades`` the metrics are null
    and the flag false.
    """
    d = sides.select(key, "ts", leading_digit(F.col("amount")).alias("d"))
    ref = d.groupBy(key).agg(F.max("ts").alias("ref"))
    age = F.unix_micros("ref") - F.unix_micros("ts")
    # The smallest window a trade falls into; the larger ones hold it too, so counts accumulate over at most
    # len(hours) rows of a key.
    first = F.lit(None).cast("int")
    for h in sorted(hours, reverse=True):
        first = F.when(age < h * 3_600_000_000, F.lit(h)).otherwise(first)
    counted = d.join(ref, key).withColumn("w", first).filter(F.col("w").isNotNull()).groupBy(key, "w").agg(*[F.count_if(F.col("d") == k).alias(f"b{k}") for k in FIRST])
    grid = ref.select(key, F.explode(F.array(*[F.lit(h) for h in sorted(hours)])).alias("w"))
    over = Window.partitionBy(key).orderBy("w")
    cum = grid.join(counted, [key, "w"], "left").select(key, F.col("w").alias("window_h"), *[F.sum(F.coalesce(f"b{k}", F.lit(0))).over(over).alias(f"c{k}") for k in FIRST])
    counts = {k: F.col(f"c{k}") for k in FIRST}
    n = sum(counts.values(), F.lit(0))
    out = cum.select(key, "window_h", n.cast("bigint").alias("n"), *[F.when(n >= min_trades, c).alias(name) for name, c in metrics(counts, FIRST).items()])
    return out.select(key, "window_h", "n", *[F.round(name, 6).alias(name) for name in ("chi2", "mad", "z_max")], F.coalesce(F.col("mad") > NONCONFORMING, F.lit(False)).alias("nonconforming"))


def overall_metrics(df: DataFrame, by: Sequence[str], amount: str = "amount", second: bool = False) -> DataFrame:
    expected, digit = (SECOND, second_digit) if second else (FIRST, leading_digit)
    counts = digit_counts(df, by, amount, digit, tuple(expected))
    m = metrics({k: F.col(f"c{k}") for k in expected}, expected)
    n = sum((F.col(f"c{k}") for k in expected), F.lit(0))
    return counts.select(*by, n.cast("bigint").alias("n"), *[F.round(c, 6).alias(name) for name, c in m.items()])


def log_digit_metrics(df: DataFrame, by: Sequence[str], amount: str = "amount") -> DataFrame:
    """chi2 of the first digits of log10(amount), shifted so that the group's smallest is 1."""
    logs = df.filter(F.col(amount) > 0).select(*by, F.log10(F.col(amount).cast("double")).alias("__l"))
    low = logs.groupBy(*by).agg(F.min("__l").alias("__m"))
    digit = F.regexp_extract(F.round(F.col("__l") - F.col("__m") + 1, 7).cast("decimal(19,7)").cast("string"), "[1-9]", 0).cast("int")
    d = logs.join(low, list(by)).withColumn("__d", digit)
    counts = d.groupBy(*by).agg(*[F.count_if(F.col("__d") == k).alias(f"c{k}") for k in FIRST])
    m = metrics({k: F.col(f"c{k}") for k in FIRST}, FIRST)
    return counts.select(*by, F.round(m["chi2"], 6).alias("chi2_log"))


def class_baseline(df: DataFrame, group: str, amount: str = "amount", least: int = 30) -> DataFrame:
    """Observed shares of first digits of each class with ``least`` amounts or more."""
    d = df.select(group, leading_digit(F.col(amount)).alias("digit")).filter(F.col("digit").isNotNull())
    c = d.groupBy(group, "digit").agg(F.count("*").alias("n"))
    t = d.groupBy(group).agg(F.count("*").alias("total")).filter(F.col("total") >= least)
    return c.join(t, group).select(group, "digit", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))
