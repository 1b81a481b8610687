"""Data quality, drift and alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def completeness(df: DataFrame, columns: Sequence[str], most: float = 0.05) -> DataFrame:
    """Share of nulls of each column, and whether it is within bounds."""
    r = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"k{j}") for j, c in enumerate(columns)])
    share = lambda j: F.coalesce(F.try_divide(F.col(f"k{j}"), F.col("n")), F.lit(0.0))
    return r.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.round(share(j), 6).alias("null_share"), (share(j) <= most).alias("passed")) for j, c in enumerate(columns)])))


def uniqueness(df: DataFrame, key: Column) -> DataFrame:
    """Rows, distinct keys and share of repeated rows; null keys are not counted."""
    g = df.select(key.alias("k")).filter("k is not null").groupBy("k").agg(F.count("*").alias("c"))
    return g.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("n_distinct"), F.round(F.coalesce(1 - F.try_divide(F.count("*"), F.sum("c")), F.lit(0.0)), 6).alias("duplicate_share"))


def validity(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Share of rows that pass each check; a null outcome fails."""
    r = df.agg(F.count("*").alias("n"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(f"k_{k}") for k, c in checks.items()])
    return r.select(F.inline(F.array(*[F.struct(F.lit(k).alias("rule"), F.round(F.coalesce(F.try_divide(F.col(f"k_{k}"), F.col("n")), F.lit(0.0)), 6).alias("valid_share")) for k in checks])))


def readiness(scores: DataFrame, ready: float = 90.0, warning: float = 70.0) -> DataFrame:
    """Weighted mean of rule scores within each dimension (dimension, weight, score 0 to 1), mean across dimensions, verdict."""
    d = scores.groupBy("dimension").agg((F.sum(F.col("score") * F.col("weight")) / F.sum("weight")).alias("s"))
    r = d.agg((F.coalesce(F.avg("s"), F.lit(0.0)) * 100).alias("score"))
    return r.select(F.round("score", 4).alias("score"), F.when(F.col("score") >= ready, "READY").when(F.col("score") >= warning, "WARNING").otherwise("QUARANTINE_REJECTED").alias("verdict"))


def psi(expected: DataFrame, actual: DataFrame, by: str, edges: Sequence[float], value: str, floor: float = 1e-4) -> DataFrame:
    """Population stability index of ``value`` per ``by`` over fixed bins; values beyond the edges fall into the outer bins."""
    inner = edges[1:-1]
    b = F.size(F.filter(F.array(*[F.lit(float(e)) for e in inner]), lambda e: e <= F.col(value).cast("double")))
    bins = len(edges) - 1

    def shares(df: DataFrame, name: str) -> DataFrame:
        c = df.filter(F.col(value).isNotNull()).groupBy(by).agg(F.count("*").alias("t"), *[F.count_if(b == k).alias(f"c{k}") for k in range(bins)])
        s = c.select(by, *[F.greatest(F.col(f"c{k}") / F.col("t"), F.lit(floor)).alias(f"s{k}") for k in range(bins)])
        total = sum((F.col(f"s{k}") for k in range(bins)), F.lit(0.0))
        return s.select(by, *[(F.col(f"s{k}") / total).alias(f"{name}{k}") for k in range(bins)])

    j = shares(expected, "e").join(shares(actual, "o"), by)
    terms = sum(((F.col(f"o{k}") - F.col(f"e{k}")) * F.ln(F.col(f"o{k}") / F.col(f"e{k}")) for k in range(bins)), F.lit(0.0))
    return j.select(by, F.round(terms, 6).alias("psi"), (terms >= 0.25).alias("drifted"))


def baseline_drift(series: DataFrame, by: str, order: str, value: str, least: int = 10, z: float = 3.0) -> DataFrame:
    """Rows whose value is more than ``z`` deviations from the mean of all earlier ones of the key, given ``least`` of them."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    x = series.select(by, order, value, F.count(value).over(w).alias("k"), F.avg(value).over(w).alias("m"), F.stddev_pop(value).over(w).alias("s"))
    return x.filter((F.col("k") >= least) & (F.col("s") > 0)).select(by, order, F.round((F.col(value) - F.col("m")) / F.col("s"), 4).alias("z")).filter(F.abs("z") > z)


def cusum(series: DataFrame, by: str, order: str, value: str, mean: float = 0.0, slack: float = 0.5, limit: float = 5.0) -> DataFrame:
    """(by, at, high, low) of the first row at which a two-sided cumulative sum passes the limit.

    The clamped sum s_n = max(0, s_(n-1) + d_n) equals the running sum less its running minimum, so window frames give
    it exactly; no fold over a collected group is needed.
    """
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    up = series.select(by, order, F.sum(F.col(value) - mean - slack).over(w).alias("u"), F.sum(mean - F.col(value) - slack).over(w).alias("d"))
    s = up.select(by, order, (F.col("u") - F.least(F.lit(0.0), F.min("u").over(w))).alias("high"), (F.col("d") - F.least(F.lit(0.0), F.min("d").over(w))).alias("low"))
    hit = s.filter((F.col("high") > limit) | (F.col("low") > limit))
    return hit.groupBy(by).agg(F.min(order).alias("at"), F.round(F.min_by("high", order), 4).alias("high"), F.round(F.min_by("low", order), 4).alias("low"))


def alert_sessions(alerts: DataFrame, gap_us: int) -> DataFrame:
    """Alerts (wallet, pair, at, detector, score) of a wallet and pair in sessions that a pause of ``gap_us`` or more ends."""
    w = Window.partitionBy("wallet", "pair").orderBy("at", "detector")
    new = F.coalesce((F.unix_micros("at") - F.lag(F.unix_micros("at")).over(w) >= gap_us).cast("int"), F.lit(1))
    s = alerts.withColumn("new", new).withColumn("session", F.sum("new").over(Window.partitionBy("wallet", "pair").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)))
    g = s.groupBy("wallet", "pair", "session").agg(F.unix_micros(F.min("at")).alias("began"), F.count("*").alias("n"), F.max("score").alias("score"), F.array_join(F.sort_array(F.collect_set("detector")), ",").alias("detectors"))
    return g.drop("session")


def consensus_alerts(alerts: DataFrame, window_us: int, least: int, key: Sequence[str] = ("wallet", "pair")) -> DataFrame:
    """Keys on which ``least`` distinct detectors fired within a window ending with some alert."""
    # The last time of each detector at each alert, without a distinct count over a window.
    kinds = [r[0] for r in alerts.select("detector").distinct().orderBy("detector").limit(1001).collect()]
    if len(kinds) > 1000:
        raise ValueError("detectors are a small set of names")
    w = Window.partitionBy(*key).orderBy(F.unix_micros("at")).rangeBetween(-window_us, 0)
    k = sum((F.max((F.col("detector") == d).cast("int")).over(w) for d in kinds), F.lit(0))
    return alerts.withColumn("k", k).groupBy(*key).agg(F.max("k").alias("n_detectors")).filter(F.col("n_detectors") >= least)


def routed(alerts: DataFrame, rules: Sequence[tuple[str, float, str]], default: str) -> DataFrame:
    """Destination of each alert: the first rule (destination, least score, LIKE pattern of pairs) that fits."""
    to = F.lit(default)
    for name, score, like in reversed(rules):
        to = F.when((F.col("score") >= score) & F.coalesce(F.col("pair").like(like), F.lit(False)), F.lit(name)).otherwise(to)
    return alerts.withColumn("destination", to)


def cooldown(alerts: DataFrame, threshold: float, pause_us: int) -> DataFrame:
    """Delivered alerts: at or above the threshold and not within the pause after the wallet's last delivered one.

    Which alert is delivered depends on the one before, so each wallet is walked in order, sorted and streamed
    through an iterator that keeps one time per wallet.
    """
    import pyarrow as pa

    src = alerts.filter(F.col("score") >= threshold).select("wallet", F.unix_micros("at").alias("at"), "score").repartition("wallet").sortWithinPartitions("wallet", "at", F.desc("score"))

    def run(batches):
        who, last = None, 0
        for b in batches:
            keep = []
            for w, t in zip(b.column("wallet").to_pylist(), b.column("at").to_pylist()):
                ok = w != who or t - last >= pause_us
                if ok:
                    who, last = w, t
                keep.append(ok)
            yield b.filter(pa.array(keep, pa.bool_()))

    return src.mapInArrow(run, src.schema)


def reconcile(raw: DataFrame, scored: DataFrame) -> DataFrame:
    """Wallets without a score, scores without a wallet, scores out of range: (issue, n)."""
    a, b = raw.select("wallet").distinct(), scored.select("wallet", "score")
    parts = [
        a.join(b, "wallet", "left_anti").select(F.lit("unscored").alias("issue")),
        b.join(a, "wallet", "left_anti").select(F.lit("orphan score").alias("issue")),
        b.filter(F.col("score").isNull() | ~F.col("score").between(0, 100)).select(F.lit("bad score").alias("issue")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("issue").agg(F.count("*").alias("n"))
