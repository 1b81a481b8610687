"""Time buckets, gap filling, replay and rolling statistics over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _slot(ts: Column | str, seconds: int) -> Column:
    return F.floor(F.unix_micros(ts) / (seconds * 1_000_000)).cast("bigint")


def candles(trades: DataFrame, seconds: int) -> DataFrame:
    """Open, high, low, close, volume and count of each pair and bucket with trades."""
    order = F.struct("ts", "trade_id")
    t = trades.filter("pair is not null and price is not null").withColumn("slot", _slot("ts", seconds))
    return t.groupBy("pair", "slot").agg(
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.sum(F.coalesce("amount", F.lit(0))).cast("decimal(38,7)").alias("volume"),
        F.count("*").alias("n"),
        F.sum(F.col("price").cast("decimal(19,7)") * F.coalesce("amount", F.lit(0)).cast("decimal(18,7)")).alias("turnover"),
    )


def filled(series: DataFrame, by: str, slot: str, value: str, last: Column | None = None) -> DataFrame:
    """(by, slot, value) for every slot from the first to the last of each key, 0 where there is none.

    The slots of a key are generated by the executors; their number is the key's span, not its rows.
    """
    span = series.groupBy(by).agg(F.min(slot).alias("lo"), F.max(slot).alias("hi"))
    grid = span.select(by, F.explode(F.sequence("lo", F.greatest(F.col("hi"), last) if last is not None else F.col("hi"))).alias(slot))
    return grid.join(series.select(by, slot, value), [by, slot], "left").select(by, slot, F.coalesce(value, F.lit(0)).alias(value))


def ohlcv_features(trades: DataFrame, seconds: int, history: int = 20) -> DataFrame:
    """Features of the last bucket of each pair; the volume of the ``history`` buckets before counts empty ones."""
    c = candles(trades, seconds)
    dense = filled(c, "pair", "slot", "volume")
    w = Window.partitionBy("pair").orderBy("slot").rowsBetween(-history, -1)
    v = dense.select("pair", "slot", F.sum("volume").over(w).alias("before"), F.count("*").over(w).alias("k"))
    last = c.groupBy("pair").agg(F.max("slot").alias("slot"))
    d = lambda x: F.col(x).cast("double")
    vwap = F.try_divide(d("turnover"), d("volume"))
    return c.join(last, ["pair", "slot"]).join(v, ["pair", "slot"]).select(
        "pair",
        "n",
        F.round(F.try_divide(d("high") - d("low"), d("open")), 6).alias("range_ratio"),
        F.round(F.coalesce(F.try_divide(F.abs(d("close") - d("open")), d("high") - d("low")), F.lit(0.0)), 6).alias("body_ratio"),
        F.round(F.try_divide(F.abs(d("close") - vwap), vwap), 6).alias("vwap_deviation"),
        F.round(F.try_divide(d("volume"), d("before") / F.col("k")), 4).alias("volume_spike"),
    )


def trend(series: DataFrame, by: str, slot: str, value: str) -> DataFrame:
    """Slope of a least-squares line through the filled series over its mean."""
    f = filled(series, by, slot, value).withColumn("v", F.col(value).cast("double"))
    base = f.groupBy(by).agg(F.min(slot).alias("t0"), F.avg("v").alias("m"))
    x = f.join(base, by).withColumn("x", (F.col(slot) - F.col("t0")).cast("double"))
    g = x.groupBy(by, "m").agg(F.try_divide(F.covar_pop("x", "v"), F.var_pop("x")).alias("b"), F.count("*").alias("n"))
    return g.select(by, "n", F.round(F.try_divide("b", "m"), 6).alias("trend"))


def replay(sides: DataFrame, cutoffs: list[int]) -> DataFrame:
    """Trades and distinct counterparties of each wallet up to each cutoff (microseconds), without copying rows per cutoff.

    A row is counted at the first cutoff that sees it; later cutoffs accumulate.
    """
    first = F.lit(None).cast("bigint")
    for c in sorted(cutoffs, reverse=True):
        first = F.when(F.unix_micros("ts") <= c, F.lit(c)).otherwise(first)
    per = sides.withColumn("cutoff", first).filter("cutoff is not null")
    new = per.groupBy("wallet", "cp").agg(F.min("cutoff").alias("cutoff")).groupBy("wallet", "cutoff").agg(F.count("cp").alias("k"))
    n = per.groupBy("wallet", "cutoff").agg(F.count("*").alias("n"))
    grid = n.groupBy("wallet").agg(F.min("cutoff").alias("lo")).select("wallet", F.explode(F.filter(F.array(*[F.lit(c) for c in sorted(cutoffs)]), lambda c: c >= F.col("lo"))).alias("cutoff"))
    w = Window.partitionBy("wallet").orderBy("cutoff")
    j = grid.join(n, ["wallet", "cutoff"], "left").join(new, ["wallet", "cutoff"], "left")
    return j.select("wallet", "cutoff", F.sum(F.coalesce("n", F.lit(0))).over(w).alias("n_trades"), F.sum(F.coalesce("k", F.lit(0))).over(w).alias("n_cps"))


def optimal_window(sides: DataFrame, key: str, hours: tuple[int, ...], least: int = 50) -> DataFrame:
    """The shortest window before a key's last trade with ``least`` trades, else the longest."""
    r = sides.groupBy(key).agg(F.max("ts").alias("ref"))
    age = F.unix_micros("ref") - F.unix_micros("ts")
    c = sides.join(r, key).groupBy(key).agg(*[F.count_if(age < h * 3_600_000_000).alias(f"n{h}") for h in hours])
    pick = F.lit(hours[-1])
    for h in reversed(hours):
        pick = F.when(F.col(f"n{h}") >= least, F.lit(h)).otherwise(pick)
    return c.select(key, pick.alias("window_h"))
