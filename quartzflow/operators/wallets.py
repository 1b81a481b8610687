"""Features of wallets and pairs from the wallet-side table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ORDER = ("ts", "trade_id", "side")


def _amount() -> Column:
    return F.coalesce(F.col("amount"), F.lit(0).cast("decimal(19,7)"))


def _num(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def _corr(x: Column, y: Column) -> Column:
    """Pearson correlation; null without spread."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def trade_pattern(sides: DataFrame) -> DataFrame:
    """Concentration on the largest counterparty, share of self-trades, spread of volume over counterparties."""
    # Per counterparty first: a hot wallet shrinks map-side to its counterparties.
    per = sides.groupBy("wallet", "cp").agg(F.sum(_amount()).alias("v"), F.count("*").alias("n"), F.count_if(F.col("wallet") == F.col("cp")).alias("own"))
    known = F.when(F.col("cp").isNotNull(), _num("v"))
    g = per.groupBy("wallet").agg(
        F.sum("n").alias("n_trades"),
        F.sum("v").alias("volume"),
        F.max(F.when(F.col("cp").isNotNull(), F.col("v"))).alias("top"),
        F.sum("own").alias("own"),
        F.count("cp").alias("n_cp"),
        F.avg(known).alias("mean"),
        F.avg(known * known).alias("square"),
    )
    var = F.greatest(F.lit(0.0), F.col("square") - F.col("mean") * F.col("mean"))
    return g.select(
        "wallet",
        "n_trades",
        F.round(F.coalesce(F.try_divide(_num("top"), _num("volume")), F.lit(0.0)), 6).alias("concentration"),
        F.round(F.col("own") / F.col("n_trades"), 6).alias("self_trade_rate"),
        F.round(F.when(F.col("n_cp") < 2, 0.0).otherwise(F.coalesce(F.least(F.lit(1.0), F.try_divide(var, F.col("mean") * F.col("mean"))), F.lit(0.0))), 4).alias("cp_variance"),
    )


def timing(sides: DataFrame) -> DataFrame:
    """Volume per counter account, minutes with several trades, share of trades in the night hours."""
    per = sides.groupBy("wallet", F.date_trunc("minute", "ts").alias("m")).agg(F.count("*").alias("n"), F.sum(_amount()).alias("v"), F.count_if(F.hour("ts") < 5).alias("night"))
    g = per.groupBy("wallet").agg(F.sum("n").alias("n"), F.sum("v").alias("v"), F.sum("night").alias("night"), F.count("*").alias("minutes"), F.count_if(F.col("n") > 1).alias("busy"))
    cps = sides.groupBy("wallet").agg(F.count_distinct("counter").alias("k"))
    return g.join(cps, "wallet").select(
        "wallet",
        F.round(F.coalesce(F.try_divide(_num("v"), _num("k")), F.lit(0.0)), 4).alias("volume_per_counter"),
        F.round(F.col("busy") / F.col("minutes"), 6).alias("intra_minute"),
        F.round(F.col("night") / F.col("n"), 6).alias("off_hours"),
    )


def volume_spikes(sides: DataFrame, rows: int = 10, factor: int = 3) -> DataFrame:
    """Share of trades above ``factor`` times the mean of the last ``rows`` trades, the current one included."""
    w = Window.partitionBy("wallet").orderBy(*ORDER).rowsBetween(-(rows - 1), 0)
    # Sums of decimals: the comparison is exact.
    m = sides.select("wallet", _amount().alias("a"), F.sum(_amount()).over(w).alias("s"), F.count("*").over(w).alias("n"))
    spike = F.col("a") * F.col("n") > F.col("s") * factor
    return m.groupBy("wallet").agg(F.round(F.avg(spike.cast("int")), 6).alias("spike_frequency"))


def inter_arrival(sides: DataFrame) -> DataFrame:
    """Sample variation of the gaps between trades; null with fewer than three trades."""
    w = Window.partitionBy("wallet").orderBy(*ORDER)
    gap = (F.unix_micros("ts") - F.lag(F.unix_micros("ts")).over(w)) / 1e6
    g = sides.select("wallet", gap.alias("gap")).groupBy("wallet").agg(F.stddev_samp("gap").alias("s"), F.avg("gap").alias("m"))
    return g.select("wallet", F.round(F.try_divide("s", "m"), 6).alias("inter_arrival_cv"))


def amount_entropy(sides: DataFrame, most_bins: int = 50) -> DataFrame:
    """Entropy in bits of a histogram of min(50, n) equal bins over the wallet's range, the last bin closed."""
    a = sides.filter(F.col("amount").isNotNull()).select("wallet", _num("amount").alias("a"))
    r = a.groupBy("wallet").agg(F.min("a").alias("lo"), F.max("a").alias("hi"), F.count("*").alias("n"))
    bins = F.least(F.lit(most_bins), F.col("n"))
    b = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(bins - 1, F.floor((F.col("a") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)))
    c = a.join(r, "wallet").groupBy("wallet", "n", b.alias("b")).agg(F.count("*").alias("c"))
    p = F.col("c") / F.col("n")
    return c.groupBy("wallet").agg(F.round(F.abs(-F.sum(p * F.log2(p))), 6).alias("amount_entropy"))


def pair_diversity(sides: DataFrame) -> DataFrame:
    """Pairs, concentration and normalised entropy of volume over pairs."""
    per = sides.groupBy("wallet", "pair").agg(F.sum(_amount()).alias("v"))
    t = per.groupBy("wallet").agg(F.sum("v").alias("t"), F.count("*").alias("k"), F.max("v").alias("m"))
    p = F.try_divide(_num("v"), _num("t"))
    h = per.join(t, "wallet").groupBy("wallet", "k", "m", "t").agg(F.sum(F.when(p > 0, -p * F.log2(p))).alias("h"))
    top = F.coalesce(F.try_divide(_num("m"), _num("t")), F.lit(0.0))
    return h.select("wallet", F.col("k").alias("n_pairs"), F.round(top, 6).alias("pair_concentration"), F.round((1 - top) / F.col("k"), 6).alias("pair_spread"), F.round(F.when(F.col("k") < 2, 0.0).otherwise(F.coalesce("h", F.lit(0.0)) / F.log2(F.col("k").cast("double"))), 6).alias("pair_diversity"))


def net_asset_flow(sides: DataFrame) -> DataFrame:
    """Largest absolute net flow of an asset, counted in the trade's amount on both legs, over the wallet's volume."""
    sign = F.when(F.col("side") == "base", F.lit(1)).otherwise(F.lit(-1))
    legs = F.array(*[F.struct(F.col(asset).alias("asset"), (sign * k * _amount()).cast("decimal(20,7)").alias("x")) for asset, k in (("base_asset", -1), ("counter_asset", 1))])
    per = sides.select("wallet", F.inline(legs)).filter("asset is not null").groupBy("wallet", "asset").agg(F.abs(F.sum("x")).alias("net"))
    top = per.groupBy("wallet").agg(F.max("net").alias("top"))
    gross = sides.groupBy("wallet").agg(F.sum(_amount()).alias("gross"))
    return gross.join(top, "wallet", "left").select("wallet", F.round(F.coalesce(F.try_divide(_num("top"), _num("gross")), F.lit(0.0)), 6).alias("net_flow"))


def first_pairs(sides: DataFrame) -> DataFrame:
    """The first two pairs of each wallet by first trade, ties by name: (wallet, pair, k)."""
    f = sides.groupBy("wallet", "pair").agg(F.min("ts").alias("t"))
    return f.withColumn("k", F.row_number().over(Window.partitionBy("wallet").orderBy("t", "pair"))).filter("k <= 2").select("wallet", "pair", "k")


def pair_overlap(sides: DataFrame) -> DataFrame:
    """Jaccard similarity of the counterparties of a wallet's first two pairs; 0 with one pair."""
    two = first_pairs(sides)
    who = sides.filter(F.col("cp").isNotNull()).join(two, ["wallet", "pair"]).groupBy("wallet", "cp").agg(F.count_distinct("k").alias("both"))
    g = who.groupBy("wallet").agg((F.count_if(F.col("both") == 2) / F.count("*")).alias("j"))
    return sides.select("wallet").distinct().join(g, "wallet", "left").select("wallet", F.round(F.coalesce("j", F.lit(0.0)), 6).alias("pair_overlap"))


def _for_all(sides: DataFrame, g: DataFrame, name: str) -> DataFrame:
    """A row for every wallet: units counted, and the correlation, 0 where units are too few or have no spread."""
    return sides.select("wallet").distinct().join(g, "wallet", "left").select("wallet", F.coalesce("n", F.lit(0)).alias("n"), F.round(F.coalesce("c", F.lit(0.0)), 4).alias(name))


def pair_volume_correlation(sides: DataFrame, unit: str = "minute") -> DataFrame:
    """Correlation of a wallet's volumes on its first two pairs over the time units both have; 0 below two."""
    two = first_pairs(sides)
    v = sides.join(two, ["wallet", "pair"]).groupBy("wallet", F.date_trunc(unit, "ts").alias("m")).agg(*[F.sum(F.when(F.col("k") == k, _amount())).alias(f"v{k}") for k in (1, 2)])
    v = v.filter("v1 is not null and v2 is not null")
    return _for_all(sides, v.groupBy("wallet").agg(F.count("*").alias("n"), _corr(_num("v1"), _num("v2")).alias("c")), "pair_corr")


def venue_features(sides: DataFrame, first: str = "sdex", second: str = "amm") -> DataFrame:
    """Ratio of trades on both venues, net flow, share of the first venue's counterparties met on the second too (the wallet itself is none), overlap in time."""
    a, b = F.col("venue") == first, F.col("venue") == second
    g = sides.groupBy("wallet").agg(
        F.count_if(a).alias("na"),
        F.count_if(b).alias("nb"),
        F.sum(F.when(a, _amount()).when(b, -_amount())).alias("net"),
        *[f(F.when(v, F.col("ts"))).alias(f"{name}{k}") for k, v in (("a", a), ("b", b)) for name, f in (("lo", F.min), ("hi", F.max))],
    )
    per = sides.filter("cp <> wallet").groupBy("wallet", "cp").agg(F.max(a).alias("a"), F.max(b).alias("b"))
    s = per.groupBy("wallet").agg(F.count_if(F.col("a") & F.col("b")).alias("i"), F.count_if("a").alias("u"))
    return g.join(s, "wallet", "left").select(
        "wallet",
        F.round(F.coalesce(F.try_divide(F.col("na"), F.col("nb")), F.lit(0.0)), 6).alias("venue_ratio"),
        F.abs("net").cast("decimal(38,7)").alias("venue_net_flow"),
        F.round(F.coalesce(F.try_divide("i", "u"), F.lit(0.0)), 6).alias("venue_cp_overlap"),
        F.coalesce((F.col("loa") <= F.col("hib")) & (F.col("lob") <= F.col("hia")), F.lit(False)).cast("int").alias("venue_simultaneous"),
    )


def venue_volume_correlation(sides: DataFrame, unit: str = "hour") -> DataFrame:
    """Correlation of volumes on both venues over all units with a trade, missing ones 0; 0 below two or without spread."""
    v = sides.groupBy("wallet", F.date_trunc(unit, "ts").alias("m")).agg(*[F.sum(F.when(F.col("venue") == k, _amount()).otherwise(0)).alias(k) for k in ("sdex", "amm")])
    return _for_all(sides, v.groupBy("wallet").agg(F.count("*").alias("n"), _corr(_num("sdex"), _num("amm")).alias("c")), "venue_corr")


def pair_summary(trades: DataFrame) -> DataFrame:
    """Wallets, trades, self-trade share and volume of each pair."""
    who = trades.select("pair", F.explode(F.array("base", "counter")).alias("w")).filter("w is not null").groupBy("pair").agg(F.count_distinct("w").alias("n_wallets"))
    g = trades.groupBy("pair").agg(F.count("*").alias("n_trades"), F.round(F.avg(F.coalesce(F.col("base") == F.col("counter"), F.lit(False)).cast("int")), 6).alias("self_share"), F.sum(_amount()).cast("decimal(38,7)").alias("volume"))
    return g.join(who, "pair", "left")


def dollar_totals(trades: DataFrame, dollar: str = "USDX") -> DataFrame:
    """Exact volume in dollars of each pair where one leg is the dollar; trades without an amount and without a rate are counted apart."""
    code = lambda c: F.split(c, ":")[0]
    usd = F.when(code("base_asset") == dollar, F.col("amount").cast("decimal(38,13)")).when(code("counter_asset") == dollar, (F.col("amount") * F.col("price")).cast("decimal(38,13)"))
    g = trades.withColumn("usd", usd).groupBy("pair")
    return g.agg(F.count("*").alias("n"), F.count("usd").alias("n_rated"), F.count_if(F.col("amount").isNull()).alias("n_null"), F.count_if(F.col("amount").isNotNull() & F.col("usd").isNull()).alias("n_unrated"), F.round(F.sum("usd"), 2).cast("decimal(38,2)").alias("usd"))


def lifecycle(sides: DataFrame, created: DataFrame, now: Column) -> DataFrame:
    """Age, first and last trade in days before ``now``, active days, and the last day against the 29 days before."""
    day = 86_400_000_000
    ago = F.floor((F.unix_micros(now) - F.unix_micros("ts")) / day)
    per = sides.groupBy("wallet", ago.alias("ago")).agg(F.count("*").alias("n"))
    g = per.groupBy("wallet").agg(F.max("ago").alias("first_ago"), F.min("ago").alias("last_ago"), F.count("*").alias("active_days"), F.sum(F.when(F.col("ago") == 0, F.col("n")).otherwise(0)).alias("today"), F.sum(F.when(F.col("ago").between(1, 29), F.col("n")).otherwise(0)).alias("before"))
    j = g.join(created, "wallet", "left")
    return j.select(
        "wallet",
        F.floor((F.unix_micros(now) - F.unix_micros("created")) / day).alias("age_days"),
        "first_ago",
        "last_ago",
        F.round(F.col("active_days") / (F.col("first_ago") - F.col("last_ago") + 1), 6).alias("active_ratio"),
        F.round(F.coalesce(F.try_divide(F.col("today"), F.col("before") / 29), F.lit(0.0)), 6).alias("burst"),
    )


def bot_fingerprint(effects: DataFrame, sides: DataFrame, created: DataFrame) -> DataFrame:
    """Seconds from creation to the first trust line, variation of gaps (five trades or more), entropy of effect types, confidence."""
    line = effects.filter("effect_type = 'trustline_created'").groupBy("wallet").agg(F.min("created_at").alias("line"))
    e = effects.groupBy("wallet", "effect_type").agg(F.count("*").alias("c"))
    t = e.groupBy("wallet").agg(F.sum("c").alias("t"))
    p = F.col("c") / F.col("t")
    h = e.join(t, "wallet").groupBy("wallet").agg(F.abs(F.sum(-p * F.log2(p))).alias("h"))
    w = Window.partitionBy("wallet").orderBy(*ORDER)
    gap = (F.unix_micros("ts") - F.lag(F.unix_micros("ts")).over(w)) / 1e6
    g = sides.select("wallet", gap.alias("g")).groupBy("wallet").agg(F.count("*").alias("n"), F.stddev_pop("g").alias("s"), F.avg("g").alias("m"))
    j = created.join(line, "wallet", "left").join(h, "wallet", "left").join(g, "wallet", "left")
    latency = (F.unix_micros("line") - F.unix_micros("created")) / 1e6
    cv = F.when(F.col("n") >= 5, F.try_divide("s", "m"))
    known = latency.isNotNull().cast("int") + cv.isNotNull().cast("int") + F.col("h").isNotNull().cast("int")
    return j.select("wallet", F.round(latency, 3).alias("trustline_latency"), F.round(cv, 6).alias("gap_cv"), F.round("h", 6).alias("effect_entropy"), F.when(known == 3, 1.0).when(known == 2, 0.6).otherwise(0.2).alias("confidence"))


def token_velocity(trades: DataFrame, supply: DataFrame, now: Column) -> DataFrame:
    """Volume of the last 1, 24 and 168 hours over the supply of each base asset."""
    age = F.unix_micros(now) - F.unix_micros("ts")
    v = trades.groupBy("base_asset").agg(*[F.sum(F.when(age <= h * 3_600_000_000, _amount()).otherwise(0)).alias(f"v{h}") for h in (1, 24, 168)])
    return v.join(supply, "base_asset").select("base_asset", *[F.round(F.try_divide(_num(f"v{h}"), _num("supply")), 6).alias(f"velocity_{h}h") for h in (1, 24, 168)])


def decimal_report(trades: DataFrame, by: str) -> DataFrame:
    """Exact sums and means to seven places, half to even; nulls skipped."""
    s = trades.groupBy(by).agg(F.sum("amount").alias("total"), F.count("amount").alias("n"), F.sum(F.col("amount").cast("decimal(19,7)") * F.col("price").cast("decimal(19,7)")).alias("weighted"))
    return s.select(by, "n", F.col("total").cast("decimal(38,7)").alias("total"), F.round(_num("total") / F.col("n"), 6).alias("mean"), F.round(F.try_divide(_num("weighted"), _num("total")), 6).alias("weighted_price"))


def cross_wallet_correlation(sides: DataFrame, unit: str = "minute") -> DataFrame:
    """Correlation of volumes with the two most frequent counterparties, missing units 0; ties by name; 0 below two units or without spread."""
    per = sides.filter("cp is not null").groupBy("wallet", "cp").agg(F.count("*").alias("n"))
    two = per.withColumn("k", F.row_number().over(Window.partitionBy("wallet").orderBy(F.desc("n"), "cp"))).filter("k <= 2").drop("n")
    v = sides.join(two, ["wallet", "cp"]).groupBy("wallet", F.date_trunc(unit, "ts").alias("m")).agg(*[F.sum(F.when(F.col("k") == k, _amount()).otherwise(0)).alias(f"v{k}") for k in (1, 2)])
    return _for_all(sides, v.groupBy("wallet").agg(F.count("*").alias("n"), _corr(_num("v1"), _num("v2")).alias("c")), "cross_wallet_corr")


def labels(sides: DataFrame, one: DataFrame, other: DataFrame) -> DataFrame:
    """1 if both signals name the wallet, null if one does; 0 for a busy wallet that none names, else null."""
    g = sides.groupBy("wallet").agg(F.count("*").alias("n"), F.count_distinct("cp").alias("k"))
    j = g.join(one.distinct().withColumn("a", F.lit(1)), "wallet", "left").join(other.distinct().withColumn("b", F.lit(1)), "wallet", "left")
    signals = F.coalesce("a", F.lit(0)) + F.coalesce("b", F.lit(0))
    return j.select("wallet", signals.alias("signals"), F.when(signals == 2, 1).when((signals == 0) & (F.col("n") > 50) & (F.col("k") > 5), 0).alias("label"))


def thin_market(trades: DataFrame, traders: int = 50, depth: int = 1000) -> DataFrame:
    """Pairs with too few traders or too small a volume, and why."""
    s = pair_summary(trades)
    why = F.array_compact(F.array(F.when(F.coalesce("n_wallets", F.lit(0)) < traders, F.lit("few traders")), F.when(F.col("volume") < depth, F.lit("low volume"))))
    return s.select("pair", F.coalesce("n_wallets", F.lit(0)).alias("n_wallets"), (F.size(why) > 0).alias("thin"), F.array_join(why, "; ").alias("reasons"))


def hourly_median(trades: DataFrame, days: int = 30) -> DataFrame:
    """Median trades an hour of each pair over its last ``days`` days, empty hours included."""
    hour = F.unix_timestamp(F.date_trunc("hour", "ts"))
    c = trades.select("pair", (hour / 3600).cast("bigint").alias("h")).groupBy("pair", "h").agg(F.count("*").alias("n"))
    last = c.groupBy("pair").agg(F.max("h").alias("hi"))
    c = c.join(last, "pair").filter(F.col("h") > F.col("hi") - days * 24)
    first = c.groupBy("pair", "hi").agg(F.min("h").alias("lo"))
    grid = first.select("pair", F.explode(F.sequence("lo", "hi")).alias("h"))
    return grid.join(c.select("pair", "h", "n"), ["pair", "h"], "left").groupBy("pair").agg(F.median(F.coalesce("n", F.lit(0))).alias("hourly_median"))
