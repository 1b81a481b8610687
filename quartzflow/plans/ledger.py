"""Queries of the ledger features over the kept trades, and their SQL."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartzflow import session
from quartzflow.functions.ids import account_id, trade_id
from quartzflow.operators import delivery, digits, joins, trades as tr, wallets
from quartzflow.session import table, written


@lru_cache(maxsize=8)
def _kept(app: str, sf: str, files: tuple[str, ...], cleared: int) -> delivery.Deduplicated:
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    return delivery.one_copy_each(spark, f"{sf}/json_trade_0.parquet", trade_id("trade_id"), "delivery_id")


def trades(spark: SparkSession, sf: str) -> DataFrame:
    """Kept copies, flattened. The vectors that name them are written once per table and session."""
    files = tuple(table(spark, sf, "json_trade_0").inputFiles())
    return tr.flat_trades(_kept(spark.sparkContext.applicationId, sf, files, session.cleared).kept)


def sides(spark: SparkSession, sf: str) -> DataFrame:
    return tr.wallet_sides(trades(spark, sf))


def created(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "accounts").select(account_id("account_id").alias("wallet"), F.col("account_created_at").alias("created")).filter("wallet is not null").groupBy("wallet").agg(F.min("created").alias("created"))


def effects(spark: SparkSession, sf: str) -> DataFrame:
    """Effects once each, ids in their one spelling."""
    e = table(spark, sf, "effects").select("effect_id", F.lower(F.btrim("effect_type", F.lit(" \t"))).alias("effect_type"), "created_at", account_id("account").alias("wallet"))
    return e.filter("wallet is not null").groupBy("effect_id").agg(F.min("effect_type").alias("effect_type"), F.min("created_at").alias("created_at"), F.min("wallet").alias("wallet"))


def now(spark: SparkSession, sf: str):
    """Reference time of the queries that would otherwise ask the clock: the last trade."""
    return F.lit(table(spark, sf, "json_trade_0").agg(F.max("ledger_close_time")).head()[0])


# ---- SQL the queries share ------------------------------------------------------------------------------------------

ACC = "nullif(upper(trim({0}, ' ' || chr(9))), '')"
_ASSET = "case when {0} is null or {0}.code is null then null else {0}.code || ':' || coalesce({0}.issuer, 'native') end"
T = (
    "with dd as (select *, lower(trim(trade_id, ' ' || chr(9))) as k, row_number() over (partition by lower(trim(trade_id, ' ' || chr(9))) order by delivery_id) as rn from json_trade_0),"
    f" t as (select nullif(k, '') as trade_id, ledger_close_time at time zone 'UTC' as ts, {ACC.format('base_account')} as base, {ACC.format('counter_account')} as counter,"
    f" {_ASSET.format('base_asset')} as base_asset, {_ASSET.format('counter_asset')} as counter_asset, base_amount as amount, counter_amount, price, asset_pair as pair, split_part(k, '-', 1) as venue"
    " from dd where rn = 1 or coalesce(k, '') = '')"
)
S = T + (
    ", s as (select *, 'base' as side, base as wallet, counter as cp from t where base is not null"
    " union all select *, 'counter', counter, base from t where counter is not null and base is distinct from counter)"
)
_DIG = "case when amount > 0 then cast(regexp_extract(cast(amount as varchar), '[1-9]') as int) end"


def _metrics_sql(counts: dict[int, str], expected: dict[int, float]) -> dict[str, str]:
    n = "(" + " + ".join(counts.values()) + ")"
    o = {d: f"({c}::double / nullif({n}, 0))" for d, c in counts.items()}
    z = ", ".join(f"greatest(0, (abs({o[d]} - {p!r}) - 1.0::double / (2 * nullif({n}, 0))) / sqrt({p * (1 - p)!r} / nullif({n}, 0)))" for d, p in expected.items())
    return {
        "n": n,
        "chi2": f"case when {n} > 0 then {n} * (" + " + ".join(f"({o[d]} - {p!r}) * ({o[d]} - {p!r}) / {p!r}" for d, p in expected.items()) + ") end",
        "mad": f"case when {n} > 0 then (" + " + ".join(f"abs({o[d]} - {p!r})" for d, p in expected.items()) + f") / {len(expected)} end",
        "z_max": f"case when {n} > 0 then greatest({z}) end",
    }


def _counts_sql(expected, cond: str = "") -> str:
    return ", ".join(f"count(*) filter (d = {k}{cond}) as c{k}" for k in expected)


_FIRST = _metrics_sql({k: f"c{k}" for k in digits.FIRST}, digits.FIRST)
_SECOND = _metrics_sql({k: f"c{k}" for k in digits.SECOND}, digits.SECOND)


def _round(m: dict[str, str]) -> str:
    return f"cast({m['n']} as bigint) as n, " + ", ".join(f"round({m[c]}, 6) as {c}" for c in ("chi2", "mad", "z_max"))


def _windows_sql() -> str:
    parts = []
    for h in digits.WINDOW_HOURS:
        m = {k: (v if k == "n" else f"case when {_FIRST['n']} >= {digits.MIN_TRADES} then {v} end") for k, v in _FIRST.items()}
        parts.append(
            f"select wallet, {h} as window_h, {_round(m)}, coalesce({m['mad']} > {digits.NONCONFORMING}, false) as nonconforming from"
            f" (select j.wallet, {_counts_sql(digits.FIRST, f' and ts > ref - interval {h} hour')} from j group by 1)"
        )
    return S + f", r as (select wallet, max(ts) as ref from s group by 1), j as (select s.wallet, ts, ref, {_DIG} as d from s join r on s.wallet = r.wallet) " + " union all ".join(parts)


# ---- queries --------------------------------------------------------------------------------------------------------


def trades_flat(spark, sf):
    t = trades(spark, sf)
    return t.withColumn("ts", F.unix_micros("ts"))


def pair_scan(spark, sf):
    """One pair from a start on; both filters reach the scan of the kept trades."""
    return trades(spark, sf).filter((F.col("base_asset").startswith("USDX:")) & (F.col("ts") >= F.lit("2024-03-01").cast("timestamp"))).select("trade_id", "pair", "amount")


def watched_pairs(spark, sf):
    """All pairs of the watched codes but the native one against itself."""
    return trades(spark, sf).filter(F.split("base_asset", ":")[0].isin("USDX", "EURX") & (F.col("base_asset") != F.col("counter_asset"))).groupBy("pair").agg(F.count("*").alias("n"))


def amm_trades(spark, sf):
    """Pool trades with the ratio of the amounts; an absent account is an empty string."""
    t = trades(spark, sf).filter("venue = 'amm'")
    return t.select("trade_id", F.coalesce("counter", F.lit("")).alias("counter"), F.round(F.coalesce(F.try_divide(F.col("counter_amount").cast("double"), F.col("amount").cast("double")), F.lit(0.0)), 4).alias("ratio"))


def canonical_pairs(spark, sf):
    t = trades(spark, sf).select(tr.canonical_pair(F.col("base_asset"), F.col("counter_asset")).alias("pair_id"))
    return t.groupBy("pair_id").agg(F.count("*").alias("n"))


def asset_classes(spark, sf):
    """Stable if a leg is, native if both legs are the native asset, else volatile."""
    stable = lambda c: F.split(c, ":")[0].isin("USDX", "EURX")
    kind = F.when(stable("base_asset") | stable("counter_asset"), "stablecoin").when((F.col("base_asset") == "XLM:native") & (F.col("counter_asset") == "XLM:native"), "native").otherwise("volatile")
    return trades(spark, sf).groupBy(kind.alias("class")).agg(F.count("*").alias("n"), F.sum("amount").cast("decimal(38,7)").alias("volume"))


def trade_validation(spark, sf):
    return tr.validated(trades(spark, sf)).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def wallet_side_counts(spark, sf):
    return sides(spark, sf).groupBy("wallet", "side").agg(F.count("*").alias("n"))


def first_activity(spark, sf):
    """Earliest creation effect of each account."""
    return effects(spark, sf).filter("effect_type = 'account_created'").groupBy("wallet").agg(F.unix_micros(F.min("created_at")).alias("created"))


def metadata_events(spark, sf):
    """Effects of the kinds that change an account's metadata, with a well-formed account."""
    e = effects(spark, sf).filter(F.col("effect_type").isin("account_created", "account_removed", "account_home_domain_updated", "signer_updated") & F.col("wallet").rlike("^G[A-Z2-7]{55}$"))
    return e.groupBy("effect_type").agg(F.count("*").alias("n"))


def digit_distribution(spark, sf):
    d = digits.digit_counts(trades(spark, sf), ["pair"])
    n = sum((F.col(f"c{k}") for k in digits.FIRST), F.lit(0))
    return d.select("pair", *[F.round(F.coalesce(F.try_divide(F.col(f"c{k}"), n), F.lit(0.0)), 6).alias(f"p{k}") for k in digits.FIRST])


def digit_windows(spark, sf):
    return digits.windowed_metrics(sides(spark, sf))


def digit_pair_metrics(spark, sf):
    return digits.overall_metrics(trades(spark, sf), ["pair"])


def second_digit_metrics(spark, sf):
    return digits.overall_metrics(trades(spark, sf), ["pair"], second=True)


def log_digit_chi(spark, sf):
    return digits.log_digit_metrics(trades(spark, sf), ["pair"])


def class_baseline(spark, sf):
    return digits.class_baseline(trades(spark, sf), "venue")


def pair_mad_dispersion(spark, sf):
    """Population deviation over a wallet's pairs of their first-digit MAD, of pairs with 20 trades or more; 0 below two."""
    m = digits.digit_counts(sides(spark, sf), ["wallet", "pair"])
    n = sum((F.col(f"c{k}") for k in digits.FIRST), F.lit(0))
    mad = digits.metrics({k: F.col(f"c{k}") for k in digits.FIRST}, digits.FIRST)["mad"]
    return m.groupBy("wallet").agg(F.round(F.coalesce(F.stddev_pop(F.when(n >= digits.MIN_TRADES, mad)), F.lit(0.0)), 6).alias("mad_dispersion"))


def digit_discrepancy(spark, sf):
    """Trades whose first digit by floating-point division differs from the exact one."""
    t = trades(spark, sf).filter("amount > 0").withColumn("x", F.col("amount").cast("double"))
    flt = F.floor(F.col("x") / F.pow(F.lit(10.0), F.floor(F.log10("x")))).cast("int")
    return t.groupBy("venue").agg(F.count("*").alias("n"), F.count_if(flt != digits.leading_digit(F.col("amount"))).alias("n_differ"))


def trade_pattern(spark, sf):
    return wallets.trade_pattern(sides(spark, sf))


def trade_timing(spark, sf):
    return wallets.timing(sides(spark, sf))


def volume_spike_frequency(spark, sf):
    return wallets.volume_spikes(sides(spark, sf))


def inter_arrival_cv(spark, sf):
    return wallets.inter_arrival(sides(spark, sf))


def amount_entropy(spark, sf):
    return wallets.amount_entropy(sides(spark, sf))


def pair_diversity(spark, sf):
    return wallets.pair_diversity(sides(spark, sf))


def net_asset_flow(spark, sf):
    return wallets.net_asset_flow(sides(spark, sf))


def pair_counterparty_jaccard(spark, sf):
    return wallets.pair_overlap(sides(spark, sf))


def pair_volume_corr(spark, sf):
    return wallets.pair_volume_correlation(sides(spark, sf))


def venue_features(spark, sf):
    return wallets.venue_features(sides(spark, sf))


def venue_volume_corr(spark, sf):
    return wallets.venue_volume_correlation(sides(spark, sf))


def cross_wallet_volume_corr(spark, sf):
    return wallets.cross_wallet_correlation(sides(spark, sf))


def pair_summary(spark, sf):
    return wallets.pair_summary(trades(spark, sf))


def lifecycle_features(spark, sf):
    return wallets.lifecycle(sides(spark, sf), created(spark, sf), now(spark, sf))


def bot_fingerprint(spark, sf):
    return wallets.bot_fingerprint(effects(spark, sf), sides(spark, sf), created(spark, sf))


def token_velocity(spark, sf):
    """Supply stands for: everything ever traded of the asset."""
    t = trades(spark, sf)
    return wallets.token_velocity(t, t.groupBy("base_asset").agg(F.sum("amount").alias("supply")), now(spark, sf))


def decimal_aggregates(spark, sf):
    return wallets.decimal_report(trades(spark, sf), "pair")


def thin_market(spark, sf):
    return wallets.thin_market(trades(spark, sf))


def hourly_trade_median(spark, sf):
    return wallets.hourly_median(trades(spark, sf))


def labelled_wallets(spark, sf):
    """Both signals (campaigns on file, self-trades) or none."""
    known = table(spark, sf, "known_manipulation_events").select(account_id("wallet").alias("wallet")).filter("wallet is not null")
    s = sides(spark, sf)
    return wallets.labels(s, known, s.filter("base = counter").select("wallet"))


def cross_pair_anomalies(spark, sf):
    """Pairs whose volume is above three times the median of all pairs."""
    v = trades(spark, sf).groupBy("pair").agg(F.sum("amount").cast("double").alias("v"))
    m = v.agg(F.median("v").alias("m"))
    return v.crossJoin(F.broadcast(m)).select("pair", F.coalesce(F.col("v") > 3 * F.col("m"), F.lit(False)).alias("anomalous"))  # the median is one row


def feature_matrix(spark, sf):
    """One row for every wallet with all its features, 0 where one is undefined.

    The wallet sides are written once; every group of features reads its columns of them and meets the others by wallet.
    """
    s = written(sides(spark, sf), "sides")
    windows = digits.windowed_metrics(s)
    # Five rows a wallet become one.
    mads = windows.groupBy("wallet").agg(*[F.max(F.when(F.col("window_h") == h, F.col(m))).alias(f"{m}_{h}h") for h in digits.WINDOW_HOURS for m in ("chi2", "mad", "z_max")])
    frames = [
        wallets.trade_pattern(s), wallets.timing(s), wallets.volume_spikes(s), wallets.inter_arrival(s), wallets.amount_entropy(s), wallets.pair_diversity(s), wallets.net_asset_flow(s), wallets.pair_overlap(s),
        wallets.pair_volume_correlation(s).drop("n"), wallets.venue_features(s), wallets.venue_volume_correlation(s).drop("n"), wallets.cross_wallet_correlation(s).drop("n"), wallets.lifecycle(s, created(spark, sf), now(spark, sf)),
        joins.synchrony(s, 30).drop("n"), joins.venue_synchrony(s, 10), mads,
    ]
    out = s.select("wallet").distinct()
    for f in frames:
        out = out.join(f, "wallet", "left")
    return out.na.fill(0).select("wallet", *[F.coalesce(c, F.lit(0)).alias(c) for c in out.columns if c != "wallet"])


def flag_scores(spark, sf):
    """Without a model a wallet is flagged if the first digits of any window don't conform."""
    w = digits.windowed_metrics(sides(spark, sf))
    return w.groupBy("wallet").agg(F.bool_or("nonconforming").alias("flagged"), F.max("mad").alias("mad_max"))


QUERIES = {
    f.__name__: f
    for f in (
        feature_matrix, flag_scores, trades_flat, pair_scan, watched_pairs, amm_trades, canonical_pairs, asset_classes, trade_validation, wallet_side_counts, first_activity, metadata_events,
        digit_distribution, digit_windows, digit_pair_metrics, second_digit_metrics, log_digit_chi, class_baseline, pair_mad_dispersion, digit_discrepancy,
        trade_pattern, trade_timing, volume_spike_frequency, inter_arrival_cv, amount_entropy, pair_diversity, net_asset_flow, pair_counterparty_jaccard, pair_volume_corr,
        venue_features, venue_volume_corr, cross_wallet_volume_corr, pair_summary, lifecycle_features, bot_fingerprint, token_velocity, decimal_aggregates, thin_market,
        hourly_trade_median, labelled_wallets, cross_pair_anomalies,
    )
}

_VALID = {
    "trade_id": "trade_id is null",
    "base": "not coalesce(regexp_full_match(base, 'G[A-Z2-7]{55}'), false)",
    "counter": "not coalesce(regexp_full_match(counter, 'G[A-Z2-7]{55}'), false)",
    "amount": "not coalesce(amount > 0, false)",
    "price": "not coalesce(price > 0, false)",
    "time": "ts is null",
}
E_SQL = f", e as (select effect_id, min(lower(trim(effect_type, ' ' || chr(9)))) as effect_type, min(created_at at time zone 'UTC') as created_at, min({ACC.format('account')}) as wallet from effects where {ACC.format('account')} is not null group by 1)"
C_SQL = f", cr as (select {ACC.format('account_id')} as wallet, min(account_created_at at time zone 'UTC') as created from accounts where {ACC.format('account_id')} is not null group by 1)"
_V = "coalesce(amount, 0)"
_F2 = (
    ", f as (select wallet, pair, min(ts) as t0 from s group by 1, 2), f2 as (select * from (select *, row_number() over (partition by wallet order by t0, pair) as k from f) where k <= 2)"
)
_CORR = (
    ", g as (select wallet, count(*) as n, case when count(*) > 1 then corr(a::double, b::double) end as c from v group by 1)"
    " select w.wallet, coalesce(n, 0) as n, round(case when c is null or isnan(c) then 0 else c end, 4) as {} from (select distinct wallet from s) w left join g on w.wallet = g.wallet"
)
_ORD = "order by ts, trade_id, side"
SQL = {
    "trades_flat": T + " select * replace (epoch_us(ts) as ts) from t",
    "pair_scan": T + " select trade_id, pair, amount from t where base_asset like 'USDX:%' and ts >= timestamp '2024-03-01'",
    "watched_pairs": T + " select pair, count(*) as n from t where split_part(base_asset, ':', 1) in ('USDX', 'EURX') and base_asset <> counter_asset group by 1",
    "amm_trades": T + " select trade_id, coalesce(counter, '') as counter, round(coalesce(counter_amount::double / nullif(amount::double, 0), 0), 4) as ratio from t where venue = 'amm'",
    "canonical_pairs": T + " select concat_ws('/', least(base_asset, counter_asset), greatest(base_asset, counter_asset)) as pair_id, count(*) as n from t group by 1",
    "asset_classes": T
    + " select case when split_part(base_asset, ':', 1) in ('USDX', 'EURX') or split_part(counter_asset, ':', 1) in ('USDX', 'EURX') then 'stablecoin' when base_asset = 'XLM:native' and counter_asset = 'XLM:native' then 'native' else 'volatile' end as class, count(*) as n, cast(sum(amount) as decimal(38,7)) as volume from t group by 1",
    "trade_validation": T + " select reason, count(*) as n from (" + " union all ".join(f"select '{k}' as reason from t where {v}" for k, v in _VALID.items()) + ") group by 1",
    "wallet_side_counts": S + " select wallet, side, count(*) as n from s group by 1, 2",
    "first_activity": "with" + E_SQL[1:] + " select wallet, epoch_us(min(created_at)) as created from e where effect_type = 'account_created' group by 1",
    "metadata_events": "with" + E_SQL[1:] + " select effect_type, count(*) as n from e where effect_type in ('account_created', 'account_removed', 'account_home_domain_updated', 'signer_updated') and regexp_full_match(wallet, 'G[A-Z2-7]{55}') group by 1",
    "digit_distribution": T + f", c as (select pair, {_counts_sql(digits.FIRST)} from (select pair, {_DIG} as d from t) group by 1) select pair, " + ", ".join(f"round(coalesce(c{k}::double / nullif({_FIRST['n']}, 0), 0), 6) as p{k}" for k in digits.FIRST) + " from c",
    "digit_windows": _windows_sql(),
    "digit_pair_metrics": T + f" select pair, {_round(_FIRST)} from (select pair, {_counts_sql(digits.FIRST)} from (select pair, {_DIG} as d from t) group by 1)",
    "second_digit_metrics": T
    + f" select pair, {_round(_SECOND)} from (select pair, {_counts_sql(digits.SECOND)} from (select pair, case when amount > 0 then coalesce(try_cast(nullif(regexp_extract(cast(amount as varchar), '[1-9]\\.?([0-9])', 1), '') as int), 0) end as d from t) group by 1)",
    "log_digit_chi": T
    + ", l as (select pair, log10(amount::double) as l from t where amount > 0), m as (select pair, min(l) as m from l group by 1),"
    f" c as (select l.pair, {_counts_sql(digits.FIRST).replace('d =', '''cast(regexp_extract(cast(cast(round(l - m + 1, 7) as decimal(19,7)) as varchar), '[1-9]') as int) =''')} from l join m on l.pair = m.pair group by 1)"
    f" select pair, round({_FIRST['chi2']}, 6) as chi2_log from c",
    "class_baseline": T + f", x as (select venue, {_DIG} as digit from t), y as (select venue, count(*) as total from x where digit is not null group by 1 having count(*) >= 30) select x.venue, digit, count(*) as n, round(count(*)::double / total, 6) as share from x join y on x.venue = y.venue where digit is not null group by 1, 2, total",
    "pair_mad_dispersion": S
    + f", c as (select wallet, pair, {_counts_sql(digits.FIRST)} from (select wallet, pair, {_DIG} as d from s) group by 1, 2) select wallet, round(coalesce(stddev_pop(case when {_FIRST['n']} >= 20 then {_FIRST['mad']} end), 0), 6) as mad_dispersion from c group by 1",
    "digit_discrepancy": T + f" select venue, count(*) as n, count(*) filter (floor(amount::double / pow(10, floor(log10(amount::double)))) <> {_DIG}) as n_differ from t where amount > 0 group by 1",
    "trade_pattern": S
    + f", p as (select wallet, cp, sum({_V}) as v, count(*) as n, count(*) filter (wallet = cp) as own from s group by 1, 2),"
    " g as (select wallet, sum(n) as n, sum(v) as vol, max(v) filter (cp is not null) as top, sum(own) as own, count(cp) as k, avg(v::double) filter (cp is not null) as m, avg(v::double * v::double) filter (cp is not null) as sq from p group by 1)"
    " select wallet, cast(n as bigint) as n_trades, round(coalesce(top::double / nullif(vol::double, 0), 0), 6) as concentration, round(own::double / n, 6) as self_trade_rate,"
    " round(case when k < 2 then 0 else coalesce(least(1, greatest(0, sq - m * m) / nullif(m * m, 0)), 0) end, 4) as cp_variance from g",
    "trade_timing": S
    + f", p as (select wallet, date_trunc('minute', ts) as m, count(*) as n, sum({_V}) as v, count(*) filter (extract(hour from ts) < 5) as night from s group by 1, 2),"
    " g as (select wallet, sum(n) as n, sum(v) as v, sum(night) as night, count(*) as minutes, count(*) filter (n > 1) as busy from p group by 1), k as (select wallet, count(distinct counter) as k from s group by 1)"
    " select g.wallet, round(coalesce(v::double / nullif(k::double, 0), 0), 4) as volume_per_counter, round(busy::double / minutes, 6) as intra_minute, round(night::double / n, 6) as off_hours from g join k on g.wallet = k.wallet",
    "volume_spike_frequency": S + f", m as (select wallet, {_V} as a, sum({_V}) over w as s, count(*) over w as n from s window w as (partition by wallet {_ORD} rows 9 preceding)) select wallet, round(avg((a * n > s * 3)::int), 6) as spike_frequency from m group by 1",
    "inter_arrival_cv": S + f", g as (select wallet, (epoch_us(ts) - lag(epoch_us(ts)) over (partition by wallet {_ORD}))::double / 1e6 as g from s) select wallet, round(stddev_samp(g) / nullif(avg(g), 0), 6) as inter_arrival_cv from g group by 1",
    "amount_entropy": S
    + ", a as (select wallet, amount::double as a from s where amount is not null), r as (select wallet, min(a) as lo, max(a) as hi, count(*) as n from a group by 1),"
    " c as (select a.wallet, n, case when hi = lo then 0 else least(least(50, n) - 1, floor((a - lo) / (hi - lo) * least(50, n))) end as b, count(*) as c from a join r on a.wallet = r.wallet group by 1, 2, 3)"
    " select wallet, round(abs(-sum(c::double / n * log2(c::double / n))), 6) as amount_entropy from c group by 1",
    "pair_diversity": S
    + f", p as (select wallet, pair, sum({_V}) as v from s group by 1, 2), q as (select wallet, sum(v) as t, count(*) as k, max(v) as m from p group by 1),"
    " h as (select q.wallet, k, m, t, sum(case when v > 0 then -(v::double / t::double) * log2(v::double / t::double) end) as h from p join q on p.wallet = q.wallet group by 1, 2, 3, 4)"
    " select wallet, k as n_pairs, round(coalesce(m::double / nullif(t::double, 0), 0), 6) as pair_concentration, round((1 - coalesce(m::double / nullif(t::double, 0), 0)) / k, 6) as pair_spread, round(case when k < 2 then 0 else coalesce(h, 0) / log2(k::double) end, 6) as pair_diversity from h",
    "net_asset_flow": T
    + ", f as (select base as wallet, base_asset as asset, -coalesce(amount, 0) as x from t union all select base, counter_asset, coalesce(amount, 0) from t union all select counter, base_asset, coalesce(amount, 0) from t where base is distinct from counter union all select counter, counter_asset, -coalesce(amount, 0) from t where base is distinct from counter),"
    " p as (select wallet, asset, abs(sum(x)) as net from f where wallet is not null and asset is not null group by 1, 2), n as (select wallet, max(net) as net from p group by 1),"
    " g as (select wallet, sum(coalesce(amount, 0)) as gross from (select base as wallet, amount from t union all select counter, amount from t where base is distinct from counter) where wallet is not null group by 1)"
    " select g.wallet, round(coalesce(net::double / nullif(gross::double, 0), 0), 6) as net_flow from g left join n on g.wallet = n.wallet",
    "pair_counterparty_jaccard": S
    + _F2
    + ", b as (select s.wallet, cp, count(distinct k) as n from s join f2 on s.wallet = f2.wallet and s.pair = f2.pair where cp is not null group by 1, 2), j as (select wallet, count(*) filter (n = 2)::double / count(*) as j from b group by 1)"
    " select w.wallet, round(coalesce(j, 0), 6) as pair_overlap from (select distinct wallet from s) w left join j on w.wallet = j.wallet",
    "pair_volume_corr": S
    + _F2
    + f", v as (select s.wallet, date_trunc('minute', ts) as m, sum({_V}) filter (k = 1) as a, sum({_V}) filter (k = 2) as b from s join f2 on s.wallet = f2.wallet and s.pair = f2.pair group by 1, 2 having a is not null and b is not null)"
    + _CORR.format("pair_corr"),
    "venue_features": S
    + f", g as (select wallet, count(*) filter (venue = 'sdex') as na, count(*) filter (venue = 'amm') as nb, sum(case venue when 'sdex' then {_V} when 'amm' then -{_V} end) as net,"
    " min(ts) filter (venue = 'sdex') as loa, max(ts) filter (venue = 'sdex') as hia, min(ts) filter (venue = 'amm') as lob, max(ts) filter (venue = 'amm') as hib from s group by 1),"
    " p as (select wallet, cp, bool_or(venue = 'sdex') as a, bool_or(venue = 'amm') as b from s where cp is not null group by 1, 2), x as (select wallet, count(*) filter (a and b) as i, count(*) filter (a) as u from p where cp <> wallet group by 1)"
    " select g.wallet, round(coalesce(na::double / nullif(nb, 0), 0), 6) as venue_ratio, cast(abs(net) as decimal(38,7)) as venue_net_flow, round(coalesce(i::double / nullif(u, 0), 0), 6) as venue_cp_overlap, coalesce(loa <= hib and lob <= hia, false)::int as venue_simultaneous from g left join x on g.wallet = x.wallet",
    "venue_volume_corr": S
    + f", v as (select wallet, date_trunc('hour', ts) as m, sum(case when venue = 'sdex' then {_V} else 0 end) as a, sum(case when venue = 'amm' then {_V} else 0 end) as b from s group by 1, 2)"
    + _CORR.format("venue_corr"),
    "cross_wallet_volume_corr": S
    + ", p as (select wallet, cp, count(*) as n from s where cp is not null group by 1, 2), p2 as (select * from (select *, row_number() over (partition by wallet order by n desc, cp) as k from p) where k <= 2),"
    f" v as (select s.wallet, date_trunc('minute', ts) as m, sum(case when k = 1 then {_V} else 0 end) as a, sum(case when k = 2 then {_V} else 0 end) as b from s join p2 on s.wallet = p2.wallet and s.cp = p2.cp group by 1, 2)"
    + _CORR.format("cross_wallet_corr"),
    "pair_summary": T
    + f", w as (select pair, count(distinct w) as n_wallets from (select pair, base as w from t union all select pair, counter from t) where w is not null group by 1), g as (select pair, count(*) as n_trades, round(avg(coalesce(base = counter, false)::int), 6) as self_share, cast(sum({_V}) as decimal(38,7)) as volume from t group by 1)"
    " select g.*, n_wallets from g left join w on g.pair = w.pair",
    "lifecycle_features": S
    + C_SQL
    + ", nw as (select epoch_us(max(ledger_close_time)) as x from json_trade_0), a as (select wallet, floor((x - epoch_us(ts)) / 86400000000)::bigint as ago from s, nw), p as (select wallet, ago, count(*) as n from a group by 1, 2),"
    " g as (select wallet, max(ago) as first_ago, min(ago) as last_ago, count(*) as d, sum(case when ago = 0 then n else 0 end) as today, sum(case when ago between 1 and 29 then n else 0 end) as before from p group by 1)"
    " select g.wallet, cast(floor((x - epoch_us(created)) / 86400000000) as bigint) as age_days, first_ago, last_ago, round(d::double / (first_ago - last_ago + 1), 6) as active_ratio, round(coalesce(today::double / nullif(before::double / 29, 0), 0), 6) as burst from g cross join nw left join cr on g.wallet = cr.wallet",
    "bot_fingerprint": S
    + E_SQL
    + C_SQL
    + ", ln as (select wallet, min(created_at) as ln from e where effect_type = 'trustline_created' group by 1), ec as (select wallet, effect_type, count(*) as c from e group by 1, 2), et as (select wallet, sum(c) as t from ec group by 1),"
    " h as (select ec.wallet, abs(sum(-(c::double / t) * log2(c::double / t))) as h from ec join et on ec.wallet = et.wallet group by 1),"
    f" gp as (select wallet, (epoch_us(ts) - lag(epoch_us(ts)) over (partition by wallet {_ORD}))::double / 1e6 as g from s), gs as (select wallet, count(*) as n, stddev_pop(g) as sd, avg(g) as m from gp group by 1),"
    " j as (select cr.wallet, (epoch_us(ln) - epoch_us(created))::double / 1e6 as lat, case when n >= 5 then sd / nullif(m, 0) end as cv, h from cr left join ln on cr.wallet = ln.wallet left join h on cr.wallet = h.wallet left join gs on cr.wallet = gs.wallet)"
    " select wallet, round(lat, 3) as trustline_latency, round(cv, 6) as gap_cv, round(h, 6) as effect_entropy, case (lat is not null)::int + (cv is not null)::int + (h is not null)::int when 3 then 1.0 when 2 then 0.6 else 0.2 end::double as confidence from j",
    "token_velocity": T
    + ", nw as (select max(ledger_close_time at time zone 'UTC') as x from json_trade_0) select base_asset, "
    + ", ".join(f"round(sum(case when ts >= x - interval {h} hour then {_V} else 0 end)::double / nullif(sum(amount)::double, 0), 6) as velocity_{h}h" for h in (1, 24, 168))
    + " from t, nw where base_asset is not null group by 1",
    "decimal_aggregates": T
    + " select pair, count(amount) as n, cast(sum(amount) as decimal(38,7)) as total, round(sum(amount)::double / count(amount), 6) as mean, round(sum(cast(amount as decimal(19,7))::decimal(24,7) * price::decimal(14,7))::double / nullif(sum(amount)::double, 0), 6) as weighted_price from t group by 1",
    "hourly_trade_median": T
    + ", c as (select pair, floor(epoch_us(ts) / 3600000000)::bigint as h, count(*) as n from t group by 1, 2), l as (select pair, max(h) as hi from c group by 1), d as (select c.*, hi from c join l on c.pair = l.pair where h > hi - 720),"
    " g as (select pair, unnest(range(min(h), max(h) + 1)) as h from d group by pair) select g.pair, median(coalesce(n, 0))::double as hourly_median from g left join d on g.pair = d.pair and g.h = d.h group by 1",
    "labelled_wallets": S
    + f", k as (select distinct {ACC.format('wallet')} as wallet from known_manipulation_events), o as (select distinct wallet from s where base = counter), g as (select wallet, count(*) as n, count(distinct cp) as c from s group by 1)"
    ", x as (select g.*, (k.wallet is not null)::int + (o.wallet is not null)::int as signals from g left join k on g.wallet = k.wallet left join o on g.wallet = o.wallet)"
    " select wallet, signals, case when signals = 2 then 1 when signals = 0 and n > 50 and c > 5 then 0 end as label from x",
    "cross_pair_anomalies": T + ", v as (select pair, sum(amount)::double as v from t group by 1) select pair, coalesce(v > 3 * (select median(v) from v), false) as anomalous from v",
}
SQL["thin_market"] = (
    SQL["pair_summary"].replace(" select g.*, n_wallets from g left join w on g.pair = w.pair", "")
    + ", q as (select g.pair, coalesce(n_wallets, 0) as n_wallets, volume from g left join w on g.pair = w.pair)"
    " select pair, n_wallets, n_wallets < 50 or coalesce(volume < 1000, false) as thin, concat_ws('; ', case when n_wallets < 50 then 'few traders' end, case when volume < 1000 then 'low volume' end) as reasons from q"
)

_NEAR = (
    "{0}, m as (select wallet, venue, max((venue = 'sdex')::int) over (partition by wallet order by ts range between interval 10 second preceding and interval 10 second following) as x from s)"
    " select wallet, round(avg(x), 6) as venue_synchrony from m where venue = 'amm' group by 1"
).format(S)
_SYNC = S + ", m as (select wallet, (min(pair) over w <> max(pair) over w)::int as x from s where pair is not null window w as (partition by wallet order by ts range between interval 30 second preceding and interval 30 second following)) select wallet, round(avg(x), 6) as pair_synchrony from m group by 1"
_PIVOT = "select wallet, " + ", ".join(f"max({m}) filter (window_h = {h}) as {m}_{h}h" for h in digits.WINDOW_HOURS for m in ("chi2", "mad", "z_max")) + f" from ({SQL['digit_windows']}) group by 1"
_PARTS = [SQL[n] for n in ("trade_pattern", "trade_timing", "volume_spike_frequency", "inter_arrival_cv", "amount_entropy", "pair_diversity", "net_asset_flow", "pair_counterparty_jaccard")]
_PARTS += [f"select * exclude (n) from ({SQL[n]})" for n in ("pair_volume_corr", "venue_volume_corr", "cross_wallet_volume_corr")]
_PARTS += [SQL["venue_features"], SQL["lifecycle_features"], _SYNC, _NEAR, _PIVOT]
SQL["feature_matrix"] = "select wallet, coalesce(columns(* exclude (wallet)), 0) from (" + S + " select distinct wallet from s) w " + " ".join(f"left join ({q}) p{k} using (wallet)" for k, q in enumerate(_PARTS))
SQL["flag_scores"] = f"select wallet, bool_or(nonconforming) as flagged, max(mad) as mad_max from ({SQL['digit_windows']}) group by 1"
