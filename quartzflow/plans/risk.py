"""Queries of joins in time, graphs, series, monitoring, scoring and storage, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartzflow.functions import scalar
from quartzflow.functions.ids import account_id
from quartzflow.operators import digits, graphs, joins, monitoring, scoring, series, sketches, wallets
from quartzflow.plans.ledger import ACC, C_SQL, S, T, _counts_sql, _DIG, created, effects, now, sides, trades
from quartzflow.session import scratch_path, table
from quartzflow.sources import storage

MIN = 60_000_000


def funding(spark, sf) -> DataFrame:
    a = table(spark, sf, "accounts").select(account_id("funding_account").alias("src"), account_id("account_id").alias("dst"))
    return a.filter("src is not null and dst is not null").distinct()


def trade_edges(spark, sf) -> DataFrame:
    return trades(spark, sf).filter("base is not null and counter is not null").select(F.col("base").alias("src"), F.col("counter").alias("dst"))


def scored(spark, sf) -> DataFrame:
    """Verdicts with their scores: id, wallet, pair, strategy, score, label, times."""
    return table(spark, sf, "annotation_queue").select("annotation_id", account_id("wallet").alias("wallet"), F.nullif(F.col("asset_pair"), F.lit("")).alias("pair"), "query_strategy", F.col("score").cast("int").alias("score"), F.col("label").cast("int").alias("label"), "selected_at", "annotated_at")


def alerts(spark, sf) -> DataFrame:
    a = scored(spark, sf).filter("wallet is not null and pair is not null and selected_at is not null and score is not null")
    return a.select("wallet", "pair", F.col("selected_at").alias("at"), F.col("query_strategy").alias("detector"), "score")


A = (
    f"with q as (select annotation_id, {ACC.format('wallet')} as wallet, nullif(asset_pair, '') as pair, query_strategy, cast(score as int) as score, cast(label as int) as label, selected_at at time zone 'UTC' as selected_at, annotated_at at time zone 'UTC' as annotated_at from annotation_queue),"
    " al as (select wallet, pair, selected_at as ts, query_strategy as detector, score from q where wallet is not null and pair is not null and selected_at is not null and score is not null)"
)
FND = f"with fe as (select distinct {ACC.format('funding_account')} as src, {ACC.format('account_id')} as dst from accounts where {ACC.format('funding_account')} is not null and {ACC.format('account_id')} is not null)"
TE = T + ", te as (select distinct base as src, counter as dst from t where base is not null and counter is not null and base <> counter), ue as (select distinct least(src, dst) as a, greatest(src, dst) as b from te)"
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---- joins in time --------------------------------------------------------------------------------------------------


@query(
    T
    + ", x as (select * from t where base <> counter and amount > 0 and ts is not null) select f.trade_id, r.trade_id as return_id, f.base, f.counter from x f join x r on f.base = r.counter and f.counter = r.base and f.base_asset = r.base_asset"
    " where r.ts > f.ts and r.ts <= f.ts + interval 30 day and abs(f.amount - r.amount)::double <= greatest(f.amount, r.amount)::double * 0.8"
)
def round_trip_pairs(spark, sf):
    return joins.round_trips(trades(spark, sf), 30 * 24 * 60 * MIN, 0.8)


@query(
    S
    + ", m as (select wallet, (min(pair) over w <> max(pair) over w)::int as x from s where pair is not null window w as (partition by wallet order by ts range between interval 30 second preceding and interval 30 second following)) select wallet, count(*) as n, round(avg(x), 6) as pair_synchrony from m group by 1"
)
def pair_synchrony(spark, sf):
    return joins.synchrony(sides(spark, sf), 30)


@query(
    S
    + ", m as (select wallet, venue, max((venue = 'sdex')::int) over (partition by wallet order by ts range between interval 10 second preceding and interval 10 second following) as x from s) select wallet, round(avg(x), 6) as venue_synchrony from m where venue = 'amm' group by 1"
)
def venue_timing_sync(spark, sf):
    return joins.venue_synchrony(sides(spark, sf), 10)


@query(
    T
    + ", a as (select row_number() over () as id, pair, ts from t where pair is not null and ts is not null), w as (select distinct pair, ts, w from (select pair, ts, base as w from t union all select pair, ts, counter from t) where pair is not null and regexp_full_match(w, 'G[A-Z2-7]{55}')),"
    " m as (select distinct a.id, a.ts, w.w from a join w on a.pair = w.pair and w.ts between a.ts and a.ts + interval 24 hour)"
    " select x.w as src, y.w as dst, count(*) as weight, epoch_us(max(x.ts)) as latest from m x join m y on x.id = y.id and x.w < y.w group by 1, 2"
)
def weighted_co_trade_edges(spark, sf):
    return joins.weighted_co_trades(trades(spark, sf), 24 * 60 * MIN)


@query(
    T
    + " select a.venue, a.base as src, b.base as dst, count(*) as weight from t a join t b on a.pair = b.pair and a.venue = b.venue and a.base <> b.base and b.ts between a.ts - interval 60 second and a.ts"
    " and (b.ts < a.ts or b.trade_id < a.trade_id) group by 1, 2, 3"
)
def coordination_edges(spark, sf):
    return joins.coordination(trades(spark, sf), MIN)


@query(
    S
    + ", a as (select * from s where venue = 'amm' and amount > 0), b as (select * from s where venue = 'sdex' and amount > 0) select a.wallet, b.wallet as other, count(*) as n from a join b on a.wallet <> b.wallet"
    " and b.ts between a.ts - interval 10 minute and a.ts + interval 10 minute and abs(a.amount - b.amount)::double <= greatest(a.amount, b.amount)::double * 0.01 group by 1, 2"
)
def amount_fingerprint_links(spark, sf):
    s = sides(spark, sf).filter("ts is not null")
    return joins.amount_links(s.filter("venue = 'amm'"), s.filter("venue = 'sdex'"), 10 * MIN, 0.01)


@query(
    "with e as (select effect_id, min(lower(trim(effect_type))) as effect_type, min(created_at at time zone 'UTC') as c, min("
    + ACC.format("account")
    + ") as w from effects where "
    + ACC.format("account")
    + " is not null group by 1), "
    + T[5:]
    + ", x as (select w, c, max(effect_type) as effect_type from e group by 1, 2) select t.trade_id, case when r.c >= t.ts - interval 30 day then r.effect_type end as last_effect from (select * from t where base is not null and trade_id is not null) t asof left join x r on t.base = r.w and t.ts >= r.c"
)
def metadata_as_of(spark, sf):
    """Last effect on the base account within 30 days before each trade."""
    e = effects(spark, sf).groupBy("wallet", F.col("created_at").alias("ts")).agg(F.max("effect_type").alias("last_effect"))
    t = trades(spark, sf).filter("base is not null and trade_id is not null").select(F.col("base").alias("wallet"), "ts", "trade_id")
    return joins.as_of(t, e, "wallet", "last_effect", valid_us=30 * 86400 * 1_000_000).select("trade_id", "last_effect")


@query(
    S
    + ", e as (select min(epoch_us(ts)) as lo, ceil((max(epoch_us(ts)) - min(epoch_us(ts))) / 3600000000)::bigint as bins from s where venue in ('amm', 'sdex')),"
    " h as (select wallet, venue, least((epoch_us(ts) - lo) // 3600000000, bins - 1) as b, count(*)::double as c from s, e where venue in ('amm', 'sdex') group by 1, 2, 3), o as (select wallet, venue, sum(c) as s1, sum(c * c) as s2 from h group by 1, 2),"
    " j as (select x.wallet, y.wallet as other, count(*) as n, sum(x.c * y.c) as xy from h x join h y on x.b = y.b and x.wallet <> y.wallet where x.venue = 'amm' and y.venue = 'sdex' group by 1, 2),"
    " r as (select j.wallet, j.other, n, (bins * xy - a.s1 * b.s1) / sqrt((bins * a.s2 - a.s1 * a.s1) * (bins * b.s2 - b.s1 * b.s1)) as r from j join o a on a.wallet = j.wallet and a.venue = 'amm' join o b on b.wallet = j.other and b.venue = 'sdex', e)"
    " select wallet, other, n, round(r, 4) as r from r where r >= 0.8"
)
def timing_correlation_links(spark, sf):
    s = sides(spark, sf)
    return joins.timing_correlation(s.filter("venue = 'amm'"), s.filter("venue = 'sdex'"))


@query(
    A
    + f", w as (select distinct base as wallet from ({T} select * from t) where base is not null), p as (select wallet, max(score) as score from q where wallet is not null group by 1)"
    " select issue, count(*) as n from (select 'unscored' as issue from w where wallet not in (select wallet from p) union all select 'orphan score' from p where wallet not in (select wallet from w) union all select 'bad score' from p where score is null or score not between 0 and 100) group by 1"
)
def reconcile_wallets(spark, sf):
    p = scored(spark, sf).filter("wallet is not null").groupBy("wallet").agg(F.max("score").alias("score"))
    return monitoring.reconcile(trades(spark, sf).filter("base is not null").select(F.col("base").alias("wallet")), p)


# ---- graphs ---------------------------------------------------------------------------------------------------------


@query(
    FND.replace("with fe", "with recursive fe", 1)
    + ", r as (select dst as node, src as ancestor, 1 as hops from fe where src <> dst union select r.node, fe.src, hops + 1 from r join fe on fe.dst = r.ancestor where hops < 4 and fe.src <> fe.dst) select node, ancestor, min(hops) as hops from r where node <> ancestor group by 1, 2"
)
def funding_ancestors(spark, sf):
    return graphs.ancestors(funding(spark, sf))


@query(
    FND.replace("with fe", "with recursive fe", 1)
    + ", r as (select dst as node, src as ancestor, 1 as hops from fe where src <> dst union select r.node, fe.src, hops + 1 from r join fe on fe.dst = r.ancestor where hops < 4 and fe.src <> fe.dst), a as (select distinct node, ancestor from r where node <> ancestor), k as (select node, count(*) as k from a group by 1),"
    " i as (select x.node, y.node as other, count(*) as i from a x join a y on x.ancestor = y.ancestor and x.node <> y.node group by 1, 2) select k.node, round(coalesce(max(i::double / (k.k + m.k - i)), 0), 6) as similarity from k left join i on k.node = i.node left join k m on i.other = m.node group by 1"
)
def funding_similarity(spark, sf):
    return graphs.funding_similarity(graphs.ancestors(funding(spark, sf)))


@query(FND + ", d as (select n as node, count(*) as degree from (select src as n from fe union all select dst from fe) group by 1) select node, degree, round(coalesce(degree::double / nullif((select count(*) from d) - 1, 0), 0), 6) as centrality from d")
def degree_centrality(spark, sf):
    return graphs.degree_centrality(funding(spark, sf))


@query(
    FND.replace("with fe", "with recursive fe", 1)
    + ", u as (select src as a, dst as b from fe where src <> dst union select dst, src from fe where src <> dst), r as (select a as node, a as m from u union select r.node, u.b from r join u on u.a = r.m) select node, min(m) as component from r group by 1"
)
def funding_components(spark, sf):
    return graphs.components(funding(spark, sf))


@query()
def ring_members(spark, sf):
    return graphs.communities(trade_edges(spark, sf))


@query()
def ring_density(spark, sf):
    e = trade_edges(spark, sf)
    return graphs.ring_statistics(graphs.communities(e), e)


@query(
    TE
    + ", n as (select a, b from ue union all select b, a from ue), d as (select a, count(*) as d from n group by 1), c as (select x.a, y.a as b, count(*) as c from n x join n y on x.b = y.b and x.a < y.a group by 1, 2)"
    " select (select count(*) from ue x join ue y on x.a = y.a and x.b < y.b join ue z on z.a = x.b and z.b = y.b) as triangles, (select cast(sum(d * (d - 1) / 2) as bigint) from d) as wedges, (select cast(coalesce(sum(c * (c - 1) / 2) / 2, 0) as bigint) from c) as four_cycles,"
    " (select round(avg((r.src is not null)::int), 6) from te left join te r on te.src = r.dst and te.dst = r.src) as reciprocity"
)
def motif_census(spark, sf):
    return graphs.motifs(trade_edges(spark, sf))


@query()
def pagerank_risk(spark, sf):
    """Scores of the review queue spread over the trade graph."""
    seeds = scored(spark, sf).filter("wallet is not null and score is not null").groupBy(F.col("wallet").alias("node")).agg(F.max("score").alias("score"))
    return graphs.propagate_risk(seeds, trade_edges(spark, sf))


# ---- series ---------------------------------------------------------------------------------------------------------

_CANDLE = T + ", c as (select pair, floor(epoch_us(ts) / 3600000000)::bigint as slot, arg_min(price, (ts, trade_id)) as open, max(price) as high, min(price) as low, arg_max(price, (ts, trade_id)) as close, cast(sum(coalesce(amount, 0)) as decimal(38,7)) as volume, count(*) as n, sum(price::double * coalesce(amount, 0)::double) as turnover from t where pair is not null and price is not null group by 1, 2)"


@query(_CANDLE + " select pair, slot, open, high, low, close, volume, n from c")
def ohlcv_1h(spark, sf):
    return series.candles(trades(spark, sf), 3600).drop("turnover")


@query(
    _CANDLE
    + ", g as (select pair, unnest(range(min(slot), max(slot) + 1)) as slot from c group by pair), d as (select g.pair, g.slot, coalesce(volume, 0) as v from g left join c on g.pair = c.pair and g.slot = c.slot), b as (select pair, slot, sum(v) over w as before, count(*) over w as k from d window w as (partition by pair order by slot rows between 20 preceding and 1 preceding)),"
    " l as (select pair, max(slot) as slot from c group by 1) select c.pair, n, round((high::double - low::double) / nullif(open::double, 0), 6) as range_ratio, round(coalesce(abs(close::double - open::double) / nullif(high::double - low::double, 0), 0), 6) as body_ratio,"
    " round(abs(close::double - turnover / nullif(volume::double, 0)) / nullif(turnover / nullif(volume::double, 0), 0), 6) as vwap_deviation, round(volume::double / nullif(before::double / k, 0), 4) as volume_spike from c join l on c.pair = l.pair and c.slot = l.slot join b on c.pair = b.pair and c.slot = b.slot"
)
def ohlcv_features(spark, sf):
    return series.ohlcv_features(trades(spark, sf), 3600)


_DAYS = T + ", c as (select pair, floor(epoch_us(ts) / 86400000000)::bigint as slot, cast(sum(coalesce(amount, 0)) as decimal(38,7)) as v from t where pair is not null group by 1, 2), g as (select pair, unnest(range(min(slot), max(slot) + 1)) as slot from c group by pair), d as (select g.pair, g.slot, coalesce(v, 0) as v from g left join c on g.pair = c.pair and g.slot = c.slot)"


def _days(spark, sf):
    return trades(spark, sf).filter("pair is not null").groupBy("pair", series._slot("ts", 86400).alias("slot")).agg(F.sum(F.coalesce("amount", F.lit(0))).cast("decimal(38,7)").alias("v"))


@query(_DAYS + " select * from d")
def resampled_series(spark, sf):
    return series.filled(_days(spark, sf), "pair", "slot", "v").withColumn("v", F.col("v").cast("decimal(38,7)"))


@query(_DAYS + ", b as (select pair, min(slot) as t0, avg(v::double) as m from d group by 1) select d.pair, count(*) as n, round(covar_pop((slot - t0)::double, v::double) / nullif(var_pop((slot - t0)::double), 0) / nullif(m, 0), 6) as trend from d join b on d.pair = b.pair group by d.pair, m")
def trend_slope(spark, sf):
    return series.trend(_days(spark, sf), "pair", "slot", "v")


CUTOFFS = [1706745600000000 + k * 2592000000000 for k in range(5)]


@query(
    S + ", k as (select unnest([" + ", ".join(map(str, CUTOFFS)) + "]) as cutoff) select wallet, cutoff, count(*) as n_trades, count(distinct cp) as n_cps from s join k on epoch_us(ts) <= cutoff group by 1, 2"
)
def replay_scores(spark, sf):
    return series.replay(sides(spark, sf), CUTOFFS)


@query(
    S
    + ", r as (select wallet, max(ts) as ref from s group by 1), c as (select s.wallet, "
    + ", ".join(f"count(*) filter (ts > ref - interval {h} hour) as n{h}" for h in digits.WINDOW_HOURS)
    + " from s join r on s.wallet = r.wallet group by 1) select wallet, case "
    + " ".join(f"when n{h} >= 50 then {h}" for h in digits.WINDOW_HOURS)
    + " else 720 end as window_h from c"
)
def optimal_window(spark, sf):
    return series.optimal_window(sides(spark, sf), "wallet", digits.WINDOW_HOURS)


@query(
    A
    + f", k as (select event_id, max({ACC.format('wallet')}) as wallet, max(campaign_start at time zone 'UTC') as s, max(campaign_end at time zone 'UTC') as e from known_manipulation_events group by 1)"
    " select event_id, round((epoch_us(min(selected_at)) - epoch_us(s)) / 3600000000.0, 6)::double as lag_hours from k join q on k.wallet = q.wallet and selected_at >= s and selected_at <= e where score >= 50 group by event_id, s"
)
def detection_lag(spark, sf):
    """Hours from a campaign's start to the first score of 50 or more within it."""
    k = table(spark, sf, "known_manipulation_events").groupBy("event_id").agg(F.max(account_id("wallet")).alias("wallet"), F.max("campaign_start").alias("s"), F.max("campaign_end").alias("e"))
    j = k.join(scored(spark, sf).filter("score >= 50"), "wallet").filter("selected_at >= s and selected_at <= e")
    return j.groupBy("event_id", "s").agg(F.min("selected_at").alias("f")).select("event_id", F.round((F.unix_micros("f") - F.unix_micros("s")) / 3_600_000_000, 6).alias("lag_hours"))


# ---- quality, drift, alerts -----------------------------------------------------------------------------------------

_COLS = ("counter", "amount", "price", "pair", "ts")


@query(T + " ".join(f"{' union all' if j else ''} select '{c}' as \"column\", round(count(*) filter ({c} is null)::double / count(*), 6) as null_share, count(*) filter ({c} is null)::double / count(*) <= 0.05 as passed from t" for j, c in enumerate(_COLS)))
def completeness(spark, sf):
    return monitoring.completeness(trades(spark, sf), _COLS)


@query("with g as (select count(*) as c from json_trade_0 where coalesce(trim(trade_id, ' ' || chr(9)), '') <> '' group by lower(trim(trade_id, ' ' || chr(9)))) select cast(sum(c) as bigint) as n, count(*) as n_distinct, round(1 - count(*)::double / sum(c), 6) as duplicate_share from g")
def uniqueness(spark, sf):
    from quartzflow.functions.ids import trade_id

    return monitoring.uniqueness(table(spark, sf, "json_trade_0"), trade_id("trade_id"))


_RULES = {"amount": "amount > 0", "price": "price > 0"}


@query(
    T
    + " select 'amount' as rule, round(avg(coalesce(amount > 0, false)::int), 6) as valid_share from t union all select 'price', round(avg(coalesce(price > 0, false)::int), 6) from t union all select 'account', round(avg(coalesce(regexp_full_match(base, 'G[A-Z2-7]{55}'), false)::int), 6) from t"
    " union all select 'timely', round(avg(coalesce(ts >= timestamp '2024-01-01' and ts < timestamp '2024-07-01', false)::int), 6) from t"
)
def field_validity(spark, sf):
    at = lambda s: F.lit(s).cast("timestamp")
    return monitoring.validity(trades(spark, sf), {k: F.expr(v) for k, v in _RULES.items()} | {"account": F.col("base").rlike("^G[A-Z2-7]{55}$"), "timely": (F.col("ts") >= at("2024-01-01")) & (F.col("ts") < at("2024-07-01"))})


@query(
    T
    + ", r as (select 'validity' as d, 2.0 as w, avg(coalesce(amount > 0, false)::int) as s from t union all select 'validity', 1.0, avg(coalesce(price > 0, false)::int) from t union all select 'completeness', 1.0, 1 - avg((counter is null)::int) from t), m as (select d, sum(s * w) / sum(w) as s from r group by 1), x as (select avg(s) * 100 as s from m)"
    " select round(s, 4) as score, case when s >= 90 then 'READY' when s >= 70 then 'WARNING' else 'QUARANTINE_REJECTED' end as verdict from x"
)
def readiness_score(spark, sf):
    t = trades(spark, sf)
    v = t.agg(*[F.avg(F.coalesce(F.expr(e), F.lit(False)).cast("int")).alias(k) for k, e in (("a", "amount > 0"), ("p", "price > 0"), ("c", "counter is not null"))])
    rows = [("validity", 2.0, "a"), ("validity", 1.0, "p"), ("completeness", 1.0, "c")]
    return monitoring.readiness(v.select(F.inline(F.array(*[F.struct(F.lit(d).alias("dimension"), F.lit(w).alias("weight"), F.col(c).alias("score")) for d, w, c in rows]))))


_EDGES = [0.0, 1.0, 10.0, 100.0, 1000.0, 10000.0, 1e12]


def _psi_sql() -> str:
    def part(name: str, cond: str) -> str:
        cs = [f"greatest(count(*) filter (amount::double >= {lo!r} and amount::double < {hi!r})::double / count(*), 1e-4) as s{k}" for k, (lo, hi) in enumerate(zip([-1e300, *_EDGES[1:-1]], [*_EDGES[1:-1], 1e300]))]
        tot = " + ".join(f"s{k}" for k in range(6))
        return f"{name}0 as (select pair, {', '.join(cs)} from t where amount is not null and {cond} group by 1), {name} as (select pair, " + ", ".join(f"s{k} / ({tot}) as {name}{k}" for k in range(6)) + f" from {name}0)"

    terms = " + ".join(f"(o{k} - e{k}) * ln(o{k} / e{k})" for k in range(6))
    return T + ", " + part("e", "ts < timestamp '2024-04-01'") + ", " + part("o", "ts >= timestamp '2024-04-01'") + f" select e.pair, round({terms}, 6) as psi, {terms} >= 0.25 as drifted from e join o on e.pair = o.pair"


@query(_psi_sql())
def psi_report(spark, sf):
    t, cut = trades(spark, sf), F.lit("2024-04-01").cast("timestamp")
    return monitoring.psi(t.filter(F.col("ts") < cut), t.filter(F.col("ts") >= cut), "pair", _EDGES, "amount")


_DAILY_N = T + ", x as (select pair, floor(epoch_us(ts) / 86400000000)::bigint as slot, count(*)::double as v from t where pair is not null group by 1, 2)"


def _daily_n(spark, sf):
    return trades(spark, sf).filter("pair is not null").groupBy("pair", series._slot("ts", 86400).alias("slot")).agg(F.count("*").cast("double").alias("v"))


@query(_DAILY_N + ", b as (select *, count(v) over w as k, avg(v) over w as m, stddev_pop(v) over w as s from x window w as (partition by pair order by slot rows between unbounded preceding and 1 preceding)) select pair, slot, round((v - m) / s, 4) as z from b where k >= 10 and s > 0 and abs(round((v - m) / s, 4)) > 3")
def baseline_drift(spark, sf):
    return monitoring.baseline_drift(_daily_n(spark, sf), "pair", "slot", "v")


@query(
    _DAILY_N
    + ", u as (select pair, slot, sum(v - 5 - 0.5) over w as u, sum(5 - v - 0.5) over w as d from x window w as (partition by pair order by slot rows unbounded preceding)), s as (select pair, slot, u - least(0, min(u) over w) as hi, d - least(0, min(d) over w) as lo from u window w as (partition by pair order by slot rows unbounded preceding))"
    " select pair, min(slot) as at, round(arg_min(hi, slot), 4) as high, round(arg_min(lo, slot), 4) as low from s where hi > 5 or lo > 5 group by 1"
)
def cusum_alarms(spark, sf):
    return monitoring.cusum(_daily_n(spark, sf), "pair", "slot", "v", mean=5.0)


@query(
    A
    + ", n as (select *, coalesce((epoch_us(ts) - lag(epoch_us(ts)) over w >= 60000000)::int, 1) as new from al window w as (partition by wallet, pair order by ts, detector)), s as (select *, sum(new) over (partition by wallet, pair order by ts range unbounded preceding) as g from n)"
    " select wallet, pair, epoch_us(min(ts)) as began, count(*) as n, max(score) as score, string_agg(distinct detector, ',' order by detector) as detectors from s group by wallet, pair, g"
)
def alert_sessions(spark, sf):
    return monitoring.alert_sessions(alerts(spark, sf), 60_000_000)


@query(A + ", c as (select a.wallet, a.ts, count(distinct b.detector) as k from al a join al b on a.wallet = b.wallet and b.ts between a.ts - interval 30 day and a.ts group by 1, 2) select wallet, cast(max(k) as int) as n_detectors from c group by 1 having max(k) >= 1")
def consensus_alerts(spark, sf):
    return monitoring.consensus_alerts(alerts(spark, sf), 30 * 86400 * 1_000_000, 1, ("wallet",))


@query(A + " select case when score >= 80 then 'pager' when score >= 50 and pair like 'USDX%' then 'stable-desk' else 'queue' end as destination, count(*) as n from al group by 1")
def routed_alerts(spark, sf):
    return monitoring.routed(alerts(spark, sf), [("pager", 80, "%"), ("stable-desk", 50, "USDX%")], "queue").groupBy("destination").agg(F.count("*").alias("n"))


@query()
def alert_cooldown(spark, sf):
    return monitoring.cooldown(alerts(spark, sf), 50, 3600 * 1_000_000)


# ---- scores ---------------------------------------------------------------------------------------------------------

_GRID = list(range(10, 100, 10))
_SWEEP = (
    A
    + ", g as (select unnest([" + ", ".join(f"{x}.0::double" for x in _GRID) + "]) as threshold), y as (select * from q where label is not null and score is not null), z as (select threshold, count(*) filter (label = 1 and score >= threshold) as tp, count(*) filter (label = 0 and score >= threshold) as fp, count(*) filter (label = 1) as p, count(*) filter (label = 0) as n from g cross join y group by 1),"
    " sw as (select threshold, tp, fp, round(coalesce(tp::double / nullif(tp + fp, 0), 0), 6) as precision, round(coalesce(tp::double / nullif(p, 0), 0), 6) as recall, round(coalesce(2 * tp::double / nullif(tp + fp + p, 0), 0), 6) as f1, round(coalesce(fp::double / nullif(n, 0), 0), 6) as fpr from z)"
)


@query(_SWEEP + " select * from sw")
def threshold_sweep(spark, sf):
    return scoring.threshold_sweep(scored(spark, sf), _GRID)


@query(_SWEEP + " select * from sw where recall >= 0.3 order by f1 desc, threshold limit 1")
def best_threshold(spark, sf):
    return scoring.best_threshold(scoring.threshold_sweep(scored(spark, sf), _GRID), 0.3)


@query(
    A
    + ", c as (select query_strategy, score, count(*) filter (label = 1) as p, count(*) filter (label = 0) as n from q where label is not null and score is not null group by 1, 2), x as (select *, coalesce(sum(n) over (partition by query_strategy order by score rows between unbounded preceding and 1 preceding), 0) as below from c)"
    " select query_strategy, cast(sum(p) as bigint) as \"P\", cast(sum(n) as bigint) as \"N\", round(sum(p * (below + n / 2.0))::double / nullif(sum(p) * sum(n), 0), 6) as auc from x group by 1"
)
def auc_rank_sum(spark, sf):
    return scoring.auc(scored(spark, sf), ["query_strategy"])


@query(A + " select query_strategy, count(*) filter (score >= 50 and label = 1) as tp, count(*) filter (score >= 50 and label <> 1) as fp, count(*) filter (score < 50 and label = 1) as fn, count(*) filter (score < 50 and label <> 1) as tn from q where label is not null and score is not null group by 1")
def confusion_by_strategy(spark, sf):
    return scoring.confusion(scored(spark, sf), "query_strategy", 50)


@query(A + " select wallet, pair, max(score) as score from q where score >= 70 and wallet is not null and pair is not null group by 1, 2")
def flagged_wallets(spark, sf):
    return scored(spark, sf).filter("score >= 70 and wallet is not null and pair is not null").groupBy("wallet", "pair").agg(F.max("score").alias("score"))


@query(A + " select wallet, score, annotation_id from (select *, row_number() over (partition by wallet order by selected_at desc nulls last, annotation_id desc) as rn from q where wallet is not null) where rn = 1")
def latest_score(spark, sf):
    q = scored(spark, sf).filter("wallet is not null").select("wallet", "score", "annotation_id", "selected_at")
    return scoring.latest(q, ["wallet"], ["selected_at", "annotation_id"]).drop("selected_at")


@query(A + " select annotation_id, wallet, score from q where annotation_id < 1000 order by annotation_id desc limit 51")
def keyset_page(spark, sf):
    return scoring.keyset_page(scored(spark, sf), "annotation_id", 1000, 50).select("annotation_id", "wallet", "score")


@query(A + " select annotation_id, wallet, score from q where score is not null order by abs(score - 50), annotation_id limit 25")
def top_uncertain(spark, sf):
    return scoring.most_uncertain(scored(spark, sf), 25, "annotation_id").select("annotation_id", "wallet", "score")


@query(A + ", d as (select distinct query_strategy, score from q where score is not null), n as (select query_strategy, count(*) as n from d group by 1 having count(*) >= 20) select d.query_strategy, score, round((row_number() over (partition by d.query_strategy order by score) - 0.5)::double / n * 100, 4) as percentile from d join n on d.query_strategy = n.query_strategy")
def score_percentile(spark, sf):
    return scoring.mid_rank_percentile(scored(spark, sf), "query_strategy", "score", 20)


@query(A + ", c as (select case when label = 1 then 1 - score / 100.0 else score / 100.0 end::double as nc from q where label is not null and score is not null) select count(*) as n, round(quantile_cont(nc, 0.9), 6) as q from c")
def conformal_quantile(spark, sf):
    return scoring.conformal_quantile(scored(spark, sf).select("label", (F.col("score") / 100).alias("p")), 0.1)


_AXIS = [1.0 if k % 2 else 0.5 for k in range(64)]


@query(f"with v as (select vec_id, [{', '.join(map(str, _AXIS))}] as p, embedding from embeddings), c as (select vec_id, list_sum([embedding[k]::double * p[k] for k in range(1, 65)]) / nullif(sqrt(list_sum([embedding[k]::double * embedding[k]::double for k in range(1, 65)])) * {sum(x * x for x in _AXIS) ** 0.5!r}, 0) as c from v) select vec_id, round(greatest(0, least(1, coalesce(c, 0))), 6) as score from c")
def zero_shot_match(spark, sf):
    """Cosine of each vector with a pattern, cut to 0..1."""
    e = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return e.select("vec_id", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), scoring.cosine(F.col("v"), _AXIS))), 6).alias("score"))


# ---- sketches -------------------------------------------------------------------------------------------------------


@query()
def approx_counterparties(spark, sf):
    return sketches.approx_counterparties(sides(spark, sf))


@query(
    S
    + ", b as (select wallet, floor((ln(greatest(0.01, least(999999000.0, amount::double))) - ln(0.01)) / ((ln(1e9) - ln(0.01)) / 32))::bigint as b from s where amount > 0), c as (select wallet, b, count(*) as n from b group by 1, 2), m as (select wallet, arg_min(b, (-n, b)) as bin from c group by 1)"
    " select wallet, bin, round(exp(ln(0.01) + (bin + 0.5) * ((ln(1e9) - ln(0.01)) / 32)), 6) as mode from m"
)
def amount_mode(spark, sf):
    return sketches.amount_mode(sides(spark, sf))


@query(
    S
    + f", d as (select wallet, ts, {_DIG} as d from s where amount > 0), r as (select wallet, max(ts) as ref from d group by 1), w as (select d.wallet, d, exp(-(epoch_us(ref) - epoch_us(ts))::double / 86400e6) as w from d join r on d.wallet = r.wallet), t2 as (select wallet, sum(w) as t from w group by 1)"
    " select w.wallet, " + ", ".join(f"round(sum(case when d = {k} then w else 0 end) / t, 6) as p{k}" for k in range(1, 10)) + " from w join t2 on w.wallet = t2.wallet group by w.wallet, t"
)
def ewma_digit_sketch(spark, sf):
    return sketches.decayed_digits(sides(spark, sf), digits.leading_digit, 86400)


@query()
def reservoir_sample(spark, sf):
    return sketches.reservoir(trades(spark, sf).select("trade_id", "amount"), "trade_id", 100)


@query()
def dp_counts(spark, sf):
    return sketches.private_counts(trades(spark, sf).filter("pair is not null"), "pair", 0.5)


# ---- scalar functions, storage --------------------------------------------------------------------------------------


PSEUDONYM_KEY = b"key of the test tables"  # real data take a secret one
_IN, _OUT = (bytes(x ^ y for x in PSEUDONYM_KEY.ljust(64, b"\0")).hex() for y in (0x36, 0x5C))


@query(
    C_SQL[1:].replace(" cr as", "with cr as", 1)
    + f" select 'anon_' || left(sha256(unhex('{_OUT}') || unhex(sha256(unhex('{_IN}') || encode(wallet)))), 32) as pseudonym, case when length(wallet) <= 4 then repeat('*', length(wallet)) else repeat('*', length(wallet) - 4) || right(wallet, 4) end as masked, strftime(created, '%Y-%m') as month from cr"
)
def pseudonyms(spark, sf):
    return created(spark, sf).select(scalar.pseudonym(F.col("wallet"), PSEUDONYM_KEY).alias("pseudonym"), scalar.masked(F.col("wallet")).alias("masked"), F.date_format("created", "yyyy-MM").alias("month"))


@query(T + " select pair, cast(sum(cast(round(coalesce(amount, 0) * 10000000) as hugeint)) as decimal(38,0)) as stroops from t group by 1")
def stroops(spark, sf):
    return trades(spark, sf).groupBy("pair").agg(F.sum(scalar.stroops(F.coalesce("amount", F.lit(0)))).cast("decimal(38,0)").alias("stroops"))


@query(
    T
    + ", x as (select *, case when split_part(base_asset, ':', 1) = 'USDX' then amount::decimal(38,13) when split_part(counter_asset, ':', 1) = 'USDX' then (amount * price)::decimal(38,13) end as usd from t) select pair, count(*) as n, count(usd) as n_rated,"
    " count(*) filter (amount is null) as n_null, count(*) filter (amount is not null and usd is null) as n_unrated, round(sum(usd), 2)::decimal(38,2) as usd from x group by 1"
)
def normalised_totals(spark, sf):
    """Volumes in dollars where one leg is the dollar; others have no rate and are counted apart."""
    return wallets.dollar_totals(trades(spark, sf))


@query(T + " select 2024 as year, extract(month from ts)::int as month, count(*) as n, count(distinct base) as n_base from t where ts >= timestamp '2024-03-01' and ts < timestamp '2024-05-01' group by 2")
def partitioned_read(spark, sf):
    """Trades written by year and month, read back with a filter that prunes to two partitions."""
    at = scratch_path(spark, "by-month")
    storage.write_by_time(trades(spark, sf), at, "ts", "month")
    r = spark.read.parquet(at).filter((F.col("year") == 2024) & F.col("month").isin(3, 4))
    return r.groupBy("year", "month").agg(F.count("*").alias("n"), F.count_distinct("base").alias("n_base"))


@query(A + ", x as (select wallet, pair, max(score) as score from q where wallet is not null and pair is not null and annotation_id % 2 = 0 group by 1, 2), y as (select wallet, pair, max(score) as score from q where wallet is not null and pair is not null and annotation_id % 2 = 1 group by 1, 2) select coalesce(y.wallet, x.wallet) as wallet, coalesce(y.pair, x.pair) as pair, case when y.wallet is not null then y.score else x.score end as score from x full join y on x.wallet = y.wallet and x.pair = y.pair")
def score_upsert(spark, sf):
    q = scored(spark, sf).filter("wallet is not null and pair is not null")
    half = lambda k: q.filter(F.col("annotation_id") % 2 == k).groupBy("wallet", "pair").agg(F.max("score").alias("score"))
    return storage.upsert(half(0), half(1), ["wallet", "pair"])
