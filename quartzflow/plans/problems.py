"""Queries of the general data problems 1 to 4 and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartzflow.functions.ids import account_id, trade_id
from quartzflow.operators import delivery, references, rejects, rolling
from quartzflow.session import table

CAMPAIGN_FIELDS = ("wallet", "asset_pair", "campaign_start", "campaign_end", "label_source", "label_confidence", "description")
WINDOWS = (7, 30)


# ---- 1: rows that fail to parse -------------------------------------------------------------------------------------


def campaign_records(spark: SparkSession, sf: str) -> DataFrame:
    """Every raw record with its fields, typed values and the list of what is wrong with it (empty: good)."""
    typed = {"campaign_start": "timestamp", "label_confidence": "int"}
    split = rejects.parse_records(table(spark, sf, "known_event_lines"), "line_id", "file_name", "line", CAMPAIGN_FIELDS, typed)
    # The reader takes other forms of times and numbers too; the form is checked on what it accepts.
    form = {
        "wallet": F.col("wallet").rlike("^G[A-Z2-7]{55}$") & ~F.col("wallet").contains("\n"),
        "campaign_start": rejects.iso_instant(F.col("campaign_start")).isNotNull(),
        "label_confidence": F.col("label_confidence").isin("1", "2", "3"),
    }
    wrong = F.array_compact(F.array(*[F.when(F.array_contains("refused", name) | ~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in form.items()]))
    return split.select(
        "line_id",
        "file_name",
        "line",
        "reason",
        "judged",
        "refused",
        F.when(F.col("reason").isNotNull(), F.array(F.lit("line"))).otherwise(wrong).alias("failed"),
        "wallet",
        "asset_pair",
        F.col("campaign_start_value").alias("campaign_start"),
        rejects.iso_instant(F.col("campaign_end")).alias("campaign_end"),
        "label_source",
        F.col("label_confidence_value").alias("label_confidence"),
        "description",
    )


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return campaign_records(spark, sf).select("line_id", F.explode("failed").alias("field"))


def p1_loaded(spark: SparkSession, sf: str) -> DataFrame:
    """The valid records, typed."""
    return campaign_records(spark, sf).filter(F.size("failed") == 0).drop("line", "reason", "judged", "refused", "failed")


def p1_rejected(spark: SparkSession, sf: str) -> DataFrame:
    """The other records, raw, each with the fields that fail."""
    return campaign_records(spark, sf).filter(F.size("failed") > 0).select("line_id", "file_name", "line", F.array_join("failed", ",").alias("fields"))


def p1_judged(spark: SparkSession, sf: str) -> DataFrame:
    """Records by who judged their split (the reader, the rule over the reader, the rule alone), reason and refused columns."""
    return campaign_records(spark, sf).groupBy("judged", "reason", F.array_join(F.array_sort("refused"), ",").alias("refused")).agg(F.count("*").alias("n"))


# ---- 2: messages delivered more than once ---------------------------------------------------------------------------


def _trades(spark: SparkSession, sf: str) -> delivery.Deduplicated:
    return delivery.one_copy_each(spark, f"{sf}/json_trade_0.parquet", trade_id("trade_id"), "delivery_id")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return _trades(spark, sf).removed.select("delivery_id")


def p2_kept(spark: SparkSession, sf: str) -> DataFrame:
    """One row of each trade, with its payload."""
    return _trades(spark, sf).kept.select(
        "delivery_id",
        trade_id("trade_id").alias("trade_id"),
        "ledger_close_time",
        account_id("base_account").alias("base_account"),
        account_id("counter_account").alias("counter_account"),
        "base_amount",
        "counter_amount",
        "asset_pair",
    )


# ---- 3: rolling totals ----------------------------------------------------------------------------------------------


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return rolling.daily_sums(_trades(spark, sf).kept, account_id("base_account"), "ledger_close_time", "base_amount")


def _last_day(spark: SparkSession, sf: str) -> int | None:
    return table(spark, sf, "json_trade_0").agg(F.unix_date(F.to_date(F.max("ledger_close_time")))).head()[0]


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    peak = rolling.rolling_windows(_daily(spark, sf), WINDOWS, _last_day(spark, sf), peaks=True)
    return peak.select(F.col("entity").alias("base_account"), "window_days", F.date_format(F.date_from_unix_date("day"), "yyyy-MM-dd").alias("peak_day"))


def p3_rolling(spark: SparkSession, sf: str) -> DataFrame:
    """Total, daily average, largest amount and number of trades of each account, window and day."""
    r = rolling.rolling_windows(_daily(spark, sf), WINDOWS, _last_day(spark, sf))
    return r.select(
        F.col("entity").alias("base_account"),
        "window_days",
        F.date_format(F.date_from_unix_date("day"), "yyyy-MM-dd").alias("day"),
        F.col("total").cast("decimal(31,7)").alias("total"),
        "average",
        "largest",
        F.col("n").alias("n_trades"),
    )


# ---- 4: references to records that do not exist ---------------------------------------------------------------------


def account_lifetimes(spark: SparkSession, sf: str) -> DataFrame:
    parents = table(spark, sf, "accounts").select(account_id("account_id").alias("key"), F.col("account_created_at").alias("created"))
    kind = F.lower(F.btrim("effect_type", F.lit(" \t")))
    changes = (
        table(spark, sf, "effects")
        .filter(kind.isin("account_created", "account_removed"))
        .select(account_id("account").alias("key"), F.col("created_at").alias("at"), F.col("effect_id").alias("seq"), (kind == "account_removed").alias("removed"))
    )
    return references.lifetimes(parents, changes)


def orphan_references(spark: SparkSession, sf: str) -> DataFrame:
    """(src_table, src_key, ref_field, ref, at) of every reference to an account that did not exist then."""
    trades = _trades(spark, sf).kept.select(
        F.lit("json_trade_0").alias("src_table"),
        trade_id("trade_id").alias("src_key"),
        F.col("ledger_close_time").alias("at"),
        F.explode(
            F.array(
                F.struct(F.lit("base_account").alias("ref_field"), account_id("base_account").alias("ref")),
                F.struct(F.lit("counter_account").alias("ref_field"), account_id("counter_account").alias("ref")),
            )
        ).alias("r"),
    )
    # Repeated rows of an event may lack a field that another has.
    events = (
        table(spark, sf, "known_manipulation_events")
        .groupBy("event_id")
        .agg(F.max(account_id("wallet")).alias("ref"), F.max("campaign_start").alias("at"))
        .select(F.lit("known_manipulation_events").alias("src_table"), F.col("event_id").cast("string").alias("src_key"), "at", F.lit("wallet").alias("ref_field"), "ref")
    )
    refs = trades.select("src_table", "src_key", "at", "r.ref_field", "r.ref").unionByName(events)
    return references.orphans(refs, "ref", "at", account_lifetimes(spark, sf))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return orphan_references(spark, sf).select("src_table", "src_key", "ref_field")


def p4_report(spark: SparkSession, sf: str) -> DataFrame:
    """Orphans and missing accounts per table, field and month."""
    return references.orphan_report(orphan_references(spark, sf), ["src_table", "ref_field"], "at")


QUERIES = {f.__name__: f for f in (p1_found, p1_loaded, p1_rejected, p1_judged, p2_found, p2_kept, p3_found, p3_rolling, p4_found, p4_report)}

# ---- SQL ------------------------------------------------------------------------------------------------------------

_FIELD = r'(?:"((?:[^"]|"")*)"|([^",]*))'
_GROUPS = ", ".join(f"'{k}'" for k in ("q0", "w0", "q1", "w1", "q2", "w2", "q3", "w3", "q4", "w4", "q5", "w5", "q6", "w6"))
_TEXT = "trim(coalesce(nullif(replace(g.q{0}, '\"\"', '\"'), ''), g.w{0}), ' ' || chr(9))"
_P1 = (
    f"with s as (select line_id, file_name, line, regexp_full_match(line, '{_FIELD}(?:,{_FIELD}){{6}}', 's') as ok,"
    f" regexp_extract(line, '^{','.join([_FIELD] * 7)}$', [{_GROUPS}], 's') as g from known_event_lines),"
    " v as (select *, "
    + ", ".join(f"{_TEXT.format(k)} as {f}_" for k, f in enumerate(CAMPAIGN_FIELDS))
    + " from s),"
    " r as (select *, coalesce(ok, false) as split,"
    " coalesce(regexp_full_match(wallet_, 'G[A-Z2-7]{55}'), false) as ok_wallet,"
    " coalesce(regexp_full_match(campaign_start_, '[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-2][0-9]:[0-5][0-9]:[0-5][0-9](\\.[0-9]+)?(Z|[+-]([01][0-9]|2[0-3]):[0-5][0-9])') and try_cast(replace(left(campaign_start_, 19), 'T', ' ') as timestamp) is not null, false) as ok_start,"
    " coalesce(label_confidence_ in ('1', '2', '3'), false) as ok_conf from v)"
)
_INSTANT = (
    "case when regexp_full_match({0}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T[0-2][0-9]:[0-5][0-9]:[0-5][0-9](\\.[0-9]+)?(Z|[+-]([01][0-9]|2[0-3]):[0-5][0-9])') then"
    " try_cast(replace(left({0}, 19), 'T', ' ') as timestamp)"
    " + to_microseconds(coalesce(try_cast(rpad(left(regexp_extract({0}, '\\.([0-9]+)', 1), 6), 6, '0') as bigint), 0))"
    " - (case when {0} like '%Z' then 0 else (case when left(right({0}, 6), 1) = '-' then -1 else 1 end) * (cast(left(right({0}, 5), 2) as bigint) * 60 + cast(right({0}, 2) as bigint)) end) * interval 1 minute end"
)
_KEPT = (
    "with d as (select *, lower(trim(trade_id, ' ' || chr(9))) as k, row_number() over (partition by lower(trim(trade_id, ' ' || chr(9))) order by delivery_id) as rn from json_trade_0),"
    " kept as (select * from d where rn = 1 or coalesce(k, '') = '')"
)
_ACC = "nullif(upper(trim({0}, ' ' || chr(9))), '')"
_P3 = (
    _KEPT
    + f", daily as (select {_ACC.format('base_account')} as a, cast(ledger_close_time as date) as d, sum(coalesce(base_amount, 0)) as s, max(coalesce(base_amount, 0)) as m, count(*) as n from kept group by 1, 2),"
    " ends as (select cast(max(ledger_close_time) as date) as e from json_trade_0),"
    " grid as (select a, unnest(generate_series(min(d), (select e from ends), interval 1 day))::date as d from daily where a is not null and d is not null group by a),"
    " dense as (select g.a, g.d, coalesce(s, 0) as s, m, coalesce(n, 0) as n from grid g left join daily y on g.a = y.a and g.d = y.d),"
    " r as (select a, d, 7 as w, sum(s) over x as t, max(m) over x as m, sum(n) over x as n from dense window x as (partition by a order by d rows 6 preceding)"
    " union all select a, d, 30, sum(s) over x, max(m) over x, sum(n) over x from dense window x as (partition by a order by d rows 29 preceding))"
)
_P4 = (
    _KEPT
    + f", born as (select {_ACC.format('account_id')} as a, min(account_created_at) as b from accounts group by 1),"
    f" eff as (select {_ACC.format('account')} as a, created_at as c, arg_max(lower(trim(effect_type)), effect_id) as kind from effects where lower(trim(effect_type)) in ('account_created', 'account_removed') group by 1, 2),"
    f" refs as (select 'json_trade_0' as src_table, k as src_key, 'base_account' as ref_field, {_ACC.format('base_account')} as ref, ledger_close_time as t from kept"
    f" union all select 'json_trade_0', k, 'counter_account', {_ACC.format('counter_account')}, ledger_close_time from kept"
    f" union all select 'known_manipulation_events', cast(event_id as varchar), 'wallet', max({_ACC.format('wallet')}), max(campaign_start) from known_manipulation_events group by event_id),"
    " dated as (select r.*, e.kind from (select * from refs where ref is not null) r asof left join eff e on r.ref = e.a and r.t >= e.c),"
    " bad as (select s.* from dated s left join born on s.ref = born.a where not coalesce(born.b <= s.t, false) or coalesce(s.kind = 'account_removed', false))"
)
SQL = {
    "p1_found": _P1 + " select line_id, 'line' as field from r where not split union all select line_id, 'wallet' from r where split and not ok_wallet"
    " union all select line_id, 'campaign_start' from r where split and not ok_start union all select line_id, 'label_confidence' from r where split and not ok_conf",
    "p1_loaded": _P1
    + " select line_id, file_name, wallet_ as wallet, asset_pair_ as asset_pair, ("
    + _INSTANT.format("campaign_start_")
    + ") at time zone 'UTC' as campaign_start, ("
    + _INSTANT.format("campaign_end_")
    + ") at time zone 'UTC' as campaign_end, label_source_ as label_source, cast(label_confidence_ as int) as label_confidence, description_ as description from r where split and ok_wallet and ok_start and ok_conf",
    "p1_rejected": _P1
    + " select line_id, file_name, line, case when not split then 'line' else concat_ws(',', case when not ok_wallet then 'wallet' end, case when not ok_start then 'campaign_start' end, case when not ok_conf then 'label_confidence' end) end as fields"
    " from r where not (split and ok_wallet and ok_start and ok_conf)",
    "p2_found": _KEPT + " select delivery_id from d where rn > 1 and coalesce(k, '') <> ''",
    "p2_kept": _KEPT
    + f" select delivery_id, nullif(k, '') as trade_id, ledger_close_time, {_ACC.format('base_account')} as base_account, {_ACC.format('counter_account')} as counter_account, base_amount, counter_amount, asset_pair from kept",
    "p3_found": _P3 + " select a as base_account, cast(w as int) as window_days, strftime(arg_min(d, (-t, d)), '%Y-%m-%d') as peak_day from r group by a, w",
    "p3_rolling": _P3 + " select a as base_account, cast(w as int) as window_days, strftime(d, '%Y-%m-%d') as day, cast(t as decimal(31,7)) as total, cast(t as decimal(31,7))::double / w as average, m as largest, cast(n as bigint) as n_trades from r",
    "p4_found": _P4 + " select src_table, src_key, ref_field from bad",
    "p4_report": _P4 + " select src_table, ref_field, strftime(t, '%Y-%m') as month, count(*) as n_orphans, count(distinct ref) as n_missing from bad group by 1, 2, 3",
}
