import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from quartzflow.functions import scalar
from quartzflow.operators import digits, graphs, joins, monitoring, scoring, series, trades, wallets
from quartzflow.sources import storage

D = dt.datetime(2024, 1, 1)
S = dt.timedelta(seconds=1)
TRADE = "trade_id string, ts timestamp, base string, counter string, base_asset string, counter_asset string, amount decimal(19,7), counter_amount decimal(19,7), price decimal(19,7), pair string, venue string"


def tr(k, sec, b, c, amount, pair="P", venue="sdex"):
    a = None if amount is None else Decimal(str(amount))
    return (f"t{k:03}", D + sec * S, b, c, "A:x", "B:y", a, a, Decimal(1), pair, venue)


def test_sides(spark):
    t = spark.createDataFrame([tr(1, 0, "a", "b", 1), tr(2, 1, "a", "a", 1), tr(3, 2, "a", None, 1), tr(4, 3, None, "b", 1)], TRADE)
    got = sorted((r["trade_id"], r["wallet"], str(r["cp"])) for r in trades.wallet_sides(t).collect())
    assert got == [("t001", "a", "b"), ("t001", "b", "a"), ("t002", "a", "a"), ("t003", "a", "None"), ("t004", "b", "None")]


def test_digits_are_exact(spark):
    xs = ["0.3", "0.6", "0.7", "999.9999999", "0.0000001", "922337203685.4775807", "0", "-5", "10", "0.0120000"]
    df = spark.createDataFrame([(Decimal(x),) for x in xs], "a decimal(19,7)")
    got = [tuple(r) for r in df.select(digits.leading_digit(F.col("a")), digits.second_digit(F.col("a"))).collect()]
    assert got == [(3, 0), (6, 0), (7, 0), (9, 9), (1, 0), (9, 2), (None, None), (None, None), (1, 0), (1, 2)]


def test_windows_guard_small_samples_and_cut_at_the_edge(spark):
    rows = [tr(k, k, "a", "b", 10 + k % 9) for k in range(19)] + [tr(50, -3600 + 18, "a", "b", 5)]
    s = trades.wallet_sides(spark.createDataFrame(rows, TRADE)).filter("wallet = 'a'")
    got = {r["window_h"]: (r["n"], r["mad"], r["nonconforming"]) for r in digits.windowed_metrics(s).collect()}
    assert got[1] == (19, None, False) and got[4][0] == 20 and got[4][1] is not None and got[4][2]


def test_wallet_features(spark):
    rows = [tr(1, 0, "a", "b", 30), tr(2, 30, "a", "c", 10), tr(3, 3600, "a", "a", 60), tr(4, 7200, "d", "a", None)]
    s = trades.wallet_sides(spark.createDataFrame(rows, TRADE))
    p = {r["wallet"]: r for r in wallets.trade_pattern(s).collect()}
    assert p["a"]["concentration"] == 0.6 and p["a"]["self_trade_rate"] == 0.25 and p["d"]["concentration"] == 0
    assert {r["wallet"]: r["intra_minute"] for r in wallets.timing(s).collect()}["a"] == round(1 / 3, 6)
    assert wallets.trade_pattern(s.limit(0)).count() == 0


def test_interval_join_is_closed_on_both_ends(spark):
    l = spark.createDataFrame([("k", 1, D)], "k string, id int, ts timestamp")
    r = spark.createDataFrame([("k", s, D + s * S) for s in (-11, -10, 0, 10, 11)] + [("x", 99, D)], "k string, s int, right_ts timestamp")
    assert sorted(x["s"] for x in joins.interval_join(l, r, ["k"], 10_000_000, 10_000_000).collect()) == [-10, 0, 10]


def test_round_trips(spark):
    rows = [tr(1, 0, "a", "b", 100), tr(2, 5, "b", "a", 99), tr(3, 11, "b", "a", 100), tr(4, 5, "b", "a", 50), tr(5, 0, "b", "a", 100)]
    got = [tuple(r)[:2] for r in joins.round_trips(spark.createDataFrame(rows, TRADE), 10_000_000, 0.05).collect()]
    assert got == [("t001", "t002")]


def test_as_of(spark):
    l = spark.createDataFrame([("k", D + s * S, s) for s in (0, 5, 100)], "k string, ts timestamp, s int")
    r = spark.createDataFrame([("k", D + 5 * S, "v"), ("k", D + 6 * S, None)], "k string, ts timestamp, v string")
    assert {x["s"]: x["v"] for x in joins.as_of(l, r, "k", "v", valid_us=60_000_000).collect()} == {0: None, 5: "v", 100: None}


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "src string, dst string")


def test_graphs(spark):
    e = edges(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "d"), ("x", "y"), ("y", "x")])
    comp = {r["node"]: r["component"] for r in graphs.components(e).collect()}
    assert comp == {"a": "a", "b": "a", "c": "a", "d": "a", "x": "x", "y": "x"}
    m = graphs.motifs(e).head()
    assert (m["triangles"], m["four_cycles"]) == (1, 0) and m["reciprocity"] == round(2 / 6, 6)
    square = graphs.motifs(edges(spark, [("a", "b"), ("b", "c"), ("c", "d"), ("d", "a"), ("a", "c")])).head()
    assert (square["triangles"], square["four_cycles"]) == (2, 1)
    anc = {(r["node"], r["ancestor"]): r["hops"] for r in graphs.ancestors(edges(spark, [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", "f")])).collect()}
    assert anc["f", "b"] == 4 and ("f", "a") not in anc
    assert graphs.components(e.limit(0)).count() == 0


def test_long_chain_is_one_component(spark):
    e = edges(spark, [(f"n{k:03}", f"n{k + 1:03}") for k in range(120)])
    assert {r["component"] for r in graphs.components(e).collect()} == {"n000"}


def test_cooldown_and_sessions(spark):
    a = spark.createDataFrame([("w", "p", D + s * S, "d", sc) for s, sc in ((0, 90), (30, 95), (59, 10), (60, 90), (200, 90))], "wallet string, pair string, at timestamp, detector string, score int")
    assert len(monitoring.cooldown(a, 50, 60_000_000).collect()) == 3
    assert sorted(r["n"] for r in monitoring.alert_sessions(a, 60_000_000).collect()) == [1, 4]


def test_cusum_equals_the_fold(spark):
    xs = [0.1, 2, 3, -1, 4, 1, -9, -3]
    df = spark.createDataFrame([("k", j, float(x)) for j, x in enumerate(xs)], "k string, j int, v double")
    hi = lo = 0.0
    want = None
    for j, x in enumerate(xs):
        hi, lo = max(0, hi + x - 0.5), max(0, lo - x - 0.5)
        if want is None and (hi > 5 or lo > 5):
            want = (j, round(hi, 4), round(lo, 4))
    r = monitoring.cusum(df, "k", "j", "v").head()
    assert (r["at"], r["high"], r["low"]) == want


def test_scoring(spark):
    df = spark.createDataFrame([(1, 90), (1, 50), (0, 50), (0, 10), (None, 99)], "label int, score int")
    assert scoring.auc(df).head()["auc"] == 0.875
    s = {r["threshold"]: (r["tp"], r["fp"]) for r in scoring.threshold_sweep(df, [20, 60]).collect()}
    assert s == {20.0: (2, 1), 60.0: (1, 0)}
    e = scoring.ensemble(spark.createDataFrame([(0.1, 0.15, 0.9), (0.1, 0.5, 0.9)], "a double, b double, c double"), ["a", "b", "c"]).collect()
    assert [(r["score"], r["consensus"]) for r in e] == [(15, True), (100, False)]


def test_series(spark):
    df = spark.createDataFrame([("k", 0, 1), ("k", 3, 5)], "k string, s bigint, v int")
    assert [r["v"] for r in series.filled(df, "k", "s", "v").orderBy("s").collect()] == [1, 0, 0, 5]


def test_storage(spark, tmp_path):
    t = spark.createDataFrame([tr(k, k * 40 * 86400, "a", "b", 1) for k in range(4)], TRADE)
    storage.write_by_time(t, str(tmp_path / "t"), "ts", "month")
    r = spark.read.parquet(str(tmp_path / "t")).filter("year = 2024 and month = 2")
    assert r.count() == 1 and "PartitionFilters: [isnotnull(year" in r._jdf.queryExecution().toString()
    old, new = (spark.createDataFrame(x, "k string, v int") for x in ([("a", 1), ("b", 2), (None, 3)], [("b", 5), (None, 6)]))
    assert sorted(storage.upsert(old, new, ["k"]).collect(), key=str) == sorted([("a", 1), ("b", 5), (None, 6)], key=str)
    assert [tuple(x) for x in storage.changed(old, spark.createDataFrame([("a", 1), ("b", 9)], "k string, v int"), ["k"]).collect()] == [("b", 9)]
    assert storage.snapshot_digest(old).head() == storage.snapshot_digest(old.repartition(3)).head()


def test_scalars(spark):
    df = spark.createDataFrame([("=+cmd\0x", "abcdefgh", 7.5)], "a string, b string, c double")
    r = df.select(scalar.sanitised(F.col("a")), scalar.masked(F.col("b")), scalar.generalised(F.col("c"), 5)).head()
    assert tuple(r) == ("cmdx", "****efgh", "[5, 10)")
