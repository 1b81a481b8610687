"""Operators that once did less than the whole job, against brute force."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal
from itertools import combinations
from pathlib import Path

import pyarrow as pa
import pytest

from quartzflow.operators import joins, trades, wallets

from tests.test_features import TRADE, tr

WHOLE = ("normalised_totals", "timing_correlation_links", "pair_volume_corr", "venue_volume_corr", "cross_wallet_volume_corr", "weighted_co_trade_edges", "feature_matrix", "flag_scores", "net_asset_flow", "venue_features")


@pytest.mark.parametrize("name", WHOLE)
def test_whole_job_over_the_tables(spark, name):
    sf = "/root/testdata/sf0.001"
    if not Path(sf).exists():
        pytest.skip("no test tables")
    import __spark_entry__ as e
    from tools import oracle

    assert ": ok" in (said := oracle.compare(spark, oracle.duck(sf), name, sf, e)), said


def test_dollar_totals_keep_extreme_null_and_unrated_trades(spark):
    rows = [tr(k, k, "a", "b", x) for k, x in enumerate(["1", "9999999999.9999999", None, "0.0000001"])]
    usd = [(*r[:4], "USDX:x", *r[5:]) for r in rows]
    priced = [(*r[:5], "USDX:x", r[6], r[7], p, "Q", r[10]) for r, p in zip(rows, (Decimal("2.5"), Decimal("1.5"), Decimal(1), None))]
    other = [(*r[:9], "R", r[10]) for r in rows]
    got = {r["pair"]: tuple(r)[1:] for r in wallets.dollar_totals(spark.createDataFrame(usd + priced + other, TRADE)).collect()}
    assert got == {"P": (4, 3, 1, 0, Decimal("10000000001.00")), "Q": (4, 2, 1, 1, Decimal("15000000002.50")), "R": (4, 0, 1, 3, None)}


def test_timing_counts_empty_hours(spark):
    # Two shared hours of 30, fewer than five; the third wallet trades every hour but those, the fourth in other hours of the same day.
    at = {"a": ("amm", [0, 0, 9]), "b": ("sdex", [0, 0, 9]), "c": ("sdex", [*range(1, 9), *range(10, 30)]), "d": ("sdex", [1, 2, 10])}
    rows = [tr(k, h * 3600, w, None, 1, venue=v) for w, (v, hours) in at.items() for k, h in enumerate(hours)]
    s = trades.wallet_sides(spark.createDataFrame(rows, TRADE))
    got = [tuple(r) for r in joins.timing_correlation(s.filter("venue = 'amm'"), s.filter("venue = 'sdex'")).collect()]
    assert got == [("a", "b", 2, 1.0)]


def test_volume_correlations_tell_apart_times_within_a_day(spark):
    # The volumes of a's pairs, venues and counterparties rise together by minute and hour; within a day they are one value.
    rows = []
    for k in range(3):
        rows += [tr(10 * k, 7200 * k, "a", "b", 1 + k, "P"), tr(10 * k + 1, 7200 * k + 5, "a", "c", 2 + 2 * k, "Q", "amm")]
    rows += [tr(90, 0, "x", None, 1)]
    s = trades.wallet_sides(spark.createDataFrame(rows, TRADE))
    for f in (wallets.pair_volume_correlation, wallets.venue_volume_correlation, wallets.cross_wallet_correlation):
        got = {r[0]: tuple(r)[1:] for r in f(s).collect()}
        assert got["a"] == (3, 1.0) and got["x"][1] == 0 and set(got) == {"a", "b", "c", "x"}, f.__name__


def test_weighted_co_trades_count_anchors_within_a_day(spark):
    rnd, w = random.Random(5), ["G" + c * 55 for c in "ABCDEF"] + ["bad", None]
    rows = [tr(k, rnd.randrange(8 * 86400), rnd.choice(w), rnd.choice(w), 1, rnd.choice("PQ")) for k in range(60)]
    want, day = defaultdict(lambda: [0, 0]), dt.timedelta(days=1)
    for a in rows:
        seen = {x for r in rows if r[9] == a[9] and a[1] <= r[1] <= a[1] + day for x in r[2:4] if x and len(x) == 56}
        for pair in combinations(sorted(seen), 2):
            us = int((a[1] - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))
            want[pair] = [want[pair][0] + 1, max(want[pair][1], us)]
    got = joins.weighted_co_trades(spark.createDataFrame(rows, TRADE), 86_400_000_000).collect()
    assert {(r["src"], r["dst"]): [r["weight"], r["latest"]] for r in got} == dict(want)


@pytest.mark.parametrize("blocks", [1, 5])
def test_weighted_co_trades_of_busy_and_quiet_pairs(spark, monkeypatch, blocks):
    # Many wallets at the same moments, some exactly a day apart, in one block and in many; the quiet pair has single couples.
    monkeypatch.setattr(joins, "BLOCKS", blocks)
    rnd, w = random.Random(11), [f"G{'A' * 53}{a}{b}" for a in "ABCDEFGHIJ" for b in "ABCDEFGHIJ"] + ["bad", None]
    rows = [tr(k, 21_600 * rnd.randrange(28), rnd.choice(w), rnd.choice(w), 1, "P" if rnd.random() < 0.9 else "Q") for k in range(500)]
    want, day = defaultdict(lambda: [0, 0]), dt.timedelta(days=1)
    for a in rows:
        seen = {x for r in rows if r[9] == a[9] and a[1] <= r[1] <= a[1] + day for x in r[2:4] if x and len(x) == 56}
        us = int((a[1] - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))
        for pair in combinations(sorted(seen), 2):
            want[pair] = [want[pair][0] + 1, max(want[pair][1], us)]
    got = joins.weighted_co_trades(spark.createDataFrame(rows, TRADE), 86_400_000_000).collect()
    assert len(got) == len(want) and {(r["src"], r["dst"]): [r["weight"], r["latest"]] for r in got} == dict(want)


def test_weighted_co_trades_of_no_trades(spark):
    assert joins.weighted_co_trades(spark.createDataFrame([tr(0, 0, "bad", None, 1)], TRADE), 86_400_000_000).collect() == []


def test_gaps_do_not_depend_on_batches(monkeypatch):
    rnd = random.Random(13)
    rows = sorted((pair, span, 86_400 * (4 * span + rnd.randrange(5)) + rnd.randrange(86_400), rnd.choice([None, 3, 4, 5]), rnd.choice([None, -7, 8])) for pair in (1, 2) for span in (-1, 0) for _ in range(60))
    t = pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("pair", "span", "us", "a", "c"), zip(*rows))})

    def gaps(batch, held):
        monkeypatch.setattr(joins, "ROWS", held)
        return sorted(z for x in joins._gaps(iter(t.to_batches(batch)), 86_400, 3) for z in zip(*(x[c][0].as_py() for c in joins.GAP)))

    want = gaps(1000, 1000)
    assert len(want) > 50 and gaps(7, 1) == want and gaps(7, 100) == want
