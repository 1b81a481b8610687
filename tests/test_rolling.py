import datetime as dt
import random
from decimal import Decimal

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quartzflow.operators import rolling


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=40), st.integers(1, 12))
def test_scan_equals_queue_and_brute_force(xs, w):
    want_sum = [sum(xs[max(0, i - w + 1) : i + 1]) for i in range(len(xs))]
    want_max = [max(xs[max(0, i - w + 1) : i + 1]) for i in range(len(xs))]
    x = np.array([xs])
    assert rolling.two_stack_scan(x, w, np.add, 0)[0].tolist() == want_sum
    assert rolling.two_stack_scan(x, w, np.maximum, -1000)[0].tolist() == want_max
    q, got = rolling.TwoStackQueue(max, -1000), []
    for v in xs:
        q.push(v)
        if len(q) > w:
            q.evict()
        got.append(q.read())
    assert got == want_max


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "acc string, t timestamp, amount decimal(19,7), entity int, total string")


def test_against_brute_force(spark):
    rng = random.Random(3)
    d0 = dt.datetime(2024, 1, 1)
    big = Decimal("999999999999.9999999")
    rows = []
    for k in range(700):
        acc = rng.choice(["hot"] * 10 + [f"a{j}" for j in range(15)])
        rows.append((acc, d0 + dt.timedelta(days=rng.randint(0, 75), seconds=rng.randint(0, 86399)), rng.choice([None, Decimal(0), big, -big, Decimal(rng.randint(1, 10**12)) / 10**7]), 1, "x"))
    rows += [(None, d0, Decimal(1), 1, "x"), ("a0", None, Decimal(1), 1, "x")]
    daily = rolling.daily_sums(rows_of(spark, rows), F.col("acc"), "t", "amount")
    base = (d0.date() - dt.date(1970, 1, 1)).days
    last = base + 75
    got = {(r["entity"], r["window_days"], r["day"]): r for r in rolling.rolling_windows(daily, (7, 30), last).collect()}
    peaks = {(r["entity"], r["window_days"]): r["day"] for r in rolling.rolling_windows(daily, (7, 30), last, peaks=True).collect()}
    by = {}
    for a, t, x, *_ in rows:
        if a and t:
            by.setdefault(a, {}).setdefault((t.date() - dt.date(1970, 1, 1)).days, []).append(x or Decimal(0))
    n = 0
    for a, days in by.items():
        for w in (7, 30):
            best = None
            for d in range(min(days), last + 1):
                xs = [v for e in range(d - w + 1, d + 1) for v in days.get(e, [])]
                r = got[a, w, d]
                assert r["total"] == sum(xs) and r["n"] == len(xs)
                assert r["largest"] == (max(xs) if xs else None)
                best = max(best or (sum(xs), -d), (sum(xs), -d))
                n += 1
            assert peaks[a, w] == -best[1]
    assert n == len(got)


def test_empty(spark):
    daily = rolling.daily_sums(rows_of(spark, []), F.col("acc"), "t", "amount")
    assert rolling.rolling_windows(daily, (7,)).count() == 0 and rolling.rolling_windows(daily, (7,), peaks=True).count() == 0
