import datetime as dt
import random

from pyspark.sql import functions as F

from quartzflow.functions.ids import account_id, annotator_id
from quartzflow.llm import consensus as c

D = dt.datetime(2024, 1, 1)
SCHEMA = "id bigint, wallet string, who string, label int, at timestamp, item string"


def latest(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return c.latest_verdicts(df, account_id("wallet"), annotator_id("who"), "label", "at", "id")


def test_latest_verdict_counts(spark):
    rows = [
        (1, "w", "a", 0, D, "x"), (2, " W\t", "A ", 1, D + dt.timedelta(1), "x"), (3, "w", "b", None, D, "x"), (4, None, "b", 1, D, "x"),
        (5, "w", None, 1, D, "x"), (6, "w", "c", 1, None, "x"), (7, "w", "c", 0, None, "x"), (8, "w", "d", 1, D, None), (9, "w", "d", 0, D, None),
    ]
    got = {(r["item"], r["annotator"]): r["label"] for r in latest(spark, rows).collect()}
    assert got == {("W", "a"): "1", ("W", "c"): "0", ("W", "d"): "0"}


def test_recovers_truth_that_majority_misses(spark):
    rng = random.Random(2)
    acc = {f"good{k}": (0.95, 0.95) for k in range(3)} | {f"flip{k}": (0.1, 0.1) for k in range(2)} | {"yes": (0.05, 0.99), "coin": (0.5, 0.5)}
    truth = {f"W{k}": int(rng.random() < 0.35) for k in range(1200)}
    rows = []
    for w, t in truth.items():
        for a in rng.sample(sorted(acc), 5):
            right = rng.random() < acc[a][t]
            rows.append((len(rows), w, a, t if right else 1 - t, D, None))
    r = c.consensus(latest(spark, rows))
    got = {x["item"]: int(x["label"]) for x in r.items.collect()}
    votes = {}
    for _, w, _, y, *_ in rows:
        votes.setdefault(w, []).append(y)
    em = sum(got[w] == t for w, t in truth.items()) / len(truth)
    majority = sum((sum(v) * 2 > len(v)) == truth[w] for w, v in votes.items()) / len(truth)
    assert em > 0.97 > majority + 0.1
    rel = {x["annotator"]: x["reliability"] for x in r.annotators.collect()}
    assert rel["good0"] > 0.9 and rel["flip0"] < 0.2 and 0.4 < rel["coin"] < 0.6
    shares = r.annotators.groupBy("annotator", "true_label").agg(F.sum("share").alias("s")).collect()
    assert all(abs(x["s"] - 1) < 1e-9 for x in shares)


def test_empty_and_single(spark):
    r = c.consensus(latest(spark, []))
    assert r.items.count() == 0 and r.annotators.count() == 0
    r = c.consensus(latest(spark, [(1, "w", "a", 1, D, None)]))
    assert [(x["item"], x["label"], x["agreement"]) for x in r.items.collect()] == [("W", "1", None)]
    a = c.agreement(latest(spark, [])).head()
    assert a["n_items"] == 0 and a["alpha"] is None


def test_alpha_of_known_table(spark):
    rows = [(k, f"w{i}", a, y, D, None) for k, (i, a, y) in enumerate([(1, "a", 0), (1, "b", 0), (2, "a", 1), (2, "b", 1), (3, "a", 0), (3, "b", 1), (4, "a", 0), (4, "b", 0)])]
    a = c.agreement(latest(spark, rows)).head()
    # Coincidences: 0-0 four, 1-1 two, mixed two; n = 8, five 0 and three 1.
    assert abs(a["observed"] - 6 / 8) < 1e-12 and abs(a["alpha"] - (1 - (8 - 1) * 2 / (2 * 5 * 3))) < 1e-9
