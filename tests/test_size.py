"""Operators that once moved every pair they compared: what they shuffle must grow with the rows, not the pairs."""

import random
from itertools import combinations

from quartzflow.operators import graphs, joins, trades

from tests.test_features import TRADE, tr


def shuffled(spark, run):
    """The result of ``run``, and the rows that its stages shuffled."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty()

    def stages():
        got = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
        return {(got.apply(k).stageId(), got.apply(k).attemptId()): got.apply(k).shuffleWriteRecords() for k in range(got.size())}

    before, most = stages(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with large tables
    try:
        out = run()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    return out, sum(n for k, n in stages().items() if k not in before)


def test_timing_moves_histograms_not_pairs(spark):
    # All meet in hour 0, so all 22,500 pairs share a bin; but for the equal ones they differ in the other two hours.
    rows = [tr(0, 3600 * 999, "z", None, 1)]
    for k in range(150):
        rows += [tr(1, 3600 * h, f"{v}{k}", None, 1, venue=v) for v in ("amm", "sdex") for h in (0, 1 + k, 500 + k)]
    s = trades.wallet_sides(spark.createDataFrame(rows, TRADE))
    got, moved = shuffled(spark, lambda: [tuple(r) for r in joins.timing_correlation(s.filter("venue = 'amm'"), s.filter("venue = 'sdex'")).collect()])
    assert sorted(got) == sorted((f"amm{k}", f"sdex{k}", 3, 1.0) for k in range(150))
    assert moved < 10_000


def test_motifs_move_neighbours_not_paths(spark):
    # Many paths for few edges; counts against brute force.
    rnd, nodes = random.Random(3), [f"n{k}" for k in range(120)]
    edges = [(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(2_400)] + [("hub", n) for n in nodes]
    near = {n: set() for n in [*nodes, "hub"]}
    for a, b in edges:
        if a != b:
            near[a].add(b), near[b].add(a)
    shared = [(a, b, len(near[a] & near[b])) for a, b in combinations(near, 2)]
    directed = {(a, b) for a, b in edges if a != b}
    want = (sum(n for a, b, n in shared if b in near[a]) // 3, sum(len(n) * (len(n) - 1) // 2 for n in near.values()), sum(n * (n - 1) // 2 for *_, n in shared) // 2, round(sum((b, a) in directed for a, b in directed) / len(directed), 6))
    got, moved = shuffled(spark, lambda: tuple(graphs.motifs(spark.createDataFrame(edges, "src string, dst string")).head()))
    assert got == want
    assert moved < 12 * len(edges)


def test_motifs_of_no_edges(spark):
    assert tuple(graphs.motifs(spark.createDataFrame([("a", "a")], "src string, dst string")).head()) == (0, None, 0, 0.0)


def test_co_trades_move_gaps_not_couples(spark):
    # 200 wallets meet on two pairs on one day: 19,900 couples from 400 trades.
    w = [f"G{'A' * 53}{a}{b}" for a in "ABCDEFGHIJ" for b in "ABCDEFGHIJKLMNOPQRST"]
    rows = [tr(k, 2 * k, x, None, 1, pair) for pair in "PQ" for k, x in enumerate(w)]
    got, moved = shuffled(spark, lambda: {(r["src"], r["dst"]): r["weight"] for r in joins.weighted_co_trades(spark.createDataFrame(rows, TRADE), 86_400_000_000).collect()})
    assert got == {(a, b): 2 * (k + 1) for k, a in enumerate(w) for b in w[k + 1 :]}
    assert moved < 10_000


def test_co_trades_move_a_trade_and_a_gap_once(spark):
    # 6,000 trades of 80 wallets in 60 days; once spans, events and gaps moved apart, and the gaps twice.
    rnd, w = random.Random(7), [f"G{'A' * 53}{a}{b}" for a in "ABCDEFGH" for b in "ABCDEFGHIJ"]
    rows = [tr(k, rnd.randrange(60 * 86_400), rnd.choice(w), rnd.choice(w), 1, rnd.choice("PQR")) for k in range(6_000)]
    df = spark.createDataFrame(rows, TRADE)
    stages = spark.sparkContext._jsc.sc().statusStore
    none = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), spark.sparkContext._jvm.java.util.ArrayList()

    def total():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        got = stages().stageList(None, False, False, *none)
        return sum(got.apply(k).shuffleWriteBytes() for k in range(got.size()))

    before = total()
    _, moved = shuffled(spark, lambda: joins.weighted_co_trades(df, 86_400_000_000).count())
    assert moved < 3 * len(rows)
    assert total() - before < 100 * len(rows)
