import datetime as dt
import random

from quartzflow.operators import references as ref

D = dt.datetime(2024, 1, 1)
H = dt.timedelta(hours=1)


def test_against_brute_force(spark):
    rng = random.Random(4)
    keys = [f"k{j}" for j in range(30)]
    parents = [(k, D + rng.randint(0, 90) * H) for k in keys[:20] for _ in range(rng.choice([1, 1, 2]))] + [(None, D), ("k3", None), ("k29", None)]
    changes = [(rng.choice(keys[:22]), D + rng.randint(0, 200) * H, f"e{j:03}", rng.random() < 0.5) for j in range(120)]
    changes += changes[:20] + [(None, D, "z", True), ("k1", None, "z", True)]
    refs = [(j, rng.choice(["k0"] * 10 + keys + [None]), rng.choice([None] + [D + rng.randint(0, 220) * H] * 9), "a", 1, "b") for j in range(900)]
    spans = ref.lifetimes(spark.createDataFrame(parents, "key string, created timestamp"), spark.createDataFrame(changes, "key string, at timestamp, seq string, removed boolean"))
    df = spark.createDataFrame(refs, "id int, ref string, at timestamp, since string, __n int, maybe string")
    got = sorted(r["id"] for r in ref.orphans(df, "ref", "at", spans).collect())
    end = dt.datetime(9999, 1, 1)

    def exists(k, t):
        t = t or end
        born = [c for p, c in parents if p == k and c and c <= t]
        past = [(a, s, gone) for p, a, s, gone in changes if p == k and a and a <= t]
        return bool(born) and not (past and max(past)[2])

    assert got == [j for j, k, t, *_ in refs if k and not exists(k, t)]


def test_no_parents_makes_all_orphans_and_no_references_none(spark):
    spans = ref.lifetimes(spark.createDataFrame([], "key string, created timestamp"), spark.createDataFrame([], "key string, at timestamp, seq string, removed boolean"))
    df = spark.createDataFrame([(1, "a", D), (2, None, D)], "id int, ref string, at timestamp")
    assert [r["id"] for r in ref.orphans(df, "ref", "at", spans).collect()] == [1]
    assert ref.orphans(df.limit(0), "ref", "at", spans).count() == 0


def test_with_a_filter_of_one_block_the_result_is_the_same(spark, monkeypatch):
    parents = spark.createDataFrame([(f"k{j}", D) for j in range(50)], "key string, created timestamp")
    spans = ref.lifetimes(parents, spark.createDataFrame([], "key string, at timestamp, seq string, removed boolean"))
    df = spark.createDataFrame([(j, f"k{j}", D + H) for j in range(80)], "id int, ref string, at timestamp")
    a = sorted(r["id"] for r in ref.orphans(df, "ref", "at", spans).collect())
    monkeypatch.setattr(ref, "FILTER_MB", 0)
    assert a == sorted(r["id"] for r in ref.orphans(df, "ref", "at", spans).collect()) == list(range(50, 80))


def test_keys_that_come_and_go_often_are_searched_by_time(spark, monkeypatch):
    rng = random.Random(6)
    changes = [("hot", D + rng.randint(0, 2000) * H, f"e{j:03}", j % 2 == 0) for j in range(300)] + [("cold", D + 5 * H, "x", True)]
    spans = ref.lifetimes(spark.createDataFrame([("hot", D), ("cold", D), ("calm", D)], "key string, created timestamp"), spark.createDataFrame(changes, "key string, at timestamp, seq string, removed boolean"))
    refs = [(j, rng.choice(["hot", "hot", "cold", "calm", "none"]), D + rng.randint(0, 2200) * H) for j in range(1500)] + [(9000, "hot", D - H), (9001, "hot", None)]
    df = spark.createDataFrame(refs, "id int, ref string, at timestamp")
    found = {}
    for most in (16, 10_000):
        monkeypatch.setattr(ref, "INLINE_SPANS", most)
        found[most] = sorted(r["id"] for r in ref.orphans(df, "ref", "at", spans).collect())
    assert found[16] == found[10_000] and 9000 in found[16] and {j for j, k, _ in refs if k == "none"} < {*found[16]}


def test_a_full_filter_only_lets_more_through(spark, monkeypatch):
    assert ref.filter_blocks(10**9)[0] * 34 <= ref.FILTER_MB * 2**20 and ref.filter_blocks(1000) == (62, 2) and ref.filter_blocks(10**8)[1] == 1
    assert ref.filter_blocks(0)[0] == 1
