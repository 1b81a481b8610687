from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quartzflow.llm import packing


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=80), st.integers(100, 300), st.integers(1, 6))
def test_bins_hold_no_more_than_fits_and_few_are_open(sizes, capacity, most):
    b, used = packing.OpenBins(capacity, most), {}
    for s in sizes:
        k = b.place(s)
        used[k] = used.get(k, 0) + s
        assert used[k] <= capacity and b.open <= most
    free = [x for bins in b.at.values() for x in bins]
    assert all(f == capacity - used[k] for k, f in free)


def test_tightest_bin_is_taken_and_the_fullest_closes():
    b = packing.OpenBins(10, 2)
    assert [b.place(6), b.place(7)] == [0, 1]
    assert b.place(3) == 1  # exactly full
    assert b.place(8) == 2 and b.place(5) == 3  # bin 2, the fullest, closed
    assert b.place(4) == 0


def test_large_capacities_are_graded_without_overflow():
    b, used = packing.OpenBins(1_000_003, 8), {}
    for k in range(3000):
        s = (k * 7919) % 400_000 + 1
        n = b.place(s)
        used[n] = used.get(n, 0) + s
    assert max(used.values()) <= 1_000_003 and sum(used.values()) / (len(used) * 1_000_003) > 0.9


def test_contents(spark):
    rows = [(k, "x" * n) for k, n in enumerate([0, 5, 9, 10, 25, 30])] + [(6, None), (7, "ä" * 5), (7, "ä" * 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"bin": F.lit(1), "part": F.lit(2), "container": F.lit("c")})
    got = packing.pack(df, "doc_id", F.octet_length("text") + 1, [("c", 10), ("none", None), ("zero", 0)]).collect()
    assert {r["container"] for r in got} == {"c"}
    total, per, fill = {}, {}, {}
    for r in got:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["size"]
        per.setdefault(r["doc_id"], []).append(r)
        fill[r["bin"]] = fill.get(r["bin"], 0) + r["size"]
    assert total == {0: 1, 1: 6, 2: 10, 3: 11, 4: 26, 5: 31, 7: 22}
    assert max(fill.values()) <= 10
    assert {d for d, rs in per.items() if any(r["parts"] > 1 for r in rs)} == {3, 4, 5, 7}
    assert sorted(r["size"] for r in per[4]) == [6, 10, 10]
    assert packing.pack(df.limit(0), "doc_id", F.octet_length("text") + 1, [("c", 10)]).count() == 0
