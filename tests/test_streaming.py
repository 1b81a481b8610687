import datetime as dt
import json

from pyspark.sql import functions as F

from quartzflow.streaming import trades as st

D = dt.datetime(2024, 1, 1)
S = dt.timedelta(seconds=1)


def stream(spark, path, df, parts=3):
    df.repartition(parts).write.mode("overwrite").parquet(str(path))
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def test_parse_splits_bad_messages(spark):
    good = {"trade_id": "t", "ledger_close_time": "2024-01-01T00:00:00Z", "base_amount": 1.5}
    raw = spark.createDataFrame([(json.dumps(good),), ("{broken",), (json.dumps({"trade_id": "u"}),), (None,)], "value string")
    ok, bad = st.parse(raw)
    assert [r["trade_id"] for r in ok.collect()] == ["t"]
    assert sorted(r["reason"] for r in bad.collect()) == ["incomplete", "malformed", "malformed"]


def test_dedup_equals_batch(spark, tmp_path):
    df = spark.createDataFrame([(f"t{k % 50}", D + k * S) for k in range(200)], "id string, ts timestamp")
    out = st.drained(st.deduplicated(stream(spark, tmp_path / "in", df), ["id"], "ts"), f"file://{tmp_path}/out", f"file://{tmp_path}/cp")
    assert sorted(r["id"] for r in out.collect()) == sorted(f"t{k}" for k in range(50))


def test_cooldown_state(spark, tmp_path):
    df = spark.createDataFrame([("w", D + s * S, float(x)) for s, x in ((0, 90), (30, 95), (60, 90), (61, 10), (130, 90))], "wallet string, at timestamp, score double")
    out = st.drained(st.cooled(stream(spark, tmp_path / "in", df, 1), 50, 60), f"file://{tmp_path}/out", f"file://{tmp_path}/cp")
    assert sorted((r["at"] - D).seconds for r in out.collect()) == [0, 60, 130]


def test_upsert_sink(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    write = st.upsert_to(f"file://{tmp_path}/t", ["k"])
    write(df, 0)
    write(spark.createDataFrame([("a", 2), ("b", 3)], "k string, v int"), 1)
    write(spark.createDataFrame([("a", 2), ("b", 3)], "k string, v int"), 1)  # the batch is tried again
    assert sorted(tuple(r) for r in st.read_upserted(spark, f"file://{tmp_path}/t").collect()) == [("a", 2), ("b", 3)]


def test_sliding_and_session_plans(spark, tmp_path):
    df = spark.createDataFrame([("w", "p", D + s * S, "d", 5, 1.0) for s in (0, 10, 100)], "wallet string, pair string, at timestamp, detector string, score int, amount double")
    s = stream(spark, tmp_path / "in", df, 1)
    out = st.drained(st.sessions(s, "at", ["wallet", "pair"], late="0 seconds"), f"file://{tmp_path}/o2", f"file://{tmp_path}/c2")
    assert sum(r["n"] for r in out.collect()) <= 3
    out = st.drained(st.sliding_stats(s, "at", "wallet", "amount", "1 minute", "1 minute"), f"file://{tmp_path}/o3", f"file://{tmp_path}/c3", "complete")
    assert out.agg(F.sum("n")).head()[0] == 3
