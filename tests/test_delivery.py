import random
import shutil

import pytest

from pyspark.sql import functions as F

from quartzflow.functions.ids import trade_id
from quartzflow.operators import delivery


def run(spark, rows, path, parts=3, extra=None):
    df = spark.createDataFrame(rows, "trade_id string, delivery_id bigint, payload string")
    if extra:
        df = df.withColumns(extra)
    df.repartition(parts).write.mode("overwrite").parquet(str(path))
    return delivery.one_copy_each(spark, str(path), trade_id("trade_id"), "delivery_id")


def test_first_delivery_stays(spark, tmp_path):
    rng = random.Random(1)
    ids = [rng.choice(["hot"] * 5 + [f"t{k}" for k in range(40)]) for _ in range(900)]
    spell = [lambda s: s, str.upper, lambda s: f" {s}\t"]
    rows = [(rng.choice(spell)(t), k, f"p{k}") for k, t in enumerate(ids)]
    d = run(spark, rows, tmp_path / "t")
    first = {}
    for t, k, _ in rows:
        first.setdefault(t.strip(" \t").lower(), k)
    assert sorted(r["delivery_id"] for r in d.kept.collect()) == sorted(first.values())
    assert {r["delivery_id"] for r in d.removed.collect()} == set(range(900)) - set(first.values())
    assert all(r["payload"] == f"p{r['delivery_id']}" for r in d.kept.collect())


def test_no_id_identifies_nothing_and_ties_keep_one(spark, tmp_path):
    rows = [(None, 1, "a"), (None, 2, "b"), (" ", 3, "c"), ("x", None, "d"), ("x", 5, "e"), ("y", 7, "f"), ("y", 7, "f"), ("z", None, None)]
    d = run(spark, rows, tmp_path / "t")
    kept = [(r["trade_id"], r["delivery_id"]) for r in d.kept.collect()]
    assert sorted(kept, key=str) == sorted([(None, 1), (None, 2), (" ", 3), ("x", 5), ("y", 7), ("z", None)], key=str)
    assert d.removed.count() == 2


def test_empty_table_and_clashing_columns(spark, tmp_path):
    assert run(spark, [], tmp_path / "e").kept.count() == 0
    names = {c: F.lit(c) for c in ("k", "file_id", "row", "__kept", "bits", "_metadata")}
    d = run(spark, [("a", 1, "x"), ("a", 2, "y")], tmp_path / "c", extra=names)
    assert [r["delivery_id"] for r in d.kept.collect()] == [1] and {*names} <= {*d.kept.columns}


def test_more_rows_than_a_vector(spark, tmp_path):
    n = 70_000
    spark.range(n).select((F.col("id") % 50_000).cast("string").alias("trade_id"), F.col("id").alias("delivery_id"), F.lit("p").alias("payload")).coalesce(1).write.parquet(str(tmp_path / "big"))
    d = delivery.one_copy_each(spark, str(tmp_path / "big"), trade_id("trade_id"), "delivery_id")
    r = d.removed.agg(F.count("*"), F.min("delivery_id"), F.max("delivery_id")).head()
    assert tuple(r) == (20_000, 50_000, 69_999)


def test_a_lost_vector_is_an_error_and_deletes_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(delivery, "scratch_path", lambda s, n: f"file://{tmp_path}/{n}")
    d = run(spark, [("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z")], tmp_path / "t")
    for p in (tmp_path / "vectors").glob("shard=*"):
        shutil.rmtree(p)
    with pytest.raises(Exception, match="is missing"):
        d.kept.collect()
