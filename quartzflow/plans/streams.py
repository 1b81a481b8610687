"""Streaming forms run to the end over the test tables, beside the SQL of their batch meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartzflow.functions.ids import account_id, trade_id
from quartzflow.operators import digits
from quartzflow.session import scratch_path, table
from quartzflow.streaming import trades as st


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    schema = table(spark, sf, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf) if _is_file(spark, f"{sf}/{name}.parquet") else spark.readStream.schema(schema).parquet(f"{sf}/{name}.parquet")


def _is_file(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isFile()


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Trades once each; the time to live covers the whole table, so the result is that of the batch."""
    t = _stream(spark, sf, "json_trade_0").select(trade_id("trade_id").alias("trade_id"), F.col("ledger_close_time").alias("ts")).filter("trade_id is not null")
    return st.drained(st.deduplicated(t, ["trade_id"], "ts", "400 days"), scratch_path(spark, "dedup"), scratch_path(spark, "cp")).select("trade_id")


def stream_sliding_stats(spark: SparkSession, sf: str) -> DataFrame:
    t = _stream(spark, sf, "json_trade_0").select(F.col("ledger_close_time").alias("ts"), F.col("asset_pair").alias("pair"), F.col("base_amount").cast("double").alias("amount")).filter("pair is not null")
    g = st.sliding_stats(t, "ts", "pair", "amount", "1 day", "1 day", "400 days")
    out = st.drained(g, scratch_path(spark, "stats"), scratch_path(spark, "cp"), "complete")
    return out.select(F.unix_micros("start").alias("start"), "pair", "n", "low", "high")


def stream_wallet_digits(spark: SparkSession, sf: str) -> DataFrame:
    t = _stream(spark, sf, "json_trade_0").select(account_id("base_account").alias("wallet"), F.col("ledger_close_time").alias("ts"), digits.leading_digit(F.col("base_amount")).alias("digit")).filter("wallet is not null")
    return st.drained(st.decayed_digit_scores(t, 86400.0), scratch_path(spark, "digits"), scratch_path(spark, "cp"), "update").select("wallet", "n", F.round("mad", 6).alias("mad"))


QUERIES = {f.__name__: f for f in (stream_dedup, stream_sliding_stats, stream_wallet_digits)}
SQL = {
    "stream_dedup": "select distinct lower(trim(trade_id, ' ' || chr(9))) as trade_id from json_trade_0 where coalesce(trim(trade_id, ' ' || chr(9)), '') <> ''",
    "stream_sliding_stats": "select epoch_us(date_trunc('day', ledger_close_time at time zone 'UTC')) as start, asset_pair as pair, count(*) as n, min(base_amount::double) as low, max(base_amount::double) as high from json_trade_0 where asset_pair is not null group by 1, 2",
}
