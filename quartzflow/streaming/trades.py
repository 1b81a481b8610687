"""Streams of trades: parsing with a dead-letter side, deduplication, windows, state per wallet, sessions, joins, upserts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quartzflow.operators import digits
from quartzflow.sources import storage

WIRE = "trade_id string, base_account string, counter_account string, base_amount double, counter_amount double, price double, asset_pair string, ledger_close_time timestamp, ingestion_timestamp_ms bigint"


def read_kafka(spark: SparkSession, servers: str, topics: str, most_per_trigger: int = 500_000) -> DataFrame:
    """Raw messages; the limit per trigger is the back-pressure."""
    return spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topics).option("maxOffsetsPerTrigger", most_per_trigger).load()


def parse(raw: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Typed trades, and the messages that are none with the reason (for the dead-letter topic)."""
    text = F.col(value).cast("string")
    p = raw.select(text.alias("value"), F.from_json(text, WIRE + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("t"))
    reason = F.when(F.col("t").isNull() | F.col("t._bad").isNotNull(), "malformed").when(F.col("t.trade_id").isNull() | F.col("t.ledger_close_time").isNull(), "incomplete")
    p = p.withColumn("reason", reason)
    return p.filter("reason is null").select("t.*").drop("_bad"), p.filter("reason is not null").select("value", "reason")


def deduplicated(trades: DataFrame, key: list[str], time: str, ttl: str = "24 hours") -> DataFrame:
    """Each key once within the time to live; state older than the watermark is dropped."""
    return trades.withWatermark(time, ttl).dropDuplicatesWithinWatermark(key)


def sliding_stats(trades: DataFrame, time: str, by: str, amount: str, window: str = "60 seconds", slide: str = "10 seconds", late: str = "1 hour") -> DataFrame:
    g = trades.withWatermark(time, late).groupBy(F.window(time, window, slide), by)
    return g.agg(F.count("*").alias("n"), F.avg(amount).alias("mean"), F.min(amount).alias("low"), F.max(amount).alias("high")).select(F.col("window.start").alias("start"), by, "n", "mean", "low", "high")


def sessions(alerts: DataFrame, time: str, by: list[str], gap: str = "60 seconds", late: str = "1 hour") -> DataFrame:
    """Alert groups that a pause ends."""
    g = alerts.withWatermark(time, late).groupBy(F.session_window(time, gap), *by)
    return g.agg(F.count("*").alias("n"), F.max("score").alias("score"), F.array_sort(F.collect_set("detector")).alias("detectors")).select(F.col("session_window.start").alias("began"), F.col("session_window.end").alias("ended"), *by, "n", "score", "detectors")


def with_metadata(trades: DataFrame, updates: DataFrame, valid: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Left join of trades (wallet, ts, ...) with metadata updates (wallet_, at, ...) not older than ``valid``."""
    t, u = trades.withWatermark("ts", late), updates.withWatermark("at", late)
    return t.join(u, F.expr(f"wallet = wallet_ and at <= ts and at >= ts - interval {valid}"), "leftOuter")


STATE = "last timestamp, c array<double>, n bigint"
SCORE = "wallet string, ts timestamp, n bigint, mad double"
_EXPECTED = list(digits.FIRST.values())


def decayed_digit_scores(sides: DataFrame, seconds: float, least: int = 20, late: str = "1 hour") -> DataFrame:
    """First-digit MAD of each wallet over exponentially decayed counts, one row per wallet and batch.

    ``sides``: wallet, ts, digit. Rows that arrive behind the wallet's last time don't decay it but count with the
    weight of their age. Wallets idle for a day of event time lose their state. Wallets under ``least`` trades give a null MAD.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last, counts, n = state.get if state.exists else (None, [0.0] * 9, 0)
        counts = list(counts)
        for f in frames:
            f = f.sort_values("ts")
            for ts, d in zip(f["ts"], f["digit"]):
                if last is None or ts > last:
                    if last is not None:
                        k = 2.718281828459045 ** (-(ts - last).total_seconds() / seconds)
                        counts = [c * k for c in counts]
                    last, w = ts, 1.0
                else:
                    w = 2.718281828459045 ** (-(last - ts).total_seconds() / seconds)
                n += 1
                if pd.notna(d):
                    counts[int(d) - 1] += w
        state.update((last, counts, n))
        state.setTimeoutTimestamp(max(int(last.timestamp() * 1000) + 86_400_000, state.getCurrentWatermarkMs() + 1))
        total = sum(counts)
        mad = sum(abs(c / total - p) for c, p in zip(counts, _EXPECTED)) / 9 if n >= least and total else None
        yield pd.DataFrame({"wallet": [key[0]], "ts": [last], "n": [n], "mad": [mad]})

    return sides.withWatermark("ts", late).groupBy("wallet").applyInPandasWithState(step, SCORE, STATE, "update", GroupStateTimeout.EventTimeTimeout)


def cooled(alerts: DataFrame, threshold: float, pause_s: float) -> DataFrame:
    """Alerts (wallet, at, score) at or above the threshold, none within the pause after the wallet's last delivered one."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        for f in frames:
            out = []
            for at, score in f.sort_values("at")[["at", "score"]].itertuples(index=False):
                if score >= threshold and (last is None or (at - last).total_seconds() >= pause_s):
                    last = at
                    out.append((key[0], at, score))
            if out:
                yield pd.DataFrame(out, columns=["wallet", "at", "score"])
        if last is not None:
            state.update((last,))

    return alerts.groupBy("wallet").applyInPandasWithState(step, "wallet string, at timestamp, score double", "last timestamp", "append", GroupStateTimeout.NoTimeout)


def upsert_to(path: str, keys: list[str], order: tuple[str, ...] = ()):
    """For foreachBatch: merge a batch into the table at ``path``; versions are written side by side and the newest is read."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = _newest(spark, path, number)
        merged = storage.upsert(batch.limit(0), batch, keys, order) if before is None else storage.upsert(spark.read.parquet(before), batch, keys, order)
        merged.write.mode("overwrite").parquet(f"{path}/v={number:012d}")

    return write


def _newest(spark: SparkSession, path: str, below: int) -> str | None:
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    found = sorted(s.getPath().getName() for s in fs.listStatus(root) if s.getPath().getName().startswith("v="))
    found = [f for f in found if int(f[2:]) < below]
    return f"{path}/{found[-1]}" if found else None


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    at = _newest(spark, path, 2**62)
    if at is None:
        raise FileNotFoundError(path)
    return spark.read.parquet(at)


def drained(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there now and return what it wrote."""
    q = df.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", checkpoint)
    if mode == "append":
        q.format("parquet").option("path", out).start().awaitTermination()
    else:
        q.foreachBatch(lambda b, _: b.write.mode("append").parquet(out)).start().awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(out)
