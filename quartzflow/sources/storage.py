"""Partitioned tables, upserts and snapshots on plain parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartzflow.functions.scalar import row_hash

PERIODS = ("year", "month", "day", "hour")


def with_time_keys(df: DataFrame, ts: str, period: str) -> DataFrame:
    parts = {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts), "hour": F.hour(ts)}
    return df.withColumns({p: parts[p] for p in PERIODS[: PERIODS.index(period) + 1]})


def write_by_time(df: DataFrame, path: str, ts: str, period: str = "month", mode: str = "append") -> None:
    """Partition columns that Spark prunes by, instead of side files. Rows are spread within a partition by AQE's rebalance."""
    keys = PERIODS[: PERIODS.index(period) + 1]
    with_time_keys(df, ts, period).hint("rebalance", *keys).write.mode(mode).partitionBy(*keys).parquet(path)


def write_by_pair(df: DataFrame, path: str, pair: str, mode: str = "append") -> None:
    safe = F.regexp_replace(F.coalesce(F.col(pair), F.lit("none")), "[^A-Za-z0-9_.-]", "_")
    df.withColumn("pair_key", safe).hint("rebalance", "pair_key").write.mode(mode).partitionBy("pair_key").parquet(path)


def write_by_prefix(df: DataFrame, path: str, wallet: str, length: int = 2, mode: str = "append") -> None:
    if not 1 <= length <= 8:
        raise ValueError("a prefix has 1 to 8 signs")
    df.withColumn("prefix", F.upper(F.substring(wallet, 1, length))).hint("rebalance", "prefix").write.mode(mode).partitionBy("prefix").parquet(path)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row a key of ``new``, and those of ``old`` whose key it lacks; keys are matched null-safe.

    Of rows of ``new`` with the same key the last by ``order`` counts, and of equals the greatest row.
    """
    rest = [c for c in new.columns if c not in keys]
    if rest:
        new = new.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order, *rest)).alias("__r")).select(*keys, "__r.*").select(*new.columns)
    else:
        new = new.distinct()
    n = new.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return old.join(n, on, "left_anti").unionByName(new)


def changed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose content differs from the row of the same key in ``old``, or that are new."""
    rest = [c for c in new.columns if c not in keys]
    o = old.select(*[F.col(k).alias(f"__{k}") for k in keys], row_hash(rest).alias("__h"))
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys] + [row_hash(rest) == F.col("__h")]
    return new.join(o, on, "left_anti")


def snapshot_digest(df: DataFrame) -> DataFrame:
    """Rows and an order-free digest of a table's content."""
    h = F.conv(F.substring(row_hash(df.columns), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n"), F.sum(h).alias("digest"))


def schema_diff(a: DataFrame, b: DataFrame) -> dict[str, list[str]]:
    """Fields added, removed and of another type, from the schemas alone."""
    x, y = dict(a.dtypes), dict(b.dtypes)
    return {"added": sorted(set(y) - set(x)), "removed": sorted(set(x) - set(y)), "retyped": sorted(c for c in set(x) & set(y) if x[c] != y[c])}
