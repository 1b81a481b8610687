"""The canonical trade table and its wallet-side form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartzflow.functions.ids import account_id, trade_id


def asset_name(asset: str) -> Column:
    """``CODE:ISSUER``, the issuer of the native asset being ``native``; null without a code."""
    return F.when(F.col(asset).isNull() | F.col(f"{asset}.code").isNull(), None).otherwise(F.concat_ws(":", F.col(f"{asset}.code"), F.coalesce(F.col(f"{asset}.issuer"), F.lit("native"))))


def canonical_pair(a: Column, b: Column) -> Column:
    """One name for both directions of a pair."""
    return F.concat_ws("/", F.least(a, b), F.greatest(a, b))


def flat_trades(df: DataFrame) -> DataFrame:
    """Flatten delivered trade records: ids in their one spelling, assets as names, venue from the id's first part."""
    return df.select(
        trade_id("trade_id").alias("trade_id"),
        F.col("ledger_close_time").alias("ts"),
        account_id("base_account").alias("base"),
        account_id("counter_account").alias("counter"),
        asset_name("base_asset").alias("base_asset"),
        asset_name("counter_asset").alias("counter_asset"),
        F.col("base_amount").alias("amount"),
        "counter_amount",
        "price",
        F.col("asset_pair").alias("pair"),
        F.substring_index(trade_id("trade_id"), "-", 1).alias("venue"),
    )


def wallet_sides(trades: DataFrame) -> DataFrame:
    """Two rows a trade, one for each wallet; a self-trade gives one. Every wallet query groups this instead of scanning for a wallet."""
    side = lambda s, w, c: F.struct(F.lit(s).alias("side"), F.col(w).alias("wallet"), F.col(c).alias("cp"))
    both = F.array(side("base", "base", "counter"), side("counter", "counter", "base"))
    own = F.array(side("base", "base", "counter"))
    return trades.withColumn("s", F.explode(F.when(F.col("base") == F.col("counter"), own).otherwise(both))).select(*trades.columns, "s.side", "s.wallet", "s.cp").filter(F.col("wallet").isNotNull())


def validated(trades: DataFrame) -> DataFrame:
    """``trades`` with the reasons for rejecting each, empty if there is none."""
    wallet = "^G[A-Z2-7]{55}$"
    checks = [
        ("trade_id", F.col("trade_id").isNull()),
        ("base", ~F.coalesce(F.col("base").rlike(wallet), F.lit(False))),
        ("counter", ~F.coalesce(F.col("counter").rlike(wallet), F.lit(False))),
        ("amount", ~F.coalesce(F.col("amount") > 0, F.lit(False))),
        ("price", ~F.coalesce(F.col("price") > 0, F.lit(False))),
        ("time", F.col("ts").isNull()),
    ]
    return trades.withColumn("reasons", F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in checks])))
