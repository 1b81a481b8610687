"""Reading of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """``df`` in as many partitions as there are cores, at least.

    Work on texts is bound by the CPU, and a file that can't be split would leave it to one core. Tables of many
    splits are read where they lie.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df
