"""Messages delivered more than once: keep one copy of each.

Only the identifier, the order of delivery and the place of the row in its file are shuffled. The aggregation picks
the first delivery of each identifier, map-side first, so an identifier with a third of all rows collapses before the
shuffle. The places become one bit vector per file and 32,768 rows, written to the shared folder; the wide payload is
then read once, never shuffled, and each row looks up its bit by file and row number. Every vector of every file is
written, also one that keeps nothing, so a vector that can't be found is an error and never means "not kept".
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from quartzflow.session import scratch_path, written

ROWS_PER_VECTOR = 32_768  # fixed by bitmap_construct_agg
VECTORS_PER_GROUP = 256  # neighbouring vectors of a file (8.4 million rows) stay together
VECTORS_PER_SHARD = 1_024  # 4 MB of bits: what a worker reads for one look-up


@dataclass(frozen=True)
class Deduplicated:
    kept: DataFrame
    removed: DataFrame


@lru_cache(maxsize=4)
def _shard(path: str, shard: int) -> dict[tuple[int, int], object]:
    """Vectors of one shard, as arrays of bits; cached in the Python worker."""
    import numpy as np
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    fs, root = pafs.FileSystem.from_uri(path)
    found = {}
    for info in fs.get_file_info(pafs.FileSelector(f"{root}/shard={shard}", allow_not_found=True)):
        if info.path.endswith(".parquet"):
            t = pq.ParquetFile(fs.open_input_file(info.path)).read()
            for file_id, vector, bits in zip(t["file_id"].to_pylist(), t["vector"].to_pylist(), t["bits"].to_pylist()):
                found[file_id, vector] = np.zeros(ROWS_PER_VECTOR // 8, np.uint8) if bits is None else np.frombuffer(bits, dtype=np.uint8)
    return found


def _is_kept(path: str):
    @F.pandas_udf(BooleanType())
    def kept(shard: pd.Series, file_id: pd.Series, row: pd.Series) -> pd.Series:
        import numpy as np

        shards, files, rows = shard.to_numpy(), file_id.to_numpy(), row.to_numpy()
        out = np.zeros(len(rows), dtype=bool)
        vectors = rows // ROWS_PER_VECTOR
        cuts = np.flatnonzero((np.diff(files) != 0) | (np.diff(vectors) != 0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(rows)]):
            if lo == hi:
                continue
            file, vector = int(files[lo]), int(vectors[lo])
            bits = _shard(path, int(shards[lo])).get((file, vector))
            if bits is None:
                raise RuntimeError(f"the bit vector {vector} of file {file} is missing in {path}: it was removed, or the table has changed since")
            at = rows[lo:hi] - vector * ROWS_PER_VECTOR
            out[lo:hi] = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        return pd.Series(out)

    return kept


def first_deliveries(df: DataFrame, key: Column, order: str) -> DataFrame:
    """Place (file_id, row) of the row to keep of every key; rows without a key are all kept."""
    placed = df.select(
        key.alias("k"),
        F.coalesce(F.col(order).cast("bigint"), F.lit(2**63 - 1)).alias("o"),
        F.xxhash64(df.metadataColumn("_metadata").getField("file_path")).alias("file_id"),
        df.metadataColumn("_metadata").getField("row_index").alias("row"),
    )
    # Without a key, the place stands in for it.
    placed = placed.withColumn("kf", F.when(F.col("k").isNull(), F.col("file_id"))).withColumn("kr", F.when(F.col("k").isNull(), F.col("row")))
    return placed.groupBy("k", "kf", "kr").agg(F.min_by("file_id", "o").alias("file_id"), F.min_by("row", "o").alias("row"))


def one_copy_each(spark: SparkSession, path: str, key: Column, order: str) -> Deduplicated:
    """Split the parquet table at ``path`` into one copy of each ``key`` (the smallest ``order``) and the rest.

    Null and empty keys (as ``key`` gives them) identify nothing: such rows are all kept. A null order comes last. Of
    rows that share key and order one is kept, the same for every later read, since the vectors are written once. An
    empty table gives two empty results. Columns pass through whatever their names are.
    """
    df = spark.read.parquet(path)
    meta = df.metadataColumn("_metadata")
    file, row = meta.getField("file_path"), meta.getField("row_index")
    # Files and their vectors, from the footers' row counts alone: no column is read.
    frame = df.select(file.alias("file"), F.floor(row / ROWS_PER_VECTOR).cast("bigint").alias("vector")).groupBy("file", "vector").agg(F.count("*").alias("n"))
    frame = written(frame.withColumn("file_id", F.xxhash64("file")), "frame")
    vectors, files, ids = frame.agg(F.count("*"), F.count_distinct("file"), F.count_distinct("file_id")).head()
    if not vectors:
        return Deduplicated(df, df.limit(0))
    if files != ids:
        raise ValueError("two files have the same 64-bit hash of their paths; rename one")
    shards = -(-vectors // VECTORS_PER_SHARD)
    shard = lambda f, r: F.pmod(F.xxhash64(f, F.floor(r / (ROWS_PER_VECTOR * VECTORS_PER_GROUP)).cast("bigint")), F.lit(shards)).cast("int")
    at = scratch_path(spark, "vectors")
    winners = first_deliveries(df, key, order).withColumn("vector", F.floor(F.col("row") / ROWS_PER_VECTOR).cast("bigint"))
    # The positions move as two numbers each; vectors are built after that shuffle, since a partial vector of 4 KB
    # for each task and vector would outweigh them. A shard of finished vectors is one file.
    bits = winners.repartition("file_id", "vector").groupBy("file_id", "vector").agg(F.expr(f"bitmap_construct_agg(row % {ROWS_PER_VECTOR})").alias("bits"))
    (
        frame.select("file_id", "vector")
        .join(bits, ["file_id", "vector"], "left")
        .withColumn("shard", shard(F.col("file_id"), F.col("vector") * ROWS_PER_VECTOR))
        .repartition("shard")
        .write.partitionBy("shard")
        .parquet(at)
    )
    file_id = F.xxhash64(file)
    mark = _is_kept(at)(shard(file_id, row), file_id, row)
    flag = "__kept"
    while flag in df.columns:
        flag += "_"
    marked = df.withColumn(flag, mark)
    return Deduplicated(marked.filter(F.col(flag)).drop(flag), marked.filter(~F.col(flag)).drop(flag))
