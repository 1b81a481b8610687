"""Session construction and the shared working folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def make_session(app: str = "quartzflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect: UTC, AQE, Arrow."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach.

    ``spark.checkpoint.dir`` names it. Where that is unset only a local master may make up its own.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        named = "file://" + tempfile.mkdtemp(prefix="quartzflow-")
        spark.conf.set("spark.checkpoint.dir", named)
        atexit.register(_remove, spark, named)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/quartzflow/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    atexit.register(_remove, spark, path)
    return path


_SCRATCH: list[str] = []
cleared = 0  # times it was; what is remembered from before is no longer there


def clear_scratch(spark: SparkSession) -> None:
    """Remove all that was written to the shared folder so far: for drivers that live long, between two jobs whose results are taken."""
    global cleared
    cleared += 1
    while _SCRATCH:
        _remove(spark, _SCRATCH.pop())


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001 - the JVM may be gone already
        pass


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    The table survives the loss of executors, keeps column pruning and costs no memory.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_blocks(files: list[str], condition, rows: int):
    """Arrow batches, not empty, of ``files``: for tasks that read a written table as a whole, a block at a time."""
    import pyarrow.dataset as ds
    import pyarrow.fs as pafs

    for uri in files:
        fs, path = pafs.FileSystem.from_uri(uri)
        for block in ds.dataset(path, filesystem=fs, format="parquet").to_batches(filter=condition, batch_size=rows, batch_readahead=1, fragment_readahead=1):
            if block.num_rows:
                yield block


def told_apart(names: DataFrame, name: str) -> tuple[DataFrame, Callable[[Column | str], Column]]:
    """``names``, one row a ``name``, written, and a 64-bit hash that is different for each: ids of 8 bytes for joins that would move long names."""
    names = written(names, "names")
    for seed in range(100):
        h = (lambda seed: lambda c: F.xxhash64(F.lit(seed), c))(seed)
        rows, hashes = names.agg(F.count("*"), F.count_distinct(h(name))).head()
        if rows == hashes:
            return names, h
    raise ValueError(f"{name} is not unique")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
