"""Parquet sinks: detail marts, the month/store partitioned mart, snapshots.

* Plain marts are overwritten whole (the reference's ``ParquetWriter``).
* The partitioned mart is written with ``REBALANCE`` on its partition keys:
  AQE then coalesces small partitions and splits a skewed one (one store or
  month holding a large share of rows) over several tasks, so each task writes
  few files without any task carrying a whole hot partition.  Overwrite is
  dynamic: only the (month, store) directories present in the batch are
  replaced, so re-running a month is idempotent.
* Snapshots go to ``<base>/<epoch_ms>`` and readers pick the newest complete one.
* What a run stores (``placed``) is in zstd, each file sorted by the key that
  its widest columns hang on, so repeated names and addresses take little room.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillmart.sources import fs

PARTITION_KEYS = ("sales_month", "store_id")
CODEC = "zstd"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once and read it back: a lineage cut in the shared folder,
    so a frame used by two branches of a plan is computed once and a lost
    executor re-reads files instead of recomputing the upstream joins.  Written
    with zstd: a working table is read a few times and then left."""
    df.write.mode("overwrite").option("compression", CODEC).parquet(path)
    return df.sparkSession.read.parquet(path)


def placed(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...] = (), rebalance: bool = True) -> DataFrame:
    """``df`` for a write by ``keys``, the rows of a file in the order of ``order``."""
    df = df.hint("rebalance", *keys) if rebalance else df
    return df.sortWithinPartitions(*keys, *order) if order else df


def write_partitioned(df: DataFrame, path: str, keys: tuple[str, ...] = PARTITION_KEYS) -> None:
    (
        df.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a partitioned mart with its declared types (no partition-value
    type inference, so ``sales_month`` stays text and ``store_id`` an int)."""
    return spark.read.schema(schema).parquet(path)


def epoch_ms(now: float | None = None) -> int:
    """Epoch milliseconds at second precision, as the snapshot directory name."""
    return int(time.time() if now is None else now) * 1000


def write_snapshot(df: DataFrame, base: str, now: float | None = None, partition_by: tuple[str, ...] = (), copy: bool = False) -> str:
    """``copy``: ``df`` is a stored mart, partitioned as the snapshot will be; its rows
    are written from where they are read, file by file, and not rebalanced again."""
    target = f"{base.rstrip('/')}/{epoch_ms(now)}"
    if partition_by and not copy:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target)
    return target


def latest_snapshot(spark: SparkSession, base: str) -> str | None:
    """Newest ``<base>/<epoch_ms>`` directory whose write completed."""
    done = []
    for path, is_dir, _ in fs.list_dir(spark, base):
        name = path.rstrip("/").rsplit("/", 1)[-1]
        if is_dir and name.isdigit() and fs.exists(spark, f"{path}/_SUCCESS"):
            done.append((int(name), path))
    return max(done)[1] if done else None
