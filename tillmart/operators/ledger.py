"""File ledger (L1-L4): which landed files a run has taken up and finished.

The reference keeps one mutable row per file in a database table (status A
while a run works on it, I when done).  Here the ledger is an append-only
Parquet table of status events; the state of a file, known by its full path
(two folders may hold files of one name), is its newest event.
Appends of small event batches are cheap and never rewrite history, and the
state is a grouped ``max_by``, so no row is ever updated in place.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.functions.scalars import base_name
from tillmart.schemas import LEDGER_SCHEMA, STATUS_ACTIVE, STATUS_INACTIVE
from tillmart.sources import fs


def events(
    spark: SparkSession, files: DataFrame | list[str], status: str, at: dt.datetime, batch: str | None = None
) -> DataFrame:
    """One ledger event per file (L2 with status A, L3 with status I): of the
    ``path`` column of a frame, such as the stored verdicts, or of given paths."""
    if not isinstance(files, DataFrame):
        files = spark.createDataFrame([(p,) for p in files], "path string")
    return files.select(
        base_name("path").alias("file_name"),
        F.col("path").alias("file_location"),
        F.lit(at).alias("event_ts"),
        F.lit(status).alias("status"),
        F.lit(batch).cast("string").alias("batch"),
    )


def append(events_df: DataFrame, ledger_path: str) -> None:
    events_df.write.mode("append").parquet(ledger_path)


def read(spark: SparkSession, ledger_path: str) -> DataFrame:
    if not fs.exists(spark, ledger_path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)


def state(ledger: DataFrame) -> DataFrame:
    """file_name, file_location, status, created_date, updated_date, batch.

    The newest event wins; on equal timestamps I (done) beats A.  ``batch`` is
    that of the newest closing.
    """
    newest = F.struct("event_ts", "status")
    closed = F.when(F.col("status") == STATUS_INACTIVE, F.col("event_ts"))
    return ledger.groupBy("file_location").agg(
        F.max("file_name").alias("file_name"),
        F.max_by("status", newest).alias("status"),
        F.min(F.when(F.col("status") == STATUS_ACTIVE, F.col("event_ts"))).alias("created_date"),
        F.max(closed).alias("updated_date"),
        F.max_by("batch", closed).alias("batch"),
    ).select("file_name", "file_location", "status", "created_date", "updated_date", "batch")


def active_files(listing: DataFrame, ledger_state: DataFrame) -> DataFrame:
    """Landed files an earlier run took up but did not finish (L1)."""
    open_files = ledger_state.where(F.col("status") == STATUS_ACTIVE).select(F.col("file_location").alias("path"))
    return listing.select("path", "file_name").join(open_files, "path", "left_semi").select("file_name")


def pending_files(listing: DataFrame, ledger_state: DataFrame) -> DataFrame:
    """Landed CSV files not yet finished by any run (L4): the next run's input."""
    done = ledger_state.where(F.col("status") == STATUS_INACTIVE).select(F.col("file_location").alias("path"))
    return listing.where("is_csv").join(done, "path", "left_anti")


def compact(spark: SparkSession, ledger_path: str) -> int:
    """Fold the event files present now into at most three events per file
    (newest per status, oldest 'A'), which determine ``state`` exactly.

    A maintenance step for quiet times, never part of a run: a run that has
    listed the old files could miss them.

    The kept events are appended first and only then are the files read
    deleted: the log holds old plus kept events in between, which has the same
    state (duplicates do not change it), so a crash or a concurrent reader
    sees the same state at every step.  Files appended by a run meanwhile are
    neither read nor deleted.  Returns the number of files folded."""
    before = [
        p for p, is_dir, _ in fs.list_dir(spark, ledger_path)
        if not is_dir and p.rsplit("/", 1)[-1].startswith("part-")
    ]
    if len(before) < 2:
        return 0
    events = spark.read.schema(LEDGER_SCHEMA).parquet(*before)
    per_status = events.groupBy("file_location", "status").agg(
        F.max("file_name").alias("file_name"),
        F.max("event_ts").alias("new_ts"),
        F.max_by("batch", "event_ts").alias("batch"),
        F.min("event_ts").alias("old_ts"),
    )
    newest = per_status.withColumnRenamed("new_ts", "event_ts").drop("old_ts")
    oldest_active = per_status.where(F.col("status") == STATUS_ACTIVE).withColumnRenamed("old_ts", "event_ts").drop("new_ts")
    kept = newest.unionByName(oldest_active).distinct()
    # As many files as the state is large: AQE sizes the write's tasks.
    kept.select(*LEDGER_SCHEMA.fieldNames()).hint("rebalance").write.mode("append").parquet(ledger_path)
    for path in before:
        fs.delete(spark, path, recursive=False)
    return len(before)
