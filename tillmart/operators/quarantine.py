"""Quarantine by run (V4): files, lines and rows that are no sales.

A run appends its own rows of each kind and, last, one row per file it took
(path, batch, taken_at).  Reading keeps, for every file, the rows of the newest
run that took it: a file that arrives again replaces its own earlier rows, a
file that has become valid has none.  What a run writes depends on its own
files only, and a run that stops before its last write changes nothing that
readers see.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.session import run_all
from tillmart.sinks.parquet import CODEC
from tillmart.sources import fs

TAKEN_SCHEMA = "path string, batch string, taken_at long"


def _taken(spark: SparkSession, base: str) -> DataFrame:
    """path, batch, taken_at of every file a run has taken."""
    if not fs.exists(spark, f"{base}/taken"):
        return spark.createDataFrame([], TAKEN_SCHEMA)
    return spark.read.schema(TAKEN_SCHEMA).parquet(f"{base}/taken")


def seen_paths(spark: SparkSession, base: str) -> DataFrame:
    """(path) of the files that some run has taken."""
    return _taken(spark, base).select("path").distinct()


def append(spark: SparkSession, base: str, batch: str, tables: dict[str, DataFrame], paths: DataFrame) -> None:
    """Write the run's ``tables`` (kind -> rows with a ``path``) and then the
    ``paths`` (path) it took; the tables are written side by side."""
    run_all(*[lambda k=k, t=t: t.write.mode("overwrite").option("compression", CODEC).parquet(f"{base}/{k}/batch={batch}") for k, t in tables.items()])
    last = _taken(spark, base).agg(F.max("taken_at")).first()[0]
    at = max(int(time.time() * 1000), (last or 0) + 1)
    paths.select("path", F.lit(batch).alias("batch"), F.lit(at).cast("long").alias("taken_at")).write.mode("append").parquet(f"{base}/taken")


def read(spark: SparkSession, base: str, kind: str) -> DataFrame:
    """The rows of one kind as they stand: the newest run of each file."""
    newest = _taken(spark, base).groupBy("path").agg(F.max_by("batch", F.struct("taken_at", "batch")).alias("batch"))
    rows = spark.read.parquet(f"{base}/{kind}").withColumn("batch", F.col("batch").cast("string"))
    return rows.join(newest, ["path", "batch"], "left_semi").drop("batch")
