"""Ranking within groups without gathering a group into one task.

``rank() OVER (PARTITION BY g ORDER BY v DESC)`` as a window puts every row
of a group into one task.  Here the rank of a row is computed as

    rank(g, v) = 1 + number of rows of group g whose value is greater than v

from the distinct (g, v) pairs and their row counts:

1. count rows per (g, v): a grouped count with map-side partial counts;
2. range-partition the pairs by (g, v DESC): Spark samples the keys, so a
   group holding a large share of the pairs is split over several
   partitions, in key order; the pairs are written once with their partition
   number, since both branches below must see one and the same partitioning;
3. inside each (partition, group) piece, a running count of the pairs
   before each value; a piece is at most one range partition;
4. per group, the rows of the pieces in earlier partitions (a running sum
   over one row per (partition, group): at most as many rows per group as
   there are range partitions);
5. join the rank back to the rows on (g, v), null-safe.

Ties share a rank and the next rank skips, as with ``rank()``.  NULL values
sort last, as with ``ORDER BY v DESC``; NULL group keys form their own group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmart.session import scratch_path
from tillmart.sinks.parquet import stage


def rank_desc(
    df: DataFrame,
    group: list[str],
    value: str,
    out: str = "rnk",
    partitions: int | None = None,
) -> DataFrame:
    """``df`` with ``out`` = rank of ``value`` (descending) within ``group``."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group, value]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    ordered = [F.col(g).asc_nulls_first() for g in group] + [F.col(value).desc_nulls_last()]
    ranged = counts.repartitionByRange(n, *ordered).withColumn("_pid", F.spark_partition_id())
    ranged = stage(ranged, scratch_path(spark, "rank-pieces"))

    before_in_piece = (
        Window.partitionBy("_pid", *group)
        .orderBy(F.col(value).desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = ranged.select(*keys, "_pid", F.coalesce(F.sum("_n").over(before_in_piece), F.lit(0)).alias("_local"))

    earlier_pieces = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_pid", *group)
        .agg(F.sum("_n").alias("_piece"))
        .select(*group, "_pid", F.coalesce(F.sum("_piece").over(earlier_pieces), F.lit(0)).alias("_offset"))
    )
    piece_cond = [local["_pid"] == offsets["_pid"]] + [local[g].eqNullSafe(offsets[g]) for g in group]
    ranks = local.join(offsets, piece_cond, "inner").select(
        *[local[k] for k in keys], (F.lit(1) + offsets["_offset"] + local["_local"]).cast("int").alias(out)
    )
    cond = [df[k].eqNullSafe(ranks[k]) for k in keys]
    return df.join(ranks, cond, "inner").select(df["*"], ranks[out])
