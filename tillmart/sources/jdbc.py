"""JDBC source and sink for the dimension tables and the marts (S5, O3).

Reads are split over ``num_partitions`` ranges of a numeric key, so a large
dimension is read by many tasks instead of one connection; pass the key's
bounds (for example from ``SELECT min(id), max(id)``) when calling.  Writes
raise on error (the reference swallowed them) and default to a truncating
overwrite, so re-running a job replaces the mart instead of doubling it.

Not exercised by the test suite: testing needs a database server or an
embedded database started inside the test process, and this project starts
neither.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    props = {**properties, "fetchsize": str(fetch_size)}
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower_bound,
        upperBound=upper_bound,
        numPartitions=num_partitions,
        properties=props,
    )


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    mode: str = "overwrite",
    batch_size: int = 10_000,
    max_connections: int | None = None,
) -> None:
    """Write ``df`` to ``table``; ``max_connections`` caps parallel writers."""
    if max_connections is not None:
        df = df.coalesce(max_connections)
    props = {**properties, "batchsize": str(batch_size), "truncate": "true"}
    df.write.jdbc(url, table, mode=mode, properties=props)
