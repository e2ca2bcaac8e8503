"""Monthly salesperson totals kept up to date by a stream (T1, A2).

The source is what the ingest stream has published: a batch's rows appear there
whole and once (``streaming.ingest``), so the file source counts every row once
across restarts of either stream.  The rows join the dimensions (a stream-static
join: a sale gets the dimension rows of its arrival) and are summed per store,
salesperson and month in Spark's state store.  There is no watermark, because a
late file may bring any month; the state is as large as the mart itself.

In update mode a batch yields the new totals of the keys it touched.  They go to
``<out>/totals/batch_id=<n>``, overwritten when a batch is replayed after a
failure, and the newest batch of a key counts.  ``read`` gives the totals of the
batches written so far.  At scale choose the RocksDB state store
(``spark.sql.streaming.stateStore.providerClass``), which holds state on disk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.operators import conform as C
from tillmart.operators import enrich as E
from tillmart.operators import marts as M
from tillmart.session import apply_defaults
from tillmart.sources import fs
from tillmart.streaming.ingest import published

KEYS = ["store_id", "sales_person_id", "full_name", "sales_month"]
TOTALS_SCHEMA = T.StructType(
    [
        T.StructField("store_id", T.IntegerType()),
        T.StructField("sales_person_id", T.LongType()),
        T.StructField("full_name", T.StringType()),
        T.StructField("sales_month", T.StringType()),
        T.StructField("total_sales", T.DecimalType(18, 2)),
        T.StructField("batch_id", T.LongType()),
    ]
)


def start(
    spark: SparkSession,
    ingest_dir: str,
    customer: DataFrame,
    store: DataFrame,
    sales_team: DataFrame,
    out_dir: str,
    checkpoint: str,
    max_files_per_trigger: int = 64,
    available_now: bool = True,
):
    """Start the totals stream over the ingest stream's ``ingest_dir``; returns the ``StreamingQuery``."""
    apply_defaults(spark)
    fs.mkdirs(spark, published(ingest_dir))
    rows = (
        spark.readStream.schema(C.STAGED_SCHEMA)
        .option("maxFilesPerTrigger", str(max_files_per_trigger))
        .parquet(f"{published(ingest_dir)}/*")
    )
    enriched = E.enrich(C.good_rows(rows), customer, store, sales_team)
    totals = M.sales_monthly_totals(M.sales_team_detail(enriched))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/totals/batch_id={batch_id}")

    writer = totals.writeStream.outputMode("update").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read(spark: SparkSession, out_dir: str) -> DataFrame:
    """store_id, sales_person_id, full_name, sales_month, total_sales as of the newest batch."""
    path = f"{out_dir.rstrip('/')}/totals"
    fs.mkdirs(spark, path)
    updates = spark.read.schema(TOTALS_SCHEMA).parquet(path)
    return updates.groupBy(*KEYS).agg(F.max_by("total_sales", "batch_id").alias("total_sales"))
