"""Incremental landing ingestion with Structured Streaming (T1).

The reference's ledger protocol (mark a file A, process, mark it I, move it to
a processed prefix) is what Spark's file stream source does natively: the
checkpoint records which files each micro-batch took, so every file is taken
exactly once across restarts, and ``cleanSource=archive`` moves a file away
only after the batch that read it has committed.

The stream only lists files (a ``binaryFile`` source that reads paths, never
content).  Each micro-batch then runs the batch ingest on exactly its own
files: one scan, headers, verdicts, rows.  The file verdicts go to
``<out>/verdicts/batch_id=<n>`` and the parsed rows (good and unparsable, told
apart by the corrupt-record column) to a working folder, which is renamed to
``<out>/parsed/batch_id=<n>`` last.  A batch replayed after a failure overwrites
what it had not published and leaves what it had, so a batch is published once
and whole, and a stream that reads it (``streaming.totals``) never meets a part.
(On an object store whose rename copies, a reader must wait for the batch.)
Zero-length files yield no row in a scan and are therefore never offered to a
batch (they carry no data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillmart.operators import conform as C
from tillmart.plans.ingest import ingest
from tillmart.session import apply_defaults
from tillmart.sources import fs
from tillmart.sources.landing import canonical

LISTING_STREAM_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("content", T.BinaryType(), True),
    ]
)


def published(out_dir: str) -> str:
    """Where the batches' parsed rows appear."""
    return f"{out_dir.rstrip('/')}/parsed"


def _batch_writer(out_dir: str):
    out = out_dir.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # The file source reports decoded paths; bring them to the listing's spelling.
        files = {canonical(r.path): r.length for r in batch.select("path", "length").collect()}
        target = f"{published(out)}/batch_id={batch_id}"
        if not files or fs.exists(spark, target):
            return
        working = f"{out}/working/batch_id={batch_id}"
        ing = ingest(spark, paths=sorted(files), lengths=files, staging=working)
        ing.verdicts.write.mode("overwrite").parquet(f"{out}/verdicts/batch_id={batch_id}")
        fs.rename(spark, working, target)

    return write_batch


def start(
    spark: SparkSession,
    landing_dir: str,
    out_dir: str,
    checkpoint: str,
    max_files_per_trigger: int = 64,
    archive_dir: str | None = None,
    available_now: bool = True,
):
    """Start the ingest stream; returns the ``StreamingQuery``."""
    apply_defaults(spark)
    reader = (
        spark.readStream.format("binaryFile")
        .schema(LISTING_STREAM_SCHEMA)
        .option("maxFilesPerTrigger", str(max_files_per_trigger))
        .option("recursiveFileLookup", "true")
    )
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    files = reader.load(landing_dir).select("path", "length")
    writer = files.writeStream.foreachBatch(_batch_writer(out_dir)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def _parsed(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.schema(C.STAGED_SCHEMA).parquet(published(out_dir)).drop("batch_id")


def read_rows(spark: SparkSession, out_dir: str) -> DataFrame:
    """All rows ingested so far (every committed batch)."""
    return C.good_rows(_parsed(spark, out_dir))


def read_corrupt(spark: SparkSession, out_dir: str) -> DataFrame:
    """Bad rows of every committed batch: path, file_name, record, bad_column, reason."""
    return C.corrupt_rows(_parsed(spark, out_dir))
