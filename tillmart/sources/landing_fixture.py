"""A landing zone of CSV files written by Spark from the provided tables.

The whole sales fact (``tables.sales``) is split into files by sales month,
and a month into ``ceil(rows / ROWS_PER_FILE)`` parts, so the number of files
grows with the data and no file (and no writing task) outgrows a fixed size:

    sales_<yyyy>_<MM>_p<part>.csv,  part = (l_orderkey + l_linenumber) % parts

The header shape of a month's files follows a fixed rule on the month number,
so the expected verdicts can be restated in SQL:

    shape = (year * 12 + month) % 5
    0 exact      the 8 mandatory columns; a quantity of 50 is written as
                 'fifty', an unparsable number (row quarantine)
    1 extra      8 + payment_mode
    2 reordered  the 8 in reverse order + payment_mode, coupon (often blank)
    3 less       no store_id, + payment_mode          -> missing:store_id
    4 case       store_id spelled Store_ID            -> missing:store_id

Besides the monthly files the zone holds ``notes.txt`` (one line per month;
not a CSV) and ``empty.csv`` (zero bytes).  Files are written by Spark (all
rows of one file in one task, hash-partitioned by file name, so a task writes
whole files of bounded size) and then given stable names.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tillmart.schemas import MANDATORY_COLUMNS
from tillmart.session import LARGE_BYTES, MAX_CONCURRENT_JOBS, run_all, scratch_path, shared_dir, shuffles_freed
from tillmart.sinks.parquet import stage
from tillmart.sources import fs
from tillmart.sources.tables import Tables, sales_keyed

# --- fixed values of the landing fixture -------------------------------------
# Rows per landed file at most (about 50 MB of CSV); a month with more rows is
# written as several files.
ROWS_PER_FILE = 500_000
N_SHAPES = 5
BAD_QUANTITY = 50
NOTES_FILE = "notes.txt"
EMPTY_FILE = "empty.csv"

SHAPE_HEADERS: dict[int, list[str]] = {
    0: list(MANDATORY_COLUMNS),
    1: MANDATORY_COLUMNS + ["payment_mode"],
    2: list(reversed(MANDATORY_COLUMNS)) + ["payment_mode", "coupon"],
    3: [c for c in MANDATORY_COLUMNS if c != "store_id"] + ["payment_mode"],
    4: ["Store_ID" if c == "store_id" else c for c in MANDATORY_COLUMNS],
}
VALID_SHAPES = (0, 1, 2)


def file_key(part: F.Column, date_col: str = "sales_date") -> F.Column:
    """File name of a month's part; the part number has four digits or more."""
    number = part.cast("string")
    padded = F.when(F.length(number) < 4, F.lpad(number, 4, "0")).otherwise(number)
    return F.concat(F.lit("sales_"), F.date_format(F.col(date_col), "yyyy_MM"), F.lit("_p"), padded, F.lit(".csv"))


def with_file(fact, rows_per_file: int, target: str):
    """Adds ``_file``: the month's part is the spread key modulo the number of
    parts, which comes from a per-month row count (one row per month, joined
    back).  The counts are stored in ``target`` first: a table of known size,
    which Spark broadcasts, so the fact is not shuffled by month for them."""
    month = F.date_format(F.col("sales_date"), "yyyy_MM")
    parts = stage(
        fact.groupBy(month.alias("_month"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_month", F.ceil(F.col("_rows") / F.lit(rows_per_file)).cast("long").alias("_parts")),
        target,
    )
    return (
        fact.join(parts, month == F.col("_month"), "inner")
        .withColumn("_file", file_key(F.col("_spread") % F.col("_parts")))
        .drop("_month", "_parts", "_spread")
    )


def shape_of(date_col: str = "sales_date") -> F.Column:
    return (F.year(date_col) * 12 + F.month(date_col)) % N_SHAPES


def _columns(shape: int) -> list[F.Column]:
    out = []
    for name in SHAPE_HEADERS[shape]:
        if name == "payment_mode":
            out.append(F.when(F.col("quantity") % 2 == 0, "cash").otherwise("UPI").alias(name))
        elif name == "coupon":
            out.append(
                F.when(F.col("quantity") % 3 == 0, F.concat(F.lit("SAVE"), F.col("quantity").cast("string")))
                .alias(name)
            )
        elif name == "Store_ID":
            out.append(F.col("store_id").alias(name))
        elif name == "quantity" and shape == 0:
            out.append(
                F.when(F.col("quantity") == BAD_QUANTITY, F.lit("fifty"))
                .otherwise(F.col("quantity").cast("string"))
                .alias(name)
            )
        else:
            out.append(F.col(name))
    return out


# Bytes of CSV for a byte of the stored fact, about.
CSV_BYTES = 4
# Concurrent metadata calls (list, rename) when files get their names.
PUBLISH_THREADS = 16


def _publish(spark: SparkSession, written: str, landing: str) -> None:
    """Move ``written/_file=<name>/part-*`` to ``landing/<name>``.

    One list and one rename per file, issued from a small thread pool: on an
    object store each call is a round trip, and files number in thousands."""

    def move(part_dir: str) -> None:
        name = part_dir.rstrip("/").rsplit("/", 1)[-1].split("=", 1)[1]
        parts = [p for p, d, _ in fs.list_dir(spark, part_dir) if not d and p.rsplit("/", 1)[-1].startswith("part-")]
        if len(parts) != 1:
            raise RuntimeError(f"expected one part file for {name}, found {len(parts)}")
        fs.rename(spark, parts[0], f"{landing}/{name}")

    dirs = [
        p for p, is_dir, _ in fs.list_dir(spark, written)
        if is_dir and p.rstrip("/").rsplit("/", 1)[-1].startswith("_file=")
    ]
    with ThreadPoolExecutor(max_workers=PUBLISH_THREADS) as pool:
        list(pool.map(move, dirs))


def write_landing(
    spark: SparkSession, sf_dir: str, landing: str | None = None, rows_per_file: int = ROWS_PER_FILE
) -> str:
    """Write the landing zone for ``sf_dir``; returns its location.  Its working tables
    are deleted at the end."""
    landing = landing or scratch_path(spark, "landing")
    with shuffles_freed(spark):
        _write_landing(spark, sf_dir, landing, rows_per_file)
    return landing


def _write_landing(spark: SparkSession, sf_dir: str, landing: str, rows_per_file: int) -> None:
    staging = scratch_path(spark, "landing-staging")
    fact_path = f"{staging}/fact"
    fact = with_file(stage(sales_keyed(Tables(spark, sf_dir)).drop("additional_column"), fact_path), rows_per_file, f"{staging}/parts").withColumn("_shape", shape_of())
    fs.mkdirs(spark, landing)

    def write_shape(shape: int) -> None:
        out = f"{staging}/shape{shape}"
        (
            fact.where(F.col("_shape") == shape)
            .select("_file", *_columns(shape))
            .repartition("_file")
            .write.option("header", "true")
            .option("dateFormat", "yyyy-MM-dd")
            .partitionBy("_file")
            .csv(out)
        )
        _publish(spark, out, landing)

    def write_notes() -> None:
        notes = f"{staging}/notes"
        (
            fact.select(F.date_format("sales_date", "yyyy-MM").alias("value"), F.lit(NOTES_FILE).alias("_file"))
            .distinct()
            .repartition("_file")
            .write.partitionBy("_file")
            .text(notes)
        )
        _publish(spark, notes, landing)

    # The shapes write disjoint files: independent jobs, submitted together while small.
    large = fs.size(spark, fact_path) * CSV_BYTES >= LARGE_BYTES
    run_all(*[lambda s=shape: write_shape(s) for shape in SHAPE_HEADERS], write_notes, at_once=1 if large else MAX_CONCURRENT_JOBS)
    fs.touch(spark, f"{landing}/{EMPTY_FILE}")
    fs.delete(spark, staging)


_CACHE: dict[tuple[str, str], str] = {}


def landing_for(spark: SparkSession, sf_dir: str) -> str:
    """The landing zone for ``sf_dir``, written once per session."""
    key = (shared_dir(spark), sf_dir.rstrip("/"))
    if key not in _CACHE or not fs.exists(spark, _CACHE[key]):
        _CACHE[key] = write_landing(spark, sf_dir)
    return _CACHE[key]
