"""Registered queries over the CSV landing zone (steps 4 and 5).

The landing zone is written by Spark from the provided tables
(``sources.landing_fixture``) into the shared folder, once per session, and
ingested once per session; each query then reads its part of the result.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.operators import ledger as LG
from tillmart.operators import quarantine as Q
from tillmart.operators import validate as V
from tillmart.plans.ingest import Ingested, ingest
from tillmart.session import apply_defaults, run_all, scratch_path, shared_dir
from tillmart.sources import landing as L
from tillmart.sources.landing_fixture import landing_for

# Ingest results hold DataFrames of one session: keyed by application too, so
# a new session over the same shared folder ingests (reads) again.
_INGESTED: dict[tuple[str, str, str], tuple[str, Ingested]] = {}


def landed(spark: SparkSession, sf_dir: str) -> tuple[str, Ingested]:
    apply_defaults(spark)
    landing = landing_for(spark, sf_dir)
    key = (spark.sparkContext.applicationId, shared_dir(spark), landing)
    if key not in _INGESTED:
        _INGESTED[key] = (landing, ingest(spark, landing))
    return _INGESTED[key]


def q_landing_listing(spark, sf_dir):
    landing, _ = landed(spark, sf_dir)
    return L.list_files(spark, landing).select("file_name", "is_csv")


def q_header_probe(spark, sf_dir):
    _, ing = landed(spark, sf_dir)
    return ing.verdicts.where("is_csv").select("file_name", F.array_join("header_cols", ",").alias("header"))


def _with_header(ing: Ingested) -> DataFrame:
    return ing.verdicts.where(F.col("is_csv") & F.col("header_cols").isNotNull())


def q_missing_columns(spark, sf_dir):
    _, ing = landed(spark, sf_dir)
    return _with_header(ing).select(
        "file_name", F.array_join("missing", ",").alias("missing"), F.size("missing").alias("n_missing")
    )


def q_extra_columns(spark, sf_dir):
    _, ing = landed(spark, sf_dir)
    return _with_header(ing).select(
        "file_name", F.array_join("extra", ",").alias("extra"), F.size("extra").alias("n_extra")
    )


def q_file_verdicts(spark, sf_dir):
    _, ing = landed(spark, sf_dir)
    return ing.verdicts.select("file_name", "verdict", "reason")


def q_quarantine_rows(spark, sf_dir):
    _, ing = landed(spark, sf_dir)
    return V.quarantine_lines(ing.verdicts, ing.lines)


def q_corrupt_rows(spark, sf_dir):
    _, ing = landed(spark, sf_dir)
    return ing.corrupt.groupBy("file_name", "bad_column", "reason").agg(F.count(F.lit(1)).alias("n_rows"))


def q_additional_column(spark, sf_dir):
    _, ing = landed(spark, sf_dir)
    return ing.rows.groupBy("file_name", "additional_column").agg(F.count(F.lit(1)).alias("n_rows"))


def q_csv_ingest_unified(spark, sf_dir):
    _, ing = landed(spark, sf_dir)
    return ing.rows.drop("path")


def q_empty_input(spark, sf_dir):
    """A run whose files are all rejected yields a typed, empty frame."""
    _, ing = landed(spark, sf_dir)
    rejected = [p for p in ing.error_paths if p.endswith(".csv")]
    return ingest(spark, paths=rejected).rows.drop("path")


# --- step 5: ledger ------------------------------------------------------------
# A replayed history: run 1 took up and finished the valid files of months
# before 2000; run 2 took up the later ones and stopped before closing them.
RUN1_OPEN = dt.datetime(2024, 1, 1, 0, 0, 0)
RUN1_CLOSE = dt.datetime(2024, 1, 1, 1, 0, 0)
RUN2_OPEN = dt.datetime(2024, 1, 2, 0, 0, 0)
SPLIT_YEAR = 2000


def ledger_history(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    landing, ing = landed(spark, sf_dir)
    valid = ing.verdicts.where(F.col("verdict") == V.VALID)
    year = F.split_part("file_name", F.lit("_"), F.lit(2)).cast("int")
    early, late = valid.where(year < SPLIT_YEAR), valid.where(year >= SPLIT_YEAR)
    path = scratch_path(spark, "ledger")
    LG.append(LG.events(spark, early, "A", RUN1_OPEN), path)
    LG.append(LG.events(spark, early, "I", RUN1_CLOSE), path)
    LG.append(LG.events(spark, late, "A", RUN2_OPEN), path)
    return landing, path


def q_ledger_state(spark, sf_dir):
    _, path = ledger_history(spark, sf_dir)
    return LG.state(LG.read(spark, path)).select("file_name", "status", "created_date", "updated_date")


def q_active_files(spark, sf_dir):
    landing, path = ledger_history(spark, sf_dir)
    return LG.active_files(L.list_files(spark, landing), LG.state(LG.read(spark, path)))


def q_pending_files(spark, sf_dir):
    landing, path = ledger_history(spark, sf_dir)
    return LG.pending_files(L.list_files(spark, landing), LG.state(LG.read(spark, path))).select("file_name")


LANDING_QUERIES = {
    "landing_listing": q_landing_listing,
    "header_probe": q_header_probe,
    "missing_columns": q_missing_columns,
    "extra_columns": q_extra_columns,
    "file_verdicts": q_file_verdicts,
    "quarantine_rows": q_quarantine_rows,
    "corrupt_rows": q_corrupt_rows,
    "additional_column": q_additional_column,
    "csv_ingest_unified": q_csv_ingest_unified,
    "empty_input": q_empty_input,
    "ledger_state": q_ledger_state,
    "active_files": q_active_files,
    "pending_files": q_pending_files,
}


# --- step 6: a whole run, and the streaming ingest -----------------------------
# Fixed run time, so the ledger rows of the run are reproducible.
RUN_AT = dt.datetime(2024, 2, 1, 0, 0, 0)


def _run(spark, sf_dir):
    from tillmart.plans import job
    from tillmart.sources.tables import RetailInputs

    landing = landing_for(spark, sf_dir)
    r = RetailInputs(spark, sf_dir)
    dims = job.Dimensions(r.customer(), r.store(), r.sales_team())
    return job, job.run(spark, landing, dims, scratch_path(spark, "run"), now=RUN_AT)


def q_end_to_end_run(spark, sf_dir):
    """Landing zone -> marts in one run; returns the sales-team mart as stored."""
    job, result = _run(spark, sf_dir)
    return job.read_mart(spark, result.paths["sales_mart"])


def q_concurrent_runs(spark, sf_dir):
    """Two runs at the same time over one landing zone, each taking half of its
    files; returns the sales-team mart as both have stored it."""
    from tillmart.plans import job
    from tillmart.sources.tables import RetailInputs

    landing, out = landing_for(spark, sf_dir), scratch_path(spark, "concurrent-runs")
    r = RetailInputs(spark, sf_dir)
    dims = job.Dimensions(r.customer(), r.store(), r.sales_team())
    half = (L.list_files(spark, landing).count() + 1) // 2
    found = []
    run_all(*[lambda: found.append(job.run(spark, landing, dims, out, now=RUN_AT, max_files=half)) for _ in range(2)])
    return job.read_mart(spark, found[0].paths["sales_mart"])


def q_published_marts(spark, sf_dir):
    """Two of the marts of one published version: each salesperson's monthly total
    beside the number of its detail rows."""
    from tillmart.plans import job
    from tillmart.sinks import published as PB
    from tillmart.sources.tables import RetailInputs

    landing, out = landing_for(spark, sf_dir), scratch_path(spark, "published-run")
    r = RetailInputs(spark, sf_dir)
    job.run(spark, landing, job.Dimensions(r.customer(), r.store(), r.sales_team()), out, now=RUN_AT, publish=True)
    keys = ["store_id", "sales_person_id", "sales_month"]
    rows = PB.read(spark, f"{out}/published", "sales_partitioned").groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return PB.read(spark, f"{out}/published", "sales_mart").join(rows, keys).select(*keys, "total_sales", "n_rows")


def q_run_customer_mart(spark, sf_dir):
    """The customer mart as a run stores it."""
    job, result = _run(spark, sf_dir)
    return job.read_mart(spark, result.paths["customer_mart"])


def q_run_quarantine(spark, sf_dir):
    """The rejected files of a run with the number of their quarantined lines."""
    _, result = _run(spark, sf_dir)
    files = Q.read(spark, result.paths["quarantine"], "files").select("path", "file_name", "reason")
    lines = Q.read(spark, result.paths["quarantine"], "lines").groupBy("path").agg(F.count("*").alias("n"))
    return files.join(lines, "path", "left").select("file_name", "reason", F.coalesce("n", F.lit(0)).cast("long").alias("n_lines"))


def q_stream_file_ingest(spark, sf_dir):
    """The landing zone ingested by a Structured Streaming query, in
    micro-batches of at most 16 files; returns every ingested row."""
    from tillmart.streaming import ingest as S

    landing = landing_for(spark, sf_dir)
    out = scratch_path(spark, "stream-out")
    query = S.start(spark, landing, out, f"{out}/_checkpoint", max_files_per_trigger=16)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return S.read_rows(spark, out).drop("path")


def q_stream_monthly_totals(spark, sf_dir):
    """The salespersons' monthly totals as a stream over the ingest stream keeps them."""
    from tillmart.sources.tables import RetailInputs
    from tillmart.streaming import ingest as S
    from tillmart.streaming import totals as ST

    landing, out = landing_for(spark, sf_dir), scratch_path(spark, "stream-totals")
    r = RetailInputs(spark, sf_dir)
    ingested = S.start(spark, landing, f"{out}/ingest", f"{out}/ingest_checkpoint", max_files_per_trigger=16)
    ingested.awaitTermination()
    totals = ST.start(spark, f"{out}/ingest", r.customer(), r.store(), r.sales_team(), out, f"{out}/checkpoint", max_files_per_trigger=8)
    totals.awaitTermination()
    return ST.read(spark, out)


LANDING_QUERIES.update({"published_marts": q_published_marts, "stream_monthly_totals": q_stream_monthly_totals, "run_customer_mart": q_run_customer_mart, "run_quarantine": q_run_quarantine})
LANDING_QUERIES.update({"concurrent_runs": q_concurrent_runs, "end_to_end_run": q_end_to_end_run, "stream_file_ingest": q_stream_file_ingest})
