"""One full batch run over a landing zone (C3 of the survey).

    listing -> header probe -> verdicts -> ledger 'A' -> quarantine
    -> parsed rows (staged Parquet) -> enrich -> detail store (Parquet,
    partitioned by month and run) -> detail marts, month/store partitioned
    mart, monthly customer and sales-team marts -> lost sales -> published
    snapshots -> ledger 'I' -> moves of rejected and processed files

Failure model: every output is a Parquet directory written by Spark's
committer, so a lost executor only re-runs its tasks.  Marts are written
before the ledger marks files done; a run that dies in between leaves them
'A' (reported by ``active_files`` on the next run) and re-processing them
replaces the same month partitions (dynamic partition overwrite), so
running twice equals running once.

The detail is stored by (month, run), rows with the path of their file: as many
directories as months per run, whatever the number of files.  A row counts if
the ledger's newest closing of its file names its run, so rows of a run that
died, or of a file that was taken up again, are passed over; a month's files may
arrive over several runs, and each run rebuilds the marts of its months.
Quarantine tables hold each run's own rows; the newest run of a file counts
(``operators.quarantine``), so taking a rejected file again adds nothing.  A run
whose valid files have no rows, or no row with all dimensions, is a run like
any other: its files are closed and its marts are empty.  Files are moved
last, each to its path below the landing folder, so equal names never meet.

Runs at the same time share the work: each claims the pending files that no other
run holds (``operators.claims``) and parses them side by side with the others;
what all runs share (ledger, detail, marts) is published one run after another,
each reading what the runs before it closed, so every file counts once.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.operators import claims as CL
from tillmart.operators import enrich as E
from tillmart.operators import ledger as LG
from tillmart.operators import marts as M
from tillmart.operators import quarantine as Q
from tillmart.operators import validate as V
from tillmart.plans.ingest import Ingested, ingest
from tillmart.session import LARGE_BYTES, MAX_CONCURRENT_JOBS, apply_defaults, run_all, scratch_path, shuffles_freed
from tillmart.sinks import parquet as P
from tillmart.sinks import published as PB
from tillmart.sources import fs
from tillmart.sources import landing as L


# Order of the rows in a file: the columns of a salesperson, or of a customer, repeat.
PERSON_ORDER, CUSTOMER_ORDER = ("store_id", "sales_person_id"), ("customer_id",)


class NoValidFiles(RuntimeError):
    """The landing zone holds no file that passes validation."""


@dataclass
class Dimensions:
    customer: DataFrame
    store: DataFrame
    sales_team: DataFrame


@dataclass
class RunResult:
    out_dir: str
    processed: list[str]
    rejected: list[str]
    active_before: list[str]
    paths: dict[str, str] = field(default_factory=dict)
    schemas: dict[str, T.StructType] = field(default_factory=dict)  # of the marts


def _dynamic(df: DataFrame, path: str, keys: tuple[str, ...]) -> None:
    """The partitions that ``df`` (``P.placed``) has, replaced in a table of the run."""
    _write_dynamic(df, path, keys)


def _write_dynamic(df: DataFrame, path: str, keys: tuple[str, ...]) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", P.CODEC)
        .partitionBy(*keys)
        .parquet(path)
    )


def _in_months(months: list[str | None]) -> Column:
    """The months, NULL among them if it is."""
    known = F.col("sales_month").isin([m for m in months if m is not None])
    return known | F.col("sales_month").isNull() if None in months else known


def _move(spark: SparkSession, files: list[str], landing_dir: str, target: str) -> None:
    """Files below ``landing_dir`` to the same relative paths below ``target``."""
    root = fs.qualified(spark, landing_dir)

    def place(path: str) -> str:
        full = fs.qualified(spark, path)
        below = full[len(root) :].lstrip("/") if full.startswith(root.rstrip("/") + "/") else full.rsplit("/", 1)[-1]
        return f"{target.rstrip('/')}/{below}"

    run_all(*[lambda p=p: fs.rename(spark, p, place(p)) for p in files])


def run(
    spark: SparkSession,
    landing_dir: str,
    dims: Dimensions,
    out_dir: str,
    now: dt.datetime | None = None,
    error_dir: str | None = None,
    processed_dir: str | None = None,
    publish: bool = False,
    max_files: int | None = None,
    lease_s: float = CL.LEASE_S,
) -> RunResult:
    """Process the pending files of ``landing_dir`` into marts under ``out_dir``.

    ``now`` is the start of the run in the ledger (files are closed at the time
    that has passed since then).  With ``error_dir``, rejected files are moved
    there once their lines are in the quarantine table, with ``processed_dir``
    finished files once they are closed; without them the landing zone is left
    as it is.  ``publish`` also writes all marts as snapshots named by epoch
    milliseconds, and one version that names them together (``sinks.published``).

    A run takes the pending files that no other run holds, at most ``max_files``
    if given, and holds them for ``lease_s`` seconds should it die.

    Raises ``NoValidFiles`` if no file is valid, after the quarantine is written."""
    apply_defaults(spark)
    began = time.monotonic()
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    batch = f"b{now:%Y%m%dT%H%M%S}_{uuid.uuid4().hex[:8]}"
    out = out_dir.rstrip("/")
    claims = f"{out}/claims"
    paths = {
        "ledger": f"{out}/ledger",
        "staged": f"{out}/staging/parsed-{batch}",
        "detail": f"{out}/detail",
        "lost_sales": f"{out}/lost_sales",
        "quarantine": f"{out}/quarantine",
        "customer_detail": f"{out}/customer_detail_mart",
        "sales_team_detail": f"{out}/sales_team_detail_mart",
        "sales_partitioned": f"{out}/sales_partitioned_mart",
        "customer_mart": f"{out}/customers_data_mart",
        "sales_mart": f"{out}/sales_team_data_mart",
    }

    try:
        with shuffles_freed(spark):
            return _claimed_run(spark, landing_dir, dims, out, claims, paths, batch, now, began, error_dir, processed_dir, publish, max_files, lease_s)
    finally:
        CL.release(spark, claims, batch)


def _claimed_run(spark, landing_dir, dims, out, claims, paths, batch, now, began, error_dir, processed_dir, publish, max_files, lease_s) -> RunResult:
    # L1/L4: which landed files still need work, and which an earlier run left open.
    # One row per landed file, listed once and kept as a local frame.
    listing = L.local_frame(spark, L.list_files(spark, landing_dir).collect(), L.LISTED_SCHEMA)
    active_before = sorted(r.file_name for r in LG.active_files(listing, LG.state(LG.read(spark, paths["ledger"]))).collect())

    def pending() -> DataFrame:
        state = LG.state(LG.read(spark, paths["ledger"]))
        others = listing.where(~F.col("is_csv")).select("path", "length")
        files = LG.pending_files(listing, state).select("path", "length").unionByName(others)
        # Rejected files stay pending; new ones come before them.
        seen = Q.seen_paths(spark, paths["quarantine"]).withColumn("seen", F.lit(True))
        return files.join(seen, "path", "left").withColumn("seen", F.coalesce("seen", F.lit(False)))

    todo = CL.claim(spark, claims, batch, pending, lease_s, max_files)
    files = {r.path: r.length for r in todo.collect()}

    # S3-S4, V1-V5: verdicts, then one parse of the good files (staged).
    ing = ingest(spark, paths=sorted(files), lengths=files, staging=paths["staged"])
    with CL.section(spark, claims, batch, lease_s):
        schemas = _publish(spark, ing, dims, out, claims, paths, batch, files, now, began, publish)
    if schemas is None:
        if error_dir:
            _move(spark, ing.error_paths, landing_dir, error_dir)
        raise NoValidFiles(f"no valid file under {landing_dir}")
    if error_dir:
        _move(spark, ing.error_paths, landing_dir, error_dir)
    if processed_dir:
        _move(spark, ing.valid_paths, landing_dir, processed_dir)
    return RunResult(out, ing.valid_paths, ing.error_paths, active_before, paths, schemas)


def _publish(spark, ing: Ingested, dims, out, claims, paths, batch, files, now, began, publish) -> dict[str, T.StructType] | None:
    """Write everything that runs share; the marts' schemas, or None without a valid file."""
    # V4/V5 sinks: rejected files, their raw lines, unparsable rows.
    taken = L.local_frame(spark, [(p,) for p in sorted(files)], "path string")
    rejected = ing.verdicts.where(F.col("verdict") == V.ERROR).drop("uri", "header_seq")
    tables = {"files": rejected, "lines": V.rejected_lines(ing.verdicts, ing.lines), "rows": ing.corrupt}
    Q.append(spark, paths["quarantine"], batch, tables, taken)
    # Read by nothing after this: the rows are staged, the rejected lines stored.
    fs.delete(spark, ing.lines_path)
    at_once = 1 if sum(files.values()) >= LARGE_BYTES else MAX_CONCURRENT_JOBS
    if not ing.valid_paths:
        return None
    state = LG.state(LG.read(spark, paths["ledger"]))  # with what other runs have closed
    good = ing.verdicts.where(F.col("verdict") == V.VALID)
    LG.append(LG.events(spark, good, "A", now), paths["ledger"])

    # J0: enrich once and store by (month, run).  Every mart reads the stored
    # detail; J4: what the inner joins drop is counted per dimension and key.
    sales = ing.rows.withColumns({"sales_month": M.sales_month("sales_date"), "batch": F.lit(batch)})
    keys = ("sales_month", "batch")
    months = E.enrich(sales, dims.customer, dims.store, dims.sales_team, carry=("path", *keys), rebalance=keys)
    lost = E.unmatched_sales(ing.rows, dims.customer, dims.store, dims.sales_team)
    run_all(
        lambda: _write_dynamic(P.placed(months, keys, PERSON_ORDER, rebalance=False), paths["detail"], keys),
        lambda: _dynamic(P.placed(lost.withColumn("batch", F.lit(batch)), ("batch",)), paths["lost_sales"], ("batch",)),
        at_once=at_once,
    )

    # Months this run brought, from the staged rows (one column of stored
    # Parquet; the enrichment is not run a second time for it).  Their marts
    # are rebuilt from the detail of every file of those months that counts:
    # this run's, and what the ledger has closed.
    touched = [r.m for r in ing.rows.select(M.sales_month("sales_date").alias("m")).distinct().collect()]
    mine = good.select("path", F.lit(batch).alias("batch"))
    closed = state.where(F.col("batch").isNotNull()).select(F.col("file_location").alias("path"), "batch")
    # Stored (one row per closed file): of known size, so Spark broadcasts it to the
    # detail of each mart instead of shuffling the detail by path.
    counted = P.stage(closed.join(mine, "path", "left_anti").unionByName(mine), scratch_path(spark, "run-counted"))
    stored = spark.read.schema(months.schema).parquet(paths["detail"]).where(_in_months(touched))
    detail = stored.join(counted, ["path", "batch"], "left_semi").drop("path", "batch")

    # O1/O2: detail marts and the month/store partitioned mart; C1/C2 + O6:
    # monthly marts, one partition per month.  All read the stored detail and
    # write separate outputs: submitted together while the run is small.
    team_detail = M.sales_team_detail(detail)
    customer_detail = M.customer_detail(detail)
    customer_mart = M.conform_customer_mart(M.customer_monthly(customer_detail))
    sales_mart = M.conform_sales_mart(M.sales_incentive(M.sales_monthly_totals(team_detail)))
    customer_month = F.date_format("sales_date_month", "yyyy-MM")
    outputs = {
        "sales_partitioned": (team_detail, P.PARTITION_KEYS, PERSON_ORDER),
        "customer_detail": (customer_detail.withColumn("_m", M.sales_month("sales_date")), ("_m",), CUSTOMER_ORDER),
        "sales_team_detail": (team_detail.withColumn("_m", F.col("sales_month")), ("_m",), PERSON_ORDER),
        "customer_mart": (customer_mart.withColumn("_m", customer_month), ("_m",), CUSTOMER_ORDER),
        "sales_mart": (sales_mart.withColumn("_m", F.col("sales_month")), ("_m",), PERSON_ORDER),
    }
    schemas = {name: df.schema for name, (df, _, _) in outputs.items()}
    # One run's detail is rebalanced by month already: the detail marts by month are
    # written from where it is read.  Several runs' files are rebalanced, so that many
    # small runs leave no small files.
    whole = closed.join(mine, "path", "left_anti").isEmpty()
    in_place = {"customer_detail", "sales_team_detail"} if whole else set()

    def write(name: str) -> None:
        df, keys, order = outputs[name]
        _dynamic(P.placed(df, keys, order, rebalance=name not in in_place), paths[name], keys)

    run_all(*[lambda n=n: write(n) for n in outputs], at_once=at_once)

    CL.check_held(spark, claims, batch)
    if publish:
        # Before the files are closed: a run that stops here leaves them open, and
        # the next one publishes; the last version stays whole meanwhile.
        whole = {name: read_mart(spark, paths[name], schemas[name]) for name in outputs}
        keys = {"sales_partitioned": P.PARTITION_KEYS}
        version = PB.publish(spark, f"{out}/published", {name: (df, keys.get(name, ())) for name, df in whole.items()})
        paths.update({f"{name}_snapshot": mart["path"] for name, mart in version["marts"].items()})
    # L3: only now, after every write above succeeded, are this run's files done.
    done = now + dt.timedelta(seconds=max(1, round(time.monotonic() - began)))
    LG.append(LG.events(spark, good, "I", done, batch), paths["ledger"])
    return schemas


def read_mart(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A month-partitioned mart without its helper partition column.  With the
    ``schema`` a run returns, a mart that has no rows yet can be read too."""
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    return df.drop("_m") if "_m" in df.columns else df
