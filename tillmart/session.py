"""Session construction and shared scratch locations.

On a cluster the session comes from the platform; this module only fills in
settings that are unset, so a cluster's own values (shuffle partitions, AQE,
checkpoint directory, file split size) always win.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the plans rely on.  Applied only where the session leaves them unset.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The salesperson joins share one partitioning of the fact; splitting a hot
    # salesperson is worth the extra shuffle that it can cost.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Partitioned writes cost one file per (partition value, task): a small
    # shuffle coalesced into one task writes every file serially.  A smaller
    # floor keeps several writers; large shuffles coalesce by size as before.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    # A CSV row's validity must not depend on which columns a query reads:
    # with parser column pruning, a bad value in an unread column would pass.
    "spark.sql.csv.parser.columnPruning.enabled": "false",
}


def build_session(
    master: str = "local[8]",
    app_name: str = "tillmart",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for local runs and tests (UI off, small shuffle width)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Fill in the plan-relevant SQL settings that the session leaves unset."""
    # An unset setting reads as None here (not its built-in default), so a
    # zone or AQE choice made by the cluster is kept.  Month keys come from
    # DATE values, which are zone-free; UTC only fixes how ledger times print.
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    A session without one is an error: a folder on one machine would lose or
    hide working tables on a cluster.  ``build_session`` sets one for local runs.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        # getCheckpointDir() appends a per-application id; use its parent.
        return current.rstrip("/").rsplit("/", 1)[0]
    if spark.sparkContext.master.startswith("local["):
        # One machine, one process: a private folder is shared by all there is.
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tillmart-ckpt-"))
        return shared_dir(spark)
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared folder."""
    return f"{shared_dir(spark)}/tillmart/{name}-{uuid.uuid4().hex[:12]}"


# Deletes a query's shuffle files when it has ended, instead of when the driver's
# garbage collector finds its plan; a plan that is run again recomputes them.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FREEING: Counter = Counter()
_FREEING_LOCK = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Free each query's shuffle files at its end, unless the session decides that
    itself: of several steps over a large table, one step's files are on disk."""
    key = (spark.sparkContext.applicationId, str(spark._jsparkSession.sessionUUID()))
    with _FREEING_LOCK:
        mine = _FREEING[key] > 0 or spark.conf.get(FREE_SHUFFLES, None) is None
        if mine:
            _FREEING[key] += 1
            spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _FREEING_LOCK:
            if mine:
                _FREEING[key] -= 1
                if not _FREEING[key]:
                    spark.conf.unset(FREE_SHUFFLES)


# Driver threads submitting jobs at once, at most.
MAX_CONCURRENT_JOBS = 16
# Landed bytes from which jobs that each shuffle the landed rows follow one another:
# each fills the cluster then, and one job's shuffle files are on disk, not all jobs'.
LARGE_BYTES = 1 << 30


def run_all(*jobs: Callable[[], object], at_once: int = MAX_CONCURRENT_JOBS) -> None:
    """Run independent Spark actions (writes) concurrently from driver threads.

    Spark schedules jobs from several threads side by side, so one job's
    tasks fill the slots another leaves idle and driver-side commits overlap.
    At most ``at_once`` run at once.  Waits for all; the first
    failure is raised, so whatever the caller does next (for example closing
    ledger entries) never follows a failed job."""
    with ThreadPoolExecutor(max_workers=max(1, min(len(jobs), at_once))) as pool:
        futures = [pool.submit(j) for j in jobs]
        errors = [f.exception() for f in futures]
    for e in errors:
        if e is not None:
            raise e
