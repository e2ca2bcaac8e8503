"""Claims on landed files, so that runs at the same time never take one file (L2, L3).

The claims of a target are a log of numbered versions, each a small file that
holds the whole state: the open runs with the time their claim ends, and the run
that is in the exclusive section, if any.  A version is committed by creating
its file only if it is absent; who loses reads the newest version and tries
again.  The claimed paths themselves are Parquet, written by Spark before the
commit that makes them count.

* ``claim``    what is pending and held by no open run is held by this one.  The
  ledger is read after the version the commit builds on, and runs append their
  closings before they release, so a file is either held or seen as closed.
* ``section``  one run at a time: months and shared tables are published one run
  after another, and each reads what the runs before it closed.
* ``release``  ends a run's claim, after its closings or when it fails.

A run that dies without a release holds its files until its lease ends; one that
outlives its lease and has lost its claim gets ``ClaimLost`` before it closes.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tillmart.sources import fs

FILES_SCHEMA = "path string, length long, batch string"
LEASE_S = 6 * 3600
POLL_S = 0.5
KEPT_VERSIONS = 100


class ClaimLost(RuntimeError):
    """The run's claim ended and another run has gone on since."""


def _newest(spark: SparkSession, base: str) -> tuple[int, dict]:
    """The newest version's number and its state without what has expired."""
    names = [p.rsplit("/", 1)[-1] for p, is_dir, _ in fs.list_dir(spark, f"{base}/log") if not is_dir]
    number = max((int(n) for n in names if n.isdigit()), default=0)
    state = json.loads(fs.read_text(spark, f"{base}/log/{number:012d}")) if number else {"open": {}, "inside": None}
    now = time.time()
    state["open"] = {b: until for b, until in state["open"].items() if until > now}
    if state["inside"] and state["inside"] not in state["open"]:
        state["inside"] = None
    return number, state


def _commit(spark: SparkSession, base: str, number: int, state: dict) -> bool:
    """Whether version ``number`` is this state (else another run made it)."""
    done = fs.create_new(spark, f"{base}/log/{number:012d}", json.dumps(state))
    if done and number > KEPT_VERSIONS:
        fs.delete(spark, f"{base}/log/{number - KEPT_VERSIONS:012d}", recursive=False)
    return done


def _files(spark: SparkSession, base: str, batch: str) -> DataFrame:
    return spark.read.schema("path string, length long").parquet(f"{base}/files/batch={batch}")


def held_files(spark: SparkSession, base: str, state: dict | None = None) -> DataFrame:
    """path, length, batch of every file that an open run holds."""
    state = state or _newest(spark, base)[1]
    held = spark.createDataFrame([], FILES_SCHEMA)
    if state["open"]:
        held = spark.read.schema(FILES_SCHEMA).option("basePath", f"{base}/files").parquet(*[f"{base}/files/batch={b}" for b in state["open"]])
    return held


def claim(
    spark: SparkSession,
    base: str,
    batch: str,
    pending: Callable[[], DataFrame],
    lease_s: float = LEASE_S,
    max_files: int | None = None,
) -> DataFrame:
    """path, length of the files that ``batch`` now holds: those of ``pending()``
    (path, length, seen; read anew for each attempt) that no open run holds, at
    most ``max_files`` if given: those no run has seen yet first, then by path."""
    while True:
        number, state = _newest(spark, base)
        free = pending().join(held_files(spark, base, state).select("path"), "path", "left_anti")
        if max_files is not None:
            free = free.orderBy("seen", "path").limit(max_files)
        free.select("path", "length").write.mode("overwrite").parquet(f"{base}/files/batch={batch}")
        state["open"][batch] = time.time() + lease_s
        if _commit(spark, base, number + 1, state):
            return _files(spark, base, batch)


def release(spark: SparkSession, base: str, batch: str) -> None:
    """End the claim of ``batch``, and its section if it is inside one."""
    while True:
        number, state = _newest(spark, base)
        if state["open"].pop(batch, None) is None:
            return
        if state["inside"] == batch:
            state["inside"] = None
        if _commit(spark, base, number + 1, state):
            return


def check_held(spark: SparkSession, base: str, batch: str) -> None:
    _, state = _newest(spark, base)
    if batch not in state["open"] or state["inside"] != batch:
        raise ClaimLost(f"{batch} no longer holds its files")


@contextmanager
def section(spark: SparkSession, base: str, batch: str, lease_s: float = LEASE_S) -> Iterator[None]:
    """Wait until no other run is inside; the lease begins anew on entry."""
    while True:
        number, state = _newest(spark, base)
        if batch not in state["open"]:
            raise ClaimLost(f"{batch} no longer holds its files")
        if state["inside"] is None:
            state["inside"], state["open"][batch] = batch, time.time() + lease_s
            if _commit(spark, base, number + 1, state):
                break
        else:
            time.sleep(POLL_S)
    try:
        yield
    finally:
        while True:
            number, state = _newest(spark, base)
            if state["inside"] != batch:
                break
            state["inside"] = None
            if _commit(spark, base, number + 1, state):
                break
