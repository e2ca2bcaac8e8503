"""One published version over several marts (O4, O5).

    <base>/<mart>/<epoch ms>       a snapshot of one mart
    <base>/versions/<number>.json  the snapshots that belong together

A version file is written last, after every snapshot of it is complete, and only
if there is none of its number yet.  Readers take the newest version and find in
it the place and schema of each mart, so they see all marts of one publication
or all of the one before; snapshots of a publication that stopped are named by no
version.  Snapshots of older versions stay for readers that began with them.

Publications follow one another (a run publishes in its exclusive section).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillmart.session import run_all
from tillmart.sinks import parquet as P
from tillmart.sources import fs


def versions(spark: SparkSession, base: str) -> list[int]:
    """The numbers of the published versions, oldest first."""
    path = f"{base.rstrip('/')}/versions"
    if not fs.exists(spark, path):
        return []
    names = [p.rsplit("/", 1)[-1] for p, is_dir, _ in fs.list_dir(spark, path) if not is_dir]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, base: str, version: int | None = None) -> dict | None:
    """A version's content, the newest by default; None if nothing is published."""
    known = versions(spark, base)
    if not known:
        return None
    return json.loads(fs.read_text(spark, f"{base.rstrip('/')}/versions/{version or known[-1]}.json"))


def publish(spark: SparkSession, base: str, marts: dict[str, tuple[DataFrame, tuple[str, ...]]]) -> dict:
    """Write a snapshot of every mart (stored frame, the columns it is partitioned by),
    then the version that names them."""
    base = base.rstrip("/")
    known, last = versions(spark, base), manifest(spark, base)
    # Later than the last version's, so no snapshot in use is overwritten.
    at = max(P.epoch_ms(), last["at"] + 1000 if last else 0)
    written: dict[str, dict] = {}

    def write(name: str, df: DataFrame, keys: tuple[str, ...]) -> None:
        path = P.write_snapshot(df, f"{base}/{name}", now=at / 1000, partition_by=keys, copy=True)
        written[name] = {"path": path, "schema": df.schema.jsonValue()}

    run_all(*[lambda n=n, df=df, keys=keys: write(n, df, keys) for n, (df, keys) in marts.items()])
    version = {"version": (known[-1] if known else 0) + 1, "at": at, "marts": written}
    if not fs.create_new(spark, f"{base}/versions/{version['version']}.json", json.dumps(version)):
        raise RuntimeError(f"version {version['version']} of {base} was published meanwhile")
    return version


def read(spark: SparkSession, base: str, mart: str, version: int | None = None) -> DataFrame:
    """A mart as the newest (or the given) version has it."""
    found = manifest(spark, base, version)
    if found is None:
        raise LookupError(f"nothing is published under {base}")
    entry = found["marts"][mart]
    schema = T.StructType.fromJson(entry["schema"])
    return P.read_partitioned(spark, entry["path"], schema).select(*schema.names)
