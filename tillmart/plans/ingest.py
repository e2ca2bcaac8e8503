"""Landing zone -> unified sales rows (E1 of the reference's run).

listing -> one scan of all files into a table of lines -> headers and verdicts
(one stored row per file) -> the valid files' lines parsed by their headers.
What follows reads the stored tables, never the files again.  Rejected files and unparsable rows are returned for the
quarantine sinks; nothing is dropped silently.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.operators import conform as C
from tillmart.operators import validate as V
from tillmart.session import scratch_path
from tillmart.sinks.parquet import stage
from tillmart.sources import landing as L

@dataclass
class Ingested:
    verdicts: DataFrame  # one row per landed file
    rows: DataFrame  # unified sales rows + file_name
    corrupt: DataFrame  # path, file_name, record, bad_column, reason
    lines: DataFrame  # every line of every file, as staged
    valid_paths: list[str]
    error_paths: list[str]
    lines_path: str | None = None  # where the lines are staged


def ingest(
    spark: SparkSession,
    landing_dir: str | None = None,
    paths: list[str] | None = None,
    staging: str | None = None,
    lengths: dict[str, int] | None = None,
) -> Ingested:
    """Validate and read the files under ``landing_dir`` (or exactly ``paths``,
    whose byte lengths the caller may already know from its own listing).

    Actions: the listing (skipped when ``lengths`` is given), the one scan of the
    files into the lines table, the verdicts, and one write of the parsed rows to
    ``staging`` (a fresh folder under the shared checkpoint folder by default)."""
    if paths is None:
        listed = L.list_files(spark, landing_dir)
    elif lengths is not None:
        listed = L.listed(spark, [(p, lengths.get(p, 0)) for p in paths])
    else:
        listed = L.list_paths(spark, paths)
    # One small row per file, kept as a local frame: the listing job runs once.
    rows = listed.collect()
    listing = L.local_frame(spark, rows, L.LISTED_SCHEMA)
    # The one scan of the landed bytes; files known to be empty have no lines.
    lines_path = scratch_path(spark, "ingest-lines")
    lines = L.stage_lines(spark, [r.path for r in rows if r.length], lines_path)
    # Written once, so later steps read them instead of probing again.
    probe = L.probe_headers(listing, lines, scratch_path(spark, "ingest-headers"))
    verdicts = stage(V.file_verdicts(probe), scratch_path(spark, "ingest-verdicts"))
    verdict_rows = verdicts.select("path", "verdict", "header_cols").collect()
    valid = [(r.path, tuple(r.header_cols)) for r in verdict_rows if r.verdict == V.VALID]
    errors = [r.path for r in verdict_rows if r.verdict == V.ERROR]
    headers = sorted({h for _, h in valid})
    # The rows, bad ones included, become a Parquet table in the shared folder
    # (also the lineage cut for what follows).
    staged_path = staging or scratch_path(spark, "ingest-parsed")
    if headers:
        known = F.array(*[F.array(*[F.lit(c) for c in h]) for h in headers])
        files = verdicts.where(F.col("verdict") == V.VALID).select(
            "path", "file_name", "uri", "header_seq", (F.array_position(known, F.col("header_cols")) - 1).alias("header_id")
        )
        parsed = L.parse_lines(lines, files, [list(h) for h in headers])
    else:
        parsed = spark.createDataFrame([], C.STAGED_SCHEMA)
    staged = stage(parsed, staged_path)
    return Ingested(
        verdicts,
        C.good_rows(staged),
        C.corrupt_rows(staged),
        lines,
        sorted(p for p, _ in valid),
        sorted(errors),
        lines_path,
    )
