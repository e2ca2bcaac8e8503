"""File validation (V1-V3) and quarantine (V4, V5).

Column-name checks are array expressions on the probed header, evaluated for
all files in one pass.  The comparison is case-sensitive like the
reference's set difference, so ``Store_ID`` does not satisfy ``store_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.schemas import MANDATORY_COLUMNS

VALID, ERROR = "valid", "error"


def mandatory() -> Column:
    return F.array(*[F.lit(c) for c in MANDATORY_COLUMNS])


def missing_columns(cols: Column) -> Column:
    """Mandatory names absent from the header (V1), in mandatory order."""
    return F.array_except(mandatory(), cols)


def extra_columns(cols: Column) -> Column:
    """Header names beyond the mandatory ones (V2), in header order."""
    return F.array_except(cols, mandatory())


def has_duplicate_names(cols: Column) -> Column:
    """Whether a mandatory name occurs twice (in any case): which of the
    columns is meant cannot be told.  Repeated extra columns are renamed by
    the probe, as Spark's reader renames them, and are no fault."""
    known = F.filter(F.transform(cols, lambda x: F.lower(x)), lambda x: F.array_contains(mandatory(), x))
    return F.size(F.array_distinct(known)) < F.size(known)


def file_verdicts(probe: DataFrame) -> DataFrame:
    """path, file_name, is_csv, header_line, header_cols, missing, extra, verdict,
    reason, uri, header_seq for every landed file (V3)."""
    miss = missing_columns(F.col("header_cols"))
    reason = (
        F.when(~F.col("is_csv"), F.lit("not_csv"))
        .when(F.col("header_line").isNull(), F.lit("empty"))
        .when(has_duplicate_names(F.col("header_cols")), F.lit("duplicate_header"))
        .when(F.size(miss) > 0, F.concat(F.lit("missing:"), F.array_join(miss, ",")))
    )
    return probe.select(
        "path",
        "file_name",
        "is_csv",
        "header_line",
        "header_cols",
        miss.alias("missing"),
        extra_columns(F.col("header_cols")).alias("extra"),
        F.when(reason.isNull(), F.lit(VALID)).otherwise(F.lit(ERROR)).alias("verdict"),
        reason.alias("reason"),
        "uri",
        "header_seq",
    )


def rejected_lines(verdicts: DataFrame, lines: DataFrame) -> DataFrame:
    """path, file_name, line: the content of the rejected files, for the error
    table, from the lines that the ingest has staged."""
    errors = verdicts.where(F.col("verdict") == ERROR).select("uri", "path", "file_name")
    return lines.select("uri", "line").join(errors, "uri").select("path", "file_name", "line")


def quarantine_lines(verdicts: DataFrame, lines: DataFrame) -> DataFrame:
    """file_name, reason, n_lines for every rejected file (V4); a file without
    lines keeps a count of 0 through the left join."""
    errors = verdicts.where(F.col("verdict") == ERROR).select("uri", "file_name", "reason")
    counts = lines.groupBy("uri").agg(F.count(F.lit(1)).alias("n_lines"))
    return errors.join(counts, "uri", "left").select(
        "file_name", "reason", F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines")
    )
