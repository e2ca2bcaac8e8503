"""Landing zone: listing, header probe, and the typed CSV scan.

* ``list_files``   one row per landed object (S1, S2, S7).  Spark's file index
  lists the landing URI directly (no page cap, any Hadoop scheme).  The list
  comes from ``inputFiles()`` because zero-length files produce no rows in a
  scan, and an empty file must still be seen and quarantined.
* ``stage_lines``  the one scan of the landing zone: every line of every file as
  a Parquet row with its file, block and row id.  All later steps read this
  table, so a landed byte is read once.
* ``probe_headers`` first line of every CSV file (S3): the lowest row id of each
  file's first block (a hash aggregate over numbers), joined back for its text.
* ``parse_lines``  the data lines of the valid files (S4), parsed in one
  projection: each distinct header has its own ``from_csv``, whose schema follows
  that header's column order.  No inference pass.

A line is a record, as in Spark's line-wise CSV reader: a quoted line break ends
the record, so both halves are bad rows and none is lost.
"""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tillmart.functions.scalars import base_name
from tillmart.schemas import ADDITIONAL_COLUMN, EXTRA_SEPARATOR, LANDING_TYPES, MANDATORY_COLUMNS, MONEY, READ_MONEY
from tillmart.sinks.parquet import stage

CORRUPT, BAD_COLUMN, BAD_REASON = "_corrupt_record", "_bad_column", "_bad_reason"
LISTING_SCHEMA = "path string"
_SCHEME_SLASHES = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*):///")
_GLOB_CHARS = re.compile(r"([\\\[\]{}*?])")
LINES_SCHEMA = "uri string, block long, seq long, blank boolean, line string"
# Distinct headers parsed by one projection over the lines.
HEADERS_PER_SCAN = 16
# Reasons of a bad row beside "not <type>".
FIELD_COUNT, INEXACT, UNREADABLE = "field count", "inexact amount", "unreadable"
LISTED_SCHEMA = "path string, file_name string, is_csv boolean, length long"


def list_files(spark: SparkSession, landing_dir: str) -> DataFrame:
    """path, file_name, is_csv, length for every object under ``landing_dir``.

    ``.csv`` is matched case-sensitively, as the reference does.  Hidden
    files (names starting with ``_`` or ``.``) are skipped by Spark's index.
    Lengths come from the ``binaryFile`` rows with the content column pruned
    (no file is read); zero-length files have no row there and get 0.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing_dir)
    # inputFiles() spells paths as encoded URIs; the listing keeps them decoded.
    return _with_lengths(spark, [canonical(p, encoded=True) for p in files.inputFiles()], files)


def listed(spark: SparkSession, files: list[tuple[str, int]]) -> DataFrame:
    """The ``list_files`` columns from known (path, length) pairs (no job)."""
    df = local_frame(spark, sorted(files), "path string, length long")
    return df.select(
        norm_path(F.col("path")).alias("path"),
        base_name("path").alias("file_name"),
        F.col("path").endswith(".csv").alias("is_csv"),
        "length",
    )


def local_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A frame of the driver's few ``rows`` that Spark holds as a local relation:
    its size is known to the planner and no Python worker starts to read it."""
    fields = T.StructType.fromDDL(schema)
    table = pa.table({f.name: pa.array([r[i] for r in rows], to_arrow_type(f.dataType)) for i, f in enumerate(fields)})
    return spark.createDataFrame(table, fields)


def list_paths(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The same columns as ``list_files`` for exactly ``paths``."""
    if not paths:
        return spark.createDataFrame([], LISTED_SCHEMA)
    return _with_lengths(spark, paths, spark.read.format("binaryFile").load([reader_path(p) for p in sorted(paths)]))


def _with_lengths(spark: SparkSession, paths: list[str], files: DataFrame) -> DataFrame:
    lengths = files.select(norm_path(F.col("path")).alias("path"), "length")
    listing = with_names(local_frame(spark, [(p,) for p in sorted(paths)], LISTING_SCHEMA))
    return listing.join(lengths, "path", "left").select(
        "path", "file_name", "is_csv", F.coalesce(F.col("length"), F.lit(0)).cast("long").alias("length")
    )


def canonical(path: str, encoded: bool = False) -> str:
    """A file's one spelling in listings, verdicts and the ledger: decoded
    (``a b.csv``, not ``a%20b.csv``), ``scheme:/x`` rather than ``scheme:///x``."""
    return _SCHEME_SLASHES.sub(r"\1:/", unquote(path) if encoded else path)


def reader_path(path: str) -> str:
    """A canonical path as a reader argument: Spark treats path strings as
    glob patterns, so glob characters in a file name are escaped."""
    return _GLOB_CHARS.sub(r"\\\1", path)


def decoded_path(uri: Column) -> Column:
    """A scanned file's ``_metadata.file_path`` (an encoded URI) in the
    canonical spelling; a literal ``+`` is kept, not read as a space."""
    return norm_path(F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))))


def norm_path(path: Column) -> Column:
    """One spelling per file URI: ``scheme:///x`` (file index) and
    ``scheme:/x`` (scan metadata) name the same file."""
    return F.regexp_replace(path, r"^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")


def with_names(listing: DataFrame) -> DataFrame:
    return listing.select(
        norm_path(F.col("path")).alias("path"),
        base_name("path").alias("file_name"),
        F.col("path").endswith(".csv").alias("is_csv"),
    )


def header_columns(line: Column) -> Column:
    """Header line -> array of column names, as Spark's CSV reader names them:
    split at commas outside quotes, surrounding quotes removed (doubled quotes
    unescaped), blanks kept, an empty name becomes ``_c<index>``, repeated names
    (in any case) beyond the mandatory ones get their index appended.  A
    leading BOM is dropped."""
    clean = F.regexp_replace(line, "^﻿", "")
    raw = F.split(clean, r',(?=(?:[^"]*"[^"]*")*[^"]*$)', -1)
    unquoted = F.transform(
        raw, lambda x: F.regexp_replace(F.regexp_replace(x, r'^"(.*)"$', "$1"), '""', '"')
    )
    lowered = F.transform(unquoted, lambda x: F.lower(x))
    fixed = F.array(*[F.lit(c) for c in MANDATORY_COLUMNS])
    repeated = lambda x: (F.size(F.filter(lowered, lambda y: y == F.lower(x))) > 1) & ~F.array_contains(fixed, F.lower(x))
    return F.transform(
        unquoted,
        lambda x, i: F.when(x == "", F.concat(F.lit("_c"), i.cast("string")))
        .when(repeated(x), F.concat(x, i.cast("string")))
        .otherwise(x),
    )


def stage_lines(spark: SparkSession, paths: list[str], target: str) -> DataFrame:
    """Every line of ``paths``: uri, block, seq, blank, line, written to ``target``.

    ``uri`` stays as the scan spells it (one dictionary entry per file, decoded
    per file and not per line); ``seq`` rises within a block of a file."""
    if not paths:
        return spark.createDataFrame([], LINES_SCHEMA)
    lines = spark.read.text([reader_path(p) for p in sorted(paths)]).select(
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        (F.trim("value") == "").alias("blank"),
        F.col("value").alias("line"),
    )
    return stage(lines, target)


def probe_headers(listing: DataFrame, lines: DataFrame, target: str) -> DataFrame:
    """path, uri, header_seq, header_line, header_cols for every listed file.

    The header is the first line that is not blank.  ``uri`` is null for a file
    without lines; the header fields are null then, and for files other than CSV.
    The place of each header is stored in ``target`` first (a hash aggregate over
    numbers): a table of known size, which Spark broadcasts to the lines if small.
    """
    files = stage(
        lines.groupBy("uri").agg(F.min(F.when((F.col("block") == 0) & ~F.col("blank"), F.col("seq"))).alias("header_seq")),
        target,
    )
    texts = lines.where(F.col("block") == 0).join(files.select("header_seq"), F.col("seq") == F.col("header_seq"))
    found = (
        listing.join(files.withColumn("path", decoded_path(F.col("uri"))), "path", "left")
        .join(texts.select("header_seq", F.col("line").alias("header_line")), "header_seq", "left")
    )
    line = F.when(F.col("is_csv"), F.col("header_line"))
    return found.select(
        *listing.columns,
        "uri",
        "header_seq",
        line.alias("header_line"),
        F.when(line.isNotNull(), header_columns(line)).alias("header_cols"),
    )


def parse_lines(lines: DataFrame, files: DataFrame, headers: list[list[str]]) -> DataFrame:
    """The data lines of ``files`` (path, file_name, uri, header_seq, header_id) as
    unified rows with the bad-row columns; ``header_id`` counts ``headers`` from 0.

    The file table joins the lines on ``uri``: Spark broadcasts it by its stored
    size, or sorts and merges with AQE splitting a file that holds most lines.
    Headers go ``HEADERS_PER_SCAN`` to a projection."""
    data = lines.where(~F.col("blank")).select("uri", "seq", "line")
    legs = []
    for start in range(0, len(headers), HEADERS_PER_SCAN):
        some = headers[start : start + HEADERS_PER_SCAN]
        mine = files.where(F.col("header_id").between(start, start + len(some) - 1))
        rows = data.join(mine, "uri").where(F.col("seq") != F.col("header_seq"))
        legs.append(_records(rows.withColumn("header_id", F.col("header_id") - start), some))
    return reduce(lambda a, b: a.unionByName(b), legs)


def _records(rows: DataFrame, headers: list[list[str]]) -> DataFrame:
    """Lines (``line``, ``header_id`` within ``headers``) as unified rows.

    Fields are named by position while they are parsed, so a header may hold any
    names.  A bad row keeps its text, the first mandatory column whose text has
    no value of its type (null if the number of fields is wrong) and the reason.
    An amount that does not fit the money type exactly is not rounded: its row is
    a bad row, and so is one with an integer written as ``2.0``.

    Parsed records are columns of their own, one per header and null for the
    others' rows, so a line is parsed once however often its fields are used; the
    texts of a record are parsed for bad rows only."""
    reads = {c: READ_MONEY if t == MONEY else t for c, t in LANDING_TYPES.items()}
    amounts = [c for c in MANDATORY_COLUMNS if LANDING_TYPES[c] == MONEY]
    money = MONEY.simpleString()

    def parsed(header: list[str], types: dict[str, T.DataType]) -> str:
        schema = ", ".join(f"c{i} {types.get(c, T.StringType()).simpleString()}" for i, c in enumerate(header))
        options = "map('mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', 'bad', 'dateFormat', 'yyyy-MM-dd')"
        return f"from_csv(line, '{schema}, bad string', {options})"

    def picked(value) -> str:
        """``value(i, header)`` of the row's own header."""
        return "CASE header_id " + " ".join(f"WHEN {i} THEN {value(i, h)}" for i, h in enumerate(headers)) + " END"

    def field(record: str, name: str) -> str:
        return picked(lambda i, h: f"{record}{i}.c{h.index(name)}")

    def extras(i: int, header: list[str]) -> str:
        places = [f"r{i}.c{k}" for k, c in enumerate(header) if c not in MANDATORY_COLUMNS]
        return f"concat_ws('{EXTRA_SEPARATOR}', {', '.join(places)})" if places else "CAST(NULL AS string)"

    keep = ["file_name", "path", "line", "header_id"]
    rows = rows.selectExpr(*keep, *[f"IF(header_id = {i}, {parsed(h, reads)}, NULL) AS r{i}" for i, h in enumerate(headers)])
    rows = rows.selectExpr(
        *keep,
        *[f"{field('r', c)} AS {c}" for c in MANDATORY_COLUMNS],
        f"{picked(extras)} AS {ADDITIONAL_COLUMN}",
        f"{picked(lambda i, h: f'r{i}.bad IS NOT NULL')} AS unread",
    )
    inexact = {c: f"({c} IS NOT NULL AND NOT coalesce(try_cast({c} AS {money}) = {c}, false))" for c in amounts}
    unified = [*MANDATORY_COLUMNS, ADDITIONAL_COLUMN, "file_name", "path"]
    rows = rows.selectExpr(*unified, "line", "header_id", " OR ".join(["unread", *inexact.values()]) + " AS is_bad")
    rows = rows.selectExpr("*", *[f"IF(header_id = {i} AND is_bad, {parsed(h, {})}, NULL) AS t{i}" for i, h in enumerate(headers)])
    faults = [f"WHEN ({field('t', c)} IS NOT NULL AND {c} IS NULL) OR {inexact.get(c, 'false')} THEN '{c}'" for c in MANDATORY_COLUMNS]
    rows = rows.selectExpr(
        *unified, "line", "is_bad",
        f"coalesce({picked(lambda i, h: f't{i}.bad IS NOT NULL')}, false) AS miscounted",
        f"IF(is_bad, CASE {' '.join(faults)} END, NULL) AS at_fault",
    )
    unread = " ".join(f"WHEN at_fault = '{c}' THEN 'not {t.typeName()}'" for c, t in LANDING_TYPES.items())
    uneven = " ".join(f"WHEN at_fault = '{c}' AND {c} IS NOT NULL THEN '{INEXACT}'" for c in amounts)
    return rows.selectExpr(
        *[f"try_cast({c} AS {money}) AS {c}" if c in amounts else c for c in MANDATORY_COLUMNS],
        ADDITIONAL_COLUMN, "file_name", "path",
        f"IF(is_bad, line, NULL) AS {CORRUPT}",
        f"IF(miscounted, NULL, at_fault) AS {BAD_COLUMN}",
        f"CASE WHEN NOT is_bad THEN NULL WHEN miscounted THEN '{FIELD_COUNT}' {uneven} {unread} ELSE '{UNREADABLE}' END AS {BAD_REASON}",
    )
