"""Landing zone with several files per month: file names, verdicts and rows
match the SQL restatement of the part rule."""

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from oracle_compare import compare
from tillmart.plans.ingest import ingest
from tillmart.plans.oracle import landing_sql
from tillmart.sources.landing_fixture import write_landing
from tillmart.sources.tables import TABLES

ROWS_PER_FILE = 25


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def ingested(spark):
    landing = write_landing(spark, SF_SMALL, rows_per_file=ROWS_PER_FILE)
    return ingest(spark, landing)


def test_months_are_split_into_parts(ingested):
    names = [r.file_name for r in ingested.verdicts.select("file_name").collect()]
    months = {n[:13] for n in names if n.startswith("sales_")}
    assert len([n for n in names if n.startswith("sales_")]) > 2 * len(months)


@pytest.mark.parametrize(
    "name, frame",
    [
        ("file_verdicts", lambda ing: ing.verdicts.select("file_name", "verdict", "reason")),
        ("corrupt_rows", lambda ing: ing.corrupt.groupBy("file_name", "bad_column", "reason").agg(F.count(F.lit(1)).alias("n_rows"))),
        (
            "additional_column",
            lambda ing: ing.rows.groupBy("file_name", "additional_column").agg(F.count(F.lit(1)).alias("n_rows")),
        ),
        ("csv_ingest_unified", lambda ing: ing.rows.drop("path")),
    ],
)
def test_parts_match_oracle(con, ingested, name, frame):
    result = compare(frame(ingested), con, landing_sql(name, ROWS_PER_FILE))
    assert result["ok"], result
