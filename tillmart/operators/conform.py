"""The unified sales schema of landed rows (P2, U1) and its good and bad rows (V5).

``sources.landing.parse_lines`` brings the rows of every header to this schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.schemas import SALES_SCHEMA
from tillmart.sources.landing import BAD_COLUMN, BAD_REASON, CORRUPT

UNIFIED_SCHEMA = T.StructType(
    SALES_SCHEMA.fields + [T.StructField("file_name", T.StringType(), True), T.StructField("path", T.StringType(), True)]
)


STAGED_SCHEMA = T.StructType(
    UNIFIED_SCHEMA.fields + [T.StructField(c, T.StringType(), True) for c in (CORRUPT, BAD_COLUMN, BAD_REASON)]
)


def good_rows(staged: DataFrame) -> DataFrame:
    return staged.where(F.col(CORRUPT).isNull()).drop(CORRUPT, BAD_COLUMN, BAD_REASON)


def corrupt_rows(staged: DataFrame) -> DataFrame:
    """Bad rows: path, file_name, the raw record, the column at fault (null if the
    number of fields is wrong) and the reason."""
    return staged.where(F.col(CORRUPT).isNotNull()).select(
        "path", "file_name", F.col(CORRUPT).alias("record"), F.col(BAD_COLUMN).alias("bad_column"), F.col(BAD_REASON).alias("reason")
    )
