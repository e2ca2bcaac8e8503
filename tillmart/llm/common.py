"""Helpers shared by the training-data operators.

Conventions of every operator in this subpackage:

* Inputs are narrowed to the columns an operator needs before anything else,
  so extra columns, whatever their names, never clash with working columns.
* A null text counts as the empty text.
* Repeated rows are documents of their own: each input row has an output row.
* Working tables go to the shared folder of ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.session import scratch_path

# Rows a table may have to be broadcast (a few tens of bytes each).
BROADCAST_ROWS = 1_000_000
# Bytes that a text column of such a table may have together.
BROADCAST_BYTES = 64 * 2**20
# Texts of an Arrow batch, and Spark's setting for it.
BATCH_ROWS = 500
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Characters handed to one call of a per-text library or numpy step.
CHUNK_CHARS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of ``BATCH_ROWS`` texts between Spark and Python, where the
    session leaves their size open: it has no setting per query, and a batch
    is held several times over on both sides."""
    if spark.conf.get(BATCH_SETTING, None) in (None, "10000"):
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) alone, null texts as empty."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: computed once
    however often it is used, and re-read rather than recomputed after the
    loss of an executor."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame) -> DataFrame:
    """Each row as one struct ``doc``: working columns beside it clash with none."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.struct("*").alias("doc"))


def small(df: DataFrame, text: str | None = None) -> DataFrame:
    """A written table, marked for broadcast if its counted rows, and the bytes
    of its ``text`` column if it has one, are few; beyond that it is joined by a
    shuffle, in which Spark splits hot keys."""
    size = F.sum(F.octet_length(text)) if text else F.lit(0)
    got = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(size, F.lit(0)).alias("size")).first()
    return F.broadcast(df) if got.n <= BROADCAST_ROWS and got.size <= BROADCAST_BYTES else df


def hash_fraction(key: Column, fraction: float, salt: str = "sample") -> Column:
    """True for about ``fraction`` of the keys, the same ones in every run: 63
    bits of the hash are compared, so the share may be as small as a table is large."""
    if fraction >= 1:
        return F.lit(True)
    return F.xxhash64(key, F.lit(salt)).bitwiseAND(F.lit((1 << 63) - 1)) < F.lit(int(fraction * (1 << 63)))


def slices(lengths: Sequence[int], most: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose lengths add up to about ``most``; a
    longer single item has a range of its own."""
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def encode_words(word_lists: Sequence[list]) -> tuple[np.ndarray, np.ndarray, list]:
    """Words of several texts as (codes, end offset of each text, distinct words)."""
    ids: dict = {}
    codes = [np.fromiter((ids.setdefault(w, len(ids)) for w in ws), dtype=np.int32, count=len(ws)) for ws in word_lists]
    ends = np.cumsum([len(c) for c in codes], dtype=np.int64)
    return (np.concatenate(codes) if codes else np.zeros(0, np.int32)), ends, list(ids)


def segment_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments ending at ``ends`` (empty segments: 0)."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), dtype=values.dtype), np.cumsum(values, axis=0)])
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    return total[ends] - total[starts]
