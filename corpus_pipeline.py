"""The corpus pipeline: documents in, token ids of the clean ones out.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before it
kept, and returns a DataFrame; ``run`` writes it as Parquet to the shared folder
and reads it back as the next stage's docs.  All stages but the last return the
columns of ``documents``.

1. toxicity: rows graded toxic by the ordinal model go.
2. SimHash near-duplicates: of each component the row with the smallest doc_id
   stays.
3. benchmark decontamination: rows that hold a benchmark item go.
4. personal data: spans are replaced by their kind in brackets.
5. byte-level BPE: every text becomes its token ids, decoded once more to check
   the round trip.

Rows with a null or empty text are kept by stages 1, 3 and 4; in stage 2 they
are near-duplicates of one another (all have fingerprint zero).  Null doc_ids
come after all others where one row of a group stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm import bpe, decontaminate, pii, simhash, toxicity
from tillmart.llm.common import staged, table

TOKENIZER = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, number of tokens, ids, and whether they decode to the text."""
    return bpe.encoded(docs, public_tokenizers.path(TOKENIZER)).select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("bpe_encoding", encode),
]

# Trained models, XXH64 fingerprints and BPE merges are beyond SQL: the tests
# hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
