"""The registered queries of this subpackage and their DuckDB SQL.

Each query applies one operator, with production parameters, to the whole of
its table.  ``ORACLE`` has SQL where SQL can express the result; the others are
tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillmart.llm import (
    alignment,
    bpe,
    decontaminate,
    divergence,
    host_rules,
    jaccard_join,
    langid,
    lm_score,
    pii,
    sharding,
    simhash,
    token_counts,
    toxicity,
)
from tillmart.llm.common import table

PIECES = "piece_bpe_32k.model"
BYTE_BPE = "byte_bpe_50k.json"


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(table(spark, sf_dir, "documents"))


def op1_lm_scores_order3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(table(spark, sf_dir, "documents"), order=3)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op3_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.quality(table(spark, sf_dir, "documents"))


def op4_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op6_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similarity_components(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECES))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_lm_scores,
        op1_lm_scores_order3,
        op2_token_counts,
        op3_host_quality,
        op4_feistel_shards,
        op5_pii,
        op6_bpe_encoding,
        op7_toxicity,
        op8_simhash_near_dedup,
        op9_benchmark_decontamination,
        op10_language_id,
        op11_jaccard_join,
        op12_alignment,
        op13_source_divergence,
    )
}

ORACLE: dict[str, str] = {
    "op1_lm_scores": lm_score.oracle(),
    "op3_host_quality": host_rules.oracle(),
    "op4_feistel_shards": sharding.oracle(),
    "op9_benchmark_decontamination": decontaminate.oracle(),
    "op13_source_divergence": divergence.oracle(),
}
