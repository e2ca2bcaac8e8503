"""The pipeline's stages against brute force on the smallest tables."""

import numpy as np
import public_tokenizers
from odd import empty_docs, odd_docs, rows, with_clashes
from test_native import plain_shingles, plain_spans
from test_near_duplicates import plain_components, plain_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from conftest import SF_MID
from tillmart.llm.common import staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "pii", "bpe_encoding"]
    kept = [{r.doc_id: r.text for r in docs.collect()}]
    for name, stage in pipeline.STAGES:
        docs = staged(stage(spark, docs, SF_MID), "test-stage")
        if name != "bpe_encoding":
            assert docs.columns == COLUMNS
            kept.append({r.doc_id: r.text for r in docs.collect()})
    given, clean, single, decontaminated, redacted = kept
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    assert np.mean([i not in clean for i, y in labels.items() if y]) > 0.9
    assert np.mean([i in clean for i, y in labels.items() if not y]) > 0.98
    ids = sorted(clean)
    groups = plain_components([(i, plain_fingerprint(clean[i])) for i in ids])
    assert set(single) == set(groups)
    items = [plain_shingles(r.text) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()]
    leaks = {i for i, t in single.items() if any(q and 100 * len(q & s) >= 80 * len(q) for s in [plain_shingles(t)] for q in items)}
    assert set(decontaminated) == set(single) - leaks and leaks
    assert set(redacted) == set(decontaminated)
    assert not any(plain_spans(t) for t in redacted.values())
    tokenizer = Tokenizer.from_file(public_tokenizers.path(pipeline.TOKENIZER))
    for r in docs.collect():
        assert r.round_trip and list(r.ids) == tokenizer.encode(redacted[r.doc_id], add_special_tokens=False).ids


def test_stages_on_odd_rows(spark):
    for make in (empty_docs, odd_docs, lambda s: with_clashes(odd_docs(s))):
        docs = make(spark)
        columns = docs.columns
        for name, stage in pipeline.STAGES:
            docs = staged(stage(spark, docs, SF_MID), "test-odd")
            assert name == "bpe_encoding" or docs.columns == columns
    assert rows(docs, "doc_id") == sorted([(1,), (4,), (4,), (6,), (7,), (8,), (None,)], key=repr)
