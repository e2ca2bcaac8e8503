"""Toxicity (7) and language identification (10): held-out accuracy, odd input."""

import zlib
from collections import Counter

import duckdb
import numpy as np
from odd import ROWS, empty_docs, odd_docs, rows, with_clashes
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from tillmart.llm import langid, toxicity
from tillmart.llm.common import hash_fraction
from tillmart.llm.queries import QUERIES

LABELS = "doc_id long, toxic int"


def test_toxicity_on_texts_it_has_not_seen():
    data = duckdb.sql(
        "SELECT text, toxic, doc_id FROM '/root/testdata/sf0.1/documents.parquet' JOIN '/root/testdata/sf0.1/labels.parquet' USING (doc_id) WHERE length(text) < 20000"
    ).fetchall()
    seen = sorted((t, y) for t, y, i in data if i % 2)
    model = toxicity.train(seen)
    scorer = toxicity.Scorer(model)
    found = [(scorer.score(t), y) for t, y, i in data if not i % 2]
    caught = [s[1] >= model.cut for s, y in found if y]
    wrong = [s[1] >= model.cut for s, y in found if not y]
    assert np.mean(caught) > 0.9 and np.mean(wrong) < 0.03
    assert (np.diff(model.thresholds) > 0).all()
    assert np.mean([s[0] for s, y in found if y]) > 1 > np.mean([s[0] for s, y in found if not y])


def test_ordinal_fit_recovers_an_order():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    hidden = x @ np.array([2.0, -1.0, 0.0]) + rng.logistic(size=2000)
    y = (hidden[:, None] > np.array([-1.0, 0.5, 2.0])).sum(axis=1)
    w, theta = toxicity.ordinal_fit(x, y, np.full(2000, 1 / 2000))
    assert w[0] > 0.8 and w[1] < -0.3 and abs(w[2]) < 0.2
    assert (np.diff(theta) > 0).all()


def test_toxicity_query_and_odd_rows(spark):
    got = QUERIES["op7_toxicity"](spark, SF_MID)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    found = {r.doc_id: r.toxic for r in got.collect()}
    assert len(found) == 1000
    assert np.mean([found[i] for i, y in labels.items() if y]) > 0.9
    assert np.mean([found[i] for i, y in labels.items() if not y]) < 0.03
    docs = odd_docs(spark)
    labelled = spark.createDataFrame([(4, 1), (4, 0), (7, 0), (8, 0), (None, 1), (6, None), (99, 1)], LABELS)
    out = toxicity.toxicity(with_clashes(docs), labelled)
    assert rows(out, "doc_id") == sorted(((r[0],) for r in ROWS), key=repr)
    # no labels of both classes: severity 0, nothing rejected
    none = spark.createDataFrame([], LABELS)
    assert rows(toxicity.toxicity(docs, none), "severity", "toxic") == [(0.0, False)] * len(ROWS)
    assert rows(toxicity.without_toxic(with_clashes(docs), none)) == rows(with_clashes(docs))
    assert rows(toxicity.toxicity(empty_docs(spark), labelled)) == []


def test_language_accuracy_on_held_out_documents(spark):
    got = {r.doc_id: r for r in QUERIES["op10_language_id"](spark, SF_MID).collect()}
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    assert set(got) == set(docs)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in docs)
    held = [i for i in docs if got[i].held_out and docs[i].lang]
    assert np.mean([got[i].lang_pred == docs[i].lang for i in held]) > 0.93
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_of_odd_rows(spark):
    docs = odd_docs(spark)
    out = langid.language_id(with_clashes(docs))
    langs = {r[2] for r in ROWS if r[2]}
    pairs = {(r[1] or "")[:50]: None for r in ROWS}
    for r, text in zip(out.collect(), [r[1] for r in ROWS]):
        assert r.lang_pred in langs if any(map(str.isalpha, text or "")) else (r.lang_pred, r.score) == ("und", 0.0), (r, text)
    assert len(pairs) > 5
    assert not any(r.held_out for r in out.where("doc_id is null").collect())
    nothing = docs.selectExpr("doc_id", "text", "cast(null as string) lang")
    assert rows(langid.language_id(nothing), "lang_pred", "score", "accepted") == [("und", 0.0, False)] * len(ROWS)
    assert rows(langid.language_id(empty_docs(spark))) == []


def test_prediction_uses_the_text_only(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = langid.train(langid.sample(docs))
    changed = docs.selectExpr("doc_id", "text", "'xx' lang", "'other' source")
    assert rows(langid.identify(docs, model)) == rows(langid.identify(changed, model))


def test_small_shares_keep_the_sample_size(spark):
    n = 40_000_000
    for expected in (20, 200):
        found = spark.range(n).where(hash_fraction(F.col("id"), expected / n)).count()
        assert abs(found - expected) < 5 * expected**0.5
    few = spark.range(1000)
    assert few.where(hash_fraction(F.col("id"), 1.0)).count() == 1000
    assert 200 < few.where(hash_fraction(F.col("id"), 0.25)).count() < 300
    assert few.where(hash_fraction(F.col("id"), 0.0)).count() == 0


def test_samples_are_bounded_whatever_repeats(spark):
    """One text in a third of the rows, one id in a third, null ids in a third."""
    rows_ = [(i, "one text again and again", "en") for i in range(3000)]
    rows_ += [(7, f"text number {i}", "en") for i in range(3000)]
    rows_ += [(None, f"no id {i}", "en") for i in range(3000)]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(3000)] + [(7, 1)] * 3000, "doc_id long, toxic int")
    got = toxicity.sample(docs, labels, per_class=5)
    assert 5 <= len(got) <= 10 and sum(y for _, y in got) <= 5
    assert len(langid.sample(docs, per_lang=5)) <= 5
    many = spark.createDataFrame([(i, f"text {i} of a language", f"l{i % 300}") for i in range(12000)], docs.schema)
    got = langid.sample(many, per_lang=20, total=900)
    assert len(got) <= 900 and len({lang for _, lang in got}) == 300


def test_scores_follow_the_formulas(spark):
    """Every text scored anew from the models' weights, over all its words."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = [r.text for r in docs.select("text").collect()][:60]
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    model = toxicity.train(toxicity.sample(docs, labels))
    scorer = toxicity.Scorer(model)
    for text in texts:
        counts = Counter(f for w in text.lower().split() for f in toxicity.word_features(w) if f in model.weights)
        total = sum(model.weights[f] * np.log1p(n) for f, n in counts.items())
        above = 1 / (1 + np.exp(model.thresholds - total))
        assert abs(scorer.score(text)[0] - above.sum()) < 1e-5 and abs(scorer.score(text)[1] - above[0]) < 1e-5
    model = langid.train(langid.sample(docs))
    predictor = langid.Predictor(model)
    for text in texts:
        words = text.lower().split()
        grams = [g for w in words for g in langid.subwords(w)]
        if not any(map(str.isalpha, text)) or not grams:
            continue
        logits = (model.table[grams].sum(axis=0) / len(grams) + model.bias) / model.temperature
        p = np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum()
        lang, score = predictor.predict(text)
        assert abs(p[model.langs.index(lang)] - score) < 1e-5 and p.max() - score < 1e-5
