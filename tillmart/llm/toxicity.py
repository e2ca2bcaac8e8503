"""Operator 7: toxicity grades by cumulative-link ordinal regression.

Sparse features: the words of a text (lower-cased, outer punctuation off) and
their prefixes of ``PREFIXES`` characters, each with log(1 + count).  The model
is P(grade <= k) = sigmoid(theta_k - w.x): one weight vector shared by all
thresholds, which are kept in order.  A text's expected severity is the sum of
P(grade > k) over the thresholds; it is toxic if P(grade > 0) reaches the
threshold that separates a kept-back fifth of the sample best.

Learning: a bounded sample of the labelled documents, about ``SAMPLE_PER_CLASS``
toxic and as many other ones of at most ``SAMPLE_CHARS`` characters, chosen by
a hash of the id, fitted in numpy on the driver.  Labels say toxic or not; the
grades of the toxic ones are the thirds of their number of indicative words
(those whose log-odds for toxic exceed ``INDICATIVE``), so grades 1 to 3 mean
few, some and many.  The ``FEATURES`` features with the largest chi-square enter
the model, as far as it and their log-odds are large enough.  All documents are scored whole; a word's features are remembered.

Defined cases: null and empty texts, and texts without a known feature, get the
model's severity for no features; without labels of both classes every severity
is 0 and nothing is toxic.  Labels: nulls are skipped, of several labels for one
id the highest counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import bounded_batches, hash_fraction, packed
from tillmart.llm.memo import Memo

SAMPLE_PER_CLASS = 2_500
SAMPLE_CHARS = 60_000
PREFIXES = (4, 5, 6)
PUNCTUATION = ".,;:!?\"'()[]{}#*$%&|<>"  # taken off both ends of a word
FEATURES = 1_500
MIN_TEXTS = 3  # texts of the sample a feature must occur in at least, and
MIN_SHARE = 1 / 400  # the share of them it must occur in
# Size of the log-odds, and chi-square per text of the sample, that a feature
# needs at least: weaker ones are often chance, and add up in long texts.
MIN_ODDS = 2.0
MIN_CHI = 0.01
INDICATIVE = 2.0
GRADES = 3
STEPS = 300
RATE = 0.05
SHRINK = 0.2  # L1 pull on the weights a step, in units of the rate


def word_features(word: str) -> tuple[str, ...]:
    """A lower-cased word and its prefixes (marked, so they differ from words)."""
    word = word.strip(PUNCTUATION)
    return (word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)) if word else ()


def feature_ids(word: str) -> tuple[int, ...]:
    return tuple(xxhash.xxh3_64_intdigest(f) for f in word_features(word))


def features(text: str, known: Memo) -> tuple[np.ndarray, np.ndarray]:
    """(ids, counts) of a text's features, ids ascending."""
    out: Counter = Counter()
    for word, n in Counter(text.lower().split()).items():
        for f in known[word]:
            out[f] += n
    ids = np.fromiter(out.keys(), dtype=np.uint64, count=len(out))
    counts = np.fromiter(out.values(), dtype=np.int32, count=len(out))
    order = np.argsort(ids)
    return ids[order], counts[order]


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Model:
    weights: dict[str, float]
    thresholds: np.ndarray
    cut: float

    def score(self, counts: dict[str, int]) -> tuple[float, float, int]:
        """Expected severity, P(grade > 0), most probable grade."""
        s = sum(self.weights[f] * np.log1p(n) for f, n in sorted(counts.items()))
        above = sigmoid(s - self.thresholds)
        each = -np.diff(np.concatenate([[1.0], above, [0.0]]))
        return round(float(above.sum()), 6), round(float(above[0]), 6), int(each.argmax())


def ordinal_fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ordered thresholds, by Adam on the likelihood.  The
    thresholds are the first one plus exponentials of free gaps."""
    k = GRADES
    w = np.zeros(x.shape[1])
    t = np.concatenate([[0.0], np.zeros(k - 1)])
    params = np.concatenate([w, t])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        w, t = params[: -k], params[-k:]
        gaps = np.exp(t[1:])
        theta = t[0] + np.concatenate([[0.0], np.cumsum(gaps)])
        s = x @ w
        cdf = sigmoid(np.concatenate([[-np.inf], theta, [np.inf]])[None, :] - s[:, None])  # P(grade < j), j = 0..k+1
        cdf[:, 0], cdf[:, -1] = 0.0, 1.0
        slope = cdf * (1 - cdf)
        rows = np.arange(len(y))
        p = np.maximum(cdf[rows, y + 1] - cdf[rows, y], 1e-9)
        hi, lo = weight * slope[rows, y + 1] / p, weight * slope[rows, y] / p
        d_theta = np.zeros(k + 2)
        np.add.at(d_theta, y + 1, -hi)
        np.add.at(d_theta, y, lo)
        d_theta = d_theta[1:-1]
        grad_w = x.T @ (hi - lo)
        tails = np.cumsum(d_theta[::-1])[::-1]
        grad = np.concatenate([grad_w, [tails[0]], tails[1:] * gaps])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        params = params - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        params[:-k] = np.sign(params[:-k]) * np.maximum(np.abs(params[:-k]) - RATE * SHRINK, 0)
    gaps = np.exp(params[-k + 1 :])
    return params[:-k], params[-k] + np.concatenate([[0.0], np.cumsum(gaps)])


def train(rows: list[tuple[str, int]]) -> Model | None:
    """Model of (text, toxic 0/1) rows; None unless both classes occur."""
    toxic = np.array([y for _, y in rows], dtype=int)
    if len(set(toxic.tolist())) < 2:
        return None
    known = Memo(feature_ids)
    bags = [features(t, known) for t, _ in rows]  # sparse: two small arrays a text
    ids, texts_with = np.unique(np.concatenate([i for i, _ in bags]), return_counts=True)
    ids = ids[texts_with >= max(MIN_TEXTS, MIN_SHARE * len(rows))]
    bags = [(i[at], c[at]) for i, c in bags for at in [np.isin(i, ids, assume_unique=True)]]
    wanted, found = set(ids.tolist()), {}
    for text, _ in rows:  # the names of what is left
        for word in set(text.lower().split()):
            found |= {i: f for i, f in zip(known[word], word_features(word)) if i in wanted and i not in found}
    names = sorted(found.values())
    place = {i: j for j, (_, i) in enumerate(sorted((f, i) for i, f in found.items()))}
    bags = [(np.array([place[k] for k in i.tolist()], dtype=np.int64), c) for i, c in bags]
    seen = np.zeros((2, len(names)))
    for (i, _), y in zip(bags, toxic):
        seen[y][i] += 1
    n = np.bincount(toxic, minlength=2)
    a, b = seen[1], seen[0]
    odds = np.log((a + 0.5) / (n[1] + 1)) - np.log((b + 0.5) / (n[0] + 1))
    share = (a + b) / n.sum()
    chi = (a - share * n[1]) ** 2 / (share * n[1]) + (b - share * n[0]) ** 2 / (share * n[0])
    chi[np.abs(odds) < MIN_ODDS] = 0
    chosen = sorted(i for i in np.argsort(-chi, kind="stable")[:FEATURES].tolist() if chi[i] >= MIN_CHI * len(rows))
    indicative = np.array([odds[i] > INDICATIVE and not names[i].endswith("*") for i in range(len(names))], dtype=bool)
    indicative &= np.isin(np.arange(len(names)), chosen)
    amount = np.array([c[indicative[i]].sum() for i, c in bags])
    thirds = np.quantile(amount[toxic == 1], [1 / 3, 2 / 3])
    grade = np.where(toxic == 1, 1 + (amount[:, None] > thirds[None, :]).sum(axis=1), 0)
    index = {names[i]: j for j, i in enumerate(chosen)}
    column = np.full(len(names), -1)
    column[chosen] = np.arange(len(chosen))
    x = np.zeros((len(rows), len(index)))
    for row, (i, c) in zip(x, bags):
        used = column[i] >= 0
        row[column[i[used]]] = np.log1p(c[used])
    del bags, known, found
    kept_back = np.zeros(len(rows), dtype=bool)
    for y in (0, 1):
        kept_back[np.nonzero(toxic == y)[0][4::5]] = True
    fit = ~kept_back
    balance = np.where(toxic == 1, 0.5 / max(1, (toxic[fit] == 1).sum()), 0.5 / max(1, (toxic[fit] == 0).sum()))
    w, theta = ordinal_fit(x[fit], grade[fit], balance[fit])
    held = kept_back if len(set(toxic[kept_back].tolist())) == 2 else fit
    p = sigmoid(x[held] @ w - theta[0])
    caught, passed = p[toxic[held] == 1], p[toxic[held] == 0]
    right = {c: (caught >= c).mean() + (passed < c).mean() for c in np.linspace(0.05, 0.95, 91)}
    best = [c for c, r in right.items() if r == max(right.values())]
    return Model({f: float(w[j]) for f, j in index.items()}, theta, float(best[len(best) // 2]))


def sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, chars: int = SAMPLE_CHARS) -> list[tuple[str, int]]:
    """(text, toxic) of a bounded number of labelled documents.  The labels are
    thinned before they meet the texts, so the small side is broadcast."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    counts = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pick = F.lit(False)
    for y, n in sorted(counts.items()):
        pick = pick | ((F.col("toxic") == y) & hash_fraction(F.col("doc_id"), min(1.0, per_class / n)))
    few = known.where(pick)
    rows = docs.select("doc_id", "text").where(F.length("text").between(1, chars)).join(F.broadcast(few), "doc_id")
    # Repeated rows count once, and of each class the smallest hashes stay: the
    # number of rows is bounded whatever ids and texts repeat.
    rows = rows.select("doc_id", "text", "toxic").distinct().withColumn("h", F.xxhash64("doc_id", "text", F.lit("bound")))
    first = [rows.where(F.col("toxic") == y).orderBy("h", "text").limit(per_class).select("text", "toxic") for y in (0, 1)]
    return sorted((r.text, r.toxic) for r in first[0].unionByName(first[1]).collect())


class Scorer:
    """Scores under a model; which of a word's features count is remembered."""

    def __init__(self, model: Model):
        self.model = model
        self.known = Memo(lambda w: tuple(f for f in word_features(w) if f in model.weights))
        self.nothing = model.score({})

    def score(self, text: str | None) -> tuple[float, float, int]:
        words = (text or "").lower().split()
        known = self.known
        hits = {w for w in set(words) if known[w]}
        if not hits:
            return self.nothing
        counts: Counter = Counter()
        for w in words:
            if w in hits:
                counts.update(known[w])
        return self.model.score(counts)


def with_severity(docs: DataFrame, text: Column, model: Model | None) -> DataFrame:
    """``docs`` and a struct column ``_toxicity`` (severity, p_toxic, grade, toxic)."""
    if model is None:
        return docs.withColumn(
            "_toxicity",
            F.struct(F.lit(0.0).alias("severity"), F.lit(0.0).alias("p_toxic"), F.lit(0).alias("grade"), F.lit(False).alias("toxic")),
        )

    @F.pandas_udf("severity double, p_toxic double, grade int, toxic boolean")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for s in batches:
            out = pd.DataFrame([scorer.score(t) for t in s], columns=["severity", "p_toxic", "grade"])
            yield out.assign(toxic=out.p_toxic >= model.cut)

    return docs.withColumn("_toxicity", score(text))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, severity, p_toxic, grade, toxic) of every row of ``docs``."""
    bounded_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    model = train(sample(docs, labels.select("doc_id", "toxic")))
    return with_severity(docs, F.col("text"), model).select("doc_id", "_toxicity.*")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are not toxic."""
    model = train(sample(docs.select("doc_id", "text"), labels.select("doc_id", "toxic")))
    return with_severity(packed(docs), F.col("doc.text"), model).where("not _toxicity.toxic").select("doc.*")
