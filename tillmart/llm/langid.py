"""Operator 10: language identification by averaged hashed subword embeddings.

A word's features are the character n-grams of its runs of letters (with
boundary marks), hashed into ``BUCKETS`` rows of an embedding table.  A text is
the average of the embeddings of all its n-grams, and a linear softmax over the
learned languages follows.  Table and softmax are trained together by
stochastic gradient descent in numpy, on the driver, on a bounded sample:
up to about ``SAMPLE_PER_LANG`` whole texts of each language, of at most
``SAMPLE_CHARS`` characters, chosen by a hash of the text.  A fifth of them is
kept back to calibrate: a temperature for the probabilities, and per setting
the smallest score at which the accepted predictions are right in
``ACCEPT_ACCURACY`` of the cases.

Learning uses text and non-null lang only, of documents whose CRC32 of the
doc_id as text is not 2 modulo 4 (a null doc_id is not held out and not
learned from).  Prediction uses the text only, always whole: since average and
softmax are linear up to the end, a word's share of the logits is computed once
and remembered, and a text's logits are the sum over its words.

Defined cases: null texts and texts without a letter get ``und`` with score 0,
not accepted; so does every text if there is nothing to learn from.  Ties go to
the language that sorts first.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmart.llm.common import bounded_batches, small, staged
from tillmart.llm.memo import Memo, WordRows

UNKNOWN = "und"
SAMPLE_PER_LANG = 1_000
SAMPLE_TOTAL = 12_000  # of all languages together
SPARE = 2  # thinning keeps so many times the rows that are wanted
SAMPLE_CHARS = 20_000
BUCKETS = 4_096
DIM = 16
ORDERS = (2, 3, 4)
EPOCHS = 12
BATCH = 32
RATE = 0.5
SEED = 7
ACCEPT_ACCURACY = 0.99
LETTERS = re.compile(r"[^\W\d_]+")


_BUCKET_OF = Memo(lambda gram: zlib.crc32(gram.encode()) % BUCKETS)


def subwords(word: str) -> list[int]:
    """Buckets of the n-grams of a lower-cased word's runs of letters."""
    out, bucket = [], _BUCKET_OF
    for run in LETTERS.findall(word):
        run = f"<{run}>"
        for n in ORDERS:
            out += [bucket[run[i : i + n]] for i in range(len(run) - n + 1)]
    return out


def letters(word: str) -> int:
    return len(word) if word.isalpha() else sum(map(str.isalpha, word))


def averages(batch: list[str]) -> np.ndarray:
    """Share of each bucket in each text."""
    known = Memo(lambda w: np.array(subwords(w), dtype=np.int64))
    x = np.zeros((len(batch), BUCKETS), dtype=np.float32)
    for row, t in zip(x, batch):
        grams = [known[w] for w in t.lower().split()]
        if grams:
            row += np.bincount(np.concatenate(grams), minlength=BUCKETS).astype(np.float32)
            row /= max(row.sum(), 1)
    return x


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # BUCKETS x languages: embeddings times softmax weights
    bias: np.ndarray
    temperature: float
    accept: float


def train(rows: list[tuple[str, str]]) -> Model | None:
    """Model of (text, lang) rows; None without any row."""
    rows = sorted(set(rows), key=lambda r: (zlib.crc32(r[0].encode()), r))
    langs = sorted({lang for _, lang in rows})
    if not rows:
        return None
    x, y = averages([t for t, _ in rows]), np.array([langs.index(lang) for _, lang in rows])
    kept_back = np.arange(len(rows)) % 5 == 4
    fit = np.nonzero(~kept_back)[0]
    rng = np.random.default_rng(SEED)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out, bias = rng.normal(0, 0.1, (DIM, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32)
    scale = np.sqrt(BUCKETS)  # averages are small numbers: a larger unit for the same model
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in np.array_split(rng.permutation(fit), max(1, len(fit) // BATCH)):
            xb = x[i] * scale
            h = xb @ emb
            p = softmax(h @ out + bias)
            p[np.arange(len(i)), y[i]] -= 1
            p /= len(i)
            used = np.nonzero(xb.any(axis=0))[0]
            step_emb, step_out = xb[:, used].T @ (p @ out.T), h.T @ p
            emb[used] -= rate * step_emb
            out -= rate * step_out
            bias -= rate * p.sum(axis=0)
    table = (emb @ out * scale).astype(np.float64)
    held = np.nonzero(kept_back)[0] if kept_back.any() else fit
    logits = x[held] @ table + bias
    loss = {t: -np.log(softmax(logits / t)[np.arange(len(held)), y[held]] + 1e-12).mean() for t in np.geomspace(0.25, 8, 21)}
    temperature = float(min(loss, key=loss.get))
    p = softmax(logits / temperature)
    right = p.argmax(axis=1) == y[held]
    order = np.argsort(-p.max(axis=1), kind="stable")
    good = np.cumsum(right[order]) >= ACCEPT_ACCURACY * np.arange(1, len(order) + 1)
    accept = float(p.max(axis=1)[order[np.nonzero(good)[0][-1]]]) if good.any() else 1.0
    return Model(langs, table, bias.astype(np.float64), temperature, accept)


class Predictor:
    """Predictions under a model; a word's share of the logits is remembered."""

    def __init__(self, model: Model):
        self.model = model
        self.known = WordRows(self.shares, len(model.bias) + 2)

    def shares(self, words: list[str]) -> np.ndarray:
        """For each word the sum of its logits, the number of its n-grams and of its letters."""
        grams = [subwords(w) for w in words]
        sizes = np.fromiter(map(len, grams), dtype=np.int64, count=len(grams))
        out = np.zeros((len(words), len(self.model.bias) + 2))
        out[:, -2], out[:, -1] = sizes, [letters(w) for w in words]
        some = np.nonzero(sizes)[0]
        if len(some):
            logits = self.model.table[list(chain.from_iterable(grams))]
            out[some, :-2] = np.add.reduceat(logits, np.cumsum(sizes[some]) - sizes[some], axis=0)
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        total = self.known.sum((text or "").lower().split())
        if not total[-1] or not total[-2]:
            return UNKNOWN, 0.0
        p = softmax((total[:-2] / total[-2] + self.model.bias) / self.model.temperature)
        return self.model.langs[int(p.argmax())], round(float(p.max()), 6)


_LAST: dict[str, Predictor] = {}


def predictor_of(name: str, model: Model) -> Predictor:
    """The worker's predictor for a model, kept from task to task; one at a time."""
    if name not in _LAST:
        _LAST.clear()
        _LAST[name] = Predictor(model)
    return _LAST[name]


def held_out(docs: DataFrame):
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def sample(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG, chars: int = SAMPLE_CHARS, total: int = SAMPLE_TOTAL) -> list[tuple[str, str]]:
    """Whole (text, lang) rows to learn from: different texts, at most ``per_lang``
    of each language, fewer where there are so many languages that ``total``
    would be exceeded (one of each at least)."""
    known = docs.where(F.col("doc_id").isNotNull() & ~held_out(docs)).select("text", "lang")
    known = known.where(F.col("lang").isNotNull() & F.length("text").between(1, chars))
    counts = staged(known.groupBy("lang").agg(F.count("*").alias("n")), "langid-counts")
    langs = counts.count()
    if not langs:
        return []
    quota = max(1, min(per_lang, total // langs))
    # Thinned by hash, with room to spare where texts repeat, then the smallest hashes of each language.
    h = F.xxhash64("text", F.lit("sample")).bitwiseAND(F.lit((1 << 63) - 1))
    share = F.least(F.lit(1.0), F.lit(float(quota) * SPARE) / F.col("n"))
    few = known.join(small(counts), "lang").withColumn("h", h).where(F.col("h").cast("double") <= share * float(1 << 63))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    first = few.select("text", "lang", "h").distinct().withColumn("place", place).where(F.col("place") <= quota)
    return [(r.text, r.lang) for r in first.orderBy("lang", "place").collect()]


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted) of every row of ``docs``."""
    if model is None:
        return docs.select(
            "doc_id", held_out(docs).alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"),
            F.lit(0.0).alias("score"), F.lit(False).alias("accepted"),
        )

    bounded_batches(docs.sparkSession)
    name = uuid.uuid4().hex

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predictor = predictor_of(name, model)
        for s in batches:
            yield pd.DataFrame([predictor.predict(t) for t in s], columns=["lang_pred", "score"])

    out = docs.select("doc_id", held_out(docs).alias("held_out"), predict("text").alias("r"))
    accepted = (F.col("score") >= model.accept) & (F.col("lang_pred") != UNKNOWN)
    return out.select("doc_id", "held_out", "r.lang_pred", "r.score").withColumn("accepted", accepted)


def language_id(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text", "lang")
    return identify(docs, train(sample(docs)))
