"""Operator 1: stupid-backoff language-model scores of any order.

The model is counted from the corpus itself, and each document is scored by
the counts of all *other* documents: its own occurrences are subtracted, so
text is not its own evidence.  With c the counts without the document's own
and N the words they cover, a word w after a context v of up to ``order`` - 1
words scores

    c(v w) / c(v)                         if c(v w) > 0
    ALPHA * (score after v without its first word)   otherwise,

where c(v) counts v as a context, that is with a word after it.  Without a
context w scores c(w) / N, with c(w) at least UNSEEN and N at least 1.  A word
with fewer words before it starts from the longest context there is.  Words are
``[^\\x20\\x09-\\x0D]+``; a document's score is the sum of log10 over its words.

Plan: texts are dealt into blocks of about ``BLOCK_BYTES``.  A block's n-grams
are counted once per block (the map-side combine: a frequent n-gram is one
entry per block, however often it occurs) and sent, as 64-bit hashes with
counts, to the hash partition ("bucket") that owns them.  With each count goes
the number of texts that end with the n-gram: the rest of its occurrences are
contexts.  A bucket adds up its n-gram count table and answers every block with
the totals of that block's entries.  The totals meet their block's texts again,
where the documents' n-grams look them up and are summed per document.  All
texts, all n-grams, no cut-offs; blocks and buckets grow in number with the
input, not in size.

Hash partition: the top bits of the hash name the bucket, the next 48 bits (as
far as there are as many) tell n-grams of a bucket apart.  Buckets hold a
bounded number of n-grams, so two of them fall together with a probability
that does not grow with the input.  A block sends each bucket one row; for very
large inputs ``block_bytes`` and ``bucket_bytes`` are best raised together, so
that these rows stay long.

Defined cases: null and empty texts have no words, score 0 and no mean; rows
are documents of their own even if repeated; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import texts

ALPHA = 0.4
UNSEEN = 0.1
SEED = 42
# Text of a block; text whose n-grams share a bucket.
BLOCK_BYTES = 8_000_000
BUCKET_BYTES = 4_000_000
KEPT_BITS = 48
PAIR, WORD = 2, 3  # salts; an n-gram of three or more words has n + 1


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """A bijective mix of 64-bit numbers (multiply, fold, multiply, fold)."""
    x = (x ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Block:
    """The n-grams of a block of texts as hashes: all lengths in one space."""

    def __init__(self, batch: list[str], order: int = 2):
        ids: dict[bytes, int] = {}
        self.codes = [
            np.fromiter((ids.setdefault(w, len(ids)) for w in ws), dtype=np.int64, count=len(ws))
            for ws in (t.encode().split() for t in batch)
        ]
        word = np.fromiter(map(xxhash.xxh64_intdigest, ids, repeat(SEED)), dtype=np.uint64, count=len(ids))
        self.order, self.word, self.left = order, mixed(word, WORD), mixed(word, PAIR)
        self.sizes = np.array([len(c) for c in self.codes], dtype=np.int64)

    def pairs(self, codes: np.ndarray) -> np.ndarray:
        # not symmetric: the left word's hash is mixed once more before the right one's
        return mixed(self.left[codes[:-1]] + self.word[codes[1:]], PAIR)

    def runs(self):
        """For n = 1 to the order: the n-grams of all texts in order, the text
        of each, and the place of its first word in the block."""
        every = np.concatenate([np.zeros(0, np.int64), *self.codes])
        text = np.repeat(np.arange(len(self.sizes)), self.sizes)
        left = np.repeat(np.cumsum(self.sizes), self.sizes) - np.arange(len(every))  # words from here to the text's end
        grams = self.word[every]
        for n in range(1, self.order + 1):
            if n == 2:
                grams = self.pairs(every)
            elif n > 2:
                grams = mixed(mixed(grams[:-1], n + 1) + self.word[every[n - 1 :]], n + 1)
            at = np.nonzero(left[: len(grams)] >= n)[0]
            yield n, grams[at], text[at], at

    def counted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct n-gram hashes of the block in order, their counts, and how
        many texts end with them (not counted for the longest)."""
        found, last = [], [np.zeros(0, np.uint64)]
        for n, grams, text, _ in self.runs():
            found.append(np.unique(grams, return_counts=True))
            if n < self.order:
                last.append(grams[np.nonzero(np.diff(text, append=-1))[0]])
        grams, counts = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(grams)
        grams, counts, ends = grams[order], counts[order], np.zeros(len(grams), np.int64)
        np.add.at(ends, np.searchsorted(grams, np.concatenate(last)), 1)
        return grams, counts, ends

    def scored(self, grams: np.ndarray, totals: np.ndarray, ends: np.ndarray, corpus: int) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """The sum of log10 of each text, and for n from 2 the number of its
        n-grams seen in others; ``totals`` and ``ends`` are those of ``grams``."""
        seen: dict[int, np.ndarray] = {}
        for n, own, text, at in self.runs():
            table, of = np.unique(own, return_inverse=True)
            here = np.searchsorted(grams, table)
            key, alike, times = np.unique(text * max(len(table), 1) + of, return_inverse=True, return_counts=True)
            mine = times[alike]
            others = totals[here][of] - mine
            if n == 1:
                s = np.maximum(others, UNSEEN) / np.maximum(corpus - self.sizes[text], 1)
            else:
                seen[n] = np.bincount(text[others > 0], minlength=len(self.sizes))
                w = at + n - 1
                s[w] = np.where(others > 0, others / np.maximum(context[at], 1), ALPHA * s[w])
            if n < self.order:
                final = np.full(len(self.sizes), -1)
                final[text] = of  # the last assignment stands: the text's last n-gram
                context = np.zeros(len(s), np.int64)
                context[at] = (totals - ends)[here][of] - (mine - (of == final[text]))
        of_word = np.repeat(np.arange(len(self.sizes)), self.sizes)
        return np.bincount(of_word, weights=np.log10(s), minlength=len(self.sizes)), seen


def bucket_of(grams: np.ndarray, bits: int) -> np.ndarray:
    return (grams >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(grams), np.int64)


def packed(grams: np.ndarray, bits: int) -> bytes:
    """The up to KEPT_BITS bits after the bucket bits, six bytes each, one byte
    plane after the other."""
    kept = min(KEPT_BITS, 64 - bits)
    low = (grams >> np.uint64(64 - bits - kept)) & np.uint64((1 << kept) - 1)
    return np.ascontiguousarray(low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : KEPT_BITS // 8].T).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(KEPT_BITS // 8, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, : KEPT_BITS // 8] = planes.T
    return out.view("<u8").ravel()


def narrow(values: np.ndarray) -> bytes:
    """Counts in the fewest bytes that hold them all, the width first."""
    most = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def widened(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{data[0]}", offset=1).astype(np.int64)


def lm_scores(docs: DataFrame, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES, order: int = 2) -> DataFrame:
    """(doc_id, n_words, n_seen_pairs, log10_score, mean_log10) of every row of
    ``docs``; from order 3 also n_seen_3grams and so on up to the order."""
    if order < 2:
        raise ValueError("the order is at least 2")
    own = texts(docs)
    words = F.size(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")).cast("long")
    size, corpus = own.agg(*(F.coalesce(F.sum(x), F.lit(0)) for x in (F.octet_length("text").cast("long"), words))).first()
    blocks = max(1, -(-size // block_bytes))
    bits = min(max(0, -(-size // bucket_bytes) - 1).bit_length(), 40)
    dealt = own.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))

    def count(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        grams, counts, last = Block(pdf["text"].tolist(), order).counted()
        buckets, starts = np.unique(bucket_of(grams, bits), return_index=True)
        ends = [*starts[1:], len(grams)]
        return pd.DataFrame(
            {
                "block": int(key[0]),
                "bucket": buckets,
                "grams": [packed(grams[a:b], bits) for a, b in zip(starts, ends)],
                "counts": [narrow(counts[a:b]) for a, b in zip(starts, ends)],
                "ends": [narrow(last[a:b]) for a, b in zip(starts, ends)],
            }
        )

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        grams = [unpacked(g) for g in rows["grams"]]
        table, at = np.unique(np.concatenate(grams), return_inverse=True)
        cuts = np.cumsum([len(g) for g in grams])[:-1]
        out = {"block": rows["block"], "bucket": rows["bucket"]}
        for name in ("counts", "ends"):
            sums = np.zeros(len(table), dtype=np.int64)
            np.add.at(sums, at, np.concatenate([widened(c) for c in rows[name]]))
            out[name] = [narrow(x) for x in np.split(sums[at], cuts)]
        return pd.DataFrame(out)

    def score(texts_of: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        block = Block(texts_of["text"].tolist(), order)
        grams, _, _ = block.counted()
        answers = answers.sort_values("bucket")
        totals, ends = (np.concatenate([np.zeros(0, np.int64), *map(widened, answers[c])]) for c in ("counts", "ends"))
        logs, seen = block.scored(grams, totals, ends, corpus)
        rows = [(int(n), round(float(x), 4), round(float(x) / n, 6) if n else None) for n, x in zip(block.sizes, logs)]
        out = pd.DataFrame(rows, columns=["n_words", "log10_score", "mean_log10"])
        return out.assign(doc_id=texts_of["doc_id"].array, **{seen_name(n): found for n, found in seen.items()})

    # Both uses of the texts by block are one exchange, shuffled once.
    sent = dealt.groupBy("block").applyInPandas(count, "block long, bucket long, grams binary, counts binary, ends binary")
    tables = sent.groupBy("bucket").applyInPandas(total, "block long, bucket long, counts binary, ends binary")
    seen_columns = ", ".join(f"{seen_name(n)} long" for n in range(2, order + 1))
    schema = f"doc_id long, n_words long, {seen_columns}, log10_score double, mean_log10 double"
    return dealt.groupBy("block").cogroup(tables.groupBy("block")).applyInPandas(score, schema)


def seen_name(n: int) -> str:
    return "n_seen_pairs" if n == 2 else f"n_seen_{n}grams"


def oracle() -> str:
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT rid, i, ws[i] AS w, CASE WHEN i > 1 THEN ws[i - 1] END AS v, i < len(ws) AS leads
      FROM (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS i FROM d)),
cw AS (SELECT w, count(*) AS c, sum(leads::INT) AS f FROM w GROUP BY w),
cp AS (SELECT v, w, count(*) AS c FROM w WHERE v IS NOT NULL GROUP BY v, w),
ow AS (SELECT rid, w, count(*) AS c, sum(leads::INT) AS f FROM w GROUP BY rid, w),
op AS (SELECT rid, v, w, count(*) AS c FROM w WHERE v IS NOT NULL GROUP BY rid, v, w),
n AS (SELECT count(*) AS n FROM w),
s AS (
  SELECT w.rid, w.v,
         coalesce(cp.c - op.c, 0) AS pair,
         greatest(coalesce(fv.f - ov.f, 0), 1) AS first,
         greatest((cw.c - ow.c)::DOUBLE, {UNSEEN}) / greatest(n.n - len(d.ws), 1) AS alone
  FROM w JOIN d USING (rid) JOIN cw USING (w) JOIN ow USING (rid, w)
  LEFT JOIN cp ON cp.v = w.v AND cp.w = w.w LEFT JOIN op ON op.rid = w.rid AND op.v = w.v AND op.w = w.w
  LEFT JOIN cw fv ON fv.w = w.v LEFT JOIN ow ov ON ov.rid = w.rid AND ov.w = w.v, n),
t AS (SELECT rid, count(*) AS n_words, sum((pair > 0)::INT) AS n_seen_pairs,
             sum(log10(CASE WHEN v IS NULL THEN alone WHEN pair > 0 THEN pair / first ELSE {ALPHA} * alone END)) AS score
      FROM s GROUP BY rid)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_seen_pairs, 0)::BIGINT AS n_seen_pairs,
       round(coalesce(score, 0), 4) AS log10_score, round(score / n_words, 6) AS mean_log10
FROM d LEFT JOIN t USING (rid)"""
