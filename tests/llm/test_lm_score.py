"""Language-model scores (1) against a plain count."""

import math
import re
from collections import Counter

import numpy as np
from odd import ROWS, empty_docs, odd_docs, rows, with_clashes

from conftest import SF_SMALL
from tillmart.llm import lm_score
from tillmart.llm.queries import QUERIES


def plain_scores(texts):
    words = [[w for w in re.split("[\x20\x09-\x0d]+", t or "") if w] for t in texts]
    uni, bi, first = Counter(), Counter(), Counter()
    for ws in words:
        uni.update(ws)
        bi.update(zip(ws, ws[1:]))
        first.update(ws[:-1])
    total = sum(map(len, words))
    out = []
    for ws in words:
        u, b, f = Counter(ws), Counter(zip(ws, ws[1:])), Counter(ws[:-1])
        score, seen = 0.0, 0
        for i, w in enumerate(ws):
            alone = max(uni[w] - u[w], 0.1) / max(total - len(ws), 1)
            pair = bi[ws[i - 1], w] - b[ws[i - 1], w] if i else 0
            seen += pair > 0
            score += math.log10(alone if not i else pair / (first[ws[i - 1]] - f[ws[i - 1]]) if pair else 0.4 * alone)
        out.append((len(ws), seen, score))
    return out


def check(got, texts):
    want = plain_scores(texts)
    key = lambda r: (r[0], r[1], round(r[2], 2))
    found = sorted(((r.n_words, r.n_seen_pairs, r.log10_score) for r in got.collect()), key=key)
    want = sorted(want, key=key)
    assert [x[:2] for x in found] == [x[:2] for x in want]
    assert np.allclose([x[2] for x in found], [x[2] for x in want], atol=1e-3)


def test_odd_rows_in_many_blocks_and_buckets(spark):
    docs = odd_docs(spark)
    texts = [r[1] for r in ROWS]
    check(lm_score.lm_scores(with_clashes(docs)), texts)
    check(lm_score.lm_scores(docs, block_bytes=2_000, bucket_bytes=500), texts)
    assert rows(lm_score.lm_scores(empty_docs(spark))) == []


def test_packing_round_trip():
    rng = np.random.default_rng(1)
    grams = np.sort(rng.integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    for bits in (0, 5, 16, 30):
        kept = min(48, 64 - bits)
        want = (grams >> np.uint64(64 - bits - kept)) & np.uint64((1 << kept) - 1)
        assert (lm_score.unpacked(lm_score.packed(grams, bits)) == want).all()
    for most in (0, 255, 256, 70_000, 1 << 40):
        x = np.array([0, most, 1])
        assert (lm_score.widened(lm_score.narrow(x)) == x).all()


def test_a_pair_differs_from_its_reverse():
    block = lm_score.Block(["a b", "b a"])
    assert block.pairs(block.codes[0])[0] != block.pairs(block.codes[1])[0]


def plain_backoff(texts, order):
    """(words, n-grams seen in others by n, score) of each text, by definition."""
    words = [[w for w in re.split("[\x20\x09-\x0d]+", t or "") if w] for t in texts]
    cut = lambda ws, n: [tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)]
    total = sum(map(len, words))
    every, led = Counter(), Counter()
    for ws in words:
        for n in range(1, order + 1):
            every.update(cut(ws, n))
            led.update(g[:-1] for g in cut(ws, n + 1))
    out = []
    for ws in words:
        own, own_led = Counter(), Counter()
        for n in range(1, order + 1):
            own.update(cut(ws, n))
            own_led.update(g[:-1] for g in cut(ws, n + 1))

        def score(context, w):
            if not context:
                return max(every[(w,)] - own[(w,)], 0.1) / max(total - len(ws), 1)
            found = every[(*context, w)] - own[(*context, w)]
            return found / (led[context] - own_led[context]) if found else 0.4 * score(context[1:], w)

        logs = [math.log10(score(tuple(ws[max(0, i - order + 1) : i]), w)) for i, w in enumerate(ws)]
        seen = [sum(every[g] > own[g] for g in cut(ws, n)) for n in range(2, order + 1)]
        out.append((len(ws), *seen, sum(logs)))
    return out


def test_longer_orders_use_longer_contexts(spark):
    some = ["a b c d", "a b c e", "x b c e", "b c", "a b", "a b c d a b c d", "q", ""]
    data = [(100 + i, t, "en", "h", 0) for i, t in enumerate(some)]
    docs = odd_docs(spark).unionByName(spark.createDataFrame(data, odd_docs(spark).schema))
    texts = [r[1] for r in ROWS] + some
    key = lambda r: (*r[:-1], round(r[-1], 2))
    for order in (2, 3, 4):
        got = lm_score.lm_scores(docs, block_bytes=2_000, bucket_bytes=500, order=order)
        names = [lm_score.seen_name(n) for n in range(2, order + 1)]
        found = sorted((tuple(r) for r in got.select("n_words", *names, "log10_score").collect()), key=key)
        want = sorted(plain_backoff(texts, order), key=key)
        assert [x[:-1] for x in found] == [x[:-1] for x in want]
        assert np.allclose([x[-1] for x in found], [x[-1] for x in want], atol=1e-3)


def test_registered_at_order_three(spark):
    assert "n_seen_3grams" in QUERIES["op1_lm_scores_order3"](spark, SF_SMALL).columns
