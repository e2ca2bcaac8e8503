"""Cross-tokenizer alignment (12) against the two libraries and brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from odd import ROWS, empty_docs, odd_docs, rows, with_clashes

from conftest import SF_SMALL
from tillmart.llm import alignment, perfect_hash
from tillmart.llm.bpe import byte_characters
from tillmart.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


class Plain:
    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.byte_of = byte_characters()

    def tokens(self, text):
        """[(id, start, end)] of A and of B, None for a text without tokens."""
        if not text:
            return None
        out = []
        ids = self.a.encode(" " + text, add_special_tokens=False).ids
        out.append([(i, bytes(self.byte_of[c] for c in self.a.id_to_token(i))) for i in ids])
        piece = self.b.id_to_piece
        out.append([(i, bytes([int(piece(i)[3:5], 16)]) if self.b.is_byte(i) else piece(i).replace("▁", " ").encode()) for i in self.b.encode(text)])
        if any(b"".join(t for _, t in side) != (" " + text).encode() for side in out):
            return None
        spans = []
        for side in out:
            at, own = 0, []
            for i, t in side:
                own.append((i, at, at + len(t)))
                at += len(t)
            spans.append(own)
        return spans

    def align(self, text):
        spans = self.tokens(text)
        if spans is None:
            return None
        a, b = spans
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, at = [], [0, 0]
        for cut in cuts:
            parts = []
            for k, side in enumerate(spans):
                own = []
                while at[k] < len(side) and side[at[k]][2] <= cut:
                    own.append(str(side[at[k]][0]))
                    at[k] += 1
                parts.append(",".join(own))
            groups.append("|".join(parts))
        links, first = [], 0
        for i, s, e in a:
            while b[first][2] <= s:
                first += 1
            k = first
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


@pytest.fixture(scope="module")
def plain():
    return Plain()


def plain_rows(plain, documents):
    found = [(i, plain.align(t)) for i, t in documents]
    counts = Counter(p for _, f in found if f for p in set(f[3]))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            links = f[3]
            out.append((i, f[0], f[1], f[2], len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), f[4]))
    return sorted(out, key=repr)


def strange_texts(n=1500):
    rng = random.Random(3)
    signs = list("ab c  \n\t.,'s1é漢😀▁᠎​\xa0　<|endoftext|>\x00﻿")
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for _ in range(n)] + [
        "".join(chr(rng.choice([rng.randint(0, 0x2FF), rng.randint(0, 0xD7FF), 32, 32, 97])) for _ in range(rng.randint(0, 12))) for _ in range(n)
    ]


def test_segments_align_like_whole_texts(plain):
    """Also with a memory so small that it is shrunk again and again."""
    m = alignment.Aligner(A, B, texts=True, most_bytes=100_000)
    assert m.by_rank  # the fast library is proven equal for this file
    given = strange_texts()
    for text, codes in ((t, c) for i in range(0, len(given), 100) for t, c in zip(given[i : i + 100], m.documents(given[i : i + 100]))):
        want = plain.align(text)
        if want is None:
            assert codes is None
            continue
        numbers = m.numbers[codes].sum(axis=0).tolist()
        links = sorted((p >> 32, p & alignment.LOW) for p in m.links(codes).tolist())
        assert (*numbers[:4], links, m.digest(codes)) == (*want[:3], len(want[3]), sorted(want[3]), want[4])
    assert m.bytes < 400_000


def test_both_encoders_of_the_byte_tokenizer_agree():
    fast, slow = alignment.Aligner(A, B, texts=True), alignment.Aligner(A, B, texts=True)
    slow.by_rank = None
    given = strange_texts(300)
    for x, y in zip(fast.documents(given), slow.documents(given)):
        assert (x is None) == (y is None)
        if x is not None:
            assert fast.digest(x) == slow.digest(y)


def test_perfect_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 70, 5000):
        keys = np.unique(rng.integers(0, 1 << 48, n))
        bucket = perfect_hash.fine_bucket(keys).astype(np.int64) % 4
        parts = [keys[bucket == b] for b in range(4)]
        table = perfect_hash.PerfectHash([(*perfect_hash.build(k), len(k)) for k in parts])
        assert sorted(table.slots(keys, bucket).tolist()) == list(range(len(keys)))
    with pytest.raises(ValueError):
        perfect_hash.build(np.array([7, 7]))


def test_a_pair_that_was_not_counted_is_noticed():
    keys = np.arange(1, 100, dtype=np.int64)
    sizes, bits = perfect_hash.build(keys)
    slots = perfect_hash.PerfectHash([(sizes, bits, 99)]).slots(keys, np.zeros(99, np.int64))
    ordered = np.empty(99, np.int64)
    ordered[slots] = keys
    table = alignment.PairTable([(sizes, bits.tobytes(), ordered.tobytes(), (ordered * 10).tobytes())], np.zeros(1, np.int64))
    assert table.counts_of(keys).tolist() == (keys * 10).tolist()
    with pytest.raises(ValueError):
        table.counts_of(np.array([1000]))


def test_query_broadcast_and_joined(spark, plain, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = plain_rows(plain, [tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert rows(QUERIES["op12_alignment"](spark, SF_SMALL), *COLUMNS) == want
    monkeypatch.setattr(alignment, "LANE_ROWS", 100)  # many lanes, a tree of two levels
    assert rows(alignment.alignment(docs.repartition(20), A, B, table_bytes=0), *COLUMNS) == want


def test_odd_rows(spark, plain):
    want = plain_rows(plain, [(r[0], r[1]) for r in ROWS])
    for table_bytes in (alignment.TABLE_BYTES, 0):
        assert rows(alignment.alignment(with_clashes(odd_docs(spark)), A, B, table_bytes), *COLUMNS) == want
        assert rows(alignment.alignment(empty_docs(spark), A, B, table_bytes)) == []
