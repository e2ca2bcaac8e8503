"""Token counts (2) and byte-level BPE (6) against the libraries themselves."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from odd import ROWS, empty_docs, odd_docs, rows, with_clashes
from tokenizers import Tokenizer

from conftest import SF_SMALL
from tillmart.llm import bpe, token_counts
from tillmart.llm.queries import BYTE_BPE, PIECES, QUERIES

PIECE_PATH, BPE_PATH = public_tokenizers.path(PIECES), public_tokenizers.path(BYTE_BPE)


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_PATH)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(BPE_PATH)


def strange_texts(n=1500):
    rng = random.Random(3)
    alphabet = "ab  \t\n\x1c\x85\xa0é'sßñ,.!?123①　漢字😀▁​\x00<|>" + "the and"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(n)]
    return made + ["", " ", "  ", "a" * 3000, " " * 2000, "<|endoftext|>", "x <|endoftext|>  y<|endoftext|>", "don't we'll I'd", "\n\n a \n b"]


def test_spliced_counts_equal_the_library(pieces):
    texts = strange_texts()
    counter = token_counts.PieceCounter(PIECE_PATH, chunk=20, overlap=2)
    assert counter.counts(texts) == [len(x) for x in pieces.encode(texts)]
    assert counter.widened > 0


def test_a_text_without_stable_boundary_is_encoded_whole(pieces):
    text = "a" * 500
    assert token_counts.PieceCounter(PIECE_PATH, chunk=16, overlap=2).counts([text]) == [len(pieces.encode(text))]


def test_stable_positions_are_never_crossed(pieces):
    counter = token_counts.PieceCounter(PIECE_PATH)
    for text in strange_texts(200):
        whole = len(pieces.encode(text))
        for p in list(counter.stable(text, 1, len(text)))[:5]:
            # the right part as inside a text: the space the library adds is one token of its own there or not
            ends = counter.ends(text)
            assert ends is None or p in set(ends.tolist()), (text, p, whole)


def test_counts_query(spark, pieces):
    got = {r.doc_id: r for r in QUERIES["op2_token_counts"](spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        n = len(pieces.encode(d.text or ""))
        assert (got[d.doc_id].n_tokens, got[d.doc_id].n_bytes, got[d.doc_id].over_limit) == (n, len((d.text or "").encode()), n > 4096)


def test_counts_of_odd_rows(spark, pieces):
    docs = odd_docs(spark)
    got = token_counts.token_counts(docs, PIECE_PATH)
    want = [(i, len((t or "").encode()), n := len(pieces.encode(t or "")), n > 4096) for i, t, *_ in ROWS]
    assert rows(got) == sorted(want, key=repr)
    assert rows(token_counts.token_counts(with_clashes(docs), PIECE_PATH)) == rows(got)
    assert rows(token_counts.token_counts(empty_docs(spark), PIECE_PATH)) == []


def test_ids_equal_the_library(tokenizer):
    model = bpe.ByteBPE(BPE_PATH, remembered=50)  # so small that it forgets all the time
    for text in strange_texts():
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        packed = model.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == ids, repr(text)
        assert model.decode(packed) == tokenizer.decode(ids, skip_special_tokens=False)


def test_pair_test_equals_the_merges():
    model = bpe.ByteBPE(BPE_PATH)

    def merged(pair):
        ids = [model.single[b] for t in pair for b in model.bytes_of[t]]
        while True:
            best = min((model.rank[p] + (i,) for i, p in enumerate(zip(ids, ids[1:])) if p in model.rank), default=None)
            if best is None:
                return ids
            ids[best[2] : best[2] + 2] = [best[1]]

    rng = random.Random(4)
    same = [t for t in range(50_256) if len(set(model.bytes_of[t])) == 1][:120]
    pairs = [(rng.randrange(2000), rng.randrange(2000)) for _ in range(6000)] + [(a, b) for a in same for b in same]
    assert all(model.pair_holds(p[0] << 32 | p[1]) == (merged(p) == list(p)) for p in pairs)


def digests(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    decoded = tokenizer.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_encoding_query(spark, tokenizer):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op6_bpe_encoding"](spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert got == {d.doc_id: digests(tokenizer, d.text) for d in docs}


def test_encoding_of_odd_rows(spark, tokenizer):
    docs = odd_docs(spark)
    want = sorted(((i, *digests(tokenizer, t)) for i, t, *_ in ROWS), key=repr)
    assert rows(bpe.encoding_digests(docs, BPE_PATH)) == want
    assert rows(bpe.encoding_digests(with_clashes(docs), BPE_PATH)) == want
    assert rows(bpe.encoding_digests(empty_docs(spark), BPE_PATH)) == []
    whole = bpe.encoded(with_clashes(docs), BPE_PATH)
    assert whole.where("not round_trip").count() == 0 and whole.count() == len(ROWS)
    assert set(docs.columns) < set(whole.columns)
