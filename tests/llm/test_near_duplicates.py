"""SimHash near-duplicates (8) against brute force."""

import random

import numpy as np
import xxhash
from odd import ROWS, empty_docs, odd_docs, rows, with_clashes

from conftest import SF_SMALL
from tillmart.llm import simhash
from tillmart.llm.queries import QUERIES


def plain_fingerprint(text):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows_):
    """component id of each (doc_id, fingerprint) row."""
    fps = sorted({f for _, f in rows_})
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    arr = np.array(fps, dtype=np.uint64)
    for i, f in enumerate(fps):
        for j in np.nonzero(np.bitwise_count(arr[i + 1 :] ^ arr[i]) <= 3)[0]:
            a, b = root(f), root(fps[i + 1 + j])
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, f in rows_:
        if i is not None:
            least[root(f)] = min(least.get(root(f), i), i)
    return [least.get(root(f)) for _, f in rows_]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_masks_cover_every_triple_of_positions():
    masks = simhash.covering_masks(list(range(64)))
    assert len(masks) == 15
    rng = random.Random(1)
    for _ in range(5000):
        diff = sum(1 << p for p in rng.sample(range(64), rng.randint(1, 3)))
        assert any(diff & m == 0 for m in masks)


def family_fingerprints():
    rng = random.Random(5)
    out = []
    for _ in range(40):  # chains of small steps
        x = rng.getrandbits(64)
        out.append(x)
        for _ in range(rng.choice([0, 2, 25])):
            x ^= sum(1 << p for p in rng.sample(range(64), rng.randint(1, 5)))
            out.append(x)
    base, few = rng.getrandbits(64), rng.sample(range(64), 18)  # one large bucket
    out += [base ^ sum(1 << p for p in rng.sample(few, rng.randint(0, 5))) for _ in range(900)]
    return list(dict.fromkeys(out))


def test_components_of_families(spark, monkeypatch):
    fps = family_fingerprints()
    want = plain_components(list(enumerate(fps)))
    frame = spark.createDataFrame([(i, signed(f)) for i, f in enumerate(fps)], "doc_id long, fp long")
    for bucket in (simhash.BUCKET, 6):  # the second splits nearly every bucket again
        monkeypatch.setattr(simhash, "BUCKET", bucket)
        got = {r.fp: r.component_id for r in simhash.fingerprint_components(frame).collect()}
        assert [got[signed(f)] for f in fps] == want


def test_forest_by_flips_equals_forest_by_comparison():
    rng = random.Random(2)
    free = rng.sample(range(64), 12)
    fps = np.array(sorted({sum(1 << p for p in rng.sample(free, rng.randint(0, 6))) for _ in range(300)}), dtype=np.uint64)
    a, b = simhash.forest(fps), simhash.forest(fps, free)
    assert sorted(zip(*map(np.ndarray.tolist, a))) == sorted(zip(*map(np.ndarray.tolist, b)))


def test_a_long_chain_is_one_component(spark):
    edge = spark.createDataFrame([(i + 1, i) for i in range(300)], "a long, b long")
    assert {r.root for r in simhash.components(edge).collect()} == {0}


def test_query(spark):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op8_simhash_near_dedup"](spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    fps = [(d.doc_id, plain_fingerprint(d.text)) for d in docs]
    assert got == {i: (f"{f:016x}", c) for (i, f), c in zip(fps, plain_components(fps))}


def test_odd_rows(spark):
    docs = odd_docs(spark)
    fps = [(r[0], plain_fingerprint(r[1])) for r in ROWS]
    want = sorted(((i, f"{f:016x}", c) for (i, f), c in zip(fps, plain_components(fps))), key=repr)
    assert rows(simhash.near_duplicates(with_clashes(docs))) == want
    assert rows(simhash.near_duplicates(empty_docs(spark))) == []
    # of every component one row stays, all columns kept
    kept = simhash.one_of_each(with_clashes(docs))
    assert kept.columns == with_clashes(docs).columns
    # two texts under the number 4 are two components; texts without words are one
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 4, 4, None, 6, 7, 8], key=repr)
    assert rows(simhash.one_of_each(empty_docs(spark))) == []
