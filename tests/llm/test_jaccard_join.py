"""Similarity join of n-gram sets (11) against brute force."""

import random

import numpy as np
from odd import ROWS, empty_docs, odd_docs, rows, with_clashes

from conftest import SF_SMALL
from tillmart.llm import common
from tillmart.llm import jaccard_join as J
from tillmart.llm.queries import QUERIES


def plain_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return frozenset()
    return frozenset(b" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1)))


def plain_links(sets):
    return [
        (i, j)
        for i, x in enumerate(sets)
        for j, y in enumerate(sets[:i])
        if x and y and 100 * len(x & y) >= 80 * len(x | y)
    ]


def component(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def plain_result(documents):
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows."""
    sets = [plain_set(t) for _, t in documents]
    comp = component(len(sets), plain_links(sets))
    least = {}
    for (i, _), c in zip(documents, comp):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return sorted(((i, len(s), least.get(c)) for (i, _), s, c in zip(documents, sets, comp)), key=repr)


def families(rng, families=12, members=14):
    """Texts in families of edits of edits, with a passage that many share."""
    word = lambda: f"w{rng.randint(0, 4000)}"
    passage = [word() for _ in range(25)]
    out = []
    for f in range(families):
        base = [word() for _ in range(rng.randint(1, 60))]
        for _ in range(rng.randint(1, members)):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = word()
            if rng.random() < 0.3:
                base = text
            if f % 3 == 0:
                text = text[:8] + passage + text[8:]
            out.append(" ".join(text))
    return out


def test_tries_give_the_components_of_all_links():
    rng = random.Random(1)
    for _ in range(60):
        base = [rng.getrandbits(63) for _ in range(60)]
        sets = set()
        for _ in range(rng.randint(2, 60)):
            s = set(base[rng.randint(0, 10) :][: rng.randint(1, 50)])
            for _ in range(rng.randint(0, 6)):
                s ^= {rng.choice(base + [rng.getrandbits(63)])}
            if s:
                sets.add(frozenset(s))
        sets = list(sets)
        counts = np.resize(np.array([rng.randint(0, 5) for _ in range(1000)]), J.BUCKETS)
        arrays = [np.array(sorted(s), dtype=np.uint64) for s in sets]
        links = plain_links(sets)
        got = J.connecting_links(arrays, np.arange(len(sets)), counts)
        assert {(max(x), min(x)) for x in got} <= set(links)
        assert component(len(sets), got) == component(len(sets), links)
        half = len(sets) // 2
        if half:
            got = J.connecting_links(arrays[:half], np.arange(half), counts, arrays[half:], np.arange(half, len(sets)))
            across = [(i, j) for i, j in links if (i < half) != (j < half)]
            assert component(len(sets), [(p + half, m) for p, m in got]) == component(len(sets), across)


def test_sketches_allow_every_link():
    rng = random.Random(4)
    pruned = 0
    for _ in range(200):
        n = rng.choice([1, 3, 8, 40, 200])
        sets = [{rng.getrandbits(64) for _ in range(n)} for _ in range(3)]
        for x in sets[:]:
            y = set(x)
            for _ in range(rng.randint(0, n // 4 + 1)):
                y ^= {rng.choice([rng.getrandbits(64), *x])}
            sets.append(y)
        sets = [np.array(sorted(x), dtype=np.uint64) for x in sets if x]
        got = J.may_link(np.array([len(x) for x in sets]), [J.sketch(x) for x in sets])
        allowed = component(len(sets), got)
        assert all(allowed[i] == allowed[j] for i, j in plain_links([set(x.tolist()) for x in sets]))
        pruned += n == 200 and len(set(allowed)) >= 3
    assert pruned > 10


def test_counts_are_packed_and_graded():
    part = np.array([0, 1, 2, 255, 256, 10**12])
    assert J.unpacked_counts(J.packed_counts(part)).tolist() == part.tolist()
    assert J.rarity(part).tolist() == [0, 16, 25, 128, 128, 255]


def test_counts_of_a_task_are_small():
    part = np.random.default_rng(1).poisson(0.23, J.BUCKETS // J.PIECES).astype(np.int32)  # about those of 16 MB of texts
    assert len(J.packed_counts(part)) < 10_000
    assert J.unpacked_counts(J.packed_counts(part)).tolist() == part.tolist()
    assert J.unpacked_counts(J.packed_counts(0 * part)).tolist() == [0] * len(part)


def test_rarest_shingles_of_linked_sets_meet():
    rng = random.Random(2)
    counts = np.resize(np.array([rng.randint(0, 9) for _ in range(997)]), J.BUCKETS)
    for n in (1, 2, 4, 5, 9, 10, 37, 100):
        x = {rng.getrandbits(63) for _ in range(n)}
        y = set(x)
        while len(y) and 100 * len(x & y) >= 80 * len(x | y):
            a, b = (np.array(sorted(s), dtype=np.uint64) for s in (x, y))
            assert set(J.rarest(a, counts).tolist()) & set(J.rarest(b, counts).tolist())
            y = set(y) - {next(iter(x & y))} if rng.random() < 0.5 else y | {rng.getrandbits(63)}


def test_parts_of_postings_keep_linked_sets_together(spark):
    rng = random.Random(6)
    counts = np.zeros(J.BUCKETS, dtype=np.uint8)
    sets = []
    for n in [3, 9, 10, 30, 60] * 4:
        base = {rng.getrandbits(63) for _ in range(n)}
        sets += [base, *({rng.getrandbits(63) for _ in range(k % (n // 5 + 2))} ^ set(list(base)[k % 7 :]) for k in range(1, 9))]
    arrays = [np.array(sorted(x), dtype=np.uint64) for x in sets if x]
    far = np.arange(1, 201, dtype=np.uint64)  # they share one shingle, the last of their rarest
    prefix = [(i, len(x), J.rarest(x, counts).view(np.int64).tolist()) for i, x in enumerate([*arrays, far])]
    prefix.append((len(prefix), 200, [*range(-40, 0), 41]))
    assert prefix[-2][2][40] == 41
    frame = spark.createDataFrame(prefix, "lo long, n long, prefix array<long>")
    held = {}
    for r in J.shared_postings(frame).collect():
        held.setdefault(r.lo, set()).add((r.token, r.part))
    for i, j in plain_links([set(x.tolist()) for x in arrays]):
        assert arrays[i].tolist() == arrays[j].tolist() or held[i] & held[j]
    assert not held.get(len(prefix) - 1)


def test_blocks_lists_and_neighbourhoods_agree(spark, monkeypatch):
    documents = list(enumerate(families(random.Random(3))))
    want = plain_result(documents)
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    columns = ("doc_id", "n_shingles", "component_id")
    assert rows(J.similarity_components(frame), *columns) == want
    monkeypatch.setattr(J, "SKETCHED", 4)  # large lists connect all their classes
    monkeypatch.setattr(J, "BLOCK", 3)  # nearly every group in several blocks
    assert rows(J.similarity_components(frame), *columns) == want
    assert rows(J.similarity_components(frame, most=2), *columns) == want  # single lists


def test_postings_are_shuffled_once_beyond_broadcasts(spark, monkeypatch):
    documents = list(enumerate(families(random.Random(5))))
    plans = []

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return common.staged(df, name)

    monkeypatch.setattr(J, "staged", watched)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = rows(J.similarity_components(spark.createDataFrame(documents, "doc_id long, text string")), "doc_id", "n_shingles", "component_id")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert got == plain_result(documents)
    postings = [p for p in plans if "explode(prefix" in p]
    assert postings and sum(p.count("Exchange hashpartitioning") for p in postings) == 1


def test_query(spark):
    documents = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op11_jaccard_join"](spark, SF_SMALL)
    assert rows(got, "doc_id", "n_shingles", "component_id") == plain_result(documents)


def test_odd_rows(spark):
    want = plain_result([(r[0], r[1]) for r in ROWS])
    got = J.similarity_components(with_clashes(odd_docs(spark)))
    assert rows(got, "doc_id", "n_shingles", "component_id") == want
    assert rows(J.similarity_components(empty_docs(spark))) == []
