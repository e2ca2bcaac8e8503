"""Source divergence (13) against its SQL and a plain computation."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from odd import ROWS, empty_docs, odd_docs, rows, with_clashes

from conftest import SF_SMALL
from oracle_compare import compare
from tillmart.llm import divergence
from tillmart.llm.queries import ORACLE, QUERIES

COLUMNS = ("lang", "source", "part", "item", "value", "rank")
MANY = [(i, "alpha beta " * (i % 4) + "Gamma Ünï " * (i % 3), "en", f"s{i % 5}", 0) for i in range(40)] + [
    (i, "alpha only", "de", "s1", 0) for i in range(4)
] + [(90, "rare", "fr", "s1", 0), (91, None, "fr", "s2", 0)]


def plain(documents):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, _ in documents:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        counts[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= 3]
        groups = {s: {t: c[t] for t in kept} for (x, s), c in counts.items() if x == lang}
        groups[None] = {t: sum(g[t] for g in groups.values()) for t in kept}
        share = {s: {t: 1 + 10**9 * (n + 1) // (sum(g.values()) + len(kept)) for t, n in g.items()} for s, g in groups.items()}
        f = lambda p, q: (p - q) ** 2 // q
        for s in groups:
            if s is None:
                continue
            pairs = [(x, sum(f(share[s][t], share[x][t]) for t in kept)) for x in groups if x not in (s, None)]
            above = [(t, f(share[s][t], share[None][t])) for t in kept if groups[s][t] and share[s][t] > share[None][t]]
            for part, items in (("pair", pairs), ("term", above)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, x, v, k + 1) for k, (x, v) in enumerate(ranked) if part == "pair" or k < 200]
    return sorted(out, key=repr)


@pytest.mark.parametrize("documents", [ROWS, MANY, ROWS * 3 + MANY])
def test_plain_computation(spark, documents, monkeypatch):
    frame = with_clashes(spark.createDataFrame(documents, odd_docs(spark).schema))
    assert rows(divergence.divergence(frame), *COLUMNS) == plain(documents)
    monkeypatch.setattr(divergence, "STEP", 2)  # walks in many small steps
    monkeypatch.setattr(divergence, "HELD", 3)
    assert rows(divergence.divergence(frame), *COLUMNS) == plain(documents)


def test_empty(spark):
    assert rows(divergence.divergence(empty_docs(spark))) == []


def test_shares_of_large_counts():
    count, total = np.array([0, 5, 10**14]), np.array([9 * 10**14, 7, 3 * 10**14])
    want = [1 + 10**9 * (int(c) + 1) // int(t) for c, t in zip(count, total)]
    assert divergence.shares(count, total).tolist() == want


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    got = compare(QUERIES["op13_source_divergence"](spark, SF_SMALL), con, ORACLE["op13_source_divergence"])
    assert got["ok"] and got["rows"][0] > 1000, got
