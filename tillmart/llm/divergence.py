"""Operator 13: divergence of sources by row accumulation (Gustavson).

Every (lang, source) group has a row of term counts.  How far a group lies
from each other source of its language is a sum over all kept terms, those
without an occurrence included, of f(p, q) = (p - q)^2 / q in whole numbers,
where p and q are the smoothed shares (see ``shares``) of the term in the two.

Kept terms are spread over blocks by a hash.  A block holds its terms' postings
term by term (the term-major index).  For each group the block walks the
group's own terms, follows each one's postings and scatters into one dense
vector with a place for every peer: no pair of postings is ever a row.  A term
that one or both of the groups lack has a share that depends on the group alone,
its zero baseline.  So the sum is, over the block's V terms,

    V f(p0, q0) + sum over the group's terms of f(p, q0) - f(p0, q0)
                + sum over the peer's terms of f(p0, q) - f(p0, q0)
                + sum over common terms of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)

and only the last line needs the walk; the two before it are taken over the
distinct counts.  Blocks' sums are added by Spark.  All whole numbers, exact:
sums are taken modulo 2^64, each true sum being below 2^63.

Memory of a task: one block of about ``BLOCK_ROWS`` postings, ``STEP`` steps of
a walk, and vectors as long as its language has sources.  A hot source or
language is spread over all blocks.  Counting: each task sums (lang, source,
term) before it writes, at most ``HELD`` at a time.

Null text, lang and source are read as ''.  Repeated rows are documents of
their own.  A language without kept terms has value 0 for all its pairs; a
source alone in its language has no pairs.  An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmart.llm.common import staged

TERM = re.compile(rb"[a-z\x80-\xff]+")  # of lower-cased UTF-8: letters A-Z and all beyond ASCII
UNIT = 1_000_000_000
LEAST_DOCS = 3
RANKS = 200
# Postings of a block, about, and blocks of a language at least.
BLOCK_ROWS = 250_000
LEAST_BLOCKS = 16
# Steps of a walk taken at once; (lang, source, term) sums a counting task holds.
STEP = 1_000_000
HELD = 300_000


def term_sums(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, d): occurrences and documents of each term, summed
    by task; a row with term '' and zeros for every group."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        groups: dict = {}

        def taken() -> pd.DataFrame:
            out = []
            for (lang, source), (n, d) in groups.items():
                out.append((lang, source, "", 0, 0))
                out += [(lang, source, t.decode(), k, d[t]) for t, k in n.items()]
            groups.clear()
            return pd.DataFrame(out, columns=["lang", "source", "term", "n", "d"])

        held = 0
        for pdf in batches:
            for lang, source, text in zip(pdf["lang"], pdf["source"], pdf["text"]):
                n, d = groups.setdefault((lang, source), (Counter(), Counter()))
                words = TERM.findall(text.encode().lower())
                held -= len(n)
                n.update(words)
                d.update(set(words))
                held += len(n)
                if held > HELD:
                    yield taken()
                    held = 0
        yield taken()

    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    own = docs.select(blank("lang"), blank("source"), blank("text"))
    return own.mapInPandas(count, "lang string, source string, term string, n long, d long")


def shares(count: np.ndarray, total) -> np.ndarray:
    """1 + floor(10^9 (count + 1) / total), by long division in steps of 1,000
    so that nothing overflows below a total of 9 * 10^15."""
    total = np.asarray(total, dtype=np.int64)
    left, out = np.asarray(count, dtype=np.int64) + 1, 0
    for _ in range(3):
        digit, left = np.divmod(left * 1000, total)
        out = out * 1000 + digit
    return out + 1


def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


class Block:
    """The postings of some terms of a language, by term and by group."""

    def __init__(self, group: np.ndarray, term: np.ndarray, n: np.ndarray, totals: np.ndarray, terms: int, kept: int):
        """``totals``: occurrences of kept terms by group; ``terms``: terms here;
        ``kept``: kept terms of the language."""
        order = np.lexsort((group, term))
        self.group, self.term, n = group[order], term[order], n[order]
        self.totals, self.kept, self.terms, self.groups = totals, kept, terms, len(totals)
        self.p = shares(n, totals[self.group] + kept)
        self.p0 = shares(np.zeros(self.groups, np.int64), totals + kept)
        self.end = np.searchsorted(self.term, np.arange(terms), side="right")
        self.start = np.searchsorted(self.term, np.arange(terms), side="left")
        self.q = shares(self.term_totals(n), totals.sum() + kept)
        by_group = np.argsort(self.group, kind="stable")
        cut = np.searchsorted(self.group[by_group], np.arange(self.groups + 1))
        self.rows = [by_group[cut[g] : cut[g + 1]] for g in range(self.groups)]
        # distinct shares of each group with how many terms have them
        pairs, self.times = np.unique(np.stack([self.group, self.p]), axis=1, return_counts=True)
        self.peer, self.peer_p = pairs

    def term_totals(self, n: np.ndarray) -> np.ndarray:
        out = np.zeros(self.terms, dtype=np.int64)
        np.add.at(out, self.term, n)
        return out

    def values(self, g: int) -> np.ndarray:
        """The block's part of the sums of group ``g`` against every group."""
        own, p0 = self.rows[g], self.p0[g]
        base = f(p0, self.p0)
        acc = base * self.terms
        p, times = np.unique(self.p[own], return_counts=True)
        for a in range(0, len(p), max(1, STEP // self.groups)):
            part = slice(a, a + max(1, STEP // self.groups))
            acc += ((f(p[part, None], self.p0[None, :]) - base) * times[part, None]).sum(axis=0)
        np.add.at(acc, self.peer, (f(p0, self.peer_p) - base[self.peer]) * self.times)
        sizes = (self.end - self.start)[self.term[own]]
        steps = np.cumsum(sizes)
        a = 0
        while a < len(own):  # the walk: own terms, then each one's postings
            b = max(a + 1, int(np.searchsorted(steps, (steps[a - 1] if a else 0) + STEP, side="right")))
            mine, k = own[a:b], sizes[a:b]
            at = np.repeat(self.start[self.term[mine]] - np.concatenate([[0], np.cumsum(k)[:-1]]), k) + np.arange(k.sum())
            peer, q, p = self.group[at], self.p[at], np.repeat(self.p[mine], k)
            np.add.at(acc, peer, f(p, q) - f(p, self.p0[peer]) - f(p0, q) + base[peer])
            a = b
        return acc

    def outstanding(self, g: int, names: np.ndarray, ranks: int) -> tuple[list[str], list[int]]:
        """The ``ranks`` first terms of the block in which group ``g`` is above its language."""
        own = self.rows[g]
        p, q = self.p[own], self.q[self.term[own]]
        above = p > q
        value, name = f(p, q)[above], names[self.term[own]][above]
        if len(value) > ranks:  # all as high as the last one that may count
            first = value >= np.partition(value, -ranks)[-ranks]
            value, name = value[first], name[first]
        order = sorted(range(len(value)), key=lambda i: (-int(value[i]), name[i].encode()))[:ranks]
        return [name[i] for i in order], [int(value[i]) for i in order]


PARTS = "lang string, source string, part string, item string, value long"


def block_parts(key: tuple, postings: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """One block: its part of every pair's sum and its terms above the language."""
    lang = key[0]
    if not len(groups):
        return pd.DataFrame({c.split()[0]: [] for c in PARTS.split(", ")})
    groups = groups.sort_values("source")
    sources = groups["source"].to_numpy(dtype=object)
    totals, kept = groups["total"].to_numpy(dtype=np.int64), int(groups["kept"].iloc[0])
    peers = len(sources)
    if kept:
        place = {s: i for i, s in enumerate(sources)}
        term, names = pd.factorize(postings["term"])
        group = postings["source"].map(place).to_numpy(dtype=np.int64)
        block = Block(group, term.astype(np.int64), postings["n"].to_numpy(dtype=np.int64), totals, len(names), kept)
    out = []
    for g, source in enumerate(sources):
        values = block.values(g) if kept else np.zeros(peers, np.int64)
        others = np.arange(peers) != g
        out.append(pd.DataFrame({"source": source, "part": "pair", "item": sources[others], "value": values[others]}))
        if kept:
            items, value = block.outstanding(g, names.to_numpy(dtype=object), RANKS)
            out.append(pd.DataFrame({"source": source, "part": "term", "item": items, "value": np.array(value, dtype=np.int64)}))
    found = pd.concat(out)
    found.insert(0, "lang", lang)
    return found


def divergence(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank): every other source of the
    language, and up to ``RANKS`` terms above the language, of every group."""
    parts = staged(term_sums(docs), "divergence-sums")
    sums = staged(parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d")), "divergence-counts")
    kept = sums.where("term <> ''").groupBy("lang", "term").agg(F.sum("d").alias("docs")).where(F.col("docs") >= LEAST_DOCS)
    kept = staged(kept.select("lang", "term"), "divergence-kept")
    postings = staged(sums.join(kept, ["lang", "term"]).select("lang", "source", "term", "n"), "divergence-postings")
    blocks = max(LEAST_BLOCKS, -(-postings.count() // BLOCK_ROWS))
    totals = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    vocabulary = kept.groupBy("lang").agg(F.count("*").alias("kept"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    groups = sums.where("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").join(vocabulary, "lang", "left")
    groups = staged(groups.select("lang", "source", zero("total"), zero("kept")), "divergence-groups")
    spread = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dealt = postings.withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int"))
    found = dealt.groupBy("lang", "block").cogroup(spread.groupBy("lang", "block")).applyInPandas(block_parts, PARTS)
    found = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= RANKS))


def oracle(documents: str = "documents") -> str:
    """DuckDB SQL for the same rows, by the plain definition (every term of the
    language for every group)."""
    letters = "".join(chr(c) for c in range(65, 91))
    unit = f"{UNIT}::HUGEINT"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{letters}', '{letters.lower()}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM {documents}
), words AS (SELECT row, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY 1, 2 HAVING count(DISTINCT row) >= {LEAST_DOCS}),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
vocabulary AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
grid AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, v.v
  FROM groups g JOIN kept k USING (lang) JOIN vocabulary v USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS (
  SELECT lang, source, term, n, 1 + {unit} * (n + 1) // (sum(n) OVER (PARTITION BY lang, source) + v)::HUGEINT AS p FROM grid
), whole AS (
  SELECT lang, term, 1 + {unit} * (n + 1) // (sum(n) OVER (PARTITION BY lang) + v)::HUGEINT AS q
  FROM (SELECT lang, term, v, sum(n)::HUGEINT AS n FROM grid GROUP BY ALL)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM found
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= {RANKS}
"""
