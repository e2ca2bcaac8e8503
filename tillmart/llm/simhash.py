"""Operator 8: near-duplicates by SimHash and covering locality-sensitive hashing.

Fingerprint: the ASCII letters of a text are lower-cased, its words
(``[^\\x20\\x09-\\x0D]+``) make shingles of ``shingle`` words, repeats included
(fewer words: the whole sequence; none: fingerprint zero); bit b is 1 if it is
set in over half of the shingles' XXH64 (UTF-8, seed 42).

Links: fingerprints with at most ``RADIUS`` = r differing bits.  Every bit
position p has a nonzero code c(p) of r + 1 bits; for every nonzero v of r + 1
bits there is a table that keeps the positions whose <c(p), v> is odd.  The at
most r codes of two fingerprints' differing bits lie in a proper subspace, so
some v is orthogonal to all of them and its table keeps none of the differing
bits: each linked pair meets in at least one of the 2^(r+1) - 1 tables.

A bucket (table, kept bits) of up to ``BUCKET`` distinct fingerprints goes to
one small task step.  A larger one is split by the same construction over the
bits its table leaves free; what then agrees on both masks differs in the few
bits that are free in both, so its size has a bound by itself (2^free) and its
neighbours are found by flipping up to r of them.  A bucket returns a spanning
forest of its links, never its pairs.  Equal fingerprints are one node.

Component: alternating large-star and small-star steps over the forests' edges
until nothing changes, each step checkpointed to the shared folder.

Nulls count as empty texts (fingerprint zero, linked to one another).  A row
with a null doc_id takes part like any other; the component id is the smallest
doc_id that is not null (null if there is none).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


from tillmart.llm.common import packed, small, staged, texts

SHINGLE = 3
RADIUS = 3
SEED = 42
BITS = 64
# Distinct fingerprints of a bucket that are compared with one another directly.
BUCKET = 256
# Shingles turned into bits at once.
BLOCK = 100_000


# --- fingerprints -----------------------------------------------------------------


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    words = text.encode().lower().split()  # bytes: ASCII case and the six ASCII blanks only
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) > shingle else [b" ".join(words)]
    n = max(len(words) - shingle + 1, 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype="<u8", count=n)
    ones = np.zeros(BITS, dtype=np.int64)
    for a in range(0, n, BLOCK):
        part = hashes[a : a + BLOCK].view(np.uint8).reshape(-1, BITS // 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, text: Column, name: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the signed 64-bit fingerprint of ``text`` (null: empty)."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(np.array([fingerprint(t or "", shingle) for t in s], dtype=np.uint64).view(np.int64))

    return docs.withColumn(name, of(text))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- covering masks ----------------------------------------------------------------


def covering_masks(positions: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over ``positions`` such that any ``radius`` of them are all left
    out by some mask: one mask per nonzero v, positions coded 1, 2, ... in turn."""
    codes = 2 ** (radius + 1) - 1
    return [
        sum(1 << p for i, p in enumerate(positions) if ((i % codes + 1) & v).bit_count() % 2)
        for v in range(1, codes + 1)
    ]


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def bits_of(mask: int) -> list[int]:
    return [p for p in range(BITS) if mask >> p & 1]


def free_of(mask: int) -> list[int]:
    return [p for p in range(BITS) if not mask >> p & 1]


# --- links within a bucket -----------------------------------------------------------


def forest(fps: np.ndarray, free: list[int] | None = None, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A star forest (node, root) with the components of the links among
    distinct fingerprints.  ``free``: the only bits in which they differ, given
    for large buckets, whose links are found by flipping bits."""
    fps = np.sort(fps.astype(np.uint64))
    label = np.arange(len(fps))
    if free is None:
        near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
        left, right = np.nonzero(np.triu(near, 1))
    else:
        pairs = []
        for k in range(1, radius + 1):
            for flips in combinations(free, k):
                other = fps ^ np.uint64(sum(1 << p for p in flips))
                at = np.minimum(np.searchsorted(fps, other), len(fps) - 1)
                hit = np.nonzero((fps[at] == other) & (at > np.arange(len(fps))))[0]
                pairs.append((hit, at[hit]))
        left, right = (np.concatenate(x) for x in zip(*pairs))
    while True:  # smallest label of the neighbours, then of the label's label
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    child = label != np.arange(len(fps))
    return fps[child].view(np.int64), fps[label[child]].view(np.int64)


EDGES = "a long, b long"  # a > b


def _forests(buckets: DataFrame, free_by_table: dict | None = None) -> DataFrame:
    """Edges of the forests of the buckets (``fps`` array, table keys)."""

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                free = free_by_table[row.t, row.u] if free_by_table else None
                fps = np.array(row.fps, dtype=np.int64).view(np.uint64)
                out.append(forest(fps, free if len(fps) > BUCKET else None))
            x, y = (np.concatenate(z) for z in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            yield pd.DataFrame({"a": np.maximum(x, y), "b": np.minimum(x, y)})

    return buckets.mapInPandas(link, EDGES)


def _keyed(fps: DataFrame, masks: list[int], table: str, key: str) -> DataFrame:
    keys = F.array(*(F.struct(F.lit(t).alias(table), F.col("fp").bitwiseAND(F.lit(signed(m))).alias(key)) for t, m in enumerate(masks)))
    return fps.select("*", F.inline(keys))


def edges(fps: DataFrame) -> DataFrame:
    """Edges (a, b) whose components are those of the links of ``fps`` (fp, distinct)."""
    masks = covering_masks(list(range(BITS)))
    rows = _keyed(fps, masks, "t", "key")
    sizes = staged(rows.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-buckets")
    small = sizes.where(F.col("n") <= BUCKET)
    buckets = rows.join(small.select("t", "key"), ["t", "key"]).groupBy("t", "key").agg(F.collect_list("fp").alias("fps"))
    out = _forests(buckets.select("fps"))
    if sizes.where(F.col("n") > BUCKET).limit(1).count():
        large = rows.join(sizes.where(F.col("n") > BUCKET).select("t", "key"), ["t", "key"])
        second = {t: covering_masks(free_of(m)) for t, m in enumerate(masks)}
        deeper = F.lit(None)
        for t, subs in second.items():
            keys = F.array(*(F.struct(F.lit(u).alias("u"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key2")) for u, m in enumerate(subs)))
            deeper = F.when(F.col("t") == t, keys) if t == 0 else deeper.when(F.col("t") == t, keys)
        split = large.select("t", "key", "fp", F.inline(deeper))
        nested = split.groupBy("t", "key", "u", "key2").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
        free = {(t, u): [p for p in free_of(masks[t]) if not m >> p & 1] for t, subs in second.items() for u, m in enumerate(subs)}
        out = out.unionByName(_forests(nested.select("t", "u", "fps"), free))
    return out.distinct()


# --- components ---------------------------------------------------------------------


def _distinct_edges(df: DataFrame) -> DataFrame:
    return df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edge: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; the root is the component's
    smallest node.  Large-star and small-star steps in turn: each node hands
    its neighbours on to its smallest neighbour, so no step gathers a group."""

    def settled(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = _distinct_edges(edge).checkpoint()
    state = settled(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = _distinct_edges(large).checkpoint()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = _distinct_edges(small.unionByName(least.select("a", F.col("m").alias("b")))).checkpoint()
        before, state = state, settled(now)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def fingerprint_components(fps: DataFrame) -> DataFrame:
    """(fp, component_id) of every distinct fingerprint of ``fps`` (doc_id, fp)."""
    nodes = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    linked = staged(components(edges(nodes.select("fp"))), "simhash-components")
    grouped = nodes.join(linked, nodes.fp == linked.node)
    first = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    member = grouped.select("fp", "root").join(first, "root").select("fp", "component_id")
    return nodes.join(member, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``."""
    own = texts(docs)
    fps = staged(with_fingerprint(own, F.col("text"), shingle=shingle).select("doc_id", "fp"), "simhash-fingerprints")
    comp = staged(fingerprint_components(fps), "simhash-component-ids")
    return fps.join(comp, "fp").select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs``, all columns, that stay when of every component one
    row stays: the one with the smallest doc_id (null last), among several with
    that id the one whose row hash is smallest, of equal rows one.

    The texts themselves are not shuffled while the rows to go are few enough
    to be broadcast; beyond that their keys meet the rows by a shuffle join."""
    docs = packed(docs).select("doc", "doc.doc_id", F.xxhash64("doc").alias("row"))
    keyed = with_fingerprint(docs, F.col("doc.text"), shingle=shingle)
    keyed = staged(keyed.groupBy("fp", "doc_id", "row").agg(F.count("*").alias("copies")), "simhash-stage-rows")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "copies")
    nodes = staged(keyed.groupBy("fp").agg(F.min(order).alias("first")), "simhash-stage-nodes")
    linked = staged(components(edges(nodes.select("fp"))), "simhash-stage-components")
    member = nodes.join(linked, nodes.fp == linked.node, "left").select(F.coalesce("root", "fp").alias("root"), "first")
    stay = staged(member.groupBy("root").agg(F.min("first").alias("first")).select("first.*"), "simhash-stage-stay")
    key = lambda df: df.select(F.col("doc_id").alias("id"), F.col("row").alias("key"))
    same = lambda left: left["doc_id"].eqNullSafe(F.col("id")) & (left["row"] == F.col("key"))
    single, several = key(stay.where("copies = 1")), key(stay.where("copies > 1"))
    go = staged(key(keyed.join(single, same(keyed), "left_anti")), "simhash-stage-go")
    kept = docs.join(small(go), same(docs), "left_anti")
    if several.limit(1).count():  # rows that stay and occur more than once
        again = docs.join(small(several), same(docs), "left_semi")
        kept = kept.unionByName(again.dropDuplicates(["doc_id", "row"]))
    return kept.select("doc.*")
