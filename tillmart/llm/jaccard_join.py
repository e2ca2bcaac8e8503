"""Operator 11: similarity join of n-gram sets by prefix trees.

A document's set holds its distinct shingles of five words (ASCII letters
lower-cased; fewer words: the whole sequence).  Two documents link when their
intersection has at least 80 % of their union.  The result is each document's
component under these links.

Documents with equal sets are one class and count once from the start.
Shingles have one global order: by how many documents hold them (counted over
all documents in ``BUCKETS`` hashed places, whose grades of a byte each are
broadcast), then by hash.  Any order gives the same links.

1. Meeting: two linked sets share one of the n - ceil(0.8 n) + 1 rarest
   shingles of each.  The classes that share such a shingle are a list; a
   shingle that only one class has among its rarest makes none.  A list is cut
   where sizes and places of the shingle rule out any link across.  Lists with
   the same members are one list.  Linked classes therefore meet in some list, and
   the classes that lists connect form a *neighbourhood*, whose sets are
   compared as one group.  A neighbourhood of more than ``MOST`` classes is
   left to its single lists, each a group of its own.
2. Prefix trees: a block of a group stores its sets in a trie, the most
   frequent shingles first, so that similar sets share their beginnings.  A
   probe goes down level by level; the overlap with what sets share is counted
   once; a subtree is pruned when its overlap so far and the shorter of the
   remaining lengths cannot reach what the smallest set in it would need, when
   all its sizes are out of range, or when all its sets are already connected
   to the probe.  A leaf has the exact overlap.
3. Large groups are split into blocks (about ``BLOCK`` sets, at most ``GRID``
   blocks unless ``LARGEST`` sets are reached), a few pivots being in each of
   them.  Then the components so far are taken, and every set outside its
   group's largest component is probed against all blocks.  Pairs inside one
   component need no link, so no link between different texts is lost, and no
   step holds more than two blocks or emits a group's pairs, only the links
   that connect.

Shingles and sets are compared by 64- and 128-bit hashes.  Null and empty texts
have empty sets (n_shingles 0) and are linked with nothing.  Repeated rows are
documents of their own, linked as equal sets.  A null doc_id takes part; the
component id is the smallest doc_id that is not null (null if there is none).
An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmart.llm.common import small, staged, texts
from tillmart.llm.perfect_hash import mixed
from tillmart.llm.simhash import components

WORDS = 5
# Linked: 100 * intersection >= PERCENT * union.
PERCENT = 80
# Hashed places of the document counts that order the shingles, in pieces for
# their sum; tasks whose counts are added in one step.
BUCKETS = 1 << 24
PIECES = 256
LANES = 64
# Sets of a block to begin with, blocks of a group until blocks have LARGEST sets, pivots of a group.
BLOCK = 64
GRID = 32
LARGEST = 2048
PIVOTS = 4
# Classes of a neighbourhood that is compared as one group.
MOST = 20_000
# Classes of a list whose sketches are compared with one another, and rows of lists compared in one step.
SKETCHED = 256
SKETCH_ROWS = 10_000


def prefix_length(n: np.ndarray | int):
    return n - -(-PERCENT * n // 100) + 1


def needed(n: int, m: np.ndarray) -> np.ndarray:
    """The least intersection with which sets of n and m shingles are linked."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


# --- sets ---------------------------------------------------------------------------


def shingles(text: str) -> np.ndarray:
    """Hashes of the distinct shingles of a text, sorted."""
    words = text.encode().lower().split()  # bytes: ASCII case and the six ASCII blanks only
    if not words:
        return np.zeros(0, np.uint64)
    code = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(WORDS, len(words))
    n = len(words) - width + 1
    total = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        total = mixed(total ^ code[k : k + n], k)
    return np.unique(total)


def signature(own: np.ndarray) -> tuple[int, int]:
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), dtype="<i8").tolist())


def place(own: np.ndarray) -> np.ndarray:
    return (own >> np.uint64(20)).astype(np.int64) % BUCKETS


def rarest(own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The part of a set that meets another linked set's such part."""
    return own[np.lexsort((own, counts[place(own)]))[: prefix_length(len(own))]]


def sketch(own: np.ndarray) -> bytes:
    """Numbers of shingles in 2^k cells, about n / 4; a cell of the 2^(k-1) cells
    is two neighbouring ones."""
    bits = max(0, (len(own) - 1).bit_length() - 2)
    cells = (own >> np.uint64(63 - bits) >> np.uint64(1)).astype(np.int64)
    return np.minimum(np.bincount(cells, minlength=1 << bits), 65_535).astype("<u2").tobytes()


def may_link(sizes: np.ndarray, sketches: list[bytes]) -> list[tuple[int, int]]:
    """Pairs (i, j) that connect all sets whose sketches allow a link (a cell with
    65,535 shingles or more allows any)."""
    cells = [np.frombuffer(x, dtype="<u2").astype(np.int64) for x in sketches]
    label = np.arange(len(sizes))
    out = []
    order = np.argsort(sizes, kind="stable")
    full = np.array([(c == 65_535).any() for c in cells])
    for at, i in enumerate(order):  # the larger ones that are near enough in size
        rest = order[at + 1 :]
        rest = rest[(sizes[rest] * PERCENT <= 100 * sizes[i]) & (label[rest] != label[i])]
        own = cells[i]
        for k in {len(cells[j]) for j in rest}:
            some = np.array([j for j in rest if len(cells[j]) == k])
            grid = np.stack([cells[j] for j in some]).reshape(len(some), len(own), -1).sum(axis=2)
            bound = np.minimum(grid, own[None, :]).sum(axis=1)
            for j in some[(bound >= needed(sizes[i], sizes[some])) | full[some] | full[i]]:
                if label[j] != label[i]:
                    out.append((int(i), int(j)))
                    label[label == label[j]] = label[i]
    return out


def classified(docs: DataFrame) -> DataFrame:
    """For every row (doc_id, n, hi, lo), the size and signature of its set; and
    for every task up to ``PIECES`` rows (piece, task, counts) with documents by place."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(BUCKETS, dtype=np.int32)
        for pdf in batches:
            out = []
            for text in pdf["text"]:
                own = shingles(text)
                np.add.at(counts, place(own), 1)
                out.append((len(own), *signature(own)))
            made = pd.DataFrame(out, columns=["n", "hi", "lo"], index=pdf.index)
            made.insert(0, "doc_id", pdf["doc_id"])
            yield made.assign(piece=None, task=None, counts=None)
        task = TaskContext.get().partitionId()
        for i, part in enumerate(counts.reshape(PIECES, -1)):
            if part.any():
                yield pd.DataFrame({"doc_id": None, "n": None, "hi": None, "lo": None, "piece": i, "task": task, "counts": [packed_counts(part)]})

    return docs.mapInPandas(run, f"doc_id {id_type}, n long, hi long, lo long, piece int, task int, counts binary")


def packed_counts(part: np.ndarray) -> bytes:
    """The counts bit by bit: of a task's counts, mostly 0 and 1, few bits are set."""
    bits = int(part.max(initial=0)).bit_length()
    planes = [np.packbits(part >> k & 1).tobytes() for k in range(bits)]
    return len(part).to_bytes(4, "little") + zlib.compress(b"".join(planes), 1)


def unpacked_counts(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    planes = np.frombuffer(zlib.decompress(data[4:]), dtype=np.uint8).reshape(-1, -(-n // 8))
    total = np.zeros(n, dtype=np.int64)
    for k, plane in enumerate(planes):
        total |= np.unpackbits(plane, count=n).astype(np.int64) << k
    return total


def rarity(counts: np.ndarray) -> np.ndarray:
    """Sixteen grades for every doubling of a count, in a byte."""
    return np.minimum(16 * np.log2(1 + counts), 255).astype(np.uint8)


def summed(pieces: DataFrame) -> np.ndarray:
    """The grades of the documents by place, ``BUCKETS`` bytes: counts added over
    all tasks as a tree, graded where the last sum is made."""

    def adder(last: bool):
        def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            total = np.zeros(BUCKETS // PIECES, dtype=np.int64)
            for c in pdf["counts"]:
                total += unpacked_counts(c)
            data = rarity(total).tobytes() if last else packed_counts(total)
            return pd.DataFrame({"piece": [key[0]], "task": [key[1]], "counts": [data]})

        return add

    tasks = pieces.agg(F.max("task")).first()[0] or 0
    for lanes in [LANES, 1] if tasks >= LANES else [1]:
        pieces = pieces.withColumn("task", F.col("task") % F.lit(lanes))
        pieces = pieces.groupBy("piece", "task").applyInPandas(adder(lanes == 1), "piece int, task int, counts binary")
    out = np.zeros((PIECES, BUCKETS // PIECES), dtype=np.uint8)
    for row in pieces.select("piece", "counts").collect():
        out[row.piece] = np.frombuffer(row.counts, dtype=np.uint8)
    return out.reshape(-1)


def prefixes(docs: DataFrame, order) -> DataFrame:
    """(hi, lo, n, prefix, sketch) of the sets, each once a task for as long as it is remembered."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, seen = order.value, set()
        for pdf in batches:
            out = []
            for text in pdf["text"]:
                own = shingles(text)
                key = signature(own)
                if len(own) and key not in seen:
                    seen.add(key)
                    out.append((*key, len(own), rarest(own, counts).view(np.int64), sketch(own)))
            if len(seen) > 200_000:
                seen.clear()
            yield pd.DataFrame(out, columns=["hi", "lo", "n", "prefix", "sketch"])

    return docs.select("text").mapInPandas(run, "hi long, lo long, n long, prefix array<long>, sketch binary")


def whole_sets(docs: DataFrame) -> DataFrame:
    """(hi, lo, shingles) of the rows' sets, each once a task for as long as it is remembered."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        for pdf in batches:
            out = []
            for own in map(shingles, pdf["text"]):
                key = signature(own)
                if key not in seen:
                    seen.add(key)
                    out.append((*key, own.view(np.int64)))
            if len(seen) > 200_000:
                seen.clear()
            yield pd.DataFrame(out, columns=["hi", "lo", "shingles"])

    return docs.select("text").mapInPandas(run, "hi long, lo long, shingles array<long>")


# --- prefix trees ---------------------------------------------------------------------


class Trie:
    """Sets of ranks (most frequent shingle first) as a path-compressed trie.
    Trie nodes are numbered level by level; those of one parent are consecutive.
    Members are in the order of a walk, so a subtree's members are a range."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">i8").tobytes())
        ordered = [sets[i] for i in self.order]
        self.n = np.array([len(s) for s in ordered], dtype=np.int64)
        shared = [0]  # ranks a set shares with the one before it
        for a, b in zip(ordered, ordered[1:]):
            k = min(len(a), len(b))
            differ = np.nonzero(a[:k] != b[:k])[0]
            shared.append(int(differ[0]) if len(differ) else k)
        runs, depth, first, last, parent, level = [], [], [], [], [], []
        todo = [(0, len(ordered), 0, -1)] if ordered else []  # members, depth, parent
        at = 0
        while at < len(todo):
            a, b, d, up = todo[at]
            at += 1
            i = a
            while i < b:
                j = i + 1
                while j < b and shared[j] > d:
                    j += 1
                end = min([len(ordered[i]), *shared[i + 1 : j]])
                runs.append(ordered[i][d:end])
                depth.append(end)
                first.append(i)
                last.append(j)
                parent.append(up)
                if j - i > 1:
                    todo.append((i, j, end, len(runs) - 1))
                i = j
        self.ranks = np.concatenate([np.zeros(0, np.int64), *runs])
        self.run_end = np.cumsum([len(r) for r in runs], dtype=np.int64)
        self.run_start = self.run_end - np.array([len(r) for r in runs], dtype=np.int64)
        self.depth, self.first, self.last, self.parent = (np.array(x, dtype=np.int64) for x in (depth, first, last, parent))
        self.least = np.array([self.n[a:b].min() for a, b in zip(first, last)], dtype=np.int64)
        self.most = np.array([self.n[a:b].max() for a, b in zip(first, last)], dtype=np.int64)
        self.top = np.nonzero(self.parent < 0)[0]
        kids = np.argsort(self.parent, kind="stable")
        self.kids = kids[np.searchsorted(self.parent[kids], 0) :]
        at_kids = self.parent[self.kids]
        self.kid_start = np.searchsorted(at_kids, np.arange(len(runs)), side="left")
        self.kid_end = np.searchsorted(at_kids, np.arange(len(runs)), side="right")

    def linked(self, probe: np.ndarray, mask: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Members (in the order of the walk) linked to ``probe``, a sorted set of
        ranks that ``mask`` marks, among those ``wanted``."""
        size = len(probe)
        before = np.concatenate([[0], np.cumsum(wanted)])
        found = []
        nodes, so_far = self.top, np.zeros(len(self.top), dtype=np.int64)
        while len(nodes):
            open_ = before[self.last[nodes]] > before[self.first[nodes]]
            open_ &= (self.most[nodes] * 100 >= PERCENT * size) & (self.least[nodes] * PERCENT <= 100 * size)
            nodes, so_far = nodes[open_], so_far[open_]
            if not len(nodes):
                break
            sizes = self.run_end[nodes] - self.run_start[nodes]
            ends = np.cumsum(sizes)
            at = np.repeat(self.run_start[nodes] - (ends - sizes), sizes) + np.arange(sizes.sum())
            hits = np.concatenate([[0], np.cumsum(mask[self.ranks[at]])])
            so_far = so_far + hits[ends] - hits[ends - sizes]
            deepest = np.where(self.run_end[nodes] > 0, self.ranks[np.maximum(self.run_end[nodes] - 1, 0)], -1)
            left = size - np.searchsorted(probe, deepest, side="right")
            reach = so_far + np.minimum(left, self.most[nodes] - self.depth[nodes])
            alive = reach >= needed(size, self.least[nodes])
            nodes, so_far = nodes[alive], so_far[alive]
            leaf = self.last[nodes] - self.first[nodes] == 1
            member = self.first[nodes[leaf]]
            found.append(member[(so_far[leaf] >= needed(size, self.n[member])) & wanted[member]])
            nodes, so_far = nodes[~leaf], so_far[~leaf]
            # sets that end where a trie node ends have a child of an empty run
            kids = self.kid_end[nodes] - self.kid_start[nodes]
            ends = np.cumsum(kids)
            at = np.repeat(self.kid_start[nodes] - (ends - kids), kids) + np.arange(kids.sum())
            nodes, so_far = self.kids[at], np.repeat(so_far, kids)
        return np.concatenate([np.zeros(0, np.int64), *found])


def connecting_links(members: list[np.ndarray], labels: np.ndarray, counts: np.ndarray, probes: list[np.ndarray] | None = None, probe_labels: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (probe, member) that connect what the labels do not connect yet:
    among the members if there are no probes, else between probes and members."""
    own = probes is None
    every = members if own else members + probes
    universe, at = np.unique(np.concatenate(every), return_inverse=True)
    rank = np.empty(len(universe), dtype=np.int64)
    rank[np.lexsort((universe, -counts[place(universe)].astype(np.int64)))] = np.arange(len(universe))
    cut = np.cumsum([len(s) for s in every])[:-1]
    ranked = [np.sort(r) for r in np.split(rank[at], cut)]
    trie = Trie(ranked[: len(members)])
    label = labels[trie.order].copy()
    todo = [(i, ranked[k], None) for i, k in enumerate(trie.order)] if own else [(i, r, probe_labels[i]) for i, r in enumerate(ranked[len(members) :])]
    probe_label = None if own else probe_labels.copy()
    out, mask = [], np.zeros(len(universe), dtype=bool)
    walk = np.arange(len(members))
    for i, probe, _ in todo:
        mine = label[i] if own else probe_label[i]
        wanted = label != mine
        if own:
            wanted &= walk > i
        if not wanted.any():
            continue
        mask[probe] = True
        for m in trie.linked(probe, mask, wanted).tolist():
            if label[m] != mine:
                out.append((trie.order[i] if own else i, trie.order[m]))
                other = label[m]
                label[label == other] = mine
                if not own:
                    probe_label[probe_label == other] = mine
        mask[probe] = False
    return out


# --- groups ---------------------------------------------------------------------------


EDGES = "a long, b long"


def _edges(pairs: list[tuple[int, int]]) -> pd.DataFrame:
    a = np.array(pairs, dtype=np.int64).reshape(-1, 2)
    return pd.DataFrame({"a": a.max(axis=1), "b": a.min(axis=1)})


def _sets(pdf: pd.DataFrame) -> list[np.ndarray]:
    return [np.asarray(s, dtype=np.int64).view(np.uint64) for s in pdf["shingles"]]


def block_links(rows: DataFrame, order) -> DataFrame:
    """Edges of the connecting links inside each block (g, block) of ``rows``."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("node")
        nodes = pdf["node"].to_numpy()
        links = connecting_links(_sets(pdf), np.arange(len(nodes)), order.value)
        return _edges([(nodes[i], nodes[j]) for i, j in links])

    return rows.groupBy("g", "block").applyInPandas(run, EDGES)


def cross_links(rows: DataFrame, order) -> DataFrame:
    """Edges between the probes and the members of each (g, block, part) of ``rows``."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        members, probes = pdf[~pdf["probe"]], pdf[pdf["probe"]]
        if not len(members) or not len(probes):
            return _edges([])
        m, p = members["node"].to_numpy(), probes["node"].to_numpy()
        links = connecting_links(_sets(members), members["root"].to_numpy(), order.value, _sets(probes), probes["root"].to_numpy())
        return _edges([(p[i], m[j]) for i, j in links])

    return rows.groupBy("g", "block", "part").applyInPandas(run, EDGES)


def blocks_of(k):
    """Blocks of a group of k sets (a column)."""
    size = F.greatest(F.lit(BLOCK), F.least(F.lit(LARGEST), F.ceil(k / F.lit(GRID))))
    return F.ceil(k / size).cast("int")


def _dealt(node, g, blocks):
    return F.pmod(F.xxhash64(node, g), blocks).cast("int")


def with_sets(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """``rows`` with their nodes' sets.  The rows are narrow: few enough, they go
    to the sets, so that each set is shuffled to its blocks only."""
    return sets.join(small(staged(rows, "jaccard-block-rows")), "node")


def linked_edges(groups: DataFrame, sets: DataFrame, order) -> DataFrame:
    """Edges that give the components of all links within the ``groups`` (g,
    node), written; ``sets``: (node, shingles)."""
    sizes = groups.groupBy("g").agg(F.count("*").alias("k")).where("k > 1")
    sized = staged(groups.join(sizes, "g").select("g", "node", blocks_of(F.col("k")).alias("blocks")), "jaccard-groups")
    dealt = sized.select("g", "node", _dealt("node", "g", F.col("blocks")).alias("block"))
    several = sized.where("blocks > 1")
    lowest = several.groupBy("g", "blocks").agg(F.array_sort(F.collect_set(F.when(_dealt("node", F.lit(0), F.col("blocks")) == 0, F.col("node")))).alias("some"))
    pivots = lowest.select("g", F.explode(F.slice("some", 1, PIVOTS)).alias("node"), "blocks")
    pivots = pivots.select("g", "node", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    first = staged(block_links(with_sets(dealt.unionByName(pivots), sets), order), "jaccard-first-edges")
    if not several.limit(1).count():
        return first
    root = staged(components(first), "jaccard-first-components")
    rooted = several.join(root, "node", "left").select("g", "node", "blocks", F.coalesce("root", "node").alias("root"))
    counts = rooted.groupBy("g", "root").agg(F.count("*").alias("n"))
    main = counts.groupBy("g").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("parts"), F.sum("n").alias("k"), F.max("n").alias("n"))
    main = main.where("parts > 1").select("g", "main", blocks_of(F.col("k") - F.col("n")).alias("outside"))
    rooted = staged(rooted.join(main, "g"), "jaccard-rooted")
    member = rooted.select("g", "node", "root", _dealt("node", "g", F.col("blocks")).alias("block"), F.explode(F.sequence(F.lit(0), F.col("outside") - 1)).alias("part"), F.lit(False).alias("probe"))
    probe = rooted.where("root <> main").select(
        "g", "node", "root", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), _dealt("node", "g", F.col("outside")).alias("part"), F.lit(True).alias("probe")
    )
    second = staged(cross_links(with_sets(member.unionByName(probe), sets), order), "jaccard-second-edges")
    return first.unionByName(second)


def shared_postings(prefix: DataFrame) -> DataFrame:
    """(lo, token, part) of the rarest shingles that several classes have.  The
    postings are shuffled once, however many tokens are shared: a token's are
    told apart where they lie together, and the others go no further.

    If a shingle is the first that two linked sets of n and m shingles share, at
    places i and j from 0, then n - i and m - j are at least their intersection,
    so that m <= most(n, i) and n <= most(m, j).  By growing size, a token's
    postings are cut into parts where no earlier one reaches the next size."""
    span = F.shiftleft(F.col("n"), 32).bitwiseOR(F.greatest(F.lit(0), F.floor((F.lit(100) * F.col("n") - F.lit(100 + PERCENT) * F.col("i")) / F.lit(PERCENT))))
    postings = prefix.select("lo", "n", F.posexplode("prefix").alias("i", "token")).select("lo", span.alias("span"), "token")
    several = lambda df, *keys: df.withColumns({k: f("lo").over(Window.partitionBy(*keys)) for k, f in (("a", F.min), ("b", F.max))}).where("a <> b").drop("a", "b")
    sized = several(postings, "token").select("lo", "token", F.shiftright("span", 32).alias("n"), F.col("span").bitwiseAND(F.lit((1 << 32) - 1)).alias("most"))
    rising = Window.partitionBy("token").orderBy("n", "lo")
    reach = F.max("most").over(rising.rowsBetween(Window.unboundedPreceding, -1))
    cut = sized.withColumn("first", F.when(reach >= F.col("n"), 0).otherwise(1))
    parts = cut.select("lo", "token", F.sum("first").over(rising.rowsBetween(Window.unboundedPreceding, 0)).alias("part"))
    return several(parts, "token", "part").distinct()


def meeting_lists(prefix: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, lists): (node, hi, lo, n) of every class that meets another one,
    and (g, node) of the lists in which they meet, each set of members once."""
    met = staged(shared_postings(prefix), "jaccard-postings")
    meeting = staged(met.select("lo").distinct(), "jaccard-meeting")
    nodes = prefix.select("hi", "lo", "n").join(small(meeting), "lo").distinct().withColumn("node", F.monotonically_increasing_id())
    nodes = staged(nodes, "jaccard-nodes")
    token = F.when(F.col("part") == 1, F.col("token")).otherwise(F.xxhash64("token", "part")).alias("token")
    lists = staged(met.join(small(nodes.select("lo", "node")), "lo").select(token, "node"), "jaccard-lists")
    marks = [F.count("*").alias("k"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit("second"))).alias("y")]
    once = lists.groupBy("token").agg(*marks).groupBy("k", "x", "y").agg(F.min("token").alias("token"))
    return nodes, staged(lists.join(once.select("token"), "token").select(F.col("token").alias("g"), "node"), "jaccard-unique-lists")


def allowed(lists: DataFrame, sketches: DataFrame) -> DataFrame:
    """Edges that connect the classes of each list which may be linked."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("g", kind="stable")
        node, n, data = pdf["node"].to_numpy(), pdf["n"].to_numpy(), pdf["sketch"].tolist()
        cut = np.concatenate([[0], np.nonzero(np.diff(pdf["g"].to_numpy()))[0] + 1, [len(pdf)]])
        pairs = []
        for a, b in zip(cut, cut[1:]):
            pairs += [(node[a + i], node[a + j]) for i, j in may_link(n[a:b], data[a:b])]
        return _edges(pairs).drop_duplicates()

    sizes = staged(lists.groupBy("g").agg(F.count("*").alias("k"), F.min("node").alias("b")), "jaccard-list-sizes")
    few = lists.join(sizes.where(F.col("k") <= SKETCHED).select("g"), "g")
    bins = max(1, -(-few.count() // SKETCH_ROWS))
    dealt = few.join(sketches, "node").withColumn("bin", F.pmod(F.xxhash64("g"), F.lit(bins)).cast("int"))
    small_lists = dealt.groupBy("bin").applyInPandas(run, EDGES)
    large_lists = lists.join(sizes.where(F.col("k") > SKETCHED), "g").select(F.col("node").alias("a"), "b")
    return staged(small_lists.unionByName(large_lists), "jaccard-allowed")


def groups_of(lists: DataFrame, sketches: DataFrame, most: int = MOST) -> DataFrame:
    """(g, node): the neighbourhoods of up to ``most`` classes, the lists of the others."""
    near = staged(components(allowed(lists, sketches)), "jaccard-neighbourhoods")
    large = near.groupBy("root").agg(F.count("*").alias("k")).where(F.col("k") > most).select("root")
    whole = near.join(large, "root", "left_anti").select(F.col("root").alias("g"), "node")
    single = lists.join(near.join(large, "root", "left_semi").select("node"), "node", "left_semi").select("g", "node")
    tagged = lambda df, t: df.select(F.struct(F.lit(t).alias("kind"), "g").alias("g"), "node")
    return tagged(whole, 0).unionByName(tagged(single, 1))


def similarity_components(docs: DataFrame, most: int = MOST) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    spark = docs.sparkSession
    own = texts(docs)
    rows = staged(classified(own), "jaccard-rows")
    order = spark.sparkContext.broadcast(summed(rows.where("piece IS NOT NULL").select("piece", "task", "counts")))
    rows = rows.where("piece IS NULL").select("doc_id", "n", "hi", "lo")
    prefix = staged(prefixes(own, order), "jaccard-prefixes")
    nodes, lists = meeting_lists(prefix)
    sketches = prefix.join(small(nodes.select("hi", "lo", "node")), ["hi", "lo"]).select("node", "n", "sketch")
    groups = groups_of(lists, staged(sketches.dropDuplicates(["node"]), "jaccard-sketches"), most)
    groups = staged(groups, "jaccard-neighbours")
    classes = rows.where("n > 0").groupBy("hi", "lo").agg(F.min("doc_id").alias("first_id"))
    classes = staged(classes.join(nodes.join(groups.select("node").distinct(), "node").select("hi", "lo", "node"), ["hi", "lo"], "left"), "jaccard-classes")
    meet = classes.where("node IS NOT NULL").select(F.col("first_id").alias("id")).distinct()
    some = own.join(small(staged(meet, "jaccard-ids")), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    wanted = staged(classes.where("node IS NOT NULL").select("hi", "lo", "node"), "jaccard-wanted")
    sets = staged(whole_sets(some).join(small(wanted), ["hi", "lo"]).select("node", "shingles"), "jaccard-sets")
    if sets.count() > wanted.count():  # rows that share a doc_id
        sets = staged(sets.dropDuplicates(["node"]), "jaccard-distinct-sets")
    edges = linked_edges(groups, sets, order)
    found = staged(components(edges), "jaccard-components")
    grouped = classes.join(found, "node", "left").select("hi", "lo", "first_id", "root")
    least = grouped.where("root IS NOT NULL").groupBy("root").agg(F.min("first_id").alias("component_id"))
    of = staged(grouped.join(least, "root", "left").select("hi", "lo", F.coalesce("component_id", "first_id").alias("component_id")), "jaccard-class-components")
    with_words = rows.where("n > 0").join(of, ["hi", "lo"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return with_words.unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
