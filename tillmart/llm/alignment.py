"""Operator 12: cross-tokenizer alignment counted by minimal perfect hashing.

Every text is encoded by a byte-level BPE (A, of a space and the text) and a
piece model (B, which puts that space itself), both without special tokens.
Byte offsets where tokens of both end cut the tokens into groups; an A and a B
token whose byte ranges overlap are linked.  The count of an id pair is the
number of documents that hold it linked, over the whole corpus.

1. First pass: every document is aligned; a task sums the documents of each of
   its distinct pairs and writes (pair, documents).
2. The distinct pairs fall into buckets by a hash; each bucket gets a minimal
   perfect hash function (``perfect_hash``) and its keys in slot order.
3. The tasks' counts are scattered into one dense vector per bucket and lane
   of tasks, indexed by the pairs' slots; the lanes' vectors are added up as a
   tree.  No lane or bucket grows beyond a fixed size.
4. Second pass: every document is aligned again and looks its pairs' counts up
   by slot, each answer verified against the key that is kept there.

The functions, keys and counts are broadcast if their counted bytes are at most
``TABLE_BYTES``; beyond that the second pass writes each document's pairs and
Spark joins them to the counts.  Both give the same rows.

A single space between two characters that no tokenizer takes as white space
is a border no token of either crosses: A begins a pretoken there, and no piece
of B holds a space after another character (checked when B is loaded; a model
with such a piece has its texts encoded whole).  So a text is a sequence of
segments that are encoded and aligned by themselves, and a worker remembers
those it has met, up to a fixed number of bytes.

Null and empty texts, and texts whose joined A or B bytes are not the space and
the text (for instance a text with U+2581), have no tokens: zeros and an empty
``groups_sha256``.  Rows that repeat are documents of their own and count as
such.  Null doc_ids stay null.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm.bpe import PRETOKENS, byte_characters
from tillmart.llm.common import segment_sums, slices, staged, texts
from tillmart.llm.memo import ENTRY_BYTES
from tillmart.llm.perfect_hash import FINE, PerfectHash, build, fine_bucket

# Keys of a bucket, about, and buckets at least.
BUCKET_KEYS = 16_384
LEAST_BUCKETS = 16
# Rows (pair, documents) that one dense vector is filled from, about; vectors added in one step.
LANE_ROWS = 500_000
BRANCHES = 16
# Bytes of functions, keys and counts that are broadcast at most.
TABLE_BYTES = 64_000_000
# Distinct pairs a task holds before it writes them, and bytes of segments it remembers.
HELD_PAIRS = 1_000_000
SEGMENT_BYTES = 96_000_000
# Characters of new segments that are encoded as one string.
RUN_CHARS = 10_000
# White space in any reading, and characters that some reading takes for it.
BLANKS = "".join(chr(c) for c in range(0x10000) if chr(c).isspace()) + "\u180e\u200b\u2060\ufeff"
BLANK = "".join(f"\\u{ord(c):04x}" for c in BLANKS)
BORDER = regex.compile(rf"(?<=[^{BLANK}]) (?=[^{BLANK}])")
ODD = regex.compile(rf"[{BLANK}] | [{BLANK}]|^ | $")
SHIFT = 32
LOW = (1 << SHIFT) - 1
# Numbers of a segment or a text.
NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def run_of(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The indices of several ranges, one range after the other."""
    sizes = ends - starts
    return np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64), sizes) + np.arange(sizes.sum())


class Aligner:
    """Both tokenizers, and the segments a worker remembers: their numbers,
    their links and, where ``texts`` is set, their groups as text.  ``lookup``
    gives the two sums (n_best, count_sum) of lists of links."""

    def __init__(self, byte_path: str, piece_path: str, lookup=None, texts: bool = False, most_bytes: int = SEGMENT_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.lookup, self.texts, self.most_bytes = lookup, texts, most_bytes
        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        byte_of = byte_characters()
        with open(byte_path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            if all(c in byte_of for c in t):
                self.bytes_a[i] = bytes(byte_of[c] for c in t)
        self.by_rank = self.ranked(spec, byte_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.bytes_b, self.bordered = [], True
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
            self.bordered &= "▁" not in piece.lstrip("▁")
        self.width_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.width_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        self.names = [str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.code: dict[str, int] = {}
        self.numbers = np.zeros((1024, len(NUMBERS) + 2), dtype=np.int64)  # the last two: n_best, count_sum
        self.hits = np.zeros(1024, dtype=np.int64)
        self.valid = np.zeros(1024, dtype=bool)
        self.start, self.end = np.zeros(1024, dtype=np.int64), np.zeros(1024, dtype=np.int64)  # in the pool of links
        self.pool, self.pooled = np.zeros(4096, dtype=np.int64), 0
        self.groups: list[str] = []
        self.bytes = 0

    def ranked(self, spec: dict, byte_path: str):
        """(encoding, id of each rank) of the ranks library, several times as
        fast, where it provably gives the same ids, else None.  It joins any
        neighbours whose bytes are a token, in the order of the merges.  If each
        token's characters encode to that token alone, no two other tokens ever
        stand side by side in its place, so only merges join."""
        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers

        shape, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = shape.get("type") == "ByteLevel" and shape.get("use_regex") and not shape.get("add_prefix_space") and not spec.get("normalizer")
        tokens = [t for t, i in model["vocab"].items() if self.bytes_a[i]]
        whole = Tokenizer.from_file(byte_path)
        whole.pre_tokenizer = pre_tokenizers.Sequence([])
        alone = [e.ids for e in whole.encode_batch_fast(tokens, add_special_tokens=False)]
        merged = [m.replace(" ", "") if isinstance(m, str) else "".join(m) for m in model["merges"]]
        if not plain or alone != [[model["vocab"][t]] for t in tokens] or len(set(merged)) < len(merged):
            return None
        shown = {b: c for c, b in byte_characters().items()}
        ids = [model["vocab"][shown[b]] for b in range(256)] + [model["vocab"][m] for m in merged]
        ranks = {self.bytes_a[i]: r for r, i in enumerate(ids)}
        return tiktoken.Encoding("ranks", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={}), np.array(ids)

    # -- what is remembered --

    def entry_bytes(self, segment: str, groups: str, links: int) -> int:
        return sys.getsizeof(segment) + len(groups) + 8 * links + 2 * ENTRY_BYTES

    def shrink(self) -> None:
        """Forget all but the segments met most often, a quarter at most."""
        n = len(self.code)
        least = max(2, int(np.partition(self.hits[:n], -max(n // 4, 1))[-max(n // 4, 1)]) + 1)
        keep = np.nonzero(self.hits[:n] >= least)[0]
        words = list(self.code)
        links = self.pool[run_of(self.start[keep], self.end[keep])]
        sizes = self.end[keep] - self.start[keep]
        self.code = {words[c]: i for i, c in enumerate(keep.tolist())}
        self.groups = [self.groups[c] for c in keep.tolist()]
        self.pool, self.pooled = links.copy(), len(links)
        k = len(keep)
        self.numbers, self.valid = self.numbers[keep], self.valid[keep]
        self.hits = self.hits[keep] // 2
        self.end = np.cumsum(sizes)
        self.start = self.end - sizes
        self.grow(k)
        self.bytes = sum(self.entry_bytes(w, g, s) for w, g, s in zip(self.code, self.groups, sizes.tolist()))

    def grow(self, size: int) -> None:
        """Room for ``size`` segments and the links they have."""
        if size >= len(self.hits):
            more = max(1024, size + 1, 2 * len(self.hits)) - len(self.hits)
            self.numbers = np.concatenate([self.numbers, np.zeros((more, self.numbers.shape[1]), np.int64)])
            for name in ("hits", "valid", "start", "end"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros(more, old.dtype)]))

    def remember(self, segments: list[str], valid, numbers: np.ndarray, links: np.ndarray, link_ends: np.ndarray, groups: list[str]) -> None:
        first, n = len(self.code), len(segments)
        self.grow(first + n)
        self.code.update(zip(segments, range(first, first + n)))
        self.numbers[first : first + n, : len(NUMBERS)] = numbers
        if self.lookup is not None:
            self.numbers[first : first + n, len(NUMBERS) :] = self.lookup(links, link_ends)
        self.valid[first : first + n] = valid
        self.hits[first : first + n] = 0
        if self.pooled + len(links) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(links)), np.int64)])
        self.pool[self.pooled : self.pooled + len(links)] = links
        self.end[first : first + n] = self.pooled + link_ends
        self.start[first : first + n] = self.pooled + np.concatenate([[0], link_ends[:-1]])
        self.pooled += len(links)
        self.groups += groups
        self.bytes += sum(map(sys.getsizeof, segments)) + sum(map(len, groups)) + 8 * len(links) + 2 * ENTRY_BYTES * n

    # -- encoding and aligning new segments --

    def encoded(self, joined: list[str]) -> tuple[np.ndarray, np.ndarray]:
        given = [" " + s for s in joined]
        if self.by_rank:
            encoding, ids = self.by_rank
            ids_a = [ids[encoding.encode_ordinary(s)] for s in given]
        else:
            ids_a = [np.array(e.ids, dtype=np.int64) for e in self.a.encode_batch_fast(given, add_special_tokens=False)]
        ids_b = [np.array(ids, dtype=np.int64) for ids in self.b.encode(joined, num_threads=1)]
        return np.concatenate(ids_a), np.concatenate(ids_b)

    def add(self, segments: list[str]) -> None:
        """Encode, align and remember segments that may stand side by side:
        runs of them are encoded as one string, and cut again by their bytes."""
        runs = [" ".join(segments[i:j]) for i, j in slices([len(s) + 1 for s in segments], RUN_CHARS)]
        a, b = self.encoded(runs)
        whole = "".join([" " + r for r in runs]).encode()
        if b"".join([self.bytes_a[i] for i in a.tolist()]) != whole or b"".join([self.bytes_b[i] for i in b.tolist()]) != whole:
            if len(segments) > 1:  # some of them has no tokens: halve until it is alone
                half = len(segments) // 2
                self.add(segments[:half])
                self.add(segments[half:])
            else:
                self.remember(segments, False, np.zeros((1, len(NUMBERS))), np.zeros(0, np.int64), np.zeros(1, np.int64), [""])
            return
        cut = np.cumsum([len(s.encode()) + 1 for s in segments])
        ends_a, ends_b = np.cumsum(self.width_a[a]), np.cumsum(self.width_b[b])
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        last = np.concatenate([ends[1:] != ends[:-1], [True]])
        common = ends[1:][~last[:-1]]  # where tokens of both end
        ends = ends[last]
        # one link for each stretch between two ends
        links = a[np.searchsorted(ends_a, ends)] << SHIFT | b[np.searchsorted(ends_b, ends)]
        marks = [np.searchsorted(x, cut, side="right") for x in (ends_a, ends_b, common, ends)]
        numbers = np.stack([np.diff(m, prepend=0) for m in marks], axis=1)
        groups = [""] * len(segments)
        if self.texts:
            text_a, text_b = [self.names[i] for i in a.tolist()], [self.names[i] for i in b.tolist()]
            at_a, at_b = np.searchsorted(ends_a, common, side="right"), np.searchsorted(ends_b, common, side="right")
            single = []
            i = j = 0
            for x, y in zip(at_a.tolist(), at_b.tolist()):
                single.append(f"{text_a[i] if x == i + 1 else ','.join(text_a[i:x])}|{text_b[j] if y == j + 1 else ','.join(text_b[j:y])}")
                i, j = x, y
            i = 0
            for k, x in enumerate(marks[2].tolist()):
                groups[k] = ";".join(single[i:x])
                i = x
        self.remember(segments, True, numbers, links, marks[3], groups)

    def segments(self, text: str) -> list[str]:
        if not self.bordered:
            return [text]
        return BORDER.split(text) if ODD.search(text) else text.split(" ")

    def documents(self, given: list[str]) -> Iterator[np.ndarray | None]:
        """For each text the codes of its segments (None: no tokens).  They hold
        until the next one is asked for."""
        for start, end in slices([len(t or "") for t in given]):
            if self.bytes > self.most_bytes:
                self.shrink()
            split = [self.segments(t) if t else [] for t in given[start:end]]
            new = set().union(*split).difference(self.code)
            side_by_side = [s for s in new if self.bordered and s.strip(BLANKS) == s]
            for i, j in slices([len(s) for s in side_by_side]):
                self.add(side_by_side[i:j])
            for s in new:
                if s not in self.code:
                    self.add([s])
            for ss in split:
                codes = np.fromiter(map(self.code.__getitem__, ss), dtype=np.int64, count=len(ss))
                self.hits[codes] += 1
                yield codes if len(codes) and self.valid[codes].all() else None

    def pairs(self, codes: np.ndarray) -> np.ndarray:
        """The distinct pairs linked in a document."""
        used = np.unique(codes)
        return np.unique(self.pool[run_of(self.start[used], self.end[used])])

    def links(self, codes: np.ndarray) -> np.ndarray:
        return self.pool[run_of(self.start[codes], self.end[codes])]

    def digest(self, codes: np.ndarray) -> str:
        return hashlib.sha256(";".join(map(self.groups.__getitem__, codes.tolist())).encode()).hexdigest()


_ALIGNERS: dict = {}


def aligner(byte_path: str, piece_path: str, use: int | str, made=None) -> Aligner:
    """The Python worker's aligner for one use (0: the first pass, -1: links
    with texts, else a name for the broadcast table that ``made`` opens)."""
    key = (byte_path, piece_path, use)
    if key not in _ALIGNERS:
        _ALIGNERS.clear()  # that of an earlier pass
        _ALIGNERS[key] = Aligner(byte_path, piece_path, lookup=made().sums if made else None, texts=use != 0)
    return _ALIGNERS[key]


# --- first pass: the tasks' counts -------------------------------------------------


class PairSums:
    """Documents per pair, summed in sorted arrays."""

    def __init__(self):
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.n = 0

    def add(self, keys: np.ndarray) -> None:
        self.waiting.append(keys)
        self.n += len(keys)
        if self.n > HELD_PAIRS:
            self.merge()

    def merge(self) -> None:
        keys, counts = np.unique(np.concatenate([np.zeros(0, np.int64), *self.waiting]), return_counts=True)
        both, at = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        sums = np.zeros(len(both), dtype=np.int64)
        np.add.at(sums, at, np.concatenate([self.counts, counts]))
        self.keys, self.counts, self.waiting, self.n = both, sums, [], 0

    def taken(self) -> pd.DataFrame:
        self.merge()
        out = pd.DataFrame({"pair": self.keys, "fine": fine_bucket(self.keys), "task": np.int32(TaskContext.get().partitionId()), "docs": self.counts})
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        return out


def pair_counts(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """(pair, fine, task, docs): documents of a task's rows that hold the pair."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, sums = aligner(byte_path, piece_path, 0), PairSums()
        for batch in batches:
            for codes in m.documents(batch["text"].tolist()):
                if codes is not None:
                    sums.add(m.pairs(codes))
            if len(sums.keys) > HELD_PAIRS:
                yield sums.taken()
        yield sums.taken()

    return docs.select("text").mapInPandas(count, "pair long, fine int, task int, docs long")


# --- functions and dense vectors ----------------------------------------------------


def hash_functions(pairs: DataFrame) -> DataFrame:
    """(bucket, sizes, bits, keys) of each bucket of distinct ``pairs`` (bucket,
    pair): its function and its keys in slot order."""

    def made(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        keys = pdf["pair"].to_numpy()
        sizes, bits = build(keys)
        ordered = np.empty(len(keys), dtype=np.int64)
        ordered[PerfectHash([(sizes, bits, len(keys))]).slots(keys, np.zeros(len(keys), np.int64))] = keys
        return pd.DataFrame({"bucket": [key[0]], "sizes": [sizes], "bits": [bits.tobytes()], "keys": [ordered.tobytes()]})

    return pairs.groupBy("bucket").applyInPandas(made, "bucket int, sizes array<int>, bits binary, keys binary")


def function_of(sizes, bits: bytes, keys: bytes) -> tuple[list[int], np.ndarray, int]:
    return list(sizes), np.frombuffer(bits, dtype="<u8"), len(keys) // 8


def vectors(counts: DataFrame, functions: DataFrame, lanes: int) -> DataFrame:
    """(bucket, lane, vector): ``counts`` (bucket, pair, task, docs) scattered
    into one dense vector per bucket and lane of tasks."""

    def scatter(key: tuple, pdf: pd.DataFrame, fn: pd.DataFrame) -> pd.DataFrame:
        f = function_of(*fn.loc[0, ["sizes", "bits", "keys"]])
        vector = np.zeros(f[2], dtype=np.int64)
        pairs = pdf["pair"].to_numpy()
        np.add.at(vector, PerfectHash([f]).slots(pairs, np.zeros(len(pairs), np.int64)), pdf["docs"].to_numpy())
        return pd.DataFrame({"bucket": [key[0]], "lane": [key[1]], "vector": [vector.tobytes()]})

    lane = (F.col("task") % F.lit(lanes)).cast("int")
    left = counts.select("bucket", lane.alias("lane"), "pair", "docs").groupBy("bucket", "lane")
    right = functions.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    used = right.join(counts.select("bucket", lane.alias("lane")).distinct(), ["bucket", "lane"])
    return left.cogroup(used.groupBy("bucket", "lane")).applyInPandas(scatter, "bucket int, lane int, vector binary")


def tree_sum(parts: DataFrame, lanes: int) -> DataFrame:
    """(bucket, vector): the lanes' vectors added in steps of ``BRANCHES``."""

    def added(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(v, dtype=np.int64) for v in pdf["vector"])
        return pd.DataFrame({"bucket": [key[0]], "lane": [key[1]], "vector": [total.tobytes()]})

    while lanes > 1:
        lanes = -(-lanes // BRANCHES)
        parts = parts.withColumn("lane", (F.col("lane") % F.lit(lanes)).cast("int"))
        parts = parts.groupBy("bucket", "lane").applyInPandas(added, "bucket int, lane int, vector binary")
    return parts.select("bucket", "vector")


def counted(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """(bucket, sizes, bits, keys, vector), written: every pair's corpus-wide count."""
    parts = staged(pair_counts(docs, byte_path, piece_path), "alignment-counts")
    rows, distinct = parts.agg(F.count("*"), F.count_distinct("pair")).first()
    buckets = LEAST_BUCKETS
    while buckets < FINE and buckets * BUCKET_KEYS < distinct:
        buckets *= 2
    parts = parts.withColumn("bucket", F.col("fine") % F.lit(buckets))
    functions = staged(hash_functions(parts.select("bucket", "pair").distinct()), "alignment-functions")
    lanes = max(1, -(-rows // (buckets * LANE_ROWS)))
    return staged(functions.join(tree_sum(vectors(parts, functions, lanes), lanes), "bucket"), "alignment-table")


def exploded(table: DataFrame) -> DataFrame:
    """(pair, n) of every pair of the written table."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for keys, vector in zip(pdf["keys"], pdf["vector"]):
                yield pd.DataFrame({"pair": np.frombuffer(keys, dtype=np.int64), "n": np.frombuffer(vector, dtype=np.int64)})

    return table.select("keys", "vector").mapInPandas(rows, "pair long, n long")


def best_counts(table: DataFrame) -> DataFrame:
    """(a, best) the highest count of each A id."""
    return exploded(table).groupBy(F.shiftright("pair", SHIFT).alias("a")).agg(F.max("n").alias("best"))


# --- second pass: lookups -------------------------------------------------------------


class PairTable:
    """All buckets' functions, keys and counts, asked for pairs."""

    def __init__(self, rows: list[tuple], best: np.ndarray):
        self.hash = PerfectHash([function_of(sizes, bits, keys) for sizes, bits, keys, _ in rows])
        self.keys = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r[2], dtype=np.int64) for r in rows)])
        self.counts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r[3], dtype=np.int64) for r in rows)])
        self.best = best

    def counts_of(self, pairs: np.ndarray) -> np.ndarray:
        at = self.hash.slots(pairs, fine_bucket(pairs).astype(np.int64) % self.hash.buckets)
        if (at < 0).any() or (self.keys[at] != pairs).any():
            raise ValueError("a pair of the second pass was not counted in the first one")
        return self.counts[at]

    def sums(self, links: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """(n_best, count_sum) of consecutive runs of links."""
        pairs, back = np.unique(links, return_inverse=True)
        count = self.counts_of(pairs)
        return segment_sums(np.stack([count == self.best[pairs >> SHIFT], count], axis=1).astype(np.int64)[back], ends)


OUTPUT = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def looked_up(docs: DataFrame, byte_path: str, piece_path: str, table: DataFrame) -> DataFrame:
    """The result with the table of counts broadcast."""
    spark = docs.sparkSession
    rows = [(list(r.sizes), bytes(r.bits), bytes(r["keys"]), bytes(r.vector)) for r in table.orderBy("bucket").collect()]
    found = best_counts(table).toPandas()  # at most one row per id of A's vocabulary
    best = np.zeros(int(found["a"].max()) + 1 if len(found) else 1, dtype=np.int64)
    best[found["a"].to_numpy(dtype=np.int64)] = found["best"].to_numpy(dtype=np.int64)
    shared, use = spark.sparkContext.broadcast((rows, best)), uuid.uuid4().hex

    @F.pandas_udf(OUTPUT)
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = aligner(byte_path, piece_path, use, lambda: PairTable(*shared.value))
        for s in batches:
            out = []
            for codes in m.documents(s.tolist()):
                known = codes is not None
                out.append((*m.numbers[codes].sum(axis=0).tolist(), m.digest(codes)) if known else (0,) * 6 + ("",))
            yield pd.DataFrame(out, columns=[f.split()[0] for f in OUTPUT.split(", ")])

    return docs.select("doc_id", look("text").alias("r")).select("doc_id", "r.*")


def joined(docs: DataFrame, byte_path: str, piece_path: str, table: DataFrame) -> DataFrame:
    """The same for a table beyond broadcasting: each document's distinct pairs
    with their number of links are joined to the counts (AQE splits frequent
    pairs) and summed by row."""
    schema = pa.schema(
        [("doc_id", pa.int64())]
        + [(n, pa.int64()) for n in NUMBERS]
        + [("groups_sha256", pa.string()), ("links", pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())])))]
    )

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = aligner(byte_path, piece_path, -1)
        for pdf in batches:
            out = []
            for codes in m.documents(pdf["text"].tolist()):
                if codes is None:
                    out.append((0, 0, 0, 0, "", []))
                    continue
                pairs, times = np.unique(m.links(codes), return_counts=True)
                links = [{"pair": p, "times": t} for p, t in zip(pairs.tolist(), times.tolist())]
                out.append((*m.numbers[codes].sum(axis=0).tolist()[: len(NUMBERS)], m.digest(codes), links))
            made = pd.DataFrame(out, columns=schema.names[1:], index=pdf.index)
            made.insert(0, "doc_id", pdf["doc_id"])
            yield made

    spec = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links array<struct<pair:long,times:long>>"
    found = docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(rows, spec)
    found = staged(found.withColumn("row", F.monotonically_increasing_id()), "alignment-rows")
    counts = exploded(table)
    counts = counts.join(best_counts(table), F.shiftright(counts.pair, SHIFT) == F.col("a")).select("pair", "n", "best")
    sums = (
        found.select("row", F.inline("links"))
        .join(counts, "pair")
        .groupBy("row")
        .agg(F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum"))
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return found.join(sums, "row", "left").select("doc_id", *NUMBERS, zero("n_best"), zero("count_sum"), "groups_sha256")


def alignment(docs: DataFrame, byte_path: str, piece_path: str, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)
    of every row of ``docs``."""
    own = texts(docs)
    table = counted(own, byte_path, piece_path)
    size = table.agg(F.sum(F.octet_length("bits") + F.octet_length("keys") + F.octet_length("vector"))).first()[0] or 0
    return (looked_up if size <= table_bytes else joined)(own, byte_path, piece_path, table)
