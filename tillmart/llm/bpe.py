"""Operator 6: byte-level BPE encoding and decoding by per-prefix dynamic programming.

A text is split into pretokens as the tokenizer file says, special strings
first.  Within a pretoken every prefix has exactly one token that can end its
encoding.  The tokens that end at a prefix are found by one pass of an
automaton over the pretoken (a trie of all token strings with suffix links:
all vocabulary words that are a suffix of the prefix, longest first).  A
candidate is the prefix's last token if it stands alone or is compatible with
the last token of what is before it: two tokens are compatible if the merges,
applied to their joined bytes, give back just these two.  Following the stored
tokens back from the end gives the ids, with no merge loop over the text.

Decoding joins the bytes of the ids and reads them as UTF-8.

The encoding of a pretoken is a pure function of it, so a worker remembers a
bounded number of them; the memory is emptied when full, which changes no result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.llm.common import bounded_batches, texts
from tillmart.llm.memo import Memo

# Fixed value: how a byte-level tokenizer splits a text into pretokens.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Words, pretokens and token pairs a worker remembers (each, twice over).
REMEMBERED = 200_000
# Texts whose ids are held at once.
ROWS = 256


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in a tokenizer file:
    printable Latin-1 characters for themselves, the rest from 256 upwards."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBPE:
    def __init__(self, path: str, remembered: int = REMEMBERED):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = byte_characters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of: list[bytes] = [b""] * (1 + max([*spec["model"]["vocab"].values(), *self.special.values()]))
        vocab: dict[bytes, int] = {}
        for token, i in spec["model"]["vocab"].items():
            if token not in self.special:
                self.bytes_of[i] = bytes(byte_of[c] for c in token)
                vocab[self.bytes_of[i]] = i
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.single = {b: vocab[bytes([b])] for b in range(256)}
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}  # (left, right) -> (rank, joined)
        self.made_by: dict[int, tuple[int, int, int]] = {}  # token -> (rank, left, right)
        self.ends = ahocorasick.Automaton()
        for b in range(256):
            self.ends.add_word(chr(b), (1, self.single[b]))
        for r, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = (vocab[bytes(byte_of[c] for c in x)] for x in (left, right))
            joined = vocab[self.bytes_of[a] + self.bytes_of[b]]
            self.rank[a, b] = (r, joined)
            self.made_by[joined] = (r, a, b)
            word = self.bytes_of[joined].decode("latin-1")
            self.ends.add_word(word, (len(word), joined))
        self.ends.make_automaton()
        self.spine_ends = Memo(lambda t: self.spine(t, 1), remembered)
        self.spine_starts = Memo(lambda t: self.spine(t, 0), remembered)
        self.split = regex.compile(PRETOKENS)
        self.odd_space = regex.compile(r"\s | \s|^ | $")
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.compatible = Memo(self.pair_holds, remembered)
        self.pretoken = Memo(lambda s: np.array(self.by_prefixes(s.encode()), dtype="<u4").tobytes(), remembered)
        self.word = Memo(lambda w: self.by_pretokens(" " + w), remembered)

    def spine(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """The tokens that stand at one edge of ``token`` while it is built:
        (token, rank of the merge that makes it, rank of the merge that uses it up)."""
        out, used = [], len(self.made_by) + len(self.bytes_of)
        while token in self.made_by:
            made, *parts = self.made_by[token]
            out.append((token, made, used))
            token, used = parts[side], made
        return out + [(token, -1, used)]

    def pair_holds(self, pair: int) -> bool:
        """Whether two tokens (left << 32 | right) stay apart under the merges: no merge across
        their border may fall due while both of its sides stand there.  Of two
        merges of one rank the left one goes first."""
        rank = self.rank
        for x, x_made, x_used in self.spine_ends[pair >> 32]:
            for y, y_made, y_used in self.spine_starts[pair & 0xFFFFFFFF]:
                across = rank.get((x, y))
                if across and across[0] < x_used and across[0] <= y_used and y_made < x_used and x_made <= y_used:
                    return False
        return True

    def by_prefixes(self, data: bytes) -> list[int]:
        """Ids of a pretoken: the last token of every prefix, then back-pointers."""
        last: list[int] = [-1] * (len(data) + 1)
        width: list[int] = [0] * (len(data) + 1)
        compatible = self.compatible
        for at, (n, token) in self.ends.iter(data.decode("latin-1")):
            end = at + 1
            if last[end] < 0:  # candidates of a prefix come longest first
                start = end - n
                if start == 0 or compatible[last[start] << 32 | token]:
                    last[end], width[end] = token, n
        ids, at = [], len(data)
        while at:
            ids.append(last[at])
            at -= width[at]
        return ids[::-1]

    def by_pretokens(self, text: str) -> bytes:
        known = self.pretoken
        return b"".join([known[p] for p in self.split.findall(text)])

    def plain(self, text: str) -> bytes:
        """Ids of a text without special strings.  A single space between two
        characters other than white space always begins a pretoken, so a text
        in which every space is like that is a sequence of words, each encoded
        by itself with its space; any other text is split as a whole."""
        if self.odd_space.search(text):
            return self.by_pretokens(text)
        first, *words = text.split(" ")
        known = self.word
        return self.by_pretokens(first) + b"".join([known[w] for w in words])

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if self.special_split is None or not any(s in text for s in self.special):
            return self.plain(text)
        out = []
        for part in self.special_split.split(text):
            known = part in self.special
            out.append(np.uint32(self.special[part]).astype("<u4").tobytes() if known else self.plain(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        table = self.bytes_of
        return b"".join([table[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", errors="replace")


_MODELS: dict[str, ByteBPE] = {}


def model(path: str) -> ByteBPE:
    """One model per Python worker and file."""
    if path not in _MODELS:
        _MODELS[path] = ByteBPE(path)
    return _MODELS[path]


def encoded(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``docs``, all columns, with ``ids`` array<int> and ``round_trip``: whether
    decoding them gives the text back; a null text is encoded as the empty one.
    Columns of docs with these two names are replaced.  ``ROWS`` texts are
    handled at once, their ids in one Arrow buffer."""
    kept = [f for f in docs.schema.fields if f.name.lower() not in ("ids", "round_trip")]
    added = [T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("round_trip", T.BooleanType())]
    names = [f.name for f in kept + added]
    text_at = next(i for i, f in enumerate(kept) if f.name.lower() == "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(tokenizer_path)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                given = [t or "" for t in part.column(text_at).to_pylist()]
                found = [m.encode(t) for t in given]
                ends = np.cumsum([0, *(len(p) // 4 for p in found)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), dtype="<i4")))
                same = pa.array([m.decode(p) == t for p, t in zip(found, given)])
                yield pa.RecordBatch.from_arrays([*part.columns, ids, same], names=names)

    bounded_batches(docs.sparkSession)
    return docs.select(*(F.col(f"`{f.name}`") for f in kept)).mapInArrow(encode, T.StructType(kept + added))


def encoding_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of ``docs``:
    the same encoding and decoding, digested in the task that makes them."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = model(tokenizer_path)
        for s in batches:
            rows = []
            for t in s:
                ids = m.encode(t)
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(m.decode(ids).encode()).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return texts(docs).select("doc_id", digest("text").alias("r")).select("doc_id", "r.*")
