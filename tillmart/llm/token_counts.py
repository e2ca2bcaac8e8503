"""Operator 2: token counts with overlap resynchronisation.

Every whole text is counted exactly as the piece model's library counts it.
Texts up to ``chunk`` characters are encoded at once.  A longer text is encoded
in chunks that overlap, each token carrying its character offsets, and the
chunk results are spliced at a *stable* boundary inside the overlap:

* the model builds tokens by merging neighbouring symbols, and a merge always
  yields a piece of the vocabulary.  If no piece contains the characters
  ``a b`` side by side, no merge can ever cross a text position between an
  ``a`` and a ``b``: what is left of it and what is right of it are encoded
  independently, in a chunk just as in the whole text.  Such a position is
  proven stable.
* both chunks must also have a token boundary there (which the proof implies;
  it is checked all the same).

Where an overlap has no stable common boundary it is widened, doubling until
one is found or the chunk reaches the end of the text, so that a text without
any stable boundary ends up encoded whole.  No text is cut or dropped.

Nulls count as empty texts (0 bytes, 0 tokens); ``over_limit`` says whether a
text has more than ``limit`` tokens.  Memory of a task: one Arrow batch of
texts plus the ids of ``CHUNK_CHARS`` characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import slices, texts

LIMIT = 4096
# Characters of a chunk, and the overlap of two chunks to begin with.
CHUNK = 16_384
OVERLAP = 64
# The library writes a space as this character and puts one before a text.
SPACE = "▁"


def found(ordered: np.ndarray, value: int) -> bool:
    i = int(np.searchsorted(ordered, value))
    return i < len(ordered) and int(ordered[i]) == value


class PieceCounter:
    """Token counts of texts under one piece model."""

    def __init__(self, model_path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.chunk, self.overlap = chunk, overlap
        size = self.model.get_piece_size()
        self.width = np.zeros(size, dtype=np.int64)  # characters of a token
        self.joined: set[str] = set()  # neighbours within some piece
        for i in range(size):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                # a character as bytes: its first byte stands for it
                self.width[i] = int((int(piece[3:5], 16) & 0xC0) != 0x80)
            elif not (self.model.is_control(i) or self.model.is_unknown(i)):
                self.width[i] = len(piece)
                self.joined.update(map("".join, zip(piece, piece[1:])))
        self.widened = 0  # overlaps that had to grow

    def counts(self, batch: list[str]) -> list[int]:
        out = [0] * len(batch)
        short = [i for i, t in enumerate(batch) if len(t) <= self.chunk]
        for a, b in slices([len(batch[i]) for i in short]):
            for i, ids in zip(short[a:b], self.model.encode([batch[i] for i in short[a:b]], num_threads=1)):
                out[i] = len(ids)
        for i, t in enumerate(batch):
            if len(t) > self.chunk:
                out[i] = self.spliced(t)
        return out

    def ends(self, part: str) -> np.ndarray | None:
        """End offset in ``part`` of each of its tokens (None: not aligned)."""
        ids = self.model.encode(part, num_threads=1)
        at = np.cumsum(self.width[ids]) - 1  # the space put before the text
        return at if len(at) and at[-1] == len(part) else None

    def stable(self, text: str, low: int, high: int) -> Iterator[int]:
        """Positions in [low, high), the last first, that no merge can cross."""
        for p in range(high - 1, low - 1, -1):
            if text[p - 1 : p + 1].replace(" ", SPACE) not in self.joined:
                yield p

    def spliced(self, text: str) -> int:
        total, start, counted = 0, 0, -1  # chunk start; tokens ending up to here are counted
        size = len(text)
        end = min(start + self.chunk, size)
        ends = self.ends(text[start:end])
        while ends is not None:
            if end == size:
                return total + int((ends + start > counted).sum())
            overlap = self.overlap
            while True:
                low = max(end - overlap, counted + 1)
                next_end = min(low + self.chunk + overlap, size)
                following = self.ends(text[low:next_end])
                if following is None:
                    return len(self.model.encode(text, num_threads=1))
                cut = next(
                    (p for p in self.stable(text, low + 1, end) if found(ends, p - start) and found(following, p - low)), None
                )
                if cut is not None:
                    break
                self.widened += 1
                if low == counted + 1:  # the whole of the chunk: take a longer one
                    end = min(start + 2 * (end - start), size)
                    ends = self.ends(text[start:end])
                    if ends is None:
                        return len(self.model.encode(text, num_threads=1))
                    if end == size:
                        return total + int((ends + start > counted).sum())
                    overlap = self.overlap
                else:
                    overlap *= 2
            at = ends + start
            total += int(((at > counted) & (at <= cut)).sum())
            counted, start, end, ends = cut, low, next_end, following
        return len(self.model.encode(text, num_threads=1))


_COUNTERS: dict = {}


def counter(model_path: str, chunk: int, overlap: int) -> PieceCounter:
    """One counter per Python worker and setting."""
    key = (model_path, chunk, overlap)
    if key not in _COUNTERS:
        _COUNTERS[key] = PieceCounter(*key)
    return _COUNTERS[key]


def token_counts(
    docs: DataFrame, model_path: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = counter(model_path, chunk, overlap)
        for s in batches:
            yield pd.Series(c.counts(s.tolist()), dtype="int64")

    out = texts(docs).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), count("text").alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
