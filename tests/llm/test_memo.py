"""The workers' memories forget by size and give the same values."""

import random
import sys

import numpy as np

from tillmart.llm.memo import Memo, WordRows


def test_long_keys_stay_within_the_bytes():
    rng = random.Random(1)
    known = Memo(lambda k: k.encode(), most=200_000, most_bytes=1_000_000)
    for _ in range(4000):  # unspaced texts of 700 characters
        key = "".join(rng.choices("abc", k=700))
        assert known[key] == key.encode() and known["often"] == b"often"
        held = sum(sys.getsizeof(k) + sys.getsizeof(v) for part in (known, known.old) for k, v in part.items())
        assert held <= 2_000_000
    huge = "x" * 100_000
    assert known[huge] == huge.encode() and huge not in known


def test_word_rows_forget_between_texts():
    rows = WordRows(lambda words: np.array([[len(w)] for w in words]), 1, most_bytes=50_000)
    for i in range(50):
        words = [f"{i}-{k}" * 20 for k in range(100)]
        assert rows.sum(words)[0] == sum(map(len, words))
        assert rows.bytes < 150_000
