"""Operator 4: reproducible shuffle into shards by a Feistel permutation.
Built-in functions only.

Rows get global numbers 0 .. N-1 without a sort of the whole: distinct
(doc_id, text checksum, size) keys with their number of copies fall into
buckets by an arithmetic hash, bucket totals give each bucket its first number,
and within a bucket a window numbers on.  Copies of one key are one row until
the numbers are written out, so no group of repeated rows meets in a task.

A Feistel network over pairs (x div a, x mod a), a = ceil(sqrt(N)), permutes
0 .. a*a-1.  Cycle walking applies it again to results of N or more, which
makes it a permutation of 0 .. N-1.  There are at most 2a - 2 such values; the
longest walk through them that begins at a row is measured beforehand on all of
them, so the number of steps in the plan is exact for every row.

Row number x lands at p = permuted(x): shard p mod 8, slot p div 8, so shards
differ by one row at most and slots have no gaps (law ``rows``).  ``position``
and ``row_at`` compute the place of a row and the row of a place without data.

Defined cases: null texts have size 1 and the checksum of no bytes; null
doc_ids sort first; identical rows share a run of numbers; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmart.llm.common import staged

SHARDS = 8
SEED = 20_240
ROUNDS = 6
# Modulus of the round function and of the bucket hash, and its multiplier.
PRIME = 2_147_483_647
FACTOR = 48_271
# Distinct keys of a bucket at least, and buckets at most (their totals are
# one small table).
BUCKET_ROWS = 64
MAX_BUCKETS = 16_384


def round_keys(seed: int = SEED) -> list[int]:
    return [int.from_bytes(hashlib.sha256(f"{seed}:{r}".encode()).digest()[:4], "big") % PRIME for r in range(ROUNDS)]


def side(n: int) -> int:
    """The smallest a with a * a >= n."""
    return math.isqrt(max(n, 1) - 1) + 1


# --- the permutation in Python: place of a row, row of a place ------------------------


def _mix(r: int, key: int) -> int:
    x = (r + key) % PRIME
    return x * x % PRIME


def permuted(x: int, n: int, seed: int = SEED) -> int:
    a = side(n)
    while True:
        left, right = divmod(x, a)
        for k in round_keys(seed):
            left, right = right, (left + _mix(right, k)) % a
        x = left * a + right
        if x < n:
            return x


def position(row: int, n: int, shards: int = SHARDS, seed: int = SEED) -> tuple[int, int]:
    """(shard, slot) of global row number ``row`` of ``n``."""
    p = permuted(row, n, seed)
    return p % shards, p // shards


def row_at(shard: int, slot: int, n: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """Global row number at a place: the network backwards, walked likewise."""
    a, x = side(n), slot * shards + shard
    while True:
        left, right = divmod(x, a)
        for k in reversed(round_keys(seed)):
            left, right = (right - _mix(left, k)) % a, left
        x = left * a + right
        if x < n:
            return x


# --- the same as expressions -----------------------------------------------------------


def network(x: Column, a: int, seed: int = SEED, back: bool = False) -> Column:
    """The permutation of 0 .. a*a-1, or its inverse."""
    start = F.struct(F.call_function("div", x, F.lit(a)).alias("l"), (x % F.lit(a)).alias("r"))

    def mixed(r: Column, k: Column) -> Column:
        y = (r + k) % F.lit(PRIME)
        return (y * y) % F.lit(PRIME)

    def step(s: Column, k: Column) -> Column:
        if back:
            return F.struct(F.pmod(s["r"] - mixed(s["l"], k), F.lit(a)).alias("l"), s["l"].alias("r"))
        return F.struct(s["r"].alias("l"), ((s["l"] + mixed(s["r"], k)) % F.lit(a)).alias("r"))

    keys = round_keys(seed)
    rounds = F.array(*(F.lit(k).cast("long") for k in (reversed(keys) if back else keys)))
    return F.aggregate(rounds, start, step, lambda s: s["l"] * F.lit(a).cast("long") + s["r"])


def longest_walk(spark, n: int, seed: int = SEED) -> int:
    """Steps until every walk that begins at a row, a value below n, is below n
    again.  Of n .. a*a-1 only images of rows begin a walk: the others lie on
    one's way, or on cycles that no row enters."""
    a = side(n)
    entered = spark.range(n, a * a).where(network(F.col("id"), a, seed, back=True) < n)
    steps, left = 0, entered.count()
    while left:
        # one plan of fixed depth per test, doubling: few jobs, however long the walk
        steps = 2 * steps if steps else 1
        left = entered.where(walked(F.col("id"), n, a, steps, seed) >= n).count()
    low = steps // 2
    while steps - low > 1:
        half = (low + steps) // 2
        done = entered.where(walked(F.col("id"), n, a, half, seed) >= n).count() == 0
        low, steps = (low, half) if done else (half, steps)
    return steps


def walked(x: Column, n: int, a: int, steps: int, seed: int = SEED) -> Column:
    """``x`` after up to ``steps`` further applications, none once it is below n."""
    again = lambda y, _: F.when(y < n, y).otherwise(network(y, a, seed))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), x, again) if steps else x


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row of ``docs``."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    keys = staged(rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies")), "shard-keys")
    n, distinct = keys.agg(F.coalesce(F.sum("copies"), F.lit(0)), F.count("*")).first()
    buckets = min(max(1, -(-distinct // BUCKET_ROWS)), MAX_BUCKETS)
    mixed = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(PRIME)) * F.lit(FACTOR) % F.lit(PRIME)
    keys = keys.withColumn("bucket", (mixed + F.col("text_crc32")) % F.lit(buckets))
    totals = keys.groupBy("bucket").agg(F.sum("copies").alias("n"))  # MAX_BUCKETS rows at most
    before = F.sum("n").over(W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    firsts = totals.select("bucket", F.coalesce(before, F.lit(0)).alias("first"))
    inside = W.partitionBy("bucket").orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "size")
    upto = F.sum("copies").over(inside.rowsBetween(W.unboundedPreceding, 0))
    numbered = keys.withColumn("upto", upto).join(F.broadcast(firsts), "bucket")
    start = F.col("first") + F.col("upto") - F.col("copies")
    numbered = numbered.select("doc_id", "size", "text_crc32", F.explode(F.sequence(start, start + F.col("copies") - 1)).alias("x"))
    a, walk = side(n), longest_walk(spark, n, seed)
    placed = numbered.withColumn("p", walked(network(F.col("x"), a, seed), n, a, walk, seed))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("p") % shards).cast("int").alias("shard"), F.call_function("div", F.col("p"), F.lit(shards)).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def oracle(shards: int = SHARDS, seed: int = SEED) -> str:
    """The same in DuckDB SQL; CRC-32 from its polynomial, walks by recursion."""
    rounds = "SELECT id, n, a, steps, x // a AS l, x % a AS r FROM walk WHERE steps = 0 OR x >= n"
    for k in round_keys(seed):
        mixed = f"((r + {k}) % {PRIME}) * ((r + {k}) % {PRIME}) % {PRIME}"
        rounds = f"SELECT id, n, a, steps, r AS l, (l + {mixed}) % a AS r FROM ({rounds})"
    return f"""
WITH RECURSIVE tab AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) t(i))),
d AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, size, list_transform(range(1, size), lambda i: ('0x' || h[2 * i - 1 : 2 * i])::BIGINT) AS bytes FROM d),
c AS (
  SELECT doc_id, size::BIGINT AS size,
         xor(list_reduce([4294967295::BIGINT] || bytes, lambda c, b: xor(c >> 8, tab[xor(c, b) % 256 + 1])), 4294967295) AS text_crc32
  FROM b, tab),
m AS (SELECT greatest(least(ceil(count(DISTINCT (doc_id, size, text_crc32)) / {float(BUCKET_ROWS)})::BIGINT, {MAX_BUCKETS}), 1) AS buckets,
             count(*) AS n FROM c),
o AS (
  SELECT c.*, n, row_number() OVER (ORDER BY
           ((((coalesce(doc_id, 0) % {PRIME}) + {PRIME}) % {PRIME}) * {FACTOR} % {PRIME} + text_crc32) % buckets,
           doc_id NULLS FIRST, text_crc32, size) - 1 AS id FROM c, m),
s AS (SELECT id, id AS x, n, ceil(sqrt(n))::BIGINT AS a FROM o),
walk AS (
  SELECT id, x, n, a, 0 AS steps FROM s
  UNION ALL
  SELECT id, l * a + r AS x, n, a, steps + 1 AS steps FROM ({rounds})),
p AS (SELECT id, x AS p FROM walk WHERE steps > 0 AND x < n)
SELECT doc_id, size, text_crc32, 'rows' AS law, (p % {shards})::INTEGER AS shard, (p // {shards})::BIGINT AS slot,
       NULL::INTEGER AS grown_shard
FROM o JOIN p USING (id)"""
