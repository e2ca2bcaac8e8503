"""Operator 9: benchmark decontamination by size-partitioned MinHash containment.
Built-in functions only.

A document is contaminated by an item if it contains at least ``PERCENT`` % of
the item's distinct shingles (``SHINGLE`` words; words are runs of letters and
digits, lower-cased).

Search: items are partitioned by size, class c holding those with 2^(c-1) < n
<= 2^c shingles.  An item's signature is its bottom-k MinHash sketch, where k
follows from the class's largest size u: k = floor(u (100 - PERCENT) / 100) + 1.
A document that holds enough of the item misses fewer than k of its shingles,
so it holds some of any k: every true pair is a candidate, whatever the
document's length, and long documents need no sketch of their own.  Since any k
serve, shingles are ranked by how many items hold them before their hash: a
phrase that many items share comes into a sketch last.  The documents' shingle
hashes stream past the signatures, which are broadcast as long as they are few
(``BROADCAST_ROWS``) and joined by a shuffle beyond that.  A (document, item)
pair is a candidate if the document holds all but as many of the sketch as it
may miss of the item.

Verification: the texts of candidate documents are read again, and the
shingles of each candidate pair's item, as words, not hashes, are looked up
among those of its document: work in proportion to the pairs found.

Defined cases: an item of fewer than ``SHINGLE`` words is one shingle of all its
words, looked for in the documents' windows of that many words; null and empty
texts have no shingles and match nothing.  Rows that share a doc_id are judged
one by one (by their text), and so are items that share an item_id or have
none; the result has the best containment per (doc_id, item_id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import packed, small, staged, texts

SHINGLE = 5
PERCENT = 80
WORD_BREAK = r"[^\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), WORD_BREAK), "")


def shingles(words: Column, make, width: int = SHINGLE) -> Column:
    """``make`` of the words of every shingle, in order."""
    window = lambda i: make([F.get(words, i + j) for j in range(width)])
    starts = F.sequence(F.lit(0), F.size(words) - width)
    return F.when(F.size(words) >= width, F.transform(starts, window))


def hashed(words: list[Column]) -> Column:
    return F.xxhash64(*words)


def joined(words: list[Column]) -> Column:
    return F.concat_ws(" ", *words)


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, words): the key tells rows of one doc_id apart."""
    return texts(docs).select("doc_id", F.xxhash64("text").alias("text_key"), words_of(F.col("text")).alias("words"))


def item_texts(items: DataFrame) -> DataFrame:
    """(item_key, grams, n, width) of each distinct item text: its distinct
    (h, shingle), their number, and the words of a shingle."""
    own = texts(items, "item_id").select("text").distinct()
    own = own.select(F.xxhash64("text").alias("item_key"), words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    both = lambda ws: F.struct(hashed(ws).alias("h"), joined(ws).alias("shingle"))
    grams = shingles(F.col("words"), both)
    for width in range(1, SHINGLE):
        grams = F.when(F.size("words") == width, shingles(F.col("words"), both, width)).otherwise(grams)
    own = own.select("item_key", F.array_distinct(grams).alias("grams"), F.least(F.size("words"), F.lit(SHINGLE)).alias("width"))
    return own.withColumn("n", F.size("grams").cast("long"))


def signatures(known: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(item_key, h, need): the bottom-k sketch of each item, k by its size
    class, and how much of it a containing document holds at least."""
    each = known.select("item_key", "n", F.explode(F.array_distinct("grams.h")).alias("h"))
    held = each.groupBy("h").agg(F.count("*").alias("items"))
    ranked = F.sort_array(F.collect_list(F.struct("items", "h")))  # of one item
    ranked = each.join(held, "h").groupBy("item_key", "n").agg(ranked.alias("ranked"))
    k = F.floor(F.pow(F.lit(2), F.ceil(F.log2("n"))) * (100 - percent) / 100) + 1
    sketch = ranked.select("item_key", "n", F.slice("ranked", F.lit(1), k.cast("int")).alias("sketch"))
    may_miss = F.floor(F.col("n") * (100 - percent) / 100)
    need = F.greatest(F.lit(1), F.size("sketch") - may_miss)
    return sketch.select("item_key", F.explode("sketch.h").alias("h"), need.cast("long").alias("need"))


def candidate_pairs(docs: DataFrame, sketch: DataFrame, widths: list[int]) -> DataFrame:
    """(doc_id, text_key, item_key) of the pairs that may match."""
    none = F.array().cast("array<bigint>")
    hashes = [F.coalesce(shingles(F.col("words"), hashed, w), none) for w in widths]
    seen = keyed(docs).select("doc_id", "text_key", F.explode(F.concat(*hashes)).alias("h"))
    hits = seen.join(small(sketch), "h").select("doc_id", "text_key", "item_key", "need", "h").distinct()
    met = hits.groupBy("doc_id", "text_key", "item_key").agg(F.first("need").alias("need"), F.count("*").alias("met"))
    return met.where("met >= need").select("doc_id", "text_key", "item_key")


def verified(docs: DataFrame, pairs: DataFrame, known: DataFrame, widths: list[int]) -> DataFrame:
    """(doc_id, text_key, item_key, n_shingles, n_found) of candidate pairs."""
    grams = known.select("item_key", "n", F.explode("grams.shingle").alias("shingle"))
    wanted = pairs.join(grams, "item_key")
    again = keyed(docs)
    chosen = small(pairs.select(F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key")).distinct())
    again = again.join(chosen, again.doc_id.eqNullSafe(F.col("c_id")) & (again.text_key == F.col("c_key")), "left_semi")
    none = F.array().cast("array<string>")
    parts = [F.coalesce(shingles(F.col("words"), joined, w), none) for w in widths]
    held = again.select(F.col("doc_id").alias("d_id"), F.col("text_key").alias("d_key"), F.explode(F.concat(*parts)).alias("held"))
    held = held.join(small(grams.select(F.col("shingle").alias("held")).distinct(), "held"), "held", "left_semi").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("d_id")) & (F.col("text_key") == F.col("d_key")) & (F.col("shingle") == F.col("held"))
    counted = wanted.join(held, same).groupBy("doc_id", "text_key", "item_key")
    return counted.agg(F.first("n").alias("n_shingles"), F.count("*").alias("n_found"))


def contaminated_rows(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_key, item_key, n_shingles, n_found) of every match."""
    known = staged(item_texts(items), "decontaminate-items")
    widths = sorted({SHINGLE} | {r.width for r in known.select("width").distinct().collect()})  # SHINGLE at most
    sketch = staged(signatures(known, percent), "decontaminate-signatures")
    pairs = staged(candidate_pairs(docs, sketch, widths), "decontaminate-candidates")
    found = verified(docs, pairs, known, widths)
    return found.where(100 * F.col("n_found") >= percent * F.col("n_shingles"))


def contaminated(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found, containment), one row per pair:
    its best containment, of equal ones the largest item's."""
    best = F.max(F.struct((F.col("n_found") / F.col("n_shingles")).alias("share"), "n_shingles", "n_found"))
    named = texts(items, "item_id").select(F.col("doc_id").alias("item_id"), F.xxhash64("text").alias("item_key")).distinct()
    rows = contaminated_rows(docs, items, percent).join(named, "item_key").groupBy("doc_id", "item_id").agg(best.alias("best"))
    return rows.select("doc_id", "item_id", "best.n_shingles", "best.n_found", F.round("best.share", 6).alias("containment"))


def without_contaminated(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item."""
    bad = staged(contaminated_rows(docs, items, percent).select("doc_id", "text_key").distinct(), "decontaminate-rows")
    rows = packed(docs)
    same = F.col("doc.doc_id").eqNullSafe(F.col("doc_id")) & (F.xxhash64(F.coalesce("doc.text", F.lit(""))) == F.col("text_key"))
    return rows.join(small(bad), same, "left_anti").select("doc.*")


def oracle(percent: int = PERCENT) -> str:
    words = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS ws FROM documents),
b AS (SELECT row_number() OVER () AS iid, item_id, ws, least(len(ws), {SHINGLE}) AS w
  FROM (SELECT item_id, {words} AS ws FROM (SELECT DISTINCT item_id, text FROM benchmark)) WHERE len(ws) > 0),
widths AS (SELECT DISTINCT w FROM b),
ds AS (SELECT DISTINCT rid, doc_id, array_to_string(ws[i:i + w - 1], ' ') AS g
  FROM (SELECT rid, doc_id, ws, w, unnest(range(1, len(ws) - w + 2)) AS i FROM d CROSS JOIN widths WHERE len(ws) >= w)),
bs AS (SELECT DISTINCT iid, item_id, array_to_string(ws[i:i + w - 1], ' ') AS g
  FROM (SELECT iid, item_id, ws, w, unnest(range(1, len(ws) - w + 2)) AS i FROM b)),
n AS (SELECT iid, count(*) AS n FROM bs GROUP BY iid),
f AS (SELECT rid, doc_id, iid, item_id, count(*) AS n_found FROM ds JOIN bs USING (g) GROUP BY ALL)
SELECT doc_id, item_id, n AS n_shingles, n_found, round(n_found / n, 6) AS containment
FROM f JOIN n USING (iid) WHERE 100 * n_found >= {percent} * n
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_found / n DESC, n DESC, n_found DESC) = 1"""
