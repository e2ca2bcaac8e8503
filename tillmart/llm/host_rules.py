"""Operator 3: quality rules with host verdicts. Built-in functions only.

Base rules are counted on whole texts inside the row: words
(``[^\\x20\\x09-\\x0D]+``), their characters, symbols, lines equal to an earlier
line, and words inside 3-word windows that occur at least twice.  A window is
known by its 64-bit hash; windows are sorted by hash, so no pairs are formed.

Host rules: failures are summed per host (the ``source`` of a document; one
partial sum per task, so a host with a third of all rows is no heavier than
another).  A beta prior is fitted to the hosts' failure rates by their mean m
and variance v (strength m(1-m)/v - 1; 1 where v is zero or cannot be had),
each host's rate is shrunk to (failed + alpha) / (n + alpha + beta), and a host
whose shrunk rate exceeds ``MAX_RATE`` fails with all its documents.  Verdicts
are joined back to the documents.

The counts are written once to the shared folder: they feed both the sums and
the result.  Nulls: a null text has no words and fails the base rules; a
document without host is judged by the base rules alone.  An empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import small, staged

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
# A host fails if more than this share of its documents does (after shrinking).
MAX_RATE = 0.5


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def repeated_words(words: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that occur at least twice."""

    def starts(ordered: Column) -> Column:
        same = lambda k, other: F.get(ordered, k)["h"] == F.get(ordered, other)["h"]
        hit = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda k: F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False)),
        )
        return F.sort_array(F.transform(hit, lambda k: F.get(ordered, k)["i"]))

    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW),
            lambda i: F.struct(F.xxhash64(*(F.get(w, i + j) for j in range(WINDOW))).alias("h"), i.alias("i")),
        )

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
        step = lambda s, i: F.struct((s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n"), i.alias("last"))
        return F.aggregate(at, start, step, lambda s: s["n"])

    count = let(words, lambda w: covered(let(F.sort_array(windows(w)), starts)))
    return F.when(F.size(words) > WINDOW, count).otherwise(F.lit(0).cast("long"))


def base_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed) of every row of ``docs``."""
    own = docs.select("doc_id", F.col("source").alias("host"), F.coalesce("text", F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    own = own.withColumn("words", words_of(F.col("text")))
    counted = own.select(
        "doc_id",
        "host",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def host_verdicts(counted: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """(host, host_rate, host_failed) of every host that is not null."""
    hosts = counted.where(F.col("host").isNotNull()).groupBy("host")
    hosts = hosts.agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    rate = F.col("failed") / F.col("n")
    prior = hosts.agg(F.avg(rate).alias("m"), F.var_samp(rate).alias("v")).first()  # two numbers
    strength = 1.0
    if prior.v and prior.m * (1 - prior.m) > prior.v:
        strength = prior.m * (1 - prior.m) / prior.v - 1
    alpha, total = (prior.m or 0.0) * strength, strength
    shrunk = (F.col("failed") + F.lit(alpha)) / (F.col("n") + F.lit(total))
    return hosts.select("host", F.round(shrunk, 6).alias("host_rate"), (shrunk > max_rate).alias("host_failed"))


def quality(docs: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """Base counts, host and verdict of every row of ``docs``."""
    counted = staged(base_counts(docs), "quality-counts")
    hosts = staged(host_verdicts(counted, max_rate), "quality-hosts")
    joined = counted.join(small(hosts), "host", "left")
    kept = ~F.col("base_failed") & ~F.coalesce("host_failed", F.lit(False))
    return joined.withColumn("kept", kept).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_rate"
    )


def oracle(max_rate: float = MAX_RATE) -> str:
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT rid, doc_id, source, t,
         list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
      FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
r AS (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM g) WHERE c > 1),
n AS (SELECT rid, count(DISTINCT j) AS n FROM r GROUP BY rid),
b AS (
  SELECT doc_id, source, len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(n.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN n USING (rid)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM b),
h AS (SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS failed FROM f WHERE source IS NOT NULL GROUP BY source),
p AS (SELECT avg(failed / n) AS m, var_samp(failed / n) AS v FROM h),
s AS (SELECT m, CASE WHEN v > 0 AND m * (1 - m) > v THEN m * (1 - m) / v - 1 ELSE 1.0 END AS k FROM p),
v AS (SELECT source, (failed + m * k) / (n + k) AS shrunk FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(shrunk > {max_rate}, false) AS kept, round(shrunk, 6) AS host_rate
FROM f LEFT JOIN v USING (source)"""
