"""Small awkward inputs shared by the operator tests."""

from pyspark.sql import functions as F

# (doc_id, text, lang, source, n_chars): null and empty texts, blanks only,
# repeated rows, a repeated id with another text, null ids, no host, a very
# long word, and a long text.
LONG = " ".join(f"word{i % 977} of the text" for i in range(12_000))
ROWS = [
    (1, None, "en", "h1", None),
    (2, "", "en", "h1", 0),
    (3, " \t\r\n\x0b\x0c ", None, "h1", 7),
    (4, "one two three four five six seven", "en", "h2", 33),
    (4, "one two three four five six seven", "en", "h2", 33),
    (4, "another text under the same number", "en", None, 34),
    (None, "no number at all here, but some words", "en", "h2", 37),
    (None, None, None, None, None),
    (6, "x" * 60_000, None, "h3", 60_000),
    (7, LONG, "en", "h3", len(LONG)),
    (8, "Straße naïve 漢字 😀 ünïcödé <|endoftext|> done", "de", "h3", 47),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside, as extra columns.
CLASHING = "fp t key u key2 block bucket host words h n row doc id copies bpe ids round_trip shingle text_key item_id x p label features kind score toxic _toxicity _base _spans size".split()


def odd_docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def with_clashes(docs):
    return docs.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, *columns):
    """Sorted tuples of some columns (all by default)."""
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=repr)
