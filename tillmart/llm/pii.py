"""Operator 5: personal data by candidate generation and gradient-boosted trees.
Built-in functions and the DataFrame learner only.

Base spans (kept always): leftmost non-overlapping matches of four patterns,
with their checks (address parts up to 255, Luhn, digit counts).  Positions
come from the pieces between the matches: the running sum of piece and match
lengths, in code points.  Running sums double their reach each step, so a text
with n matches costs n log n.

Candidates: the base spans, and what high-recall generators (loose patterns
for the four kinds, which may overlap one another) find in the text with the
base spans blanked out.  Trees boosted on the candidates of every distinct text,
and of the seed texts, score them by format (lengths, digits, separators, groups) and context (neighbouring
characters, cue words before).  Labels come from evidence: base spans, and an
address that is one once (at), [dot] and blanks are undone, a national phone
number by its form or a cue word before it, a number that passes the check of
its kind without its separators.  The checks (Luhn, ranges) are no features.
Evidence labels only; what is added is what the trees score at or above the
threshold of its kind.  The fitted trees become one expression, evaluated where
the candidate stands, with no shuffle.

Seed texts: fixed sentences of known formats with varied digits, labelled by the
same evidence.  They make both classes and all kinds present in every table, so
trees and thresholds exist for a table of any size.

Calibration: on a kept-back half of the candidates each kind gets the smallest
threshold at which ``PRECISION`` of the candidates above it are labelled as
spans, ``LEAST`` at the lowest.  A kind with no such threshold adds none.

Defined cases: null texts count as empty (no spans); an empty table gives none;
equal rows give equal rows, whatever their ids.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm.common import packed, staged

KINDS = ("email", "ip", "card", "phone")

# Base patterns.  Same matches as their plain forms; possessive, and starting
# at the beginning of a run or right after the last match, so that a text of
# one long run is read once instead of once per position.
LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Loose patterns; a candidate begins where no longer one could have begun.
LOOSE = {
    "email": rf"(?<![{LOCAL}])[{LOCAL}]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9.])[0-9]++(?:\.[0-9]++){3,}+",
    "card": r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){12,}+",
    "phone": r"(?<![0-9])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,14}+",
}
CUES = {
    "mail": "mail|contact|correo|courriel",
    "net": "ip|host|server|addr|login",
    "pay": "card|visa|pay|carte|karte|tarjeta|account|iban",
    "call": "tel|phone|call|fax|mobil|appel|llam",
}
CONTEXT = 24  # characters before a candidate that are looked at
SEED_VARIANTS = 120
TREES = 10
DEPTH = 4
SEED = 11
PRECISION = 0.98
LEAST = 0.5
DIGITS = "0123456789"
ADDRESS = rf"^[{LOCAL}]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,24}}$"
# National numbers: area code in brackets or after a 0, or 3-3-4 digits; no dates.
NATIONAL = r"^\([0-9]{2,5}\)[\x20.-]?[0-9]|^0[0-9]+(?:[\x20().-]{1,2}[0-9]{2,})+$|^[0-9]{3}[\x20.-][0-9]{3}[\x20.-][0-9]{4}$"
DATE = r"^[0-9]{1,2}[.-][0-9]{1,2}[.-][0-9]{2,4}(?![0-9])"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def running(values: Column, combine) -> Column:
    """Running ``combine`` of an array, its reach doubled log2(n) times."""
    reach = F.filter(F.array(*(F.lit(1 << k) for k in range(30))), lambda d: d < F.size(values))
    step = lambda a, d: F.transform(a, lambda x, i: F.when(i >= d, combine(F.get(a, i - d), x)).otherwise(x))
    return F.aggregate(reach, values, step)


def matches(text: Column, pattern: str) -> Column:
    """array<struct<s, e, m, before, after>> of a pattern's matches: code-point
    positions (end exclusive), the match and its surroundings."""

    def located(found: Column, pieces: Column) -> Column:
        lengths = F.transform(found, lambda m, i: (F.length(F.get(pieces, i)) + F.length(m)).cast("long"))
        ends = running(lengths, lambda x, y: x + y)
        return let(
            ends,
            lambda at: F.transform(
                found,
                lambda m, i: F.struct(
                    (F.get(at, i) - F.length(m)).alias("s"),
                    F.get(at, i).alias("e"),
                    m.alias("m"),
                    F.right(F.get(pieces, i), F.lit(CONTEXT)).alias("before"),
                    F.left(F.get(pieces, i + 1), F.lit(2)).alias("after"),
                ),
            ),
        )

    none = "array<struct<s:bigint,e:bigint,m:string,before:string,after:string>>"
    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.size(found) == 0, F.array().cast(none)).otherwise(
            let(F.split(text, pattern, -1), lambda pieces: located(found, pieces))
        ),
    )


def n_digits(m: Column) -> Column:
    return F.length(m) - F.length(without(m, DIGITS))


def luhn_sum(m: Column) -> Column:
    digits = F.filter(F.split(F.reverse(m), ""), lambda c: c.rlike("^[0-9]$"))
    value = F.transform(digits, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(2 * c.cast("int")))
    return F.aggregate(value, F.lit(0), lambda t, v: t + F.when(v > 9, v - 9).otherwise(v))


def luhn(m: Column) -> Column:
    return luhn_sum(m) % 10 == 0


def holds(kind: str, m: Column) -> Column:
    """The check of a kind's base pattern."""
    if kind == "ip":
        return m.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|)(?:\.|$)){4}$")
    if kind == "card":
        return F.when(n_digits(m).between(13, 19), luhn(m)).otherwise(F.lit(False))
    if kind == "phone":
        return n_digits(m).between(9, 15)
    return F.lit(True)


def holding(kind: str):
    return lambda x: holds(kind, x["m"])


def of_kind(kind: str):
    return lambda x: x["kind"] == kind


def address(m: Column) -> Column:
    """An obfuscated address as it is meant; what follows a full stop is not part of it."""
    m = F.regexp_replace(m, r"(?<=[^\x20])\.\x20.*$", "")
    return F.regexp_replace(F.regexp_replace(m, r"\x20?(?:@|\(at\)|\[at\])\x20?", "@"), r"\x20?(?:\.|\(dot\)|\[dot\])\x20?", ".")


def evident(c: Column) -> Column:
    """Whether a loose candidate is personal data by what it says, not by its
    likeness to the base pattern: its label in training."""
    m = c["m"]
    alone = ~c["before"].rlike("[A-Za-z_]$") & ~c["after"].rlike("^[A-Za-z0-9_]")
    called = F.lower(c["before"]).rlike(rf"\b(?:{CUES['call']})") | m.rlike(NATIONAL)
    return (
        F.when(c["kind"] == "email", address(m).rlike(ADDRESS))
        .when(c["kind"] == "ip", holds("ip", m))
        .when(c["kind"] == "card", alone & holds("card", without(m, " .-")))
        .otherwise(alone & called & holds("phone", m) & ~m.rlike(DATE))
    )


# --- spans in order, merged, blanked ------------------------------------------------


def merged(spans: Column) -> Column:
    """Disjoint stretches (s, e, kind of the first span) that cover the spans."""

    def groups(ordered: Column, reach: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(ordered) - 1)
        first = F.filter(every, lambda i: (i == 0) | (F.get(ordered, i)["s"] >= F.coalesce(F.get(reach, i - 1), F.lit(0))))
        following = lambda firsts, j: F.coalesce(F.get(firsts, j + 1), F.size(ordered))
        return let(
            first,
            lambda firsts: F.transform(
                firsts,
                lambda i, j: F.struct(
                    F.get(ordered, i)["s"].alias("s"), F.get(reach, following(firsts, j) - 1).alias("e"), F.get(ordered, i)["kind"].alias("kind")
                ),
            ),
        )

    none = "array<struct<s:bigint,e:bigint,kind:string>>"
    ordered = F.sort_array(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))
    whole = let(ordered, lambda o: let(running(F.transform(o, lambda x: x["e"]), F.greatest), lambda reach: groups(o, reach)))
    return F.when(F.size(spans) > 0, whole).otherwise(F.array().cast(none))


def replaced(text: Column, stretches: Column, by) -> Column:
    """``text`` with each of the disjoint, ordered stretches replaced."""

    def parts(st: Column) -> Column:
        start = lambda j: F.coalesce(F.get(st, j - 1)["e"], F.lit(0).cast("long"))
        kept = lambda x, j: F.substring(text, (start(j) + 1).cast("int"), (x["s"] - start(j)).cast("int"))
        last = F.substring(text, (F.element_at(st, -1)["e"] + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(F.transform(st, lambda x, j: F.concat(kept(x, j), by(x))), ""), last)

    return F.when(F.size(stretches) > 0, let(stretches, parts)).otherwise(text)


# --- candidates, features, trees ------------------------------------------------------


def with_kind(found: Column, kind: str) -> Column:
    return F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), *(x[c].alias(c) for c in ("s", "e", "m", "before", "after"))))


def generated(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with ``_base`` (checked base spans by kind) and ``_extra``
    (loose candidates of the text without them)."""
    base = [F.filter(matches(text, BASE[k]), holding(k)) for k in KINDS]
    out = docs.withColumn("_base", F.concat(*(with_kind(b, k) for b, k in zip(base, KINDS))))
    blank = replaced(text, merged(F.col("_base")), lambda x: F.repeat(F.lit("\n"), (x["e"] - x["s"]).cast("int")))
    out = out.withColumn("_rest", blank)
    extra = F.concat(*(with_kind(matches(F.col("_rest"), LOOSE[k]), k) for k in KINDS))
    return out.withColumn("_extra", extra).drop("_rest")


def features(c: Column) -> dict[str, Column]:
    m, before = c["m"], F.lower(c["before"])
    groups = F.array_remove(F.split(m, "[^0-9]+"), "")
    longest = F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(0))
    count = lambda chars: F.length(m) - F.length(without(m, chars))
    out = {f"is_{k}": c["kind"] == k for k in KINDS}
    out |= {"length": F.length(m), "digits": n_digits(m), "groups": F.size(groups), "longest": longest}
    out |= {"dots": count("."), "spaces": count(" "), "dashes": count("-"), "brackets": count("()[]"), "ats": count("@"), "plus": count("+")}
    out |= {"first": F.length(F.get(groups, 0)), "last": F.length(F.get(groups, F.size(groups) - 1))}
    domain = F.regexp_extract(m, r"(?:@|at[)\]])(.*)$", 1)
    out |= {"domain_parts": F.regexp_count(domain, F.lit(r"\.|[(\[]dot[)\]]")), "full_stop": m.rlike(r"[^\x20]\.\x20"), "ends_in_letters": m.rlike("[A-Za-z]{2}$")}
    out |= {"lead_zero": m.rlike(r"^\(?0"), "parts_of_a_date": m.rlike(DATE)}
    out |= {"after_letter": c["before"].rlike("[A-Za-z]$"), "after_mark": c["before"].rlike("[=:#\"'/_]$"), "before_letter": c["after"].rlike("^[A-Za-z0-9]")}
    out |= {f"cue_{k}": before.rlike(rf"\b(?:{rx})") for k, rx in CUES.items()}
    return {k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in out.items()}


def leaf_or_split(node, values: list[Column]) -> Column:
    """A fitted tree as an expression over the feature values."""
    if node.numDescendants() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    goes_left = values[split.featureIndex()] <= F.lit(float(split.threshold()))
    return F.when(goes_left, leaf_or_split(node.leftChild(), values)).otherwise(leaf_or_split(node.rightChild(), values))


class Trees:
    """Boosted trees as an expression, with a threshold per kind."""

    def __init__(self, fitted, thresholds: dict[str, float]):
        self.model = fitted
        self.roots = [(w, t._call_java("rootNode")) for w, t in zip(fitted.treeWeights, fitted.trees)]
        self.thresholds = thresholds

    def probability(self, c: Column) -> Column:
        def of(f: Column, names: list[str]) -> Column:
            values = [f[n] for n in names]
            margin = reduce(lambda x, y: x + y, (F.lit(float(w)) * leaf_or_split(root, values) for w, root in self.roots))
            return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))

        found = features(c)
        return let(F.struct(*(v.alias(k) for k, v in found.items())), lambda f: of(f, list(found)))

    def chosen(self, candidates: Column) -> Column:
        """The candidates at or above their kind's threshold."""
        cut = lambda c: reduce(
            lambda rest, k: F.when(c["kind"] == k, F.lit(self.thresholds[k])).otherwise(rest), KINDS, F.lit(2.0)
        )
        return F.filter(candidates, lambda c: self.probability(c) >= cut(c))


def sampled_texts(docs: DataFrame, most: int) -> DataFrame:
    """(text): the ``most`` distinct texts of smallest hash, however often each
    occurs and whatever the ids, to look at by hand; training reads every text."""
    own = docs.select("text", F.xxhash64("text", F.lit("pii")).alias("h"))
    last = own.select("h").distinct().orderBy("h").limit(most).agg(F.max("h")).first()[0]
    return own.where(F.col("h") <= F.lit(last).cast("long")).select("text").distinct()


def seed_texts(spark: SparkSession) -> DataFrame:
    """(text): ``SEED_VARIANTS`` of each of a list of sentences, by formats of
    personal data and of what resembles it."""
    digits = lambda name, n: F.lpad(F.pmod(F.xxhash64("id", F.lit(name)), F.lit(10**n)).cast("string"), n, "0")
    octet = lambda name: F.pmod(F.xxhash64("id", F.lit(name)), F.lit(256)).cast("string")
    body = F.concat(F.lit("4"), digits("card", 14))
    check = F.pmod(-luhn_sum(F.concat(body, F.lit("0"))), F.lit(10))
    card = F.concat(body, check.cast("string"))
    wrong = F.concat(body, F.pmod(check + 1, F.lit(10)).cast("string"))
    in_fours = lambda c, by: F.regexp_replace(c, r"([0-9]{4})(?=[0-9])", f"$1{by}")
    among = lambda name, words: F.element_at(F.array(*map(F.lit, words)), (F.pmod(F.xxhash64("id", F.lit(name)), F.lit(len(words))) + 1).cast("int"))
    who = F.concat(among("who", ("ann", "bob.lee", "user", "c-smith", "info", "j_doe")), F.when(F.col("id") % 2 == 0, digits("who2", 2)).otherwise(""))
    site = F.concat(among("site", ("mail", "host", "some-shop", "web", "uni")), F.when(F.col("id") % 3 == 0, digits("site1", 1)).otherwise(""))
    top = among("top", ("com", "org", "net", "de", "info"))
    a, b, three, four = digits("a", 3), digits("b", 2), digits("three", 3), digits("four", 4)
    seven = digits("seven", 7)
    sentences = [
        ("mail ", who, "@", site, ".", top, " or"),
        ("write to ", who, " (at) ", site, " (dot) ", top, " now"),
        ("ask ", who, " [at] some.", site, " [dot] ", top, ". Then"),
        ("ask ", who, "[at]", site, "[dot]", top, " please"),
        ("reach ", who, " @ ", site, ".", top, " today"),
        ("meet ", who, " @ noon on day ", b),
        ("see ", who, "@ ", site, ". Then ", b),
        ("we were at ", who, " (at) ", site, " then"),
        ("sold ", a, " @ ", b, " dollars each"),
        ("from host ", octet("o"), ".", octet("p"), ".", octet("q"), ".", octet("r"), " on"),
        ("build ", four, ".", four, ".", seven, ".", a, " is out"),
        ("pay with card ", card, " now"),
        ("card ", in_fours(card, "."), " fine"),
        ("the visa was ", in_fours(card, "."), ", thanks"),
        ("my account ", in_fours(card, "."), " is open"),
        ("serial ", wrong, " is on the back"),
        ("and ", in_fours(wrong, "."), " in the log"),
        ("dial +", b, " 30 ", seven, " ok"),
        ("or call 030 ", seven, " ok"),
        ("tel 0171 ", seven, ", after six"),
        ("Then (", three, ") ", a, "-", four, " is it"),
        ("she said ", three, "-", a, "-", four, " is right"),
        ("phone ", three, " ", a, " ", four, " please"),
        ("it is 0", b, " ", three, " ", four, " at home"),
        ("on 0", F.substring(b, 1, 1), "-02-2021 ", b, " we met"),
        ("on 2021-03-1", F.substring(b, 1, 1), " ", b, " we met"),
        ("with order 1", seven, b, " and more"),
        ("token ", four, four, " here"),
        ("rows ", b, " ", b, " ", three, " ", b, " of it"),
    ]
    whole = [F.concat(*(x if isinstance(x, Column) else F.lit(x) for x in parts)) for parts in sentences]
    return spark.range(SEED_VARIANTS).select(F.explode(F.array(*whole)).alias("text"))


def training_rows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(kind, label, held, features, n): the candidates of every distinct text of
    ``docs`` and of the seed texts, equal ones counted by ``n``.  Copies of a text
    are one text, told by hash, place and content, so no text is shuffled."""
    own = docs.select(F.coalesce(text_col, F.lit("")).alias("text")).unionByName(seed_texts(docs.sparkSession))
    marked = lambda name, base: F.transform(name, lambda c: F.struct(F.lit(base).alias("base"), c.alias("c")))
    found = generated(own, F.col("text")).select(
        F.xxhash64("text").alias("h"), F.explode(F.concat(marked("_base", True), marked("_extra", False))).alias("x")
    )
    found = found.select("h", "x.base", "x.c").distinct()
    label = F.when(F.col("base"), F.lit(True)).otherwise(evident(F.col("c"))).cast("double")
    rows = found.select(label.alias("label"), F.col("c.kind").alias("kind"), (F.pmod(F.xxhash64("h", "c.s"), F.lit(2)) == 0).alias("held"),
                        *(v.alias(k) for k, v in features(F.col("c")).items()))
    return rows.groupBy(*rows.columns).agg(F.count("*").cast("double").alias("n"))


def train(docs: DataFrame, text_col: str = "text") -> Trees:
    rows = staged(training_rows(docs, text_col), "pii-training")
    names = list(features(F.col("c")))
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(rows).where("not held")
    # The learner looks for split points in bins ** 2 rows: as many as there are.
    bins = max(32, math.isqrt(vectors.count()) + 1)
    fitted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=bins, seed=SEED, labelCol="label", weightCol="n").fit(vectors)
    trees = Trees(fitted, dict.fromkeys(KINDS, 2.0))
    score = F.floor(trees_on_columns(trees, names) * 100) / 100
    held = rows.where("held").groupBy("kind", score.alias("score")).agg(F.sum(F.col("label") * F.col("n")).alias("spans"), F.sum("n").alias("n"))
    found = held.collect()  # at most 101 rows a kind
    for k in KINDS:
        spans = n = 0
        for r in sorted((r for r in found if r.kind == k), key=lambda r: -r.score):
            spans, n = spans + r.spans, n + r.n
            if r.score >= LEAST and spans >= PRECISION * n:
                trees.thresholds[k] = float(r.score)
    return trees


def trees_on_columns(trees: Trees, names: list[str]) -> Column:
    values = [F.col(n) for n in names]
    margin = reduce(lambda x, y: x + y, (F.lit(float(w)) * leaf_or_split(root, values) for w, root in trees.roots))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))


def with_spans(docs: DataFrame, trees: Trees | None, text: Column) -> DataFrame:
    """``docs`` with ``_base`` and ``_spans`` (base and added spans by kind, then
    start); without trees only base spans."""
    out = generated(docs, text)
    extra = trees.chosen(F.col("_extra")) if trees else F.slice("_extra", 1, 0)
    out = out.withColumn("_added", extra)
    plain = lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))
    ordered = lambda k: F.sort_array(F.transform(F.filter(F.concat("_base", "_added"), of_kind(k)), plain))
    return out.withColumn("_spans", F.concat(*map(ordered, KINDS))).drop("_extra", "_added")


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row
    of ``docs``; the counts and the digest are of the base spans."""
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = with_spans(own, train(own), F.col("text"))
    counts = (F.size(F.filter("_base", of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS)
    return found.select("doc_id", *counts, F.sha2(listed(F.col("_base")), 256).alias("base_sha256"), listed(F.col("_spans")).alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every stretch of personal data in ``text`` replaced by its
    kind in brackets, ``n_chars`` counted anew where there is such a column;
    a null text stays null."""
    text = F.col("doc.text")
    found = with_spans(packed(docs), train(docs.select("text")), F.coalesce(text, F.lit("")))
    clean = replaced(text, merged(F.col("_spans")), lambda x: F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))
    found = found.withColumn("doc", F.col("doc").withField("text", F.when(text.isNotNull(), clean)))
    if "n_chars" in docs.columns:
        found = found.withColumn("doc", F.col("doc").withField("n_chars", F.length(text).cast(dict(docs.dtypes)["n_chars"])))
    return found.select("doc.*")
