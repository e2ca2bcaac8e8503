"""Host rules (3), sharding (4), personal data (5), decontamination (9): brute
force, odd input, and plans without Python."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
from odd import ROWS, SCHEMA, empty_docs, odd_docs, rows, with_clashes
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from tillmart.llm import decontaminate, host_rules, pii, sharding
from tillmart.llm.queries import QUERIES


@pytest.mark.parametrize("name", ["op3_host_quality", "op4_feistel_shards", "op5_pii", "op9_benchmark_decontamination"])
def test_no_python_in_the_plan(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)


# --- 3 ---------------------------------------------------------------------------------


def plain_counts(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def test_base_counts_of_odd_rows(spark):
    more = [(20, "a a a a a", "en", "h1", 9), (21, "x y z\nx y z\n\n x y z", "en", "h1", 19), (22, "p q r p q r p q", "en", "h1", 15)]
    docs = spark.createDataFrame(ROWS + more, SCHEMA)
    got = host_rules.quality(with_clashes(docs)).drop("kept", "host_rate")
    assert rows(got) == sorted(((r[0], *plain_counts(r[1])) for r in ROWS + more), key=repr)
    assert rows(host_rules.quality(empty_docs(spark))) == []


def test_a_bad_host_fails_with_all_its_documents(spark):
    good = " ".join(f"w{i}" for i in range(60))
    data = [(i, good if i % 10 else "short", "en", "good", 1) for i in range(100)]
    data += [(100 + i, "short" if i % 10 else good, "en", "bad", 1) for i in range(100)]
    data += [(300, "short", "en", "tiny", 1), (301, good, "en", None, 1), (302, good, "en", "tiny", 1)]
    got = {r.doc_id: r for r in host_rules.quality(spark.createDataFrame(data, SCHEMA)).collect()}
    assert all(got[i].kept == (i % 10 > 0) for i in range(100))
    assert not any(got[100 + i].kept for i in range(100))
    assert got[301].kept and got[301].host_rate is None  # no host: base rules alone
    assert 0.1 < got[302].host_rate < 0.9


# --- 4 ---------------------------------------------------------------------------------


def test_permutation_and_its_inverse():
    for n in (1, 2, 3, 7, 10, 97, 1000):
        places = [sharding.position(x, n) for x in range(n)]
        assert len(set(places)) == n
        assert all(sharding.row_at(*p, n) == x for x, p in enumerate(places))
        counts = Counter(s for s, _ in places)
        assert max(counts.values()) - min(counts.get(s, 0) for s in range(8)) <= 1
        assert all(sorted(slot for s, slot in places if s == shard) == list(range(counts[shard])) for shard in counts)


@pytest.mark.parametrize("n", [1, 2, 5, 30, 1000])
def test_expression_equals_python(spark, n):
    a, walk = sharding.side(n), sharding.longest_walk(spark, n)
    got = spark.range(n).select("id", sharding.network(sharding.F.col("id"), a).alias("p")).collect()

    def once(x):
        left, right = divmod(x, a)
        for k in sharding.round_keys():
            left, right = right, (left + sharding._mix(right, k)) % a
        return left * a + right

    assert all(r.p == once(r.id) for r in got)
    longest = 0
    for x in range(n):
        steps = 0
        while (x := once(x)) >= n:
            steps += 1
        longest = max(longest, steps)
    assert all(r.x == r.id for r in spark.range(a * a).select("id", sharding.network(sharding.network(sharding.F.col("id"), a), a, back=True).alias("x")).collect())
    assert walk == longest


def test_shards_of_odd_rows(spark):
    docs = odd_docs(spark).unionByName(odd_docs(spark)).unionByName(odd_docs(spark))
    got = sharding.shard_documents(with_clashes(docs)).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in ROWS * 3)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(len(by.get(s, [])) for s in range(8)) <= 1
    assert rows(sharding.shard_documents(docs)) == rows(sharding.shard_documents(docs.repartition(5)))
    assert rows(sharding.shard_documents(empty_docs(spark))) == []


# --- 5 ---------------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(m):
    digits = [int(c) for c in m if c.isdigit()][::-1]
    total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits))
    return 13 <= len(digits) <= 19 and total % 10 == 0


CHECK = {
    "email": lambda m: True,
    "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
    "card": plain_luhn,
    "phone": lambda m: 9 <= sum(c.isdigit() for c in m) <= 15,
}
PERSONAL = [
    "a@b.c.d@e.f a@b.c_d@e.f %@x.y",
    "1.2.3.4.5.6.7.8 300.1.1.1 0001.02.3.255 1.2.3.999 1.2.3",
    "4111 1111 1111 1111 x4111-1111-1111-1112 +1 (234) 567-8901 +12",
    "é😀 a@b.co 😀+49 30 1234567 card 4111111111111111é",
    "1" * 3000,
    "a@b" + ".c" * 3000,
    "+" + "1 " * 300,
    "12345678901234567890 4111 1111 1111 1111 2",
    " 4111  1111",
    "@a.b x@ a@b a@b.c",
]


def plain_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, rx in PLAIN.items() for m in re.finditer(rx, text or "") if CHECK[k](m[0])]


def test_base_spans(spark):
    data = [r for r in ROWS] + [(100 + i, t, "en", "h", len(t)) for i, t in enumerate(PERSONAL)]
    given = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("doc_id", sharding.F.col("doc_id") + 1000)
    docs = spark.createDataFrame(data, SCHEMA).unionByName(given, allowMissingColumns=True)
    got = Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.personal_data(with_clashes(docs)).collect())
    want = Counter()
    for r in docs.collect():
        spans = plain_spans(r.text)
        counts = (sum(s.startswith(f"{k}:") for s in spans) for k in PLAIN)
        want[(r.doc_id, *counts, hashlib.sha256(",".join(spans).encode()).hexdigest())] += 1
    assert got == want


def test_all_spans_hold_the_base_spans(spark):
    got = {r.doc_id: r.spans for r in QUERIES["op5_pii"](spark, SF_MID).collect()}
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        assert set(plain_spans(d.text)) <= set(got[d.doc_id].split(",")) | {""}


def test_trees_add_candidates_like_base_spans(spark):
    """Card-like numbers with a wrong check digit are few beside right ones:
    the trees, which do not see the check, add them above the threshold."""

    def card(i):
        body = f"{400000000000000 + 7919 * i:015d}"
        return next(body + c for c in "0123456789" if plain_luhn(body + c))

    data = [(i, f"pay with card {card(i)} now", "en", "h", 1) for i in range(600)]
    wrong = [(1000 + i, f"pay with card {card(i)[:-1]}{(int(card(i)[-1]) + 1) % 10} now", "en", "h", 1) for i in range(3)]
    other = [(2000 + i, f"token {10**7 + 131 * i} here", "en", "h", 1) for i in range(300)]
    docs = spark.createDataFrame(data + wrong + other, SCHEMA)
    got = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    assert all(got[i].n_card == 1 for i in range(600))
    assert all(got[1000 + i].n_card == 0 and got[1000 + i].spans.startswith("card:14:30") for i in range(3))
    assert all(got[2000 + i].spans == "" for i in range(300))


def test_frequent_formats_beside_the_base_patterns(spark):
    """A third of all rows have addresses and numbers in no base format, beside
    base spans and numbers and words that are neither; some formats are rare."""
    data = [(i, f"write to user{i}@host{i % 7}.com or +49 30 {1000000 + 7919 * i} ok", "en", "h", 1) for i in range(150)]
    hot = [(1000 + i, f"write to user{i} (at) host{i % 7} (dot) com or call 030 {1000000 + 7919 * i} ok", "en", "hot", 1) for i in range(150)]
    other = [(2000 + i, f"meet me @ noon on 01-02-2021 10 with order {10**9 + 7919 * i} and 1234.5678.9012.{1000 + i}", "en", "h", 1) for i in range(150)]
    rare = [(3000, "ask name [at] some.host [dot] org. Then (555) 123-4567", "en", "h", 1), (3001, "card 4111.1111.1111.1111 fine", "en", "h", 1)]
    clean = [(r.doc_id, r.text) for r in pii.redacted(spark.createDataFrame(data + hot + other + rare, SCHEMA)).collect()]
    clean = dict(clean)
    assert {clean[1000 + i] for i in range(150)} == {"write to [EMAIL] or call [PHONE] ok"}
    assert all(f"order {10**9 + 7919 * i} and" in clean[2000 + i] and "me @ noon on 01-02-2021 10" in clean[2000 + i] for i in range(150))
    assert "name" not in clean[3000] and "555" not in clean[3000] and "4111" not in clean[3001]
    # with no candidate of another kind the seed texts give the other class
    alone = pii.redacted(spark.createDataFrame(hot, SCHEMA)).collect()
    assert {r.text for r in alone} == {"write to [EMAIL] or call [PHONE] ok"}


def test_trees_and_thresholds_decide(spark):
    """Added spans are the candidates that the fitted model itself scores at or
    above their kind's threshold; without trees there are none."""
    from pyspark.ml.feature import VectorAssembler

    lines = ["write to ann (at) web7 (dot) com now", "or call 030 1234567 ok", "card 4111.1111.1111.1111 fine", "meet me @ noon on 01-02-2021 10", "order 1234567890 is late"]
    docs = spark.createDataFrame([(i, f"{line} {i}", "en", "h", 1) for i, line in enumerate(lines * 3)], SCHEMA)
    trees = pii.train(docs)
    assert all(0.5 <= t <= 1 for t in trees.thresholds.values())
    found = pii.generated(docs, F.col("text"))
    names = list(pii.features(F.col("c")))
    each = found.select("doc_id", F.explode("_extra").alias("c")).select("doc_id", "c.kind", "c.s", "c.e", trees.probability(F.col("c")).alias("p"), *(v.alias(k) for k, v in pii.features(F.col("c")).items()))
    scored = trees.model.transform(VectorAssembler(inputCols=names, outputCol="features").transform(each)).collect()
    assert scored and all(abs(r.probability[1] - r.p) < 1e-9 for r in scored)
    want = {(r.doc_id, f"{r.kind}:{r.s}:{r.e}") for r in scored if r.probability[1] >= trees.thresholds[r.kind]}
    added = lambda t: {(r.doc_id, x) for r in pii.with_spans(docs, t, F.col("text")).select("doc_id", pii.listed(F.col("_spans")).alias("x")).collect() for x in r.x.split(",") if x}
    assert added(trees) == want and len(want) == 9
    assert added(None) == set()
    trees.thresholds["phone"] = 2.0
    assert {x.split(":")[0] for _, x in added(trees)} == {"email", "card"}


LOOSE_PLAIN = pii.LOOSE  # possessive patterns, read alike by Python


def test_candidates_by_plain_patterns(spark):
    text = "a@b.co x (at) y (dot) z +1 234 567 8901 (030) 123-4567 1.2.3.4 999.1.1.1.5 4111 1111 1111 1111 ünï 4111.1111.1111.1112 m @ n😀 05-06 78 90 12"
    docs = spark.createDataFrame([(1, text), (2, "")], "doc_id long, text string")
    for r in pii.generated(docs, F.col("text")).collect():
        blank = list(r.text)
        for span in plain_spans(r.text):
            _, s, e = span.split(":")
            blank[int(s) : int(e)] = "\n" * (int(e) - int(s))
        want = {(k, m.start(), m.end()) for k in pii.KINDS for m in re.finditer(LOOSE_PLAIN[k], "".join(blank))}
        assert {(c.kind, c.s, c.e) for c in r._extra} == want and (len(want) > 4 or not r.text)


def test_samples_are_bounded_whatever_the_ids(spark):
    docs = spark.range(4000).select(F.when(F.col("id") % 3 == 0, "one text").otherwise(F.concat(F.lit("t"), F.col("id") % 1500)).alias("text"))
    assert pii.sampled_texts(docs, 50).count() == 50
    assert rows(pii.sampled_texts(docs, 50)) == rows(pii.sampled_texts(docs.repartition(7), 50))
    assert pii.sampled_texts(docs, 5000).count() == docs.distinct().count()
    assert pii.sampled_texts(docs.where("text = 'one text'"), 5).count() == 1


def test_training_reads_every_text(spark):
    """More texts than the former sample of 5,000: each counts once, copies as one."""
    docs = spark.range(12000).select(F.concat(F.lit("reach x"), F.col("id") % 6000, F.lit(" (at) host (dot) org now")).alias("text"))
    count = lambda d: pii.training_rows(d).where("kind = 'email' and is_email = 1 and brackets = 4 and length < 30").agg(F.sum("n")).first()[0] or 0
    assert count(docs) - count(docs.limit(0)) == 6000


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "mail a@b.co or +1 234 567 8901.", "en", "h", 0), (2, None, None, None, None)], SCHEMA)
    assert rows(pii.redacted(with_clashes(docs)), *docs.columns) == [
        (1, "mail [EMAIL] or [PHONE].", "en", "h", len("mail [EMAIL] or [PHONE].")),
        (2, None, None, None, None),
    ]
    assert pii.redacted(with_clashes(docs)).columns == with_clashes(docs).columns
    assert rows(pii.redacted(empty_docs(spark))) == [] == rows(pii.personal_data(empty_docs(spark)))


# --- 9 ---------------------------------------------------------------------------------


def plain_words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def plain_shingles(text):
    w = plain_words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_containment_of_planted_items(spark):
    items = [(i, " ".join(f"i{i}w{j}" for j in range(n))) for i, n in enumerate([5, 9, 14, 30, 64, 100, 129])]
    items += [(50, None), (51, ""), (52, "only four words here")]
    docs, k = [], 1000
    for i, text in items[:7]:
        w = text.split()
        for part in (0.5, 0.78, 0.8, 0.82, 0.9, 1.0):
            for filler in (0, 3000):
                cut = w[: max(5, round(part * (len(w) - 4)) + 4)]
                pad = [f"f{j % 701}" for j in range(filler)]
                docs.append((k := k + 1, " ".join(pad + cut + pad), "en", "h", 1))
    docs = docs + list(ROWS) + [docs[3], (docs[5][0], "same id, clean text", "en", "h", 1)]
    got = decontaminate.contaminated(with_clashes(spark.createDataFrame(docs, SCHEMA)), spark.createDataFrame(items, "item_id long, text string"))
    want = set()
    for d in docs:
        s = plain_shingles(d[1])
        for i, t in items:
            q = plain_shingles(t)
            if q and 100 * len(s & q) >= 80 * len(q):
                want.add((d[0], i, len(q), len(s & q)))
    assert set(rows(got.drop("containment"))) == want and len(want) > 20
    kept = decontaminate.without_contaminated(with_clashes(spark.createDataFrame(docs, SCHEMA)), spark.createDataFrame(items, "item_id long, text string"))
    bad = {w[0] for w in want}
    assert Counter(r.text for r in kept.collect()) == Counter(d[1] for d in docs if d[0] not in bad or d[1] == "same id, clean text")


def test_decontamination_of_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert rows(decontaminate.contaminated(odd_docs(spark), items)) == []
    assert rows(decontaminate.without_contaminated(odd_docs(spark), items)) == rows(odd_docs(spark))
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert rows(decontaminate.contaminated(empty_docs(spark), some)) == []


def test_shuffle_join_beyond_the_broadcast_bound(spark, monkeypatch):
    want = rows(QUERIES["op9_benchmark_decontamination"](spark, SF_SMALL))
    monkeypatch.setattr("tillmart.llm.common.BROADCAST_ROWS", 0)
    assert rows(QUERIES["op9_benchmark_decontamination"](spark, SF_SMALL)) == want
    assert rows(QUERIES["op3_host_quality"](spark, SF_SMALL)) != []


def test_items_that_share_an_id_or_have_none(spark):
    text = lambda name, n: " ".join(f"{name}{j}" for j in range(n))
    items = [(1, text("a", 20)), (1, text("b", 20)), (1, text("b", 20)), (2, text("c", 30))]
    items += [(None, text(f"n{i}x", 12)) for i in range(9)]
    docs = [(1, "x " + text("a", 20) + " y"), (2, text("b", 20)), (3, text("c", 30)), (4, text("n7x", 12) + " z"), (5, "clean words only in this text")]
    docs += [(6, text("a", 20) + " " + text("b", 18))]
    given = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = [(1, 1, 16, 16, 1.0), (2, 1, 16, 16, 1.0), (3, 2, 26, 26, 1.0), (4, None, 8, 8, 1.0), (6, 1, 16, 16, 1.0)]
    assert rows(decontaminate.contaminated(given, bench)) == sorted(want, key=repr)
    assert rows(decontaminate.without_contaminated(given, bench), "doc_id") == [(5,)]


def test_items_of_few_words(spark):
    docs = [(1, "he said: Hello, world again"), (2, "hello big world"), (3, "yes"), (4, "no four words in it"), (5, "漢字 一句話"), (None, "YES and hello world")]
    items = [(1, "hello world"), (2, "Yes!"), (3, "four words in it"), (4, "一句話"), (5, "four words in it now"), (6, "..."), (None, "hello world")]
    given, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = rows(decontaminate.contaminated(with_clashes(given), bench), "doc_id", "item_id")
    pairs = [(1, 1), (1, None), (3, 2), (4, 3), (5, 4), (None, 1), (None, 2), (None, None)]
    assert got == sorted(pairs, key=repr)
    assert rows(decontaminate.without_contaminated(given, bench), "doc_id") == [(2,)]


def test_a_phrase_that_all_items_share(spark):
    """Many documents and items open with one phrase: the pairs to verify are those that may match."""
    phrase = "answer the following question with one word only"
    tail = lambda name: " ".join(f"{name}t{j}" for j in range(12))
    items = [(i, f"{phrase} {tail(f'i{i}')}") for i in range(300)]
    docs = [(i, f"{phrase} {tail(f'd{i}' if i % 10 else f'i{i}')}") for i in range(300)]
    given, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    known = decontaminate.staged(decontaminate.item_texts(bench), "test-items")
    pairs = decontaminate.candidate_pairs(given, decontaminate.staged(decontaminate.signatures(known), "test-sketch"), [5])
    assert pairs.count() == 30
    assert rows(decontaminate.contaminated(given, bench), "doc_id", "item_id") == sorted(((i, i) for i in range(0, 300, 10)), key=repr)


def test_items_against_the_sql(spark):
    """The oracle on rows with repeated and null ids, copies and short items."""
    import duckdb
    import pandas as pd

    text = lambda name, n: " ".join(f"{name}{j}" for j in range(n))
    items = [(1, text("a", 20)), (1, text("b", 30)), (2, text("a", 20)), (None, text("c", 9)), (None, "short one"), (3, None), (3, "short one")]
    docs = [(1, text("a", 19) + " short one"), (1, text("b", 30)), (None, text("c", 9)), (None, None), (2, text("b", 25)), (2, text("b", 26)), (2, text("b", 26))]
    got = rows(decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    con = duckdb.connect()
    frame = lambda data, key: pd.DataFrame({key: pd.array([d[0] for d in data], "Int64"), "text": pd.array([d[1] for d in data], "string")})
    con.register("documents", frame(docs, "doc_id"))
    con.register("benchmark", frame(items, "item_id"))
    assert got == sorted(con.execute(decontaminate.oracle()).fetchall(), key=repr) and len(got) > 5
