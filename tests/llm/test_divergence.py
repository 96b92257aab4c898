"""The audit of sources against brute force, and its edge cases."""

import collections
import random
import re

from pyspark.sql import functions as F

from aquifer.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, vector string, v string, n string"


def docs(spark, rows):
    return spark.createDataFrame([(k, t, la, so, "a", "b", "c", "d") for k, (t, la, so) in enumerate(rows)], SCHEMA)


def terms(t):
    return re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(rows, least=10, top=10):
    rows = [tuple(x or "" for x in r) for r in rows]
    out = set()
    for lang in {la for _, la, _ in rows}:
        own = [(terms(t), so) for t, la, so in rows if la == lang]
        df = collections.Counter(w for t, _ in own for w in set(t))
        kept = [w for w, k in df.items() if k >= least]
        v = len(kept)
        count = collections.defaultdict(collections.Counter)
        for t, so in own:
            count[so].update(w for w in t if df[w] >= least)
        total = {so: sum(c.values()) for so, c in count.items()}
        p = lambda n, t: 1 + 10**9 * (n + 2) // (t + 2 * v)  # noqa: E731,B023
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for so in count:
            values = {o: sum(f(p(count[so][w], total[so]), p(count[o][w], total[o])) for w in kept) for o in count if o != so}
            for r, (o, x) in enumerate(sorted(values.items(), key=lambda x: (-x[1], x[0].encode()))):
                out.add((lang, so, "pair", o, x, r + 1))
            values = {}
            for w in kept:
                a, q = p(count[so][w], total[so]), p(sum(c[w] for c in count.values()), sum(total.values()))
                if count[so][w] and a > q:
                    values[w] = f(a, q)
            for r, (w, x) in enumerate(sorted(values.items(), key=lambda x: (-x[1], x[0].encode()))[:top]):
                out.add((lang, so, "term", w, x, r + 1))
    return out


def some(seed, n=300):
    rnd = random.Random(seed)
    vocab = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(80)] + ["é", "ÉT", "日本", "𐐀", "ab1cd", "Don't", "ß\x85x"]
    rows = []
    for _ in range(n):
        so = rnd.choice(["a", "b", "c", "é", None, ""])
        bias = {"a": 20, "b": 60}.get(so, len(vocab))
        rows.append((" ".join(rnd.choices(vocab[:bias], k=rnd.randint(0, 30))), rnd.choice(["en", "de", None]), so))
    return [*rows, (None, "en", "no text"), ("", "fr", "alone"), ("once only", "it", "x"), ("123", "it", "y"), *[("same same", "en", "copies")] * 40, *[("only here", "ja", "z")] * 10, ("the " * 50_000 + "end", "en", "a")]


def got(df):
    rows = df.collect()
    out = {tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in rows}
    assert len(out) == len(rows)
    return out


def test_bruteforce(spark):
    for seed in range(2):
        rows = some(seed)
        assert got(divergence.audit(docs(spark, rows).repartition(4))) == brute(rows)
    assert got(divergence.audit(docs(spark, rows), least=1, top=3)) == brute(rows, 1, 3)


def test_small_tables_of_counts_give_the_same(spark):
    df = docs(spark, some(5))
    read = lambda e: {(r.lang, r.term and bytes(r.term), tuple(map(tuple, r.vector))) for r in divergence.counts(df, entries=e).collect()}
    assert read(1) == read(200_000)


def test_terms_of_one_vector_are_one(spark):
    """Fifty terms with equal counts are evaluated once, and only the first ten are looked at."""
    rows = [(" ".join(f"t{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(50)) + (" x" * (k % 3)), "en", f"s{k % 2}") for k in range(20)]
    kept = divergence.counts(docs(spark, rows))
    found = {r.m: r.terms for r in divergence.vectors(kept, 10).collect()}
    assert set(found) == {50, 1} and len(found[50]) == 10 and found[50] == sorted(found[50])
    assert got(divergence.audit(docs(spark, rows))) == brute(rows)


def test_shares_of_large_counts(spark):
    cases = [(0, 0, 1), (10**12, 10**15, 10**9), (9 * 10**14, 9 * 10**14, 1), (7, 10**13, 123_456_789), (5, 5, 0)]
    df = spark.createDataFrame(cases, "n long, t long, v long").select(divergence.share(F.col("n"), F.col("t"), F.col("v")).alias("p"))
    assert [r.p for r in df.collect()] == [1 + 10**9 * (n + 2) // max(1, t + 2 * v) for n, t, v in cases]


def test_no_rows(spark):
    assert divergence.audit(docs(spark, [])).collect() == []
