"""The conversation trie against brute force, its merge, and its edge cases."""

import collections
import hashlib
import itertools
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from aquifer.llm import common, trie

SCHEMA = "conv_id long, turn long, role string, text string, rank long, key string, pos long, kind string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def chats(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", 2, "x") for r in rows], SCHEMA)


def own(rows):
    turns = collections.defaultdict(list)
    for c, k, role, text in rows:
        if c is not None:
            turns[c].append(((k is not None, k or 0), role or "", text or ""))
    return {c: [t[1:] for t in sorted(ts, key=lambda t: (t[0], t[1].encode(), t[2].encode()))] for c, ts in turns.items()}


def rebuilt(rows):
    of = own(rows)
    out = {}
    for c, ts in of.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = of.get(c - int(math.fmod(c, 20)), [])[:h] + ts[h:]
    return out


def brute(of):
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, ts in of.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    children = collections.Counter(s[:-1] for s in members if s)
    leaves, saved = collections.Counter(), collections.Counter()
    for s, cs in members.items():
        w = len([x for x in s[-1][1].translate({k: " " for k in (9, 10, 11, 12, 13)}).split(" ") if x]) if s else 0
        for d in range(len(s) + 1):
            leaves[s[:d]] += not children[s]
            saved[s[:d]] += (len(cs) - 1) * w
    hashed = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return collections.Counter((min(cs), len(s), min(members[s[:-1]]) if s else None, len(cs), children[s], leaves[s], saved[s], hashed(ends[s])) for s, cs in members.items())


def got(df):
    return collections.Counter(tuple(r[c] for c in NAMES) for r in df.collect())


def some(seed, n=60, most=9):
    rnd = random.Random(seed)
    vocab = ["a b", "", None, "é  日 本", "x\ny\x85z", "A"]
    stem = [("user", rnd.choice(vocab)) for _ in range(most)]
    rows = []
    for c in [*range(n), *rnd.sample(range(1000, 9000), n // 3), -7, -20, 0]:
        turns = stem[: rnd.randint(0, most)] + [(rnd.choice(["user", "bot", None]), rnd.choice(vocab)) for _ in range(rnd.randint(1, 3))]
        rows += [(c, None if rnd.random() < 0.1 else k, *t) for k, t in enumerate(turns)]
    return [*rows, (None, 1, "user", "no conversation"), (5, 1, "user", "a b"), (5, 1, "user", "a b")]


def built(spark, rows, **sizes):
    return got(trie.build(*trie.rebuilt(chats(spark, rows)), **sizes))


@pytest.mark.parametrize("sizes", [{}, {"run": 300, "size": 700}, {"span": 3, "run": 500, "size": 900}, {"span": 1}])
def test_bruteforce(spark, sizes):
    rows = some(1)
    random.Random(2).shuffle(rows)
    assert built(spark, rows, **sizes) == brute(rebuilt(rows))


def test_conversations_as_they_are(spark):
    rows = some(4)
    assert got(trie.nodes(chats(spark, rows).repartition(3))) == brute(own(rows))


def test_many_alike_spread_over_ranges(spark):
    """A third of all conversations are alike, another third share a first turn; no range holds all of them."""
    rows = [(c, k, "user", "same" if c % 3 == 0 or c % 3 == 1 and k == 0 else f"t{c}") for c in range(0, 6000, 20) for k in range(3)]
    chat = chats(spark, rows)
    turns, convs = trie.rebuilt(chat)
    assert got(trie.build(turns, convs, size=4000)) == brute(rebuilt(rows))
    records = trie._segments(turns, convs, 1024).select(F.lit(b"").alias("cls"), "conv", F.lit(False).alias("more"), "turns", "bytes")
    parts = trie._round(records, 0, 1000, 4000).where(F.col("kind") == trie.SEAM).groupBy("part").agg(F.max("n_convs").alias("n")).collect()
    assert len(parts) > 5 and max(r.n for r in parts) < len(rows) / 3 / 4


@pytest.mark.parametrize("span", [4, 1024])
def test_long_conversations_that_share_long_beginnings(spark, span):
    rows = [(c, k, "u", f"t{k}" if k < n else f"{c}:{k}") for c, n, m in ((100, 30, 30), (200, 30, 45), (300, 17, 60), (400, 0, 50), (500, 12, 12), (600, 8, 9)) for k in range(m)]
    assert got(trie.nodes(chats(spark, rows)) if span == 1024 else trie.build(*as_they_are(spark, rows), span=span)) == brute(own(rows))


def as_they_are(spark, rows):
    of = own(rows)
    turns = [(c, k, *t, len(ts)) for c, ts in of.items() for k, t in enumerate(ts)]
    return spark.createDataFrame(turns, "conv long, pos long, role string, body string, m long"), spark.createDataFrame([(c, len(ts)) for c, ts in of.items()], "conv long, m long")


def test_a_conversation_without_turns_and_one_that_goes_on_alone(spark):
    turns, convs = as_they_are(spark, [(1, k, "u", f"t{k}") for k in range(9)] + [(2, k, "u", f"t{k}") for k in range(3)])
    convs = convs.unionAll(spark.createDataFrame([(3, 0)], "conv long, m long"))
    of = {1: [("u", f"t{k}") for k in range(9)], 2: [("u", f"t{k}") for k in range(3)], 3: []}
    for span in (2, 3, 4, 100):
        assert got(trie.build(turns, convs, span=span)) == brute(of)


def test_the_merge_skips_what_is_shared():
    """The stream is in order, its LCPs are right, and no turn that both records share with the last one is looked at again."""
    rnd = random.Random(3)
    looked = collections.Counter()

    class Turn:
        def __init__(self, x):
            self.x = x

        def __eq__(self, other):
            looked["eq"] += 1
            return self.x == other.x

        def __lt__(self, other):
            return self.x < other.x

        def __le__(self, other):
            return self.x <= other.x

    for n in (1, 2, 5, 8):
        records = [(tuple(Turn(0) for _ in range(40)) + tuple(Turn(rnd.randint(0, 1)) for _ in range(rnd.randint(0, 4))), c, False) for c in range(200)]
        plain = lambda r: (tuple(t.x for t in r[0]), r[1])
        runs = [sorted(records[k::n], key=plain) for k in range(n)]
        carried = [[(r, trie.shared(a[0], r[0]) if a else 0) for a, r in itertools.zip_longest([None, *run[:-1]], run)] for run in runs]
        looked.clear()
        out = list(trie.merged(carried))
        assert looked["eq"] < 40 * n + 4 * 200 * 8
        assert [plain(r) for r, _ in out] == sorted(map(plain, records))
        assert [k for _, k in out[1:]] == [trie.shared(a[0], b[0]) for (a, _), (b, _) in itertools.pairwise(out)]


def test_ranks_without_numbers_that_tell_turns_apart(spark):
    """Times as turns, and no number at all: ranks are whole, and a long group lies in several ranges."""
    rnd = random.Random(1)
    rows = [(c, None if c == 2 else rnd.getrandbits(40), "u", f"{rnd.random()}") for c in (1, 2, 3) for _ in range(500 if c < 3 else 3)]
    df = spark.createDataFrame(rows, "c long, turn long, role string, body string").repartition(3)
    out, sizes = common.ranked(df, "c", ["turn", "role", "body"], [F.col("turn"), F.substring("body", 1, 32)], "test")
    assert {r.c: r.n for r in sizes.collect()} == {1: 500, 2: 500, 3: 3}
    for c in (1, 2, 3):
        found = [(r.turn, r.role, r.body) for r in sorted(out.where(F.col("c") == c).collect(), key=lambda r: r["rank"])]
        assert found == sorted([r[1:] for r in rows if r[0] == c], key=lambda r: (r[0] or 0, r[1:])) and len(found) == (500 if c < 3 else 3)


def test_a_very_long_text(spark):
    rows = [(c, k, "u", "word " * 200_000 if k == 0 else "b") for c in (20, 40) for k in range(2)]
    assert built(spark, rows) == brute(rebuilt(rows))


def test_no_rows(spark):
    assert built(spark, []) == {}
    assert built(spark, [(None, 1, "u", "x")]) == {}
