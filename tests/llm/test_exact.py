"""Grace deduplication against brute force, and its edge cases."""

import collections
import hashlib
import random
import re

import pytest

from aquifer.llm import exact

SCHEMA = "doc_id long, text string, lang string, sha string, keep_id string, row string, n string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "x", "y", "z", None) for i, t in rows], SCHEMA)


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute(rows):
    """doc_id, keep_id, group_size, kept and hash of each row, as a multiset."""
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    out = collections.Counter()
    for t, ids in groups.items():
        top = max(ids, key=lambda i: (i is not None, i))
        left = True
        for i in ids:
            out[(i, top, len(ids), left and i == top, hashlib.sha256(t.encode()).hexdigest())] += 1
            left = left and i != top
    return out


def rows_of(df):
    return collections.Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect())


def some(seed, n=400):
    rnd = random.Random(seed)
    texts = [" ".join(rnd.choices("aB cD é ß 日本 X".split(), k=rnd.randint(0, 4))) for _ in range(n)]
    return [*enumerate(texts), (9, texts[9]), (9, texts[9]), (None, texts[9]), (None, "only here"), (None, "only here"), (1001, None), (1002, ""), (1003, "x" * 300_000), (1004, "X" * 300_000)]


@pytest.mark.parametrize(("room", "bucket"), [(exact.ROOM, exact.BUCKET), (1, 200), (700, 100_000), (3000, 2000)])
def test_bruteforce_at_every_room(spark, room, bucket):
    rows = some(room)
    random.Random(1).shuffle(rows)
    got = exact.deduplicate(docs(spark, rows).repartition(5), room=room, bucket=bucket)
    assert rows_of(got) == brute(rows)


def test_a_group_of_a_third_of_all_rows(spark):
    rows = [(k, "Hot text" if k % 3 == 0 else f"t{k}" if k % 3 == 1 else f"t{k // 6}") for k in range(6000)] + [(5997, "hot text")] * 3
    assert rows_of(exact.deduplicate(docs(spark, rows).repartition(7))) == brute(rows)


def test_what_spills_is_dealt_again(spark, monkeypatch):
    """Only records without room go on, and equal ones together."""
    seen = []
    keep = exact.written
    monkeypatch.setattr(exact, "written", lambda df, tag: seen.append(tag) or keep(df, tag))
    rows = [(k, f"{k % 50:03d}" * 100) for k in range(200)]
    assert rows_of(exact.deduplicate(docs(spark, rows), room=4000, bucket=1 << 30)) == brute(rows)
    assert len(seen) > 3 and seen[:2] == ["grace-0", "grace-1"]


def test_texts_with_one_hash_are_told_apart():
    table = exact.Texts(1 << 20)
    for k in range(1000):
        assert table.add(k % 3, b"%d" % (k % 100), 1, k)
    found = dict(zip(table.texts, zip(table.counts, table.largest, strict=True), strict=True))
    assert len(table) == 300 and sum(n for n, _ in zip(table.counts, table.texts, strict=True)) == 1000
    assert max(n for n, _ in found.values()) <= 4


def test_unique_gives_rows_as_they_came(spark):
    rows = some(3)
    df = docs(spark, rows)
    out = exact.unique(df)
    assert out.columns == df.columns
    got = collections.Counter(map(tuple, out.collect()))
    want = {(k[0], k[4]) for k in brute(rows) if k[3]}
    assert len(want) == sum(got.values()) == len({lower(t) for _, t in rows})
    assert {(r[0], hashlib.sha256(lower(r[1]).encode()).hexdigest()) for r in got} == want


def test_ids_that_are_texts(spark):
    rows = [("b", "x"), ("é", "X"), ("a", "x"), (None, "x"), ("c", "y")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    assert {r.doc_id: (r.keep_id, r.kept) for r in exact.deduplicate(df).collect()} == {"b": ("é", False), "é": ("é", True), "a": ("é", False), None: ("é", False), "c": ("c", True)}


def test_no_rows(spark):
    assert exact.deduplicate(docs(spark, [])).collect() == []
    assert exact.unique(docs(spark, [])).collect() == []
