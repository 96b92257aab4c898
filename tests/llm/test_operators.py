"""The training-data operators against brute force, and their edge cases."""

import collections
import hashlib
import math
import pickle
import random
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from aquifer.llm import chat, decontaminate, langid, mixing, quality, queries, rules, simhash, substrings, tokens, toxicity

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, fp string, row string"


def docs(spark, texts, ids=None):
    """Documents with columns whose names the operators use themselves."""
    rows = [(i, t, "en", f"s{(i or 0) % 2}", None, "x", None, "r") for i, t in zip(ids or range(len(texts)), texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def some_texts(seed=0, n=40):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    passage = " ".join(rnd.choices(vocab, k=60))
    out = [None, "", " \n\t ", "one", "A b C", "é ß 日本 x"]
    for i in range(n):
        t = " ".join(rnd.choices(vocab, k=rnd.randint(1, 120)))
        if i % 3 == 0:
            t = t + "\n" + passage
        out.append(t if i % 7 else t + "\n" + t)
    return out + out[6:10] + [passage + " " + passage]


def words(t):
    return [w for w in re.split("[ \t-\r]+", t or "") if w]


def brute_repeats(texts, n=20, ids=None):
    """Words covered by windows that start earlier, by row; ids order the texts."""
    seen, gone = {}, collections.defaultdict(set)
    for i, t in sorted(enumerate(texts), key=lambda x: x[0] if ids is None else ids[x[0]]):
        w = words(t)
        for a in range(len(w) - n + 1):
            if seen.setdefault(tuple(w[a : a + n]), (i, a)) != (i, a):
                gone[i].update(range(a, a + n))
    return gone


def test_simhash_bruteforce(spark):
    texts = some_texts() + [some_texts()[9] + " tail"]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs(spark, texts)).collect()}
    fps = []
    for t in texts:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sh = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    root = list(range(len(texts)))
    for _ in root:
        for i in range(len(fps)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= 4:
                    root[i] = root[j] = min(root[i], root[j])
    assert got == {i: (f"{fps[i]:016x}", root[i]) for i in range(len(texts))}


def test_simhash_links_cover_every_distance(spark):
    rnd = random.Random(5)
    fps = set()
    for _ in range(60):
        base = rnd.getrandbits(64)
        fps |= {base} | {base ^ sum(1 << b for b in rnd.sample(range(64), k)) for k in (1, 2, 3, 4, 5)}
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    got = {(r.u, r.v) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    assert got == {(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4}


def test_simhash_links_grow_with_a_group_of_near_copies_not_its_square(spark):
    """A dense group gives links in proportion to its size, in any pieces, and the components of all pairs."""
    rnd = random.Random(12)
    base, fps = rnd.getrandbits(64), {rnd.getrandbits(64) for _ in range(300)}
    fps |= {base ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 6))) for _ in range(500)}
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    root = {f: f for f in signed}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    pairs = [(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4]
    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    want = {f: find(f) for f in {x for p in pairs for x in p}}
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for piece in (simhash.PIECE, 40):
        got = [(r.u, r.v) for r in simhash.spanning(df, piece=piece).collect()]
        assert set(got) <= set(pairs) and len(got) == len(set(got))
        assert {r.node: r.root for r in simhash.components(spark.createDataFrame(got, "u long, v long")).collect()} == want
    near = [base ^ 1 << i ^ 1 << j for i in range(64) for j in range(i)]
    rnd.shuffle(near)
    made = [simhash.spanning(spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in near[:n]], "fp long")).count() for n in (500, 1000)]
    assert made[1] < 2.5 * made[0] and made[1] < 1000 * 999 / 2 / 10  # all pairs of these are links


def test_near_dedup_of_the_pipeline_joins_no_pairs(spark, monkeypatch):
    """The stage keeps one row of each group without the join of all pairs of a cell."""
    import corpus_pipeline

    def pairs(*_):
        raise AssertionError("all pairs of a cell are joined")

    monkeypatch.setattr(simhash, "neighbours", pairs)
    text = " ".join(f"w{i}" for i in range(200))
    df = docs(spark, [text, text, "another text of a few words", None])
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()} == {0, 2, 3}


def test_simhash_candidates_are_few(spark):
    rnd = random.Random(9)
    for n in (1000, 2000):
        fps = spark.createDataFrame([(rnd.getrandbits(64) - (1 << 63),) for _ in range(n)], "fp long").distinct()
        assert simhash.candidates(fps, 4).count() < n * n / 2 * 2e-4
    out = simhash.candidates(fps, 4)
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_simhash_manhattan_distance_bounds_from_below(spark):
    rnd = random.Random(6)
    pairs = [(a, a ^ sum(1 << b for b in rnd.sample(range(64), k))) for k in range(0, 12) for a in [rnd.getrandbits(64) for _ in range(40)]] + [(0, (1 << 64) - 1), (rnd.getrandbits(64), rnd.getrandbits(64))]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    got = spark.createDataFrame([(signed(a), signed(b)) for a, b in pairs], "a long, b long").select("a", "b", simhash.manhattan(F.col("a"), F.col("b")).alias("d")).collect()
    counts = lambda x: [(x >> k & 3).bit_count() for k in range(0, 64, 2)]
    for (a, b), r in zip(pairs, got, strict=True):
        assert r.d == sum(abs(x - y) for x, y in zip(counts(a), counts(b), strict=True)) <= (a ^ b).bit_count()


def test_simhash_points_leave_few_to_verify(spark):
    """Of neighbours in the grid most are told apart by their points."""
    rnd = random.Random(7)
    fps = spark.createDataFrame([(rnd.getrandbits(64) - (1 << 63),) for _ in range(6000)], "fp long").distinct()
    near, left = simhash.neighbours(fps, 4).count(), simhash.candidates(fps, 4).count()
    assert near < 6000**2 / 2 * 3e-5 and left <= near / 50


def test_first_of_each_does_not_depend_on_arrival(spark):
    t = some_texts()
    rows = [(5, t[9], lang, src, 1, "x", None, "r") for lang in ("en", "de", None) for src in ("a", "b", None)] + [(None, t[9], "fr", "a", 2, "x", None, "r")] * 3
    got = set()
    for k in range(4):
        random.Random(k).shuffle(rows)
        out = simhash.first_of_each(spark.createDataFrame(rows, SCHEMA).repartition(1 + k)).collect()
        assert len(out) == 1 and out[0].doc_id == 5
        got.add(tuple(out[0]))
    assert len(got) == 1


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 30)] + [(40, 50)], "u long, v long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {i: 1 for i in range(1, 31)} | {40: 40, 50: 40}


def test_tokens_equal_the_library(spark):
    library = pytest.importorskip("tokenizers")
    path = VOCABULARY
    texts = [*some_texts(), "a<|endoftext|>b İΣ café don't ²³ Ⅷ 日本 \x85​!!!'s", "x" * 5000, "<|startoftext|>"]
    own = library.Tokenizer.from_file(path)
    got = {r.doc_id: r for r in tokens.token_counts(docs(spark, texts), path).collect()}
    for i, t in enumerate(texts):
        assert got[i].n_tokens == len(own.encode(t or "", add_special_tokens=False).ids) and got[i].n_bytes == len((t or "").encode())
        assert got[i].over_limit == (got[i].n_tokens > 2048)


def test_tokens_of_every_kind_of_character():
    library = pytest.importorskip("tokenizers")
    own, count = library.Tokenizer.from_file(VOCABULARY), tokens.Counter(tokens.load(VOCABULARY)).count
    codes = [*range(0x3100), *range(0x3100, 0x110000, 23), *range(0xA640, 0xA800), *range(0x11D00, 0x11E00), *range(0x18E70, 0x18E90)]
    codes = [c for c in codes if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}1{chr(c)}2! e{chr(c)}'{chr(c)}s '{chr(c)}" for c in codes]
    rnd = random.Random(11)
    texts += ["".join(chr(rnd.choice(codes)) for _ in range(rnd.randint(1, 30))) for _ in range(4000)]
    texts += ["".join(rnd.choice("aé\u0301\u0323oΣσ'S1 \u3099か\u1100\u1161") for _ in range(20)) for _ in range(4000)]
    want = [len(e.ids) for e in own.encode_batch(texts, add_special_tokens=False)]
    assert [t for t, n in zip(texts, want, strict=True) if count(t) != n] == []


def test_substrings_bruteforce(spark):
    texts = some_texts(3)
    gone = brute_repeats(texts)
    for df in (docs(spark, texts), docs(spark, texts).repartition(7)):
        got = {r.doc_id: r for r in substrings.dedup(df, keep=True).collect()}
        for i, t in enumerate(texts):
            kept = [x for p, x in enumerate(words(t)) if p not in gone[i]]
            assert (got[i].n_words, got[i].n_removed) == (len(words(t)), len(gone[i]))
            assert got[i].kept_sha256 == hashlib.sha256(" ".join(kept).encode()).hexdigest() and words(got[i].kept_text) == kept and got[i].row.row == "r"


@pytest.mark.parametrize("bits", [64, 40, 2, 0])
def test_windows_are_told_apart_by_their_words(monkeypatch, bits):
    real = substrings.gram_hashes  # contents that agree in all but a few bits
    monkeypatch.setattr(substrings, "gram_hashes", lambda h, n: real(h, n) & np.uint64((1 << bits) - 1))
    texts = [t for t in some_texts(3) if len(words(t)) >= 20]
    plain = [" ".join(words(t)).encode() for t in texts]
    data = b" ".join(plain)
    lengths = [len(words(t)) for t in texts]
    at = np.concatenate([np.arange(n - 19) + sum(lengths[:i]) for i, n in enumerate(lengths)])
    src = substrings.settle(data, substrings.word_hashes(np.frombuffer(data, np.uint8)), at, 20)
    flat, first = data.split(), {}
    assert src.tolist() == [first.setdefault(tuple(flat[a : a + 20]), i) for i, a in enumerate(at.tolist())]


def test_an_anchor_over_many_batches_keeps_its_first_windows():
    rnd = random.Random(6)
    tail = [" ".join(rnd.choices("abcdefgh", k=21)) for _ in range(5)]
    rows = [(7, i, i, -i, 0, 2, tail[i % 5].encode()) for i in range(40)] + [(9, 50, 50, 50, 3, 4, None)]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    whole = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], substrings.SPANS)
    want = sorted([(i, -i, 0, 2) for i in range(5, 40)] + [(50, 50, 3, 4)])
    for size in (1, 3, 100):
        out = substrings._repeats(20)(iter([whole.slice(a, size) for a in range(0, len(rows), size)]))
        assert sorted(tuple(r.values()) for b in out for r in b.to_pylist()) == want


def test_repeats_inside_one_run_of_windows(spark):
    texts = ["a " * n for n in (20, 21, 33, 60)] + ["a b " * n for n in (11, 40)] + [" ".join(f"{k}" for k in range(p)) + " " + " ".join(f"{k}" for k in range(p)) + " z" for p in (12, 13, 14, 25)]
    for i, t in enumerate(texts):  # each alone: nothing but itself repeats it
        for most in (500_000, 0):
            assert substrings.dedup(docs(spark, [t]), most=most).first().n_removed == len(brute_repeats([t])[0]), i


def test_words_of_long_texts(monkeypatch):
    text = " ".join(some_texts(1)[6:] + ["x" * 3000, "y"]).encode()
    whole = substrings.word_hashes(np.frombuffer(text, np.uint8))
    monkeypatch.setattr(substrings, "SEGMENT", 500)
    pieces = substrings.word_hashes(np.frombuffer(text, np.uint8))
    assert all((a == b).all() for a, b in zip(whole, pieces)) and len(whole[0]) == len(text.split())


def test_split_anchors_change_no_result(spark):
    rnd = random.Random(4)
    line = " ".join(f"l{i}" for i in range(12))
    df = docs(spark, some_texts(3) + [" ".join(f"u{rnd.random()}" for _ in range(15)) + "\n" + line + "\n" + " ".join(f"u{rnd.random()}" for _ in range(15)) for _ in range(30)]).repartition(5)
    plain = df.select(F.xxhash64("doc_id", "text").alias("key"), F.col("text").cast("binary").alias("t"))
    wide = substrings.wide_anchors(plain, 8, 20, 30)
    assert len(wide) and not len(substrings.wide_anchors(plain, 8, 20, 500_000))
    ways = [sorted(map(tuple, substrings.dedup(df, most=most).collect())) for most in (30, 0, 500_000)]
    assert ways[0] == ways[1] == ways[2] and any(r[2] for r in ways[0])
    # a hot anchor's windows are dealt by their content
    text = (" ".join(f"a{i}" for i in range(15)) + " " + line + " " + " ".join(f"b{i}" for i in range(15))).encode()
    h = substrings.word_hashes(np.frombuffer(text, np.uint8))[2]
    common = substrings.window_seeds(h, 8, 20, wide[:0])[0]
    assert len(set(substrings.window_seeds(h, 8, 20, common)[0].tolist())) == len(common)


def test_substrings_of_any_id_and_shuffled_once(spark):
    texts = some_texts(3)
    ids = [f"{chr(97 + i % 26)}é{i}" for i in range(len(texts))]
    df = spark.createDataFrame(list(zip(ids, texts)), "name string, body string").repartition(6)
    gone = brute_repeats(texts, ids=ids)
    out = substrings.dedup(df, "name", "body")
    got = {r["name"]: r.n_removed for r in out.collect()}
    assert got == {k: len(gone[i]) for i, k in enumerate(ids)}
    out = substrings.dedup(df, "name", "body", keep=True)
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_decontamination_bruteforce(spark):
    rnd = random.Random(1)
    vocab = [f"v{i}" for i in range(30)]
    bench = [(k, " ".join(rnd.choices(vocab, k=n))) for k, n in enumerate((25, 12, 3, 10))] + [(9, ""), (10, None)]
    texts = [None, "", "x"] + [" ".join(rnd.choices(vocab, k=80)) + ". " + bench[i % 4][1].upper() + " " + rnd.choice(vocab) for i in range(8)]
    cut = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]
    for block in (8 << 20, 40):
        got = {r.doc_id: r for r in decontaminate.matches(docs(spark, texts), spark.createDataFrame(bench, "item_id long, text string"), block_bytes=block).collect()}
        for i, t in enumerate(texts):
            w, hit, items = cut(t), set(), set()
            for k, b in bench:
                v = cut(b)
                n = min(10, len(v))
                for a in range(len(v) - n + 1 if v else 0):
                    for p in range(len(w) - n + 1):
                        if w[p : p + n] == v[a : a + n]:
                            hit.update(range(p, p + n))
                            items.add(str(k))
            r = got[i]
            assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(w), len(hit), len(items), bool(hit))
            assert r.items_sha256 == hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
            assert (r.match_at >= 0) == bool(hit)
            if hit:  # the longest verbatim match with any item from a hit window on
                def reach(p, v, a):
                    n = 0
                    while p + n < len(w) and a + n < len(v) and w[p + n] == v[a + n]:
                        n += 1
                    return n
                whole = [(reach(p, v, a), min(10, len(v)), str(k), p) for k, v in ((k, cut(b)) for k, b in bench) for a in range(len(v)) for p in range(len(w))]
                most = max(n for n, least, _, _ in whole if n >= least)
                assert (r.longest_match, r.match_item, r.match_at) in [(n, k, p) for n, least, k, p in whole if n == most]


def test_decontamination_of_long_items(spark):
    rnd = random.Random(3)
    texts = {"a": " ".join(f"w{rnd.randrange(50_000)}" for _ in range(100_000)), "b": "x " * 100_000, "c": "the"}
    tracemalloc.start()
    probes = [decontaminate.Probe([(k, t.encode())], 10) for k, t in texts.items()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20 and len(pickle.dumps(probes)) < 40 << 20
    whole = texts["a"].split()
    df = docs(spark, [texts["a"], " ".join(["q", *whole[500:60_000], "z"]), "the x " * 3000, "x " * 50_000, "q " * 50_000])
    for block in (4 << 20, 1000):  # one block, or one for each item
        got = {r.doc_id: r for r in decontaminate.matches(df, spark.createDataFrame(list(texts.items()), "item_id string, text string"), block_bytes=block).collect()}
        assert [(got[i].n_hit, got[i].n_items, got[i].longest_match, got[i].match_at) for i in range(5)] == [(100_000, 1, 100_000, 0), (59_500, 1, 59_500, 1), (3000, 1, 1, 0), (50_000, 1, 50_000, 0), (0, 0, 0, -1)]


def test_suffix_arrays_of_shards():
    """The shard's array is in order, every window is found at all its places, and each place has its longest match, also by a block from a file."""
    rnd = random.Random(0)
    for _ in range(150):
        vocab = [f"v{i}" for i in range(rnd.choice([2, 4, 30]))]
        bench = [(str(k), " ".join(rnd.choices(vocab, k=rnd.choice([0, 1, 3, 5, 12, 25])))) for k in range(rnd.randint(1, 5))]
        probe = pickle.loads(pickle.dumps(decontaminate.Probe([(k, t.encode()) for k, t in bench], rnd.choice([2, 4, 10]))))
        w = [x for _ in range(3) for x in [*rnd.choices([*vocab, "q"], k=rnd.randint(0, 60)), None]]
        text = decontaminate.Sequence(np.array([probe.vocabulary.get((x or "").encode(), 0) for x in w], np.int64))
        array = probe.shard(text)
        after = [text.ids[p : p + text.run[p]].tolist() for p in array]
        assert after == sorted(after)
        number, at, n = probe.search(text, array)
        items = [t.split() for _, t in bench if t]
        windows = [v[a : a + m] for v in items for m in [min(probe.window, len(v))] for a in range(len(v) - m + 1)]
        assert {(p, len(x)) for x in windows for p in range(len(w)) if w[p : p + len(x)] == x} == set(zip(at.tolist(), n.tolist(), strict=True))
        for m in np.unique(n):
            places = np.unique(at[n == m])
            for p, k, to in zip(places, *probe.longest(text, array, np.unique(number[n == m]), places), strict=True):
                reach = lambda v, a, p=p: next((x for x in range(len(v) - a) if p + x >= len(w) or v[a + x] != w[p + x]), len(v) - a)
                own = [reach(v, a) for v in items if min(probe.window, len(v)) == m for a in range(len(v))]
                assert k == max(x for x in own if x >= m) and (text.ids[p : p + k] == probe.text.ids[to : to + k]).all()


def test_decontamination_by_forty_blocks(spark):
    """Blocks are built in tasks and read from their files; many give what one gives."""
    rnd = random.Random(9)
    vocab = [f"v{i}" for i in range(500)]
    bench = spark.createDataFrame([(k, " ".join(rnd.choices(vocab, k=40))) for k in range(200)], "item_id long, text string")
    texts = [" ".join(rnd.choices(vocab, k=30)) + " " + " ".join(r.text.split()[k % 20 :]) for k, r in enumerate(bench.collect())]
    files = decontaminate.blocks(bench, "item_id", "text", 10, 1200)
    assert 20 < len(files) <= 40 and sum(len(p.names) for p in decontaminate.opened(files)) == 200
    one, many = (sorted(map(tuple, decontaminate.matches(docs(spark, texts), bench, block_bytes=b).collect())) for b in (4 << 20, 1200))
    assert one == many and all(r[3] == 1 and r[6] >= 20 for r in one)


def test_mixing_budgets_and_reruns(spark):
    df = docs(spark, some_texts()).withColumn("source", F.when(F.col("doc_id") % 11 == 0, None).otherwise(F.concat(F.lit("s"), (F.col("doc_id") % 3).cast("string"))))
    first, again = (sorted(map(tuple, mixing.mix(d).select("doc_id", "size", "taken", "target", "source").collect()), key=str) for d in (df, df.repartition(5)))
    assert first == again
    taken, target, size = collections.Counter(), {}, collections.Counter()
    for _, s, k, goal, src in first:
        taken[src] += k
        size[src] += s
        target[src] = goal
        assert k <= 2 * s
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    assert all(abs(taken[s] - target[s]) <= 1 and target[s] <= 2 * size[s] for s in target)


def test_rules_bruteforce(spark):
    texts = [*some_texts(2), "a | b # c\nx y\n x y\nx y\n\n", "k " * 30]
    df = docs(spark, texts)
    got = {r.doc_id: r for r in rules.judge(df, df.where("doc_id % 2 = 0").select("doc_id"), buckets=64).collect()}
    for i, t in enumerate(texts):
        w = words(t)
        g = [tuple(w[a : a + 5]) for a in range(len(w) - 4)]
        many = collections.Counter(g)
        repeat = len({p for a, x in enumerate(g) if many[x] > 1 for p in range(a, a + 5)})
        lines = [x for x in (t or "").split("\n") if words(x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), sum(c in rules.SYMBOLS for c in t or ""), len(lines) - len(set(lines)), repeat)
        assert r.base_failed == (len(w) < 10 or 100 * repeat > 20 * len(w)) and not (r.base_failed and r.kept)
    assert "Python" not in rules.judge(df, df.select("doc_id"), buckets=64)._jdf.queryExecution().toString()
    kept = sorted(i for i, r in got.items() if r.kept)
    out = rules.kept_documents(df, df.where("doc_id % 2 = 0").select("doc_id"), buckets=64)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == kept
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan[: plan.index("Subquery")]  # the verdict is found inside the row
    # the score, from counts of hashed words and pairs
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    one = lambda x: xxhash.xxh64_intdigest(x, 42)
    grams = [[signed(one(x)) % 64 for x in words(t)] + [signed(xxhash.xxh64_intdigest(y, one(x))) % 64 for x, y in zip(words(t), words(t)[1:])] for t in texts]
    raw = collections.Counter(g for x in grams for g in x)
    good = collections.Counter(g for i, x in enumerate(grams) if i % 2 == 0 for g in x)
    share = sum(good.values()) / sum(raw.values())
    ratio = [round(math.log((good[k] + 4) / (raw[k] * share + 4)), 6) for k in range(64)]
    for i, x in enumerate(grams):
        assert got[i].score == pytest.approx(sum(ratio[g] for g in x) / max(1, len(x)), abs=2e-6)
        assert got[i].kept == (not got[i].base_failed and got[i].score >= -0.2)


def test_rules_deal_documents_without_an_id_by_their_texts(spark):
    df = docs(spark, [t for t in some_texts() if t] * 2).withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, F.col("doc_id")))
    table = rules.ratios(df, df.select("doc_id"), buckets=64)
    assert "hashpartitioning(doc_id" in table._jdf.queryExecution().executedPlan().toString() and ", salt" in table._jdf.queryExecution().executedPlan().toString()
    known = df.where("doc_id IS NOT NULL")
    good = {r.bucket: r.n for r in rules._tokens(known.select(rules.words(F.col("text")).alias("words"))).where("word IS NOT NULL").select(F.explode(F.array("one", "two")).alias("g")).where("g IS NOT NULL").groupBy(F.pmod("g", F.lit(64)).alias("bucket")).agg(F.count("*").alias("n")).collect()}
    every = {r.bucket: r.n for r in rules._tokens(df.select(rules.words(F.col("text")).alias("words"))).where("word IS NOT NULL").select(F.explode(F.array("one", "two")).alias("g")).where("g IS NOT NULL").groupBy(F.pmod("g", F.lit(64)).alias("bucket")).agg(F.count("*").alias("n")).collect()}
    share = sum(good.values()) / sum(every.values())
    assert table.first().table == pytest.approx([math.log((good.get(k, 0) + 4) / (every.get(k, 0) * share + 4)) for k in range(64)], abs=2e-6)


def test_rules_count_every_trusted_document(spark):
    df = spark.range(30_000).selectExpr("id AS doc_id", "concat_ws(' ', id % 100, id % 77) AS text")
    # a target that is the whole corpus tells nothing apart
    assert set(rules.ratios(df, df.select("doc_id")).first().table) == {0.0}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_rules_of_a_very_large_corpus(spark, ansi):
    """Counts whose products don't fit a long."""
    counts = [(0, 10**13, 10**13), (1, 3 * 10**13, 10**12), (2, 7, 0)]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        got = rules.ratio_table(spark.createDataFrame(counts, "bucket int, raw long, good long"), 4, 4.0).first().table
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    share = sum(g for *_, g in counts) / sum(r for _, r, _ in counts)
    assert got == pytest.approx([math.log((g + 4) / (r * share + 4)) for _, r, g in counts] + [0.0], abs=2e-6)


CHAT = "conv_id long, turn long, role string, text string"


def test_chat_rotation(spark):
    rows = [(1, 0, "system", "be"), (1, 1, "ann", "hi"), (1, 2, "bob", "yo"), (1, 600, "ann", None), (None, None, None, "x"), (None, None, None, "x"), (2, 0, "system", "only")]
    got = {(r.conv_id, r.piece, r.perspective): r for r in chat.rotate(spark.createDataFrame(rows, CHAT).withColumns({"c": F.lit(1), "rank": F.lit(2), "piece": F.lit(3)})).collect()}
    r = got[1, 0, "ann"]
    assert r.text == "<|system|>\nbe\n<|assistant|>\nhi\n<|user name=bob|>\nyo\n<|assistant|>\n\n" and [r.text[s.start : s.stop] for s in r.spans] == ["hi\n", "\n"]
    assert set(got) == {(1, 0, "ann"), (1, 0, "bob"), (None, 0, "unknown")} and got[None, 0, "unknown"].n_trained == 2
    out = chat.rotate(spark.createDataFrame(rows, CHAT), most=2, overlap=1, lead=1)
    got = {(r.conv_id, r.piece, r.perspective): r.text for r in out.collect()}
    assert got[1, 1, "bob"] == "<|system|>\nbe\n<|user name=ann|>\nhi\n<|assistant|>\nyo\n<|user name=ann|>\n\n" and (1, 0, "bob") not in got
    assert all(r.n_trained for r in out.collect()) and out.agg(F.sum("n_trained")).first()[0] == 5


def test_chat_of_long_dialogues(spark):
    rnd = random.Random(8)
    rows = [(1, k, rnd.choice(["ann", "bob", "system"]) if k else "system", f"t{k}") for k in range(600)]
    rows += [(2, k // 2 - 50, rnd.choice(["ann", "bob", "cat"]) if k else "system", f"é{k}") for k in range(9_000)]
    rows += [(None, None, "dan", "z"), (4, 0, "system", "s")] * 3 + [(None, None, "eve", None)] * 5_000
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, CHAT)
    assert chat.rotate(df).where("conv_id = 1").select("n_turns").distinct().first()[0] == 600
    con = duckdb.connect()
    con.register("conversations", df.toArrow())
    out = queries.chat_digest(chat.rotate(df))
    cols = sorted(out.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE_SQL['op9_chat']})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in out.select(*cols).collect()) and len(want) == 7  # no dialogue is cut


@pytest.fixture
def small_ranges(spark):
    """Ranges as small as many partitions make them."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "12"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_chat_of_dialogues_that_no_row_holds(spark, small_ranges):
    """Cut by bytes: every turn is trained on once, every system turn before a piece is in it, and the last turns before it."""
    rows = [(1, k, "system" if k % 500 == 7 else f"p{k % 3}", f"turn {k} " + "x" * (k % 50)) for k in range(3_000)] + [(2, 0, "ann", "short")]
    df = spark.createDataFrame(rows, CHAT).repartition(3)
    got = chat.rotate(df, room=20_000).collect()
    assert len({r.piece for r in got if r.conv_id == 1}) > 2 and {r.piece for r in got if r.conv_id == 2} == {0}
    trained = [r.text[s.start : s.stop] for r in got for s in r.spans]
    assert sorted(trained) == sorted(t + "\n" for _, _, role, t in rows if role != "system")
    for r in got:
        k = sorted(int(m) for m in re.findall(r"^turn (\d+)", r.text, re.M))
        first = min((int(r.text[s.start : s.stop].split()[1]) for s in r.spans), default=0) if r.conv_id == 1 else 0
        assert [x for x in k if x % 500 == 7 and x < first] == [x for x in range(7, first, 500)]
        assert r.piece == 0 or len([x for x in k if x < first]) >= 8
        assert all(r.text[s.start - len("<|assistant|>\n") : s.start] == "<|assistant|>\n" for s in r.spans)


def test_chat_with_times_as_turns(spark, small_ranges):
    """Turn numbers far apart: the dialogue is dealt over ranges, and no window orders a whole one."""
    rnd = random.Random(4)
    times = rnd.sample(range(1 << 40), 3_000)
    df = spark.createDataFrame([(1, t, f"p{k % 2}", f"t{t}") for k, t in enumerate(times)], CHAT).repartition(4)
    rows = df.select("conv_id", "turn", "role", F.col("text").alias("body"))
    out, _ = chat.placed(rows, "system", chat.ROOM, None)
    assert {r.turn: r["rank"] for r in out.collect()} == {t: k for k, t in enumerate(sorted(times))}
    per = spark.read.parquet(next(f for f in out.inputFiles() if "/dialogues-ranges-" in f).rsplit("/", 1)[0])
    assert per.count() >= 4 and per.agg(F.max("n")).first()[0] < 1_500
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def held_out(spark, sf):
    marks = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    return {k: r for k, r in marks.items() if zlib.crc32(str(k).encode()) % 5 == 0}


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    marks = held_out(spark, sf)
    got = {r.doc_id: r for r in queries.op1_quality(spark, sf).collect()}
    right = [got[k].predicted == r.quality for k, r in marks.items()]
    assert sum(right) / len(right) > 0.93 and all(0 <= r.score <= 1 for r in got.values())


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    marks = held_out(spark, sf)
    got = {r.doc_id: r for r in queries.op2_toxicity(spark, sf).collect()}
    found, real = {k for k in marks if got[k].toxic}, {k for k, r in marks.items() if r.toxic}
    assert len(found & real) > 0.8 * len(real) and len(found - real) < 0.05 * len(found)


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = [r for r in queries.op3_language(spark, sf).collect() if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in got) / len(got) > 0.97


def test_additive_scores_are_sums_of_bins():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(600, len(quality.FEATURES)))
    y = ((x[:, 0] + x[:, 1] * x[:, 2]) > 0).astype(float)
    m = quality.fit(x, y)
    for row, got in zip(x[:50], m.score(x[:50]), strict=True):
        logit = m.intercept
        for e, t, v in zip(m.edges, m.tables, row, strict=True):
            logit += t[sum(1 for b in e if b <= v)]
        for (j, k), t in zip(m.pairs, m.pair_tables, strict=True):
            logit += t[sum(1 for b in m.pair_edges[j] if b <= row[j]), sum(1 for b in m.pair_edges[k] if b <= row[k])]
        assert got == pytest.approx(1 / (1 + math.exp(-logit)))
    assert (1, 2) in m.pairs and ((m.score(x) > 0.5) == y).mean() > 0.9
    # a tree's steps against all ways to cut once
    g, h = rnd.normal(size=12), rnd.uniform(0.1, 1, size=12)
    best = max(range(1, 12), key=lambda c: g[:c].sum() ** 2 / (h[:c].sum() + 2) + g[c:].sum() ** 2 / (h[c:].sum() + 2))
    assert quality._tree(g, h, 2, 2.0) == pytest.approx([g[:best].sum() / (h[:best].sum() + 2)] * best + [g[best:].sum() / (h[best:].sum() + 2)] * (12 - best))


def test_chain_feeds_out_of_fold_probabilities():
    rnd = np.random.default_rng(2)
    lists = [np.flatnonzero(rnd.random(40) < 0.3) for _ in range(300)]
    first = np.array([float(3 in x) if rnd.random() < 0.9 else 0.0 for x in lists])
    marks = np.column_stack([first, np.maximum(first, [float(7 in x) for x in lists])])
    chain, oof = toxicity.fit_chain(lists, marks, ["a", "b"])
    fold = np.arange(300) % 5
    for f in range(5):  # the first category's predictions know nothing of their own rows
        own = [x for x, g in zip(lists, fold) if g != f]
        keep = toxicity._features(own, marks[fold != f], 1500, 4)
        rows = toxicity.Rows(toxicity.index(keep, own), len(keep))
        w = toxicity.logistic(rows, np.zeros((len(own), 0)), first[fold != f], np.ones(len(own), bool))
        left = toxicity.Rows(toxicity.index(keep, [x for x, g in zip(lists, fold) if g == f]), len(keep))
        assert oof[fold == f, 0] == pytest.approx(toxicity.probability(left, np.zeros((left.n, 0)), w), abs=1e-6)
    # a score, by hand: weights of the features there, and of the category before
    for x, p in zip(lists[:30], chain.score(toxicity.index(chain.features, lists[:30])), strict=True):
        there, before = [k for k, f in enumerate(chain.features) if f in x], []
        for w, got in zip(chain.weights, p, strict=True):
            logit = w[there].sum() + sum(a * b for a, b in zip(w[len(chain.features) : -1], before)) + w[-1]
            before.append(1 / (1 + math.exp(-logit)))
            assert got == pytest.approx(before[-1])


def test_bundles_bruteforce():
    texts = ["Aé b-c", "", "ab ab", "日本 語x", " 1 ", "q" * 7]
    dims, seed = 64, 5
    for t, got in zip(texts, langid.bundles(texts, dims, seed), strict=True):
        spaced = [0, *(ord(c) if c.isalpha() else 0 for c in t.lower()), 0]
        codes = [c for k, c in enumerate(spaced) if c or not k or spaced[k - 1]]
        want = np.zeros(dims)
        for g in zip(codes, codes[1:], codes[2:]):
            want += np.prod([np.roll(langid.letter_vector(c, dims, seed).astype(int), 2 - k) for k, c in enumerate(g)], axis=0)
        assert got.tolist() == want.tolist(), t


def test_language_of_the_nearest_prototype(spark):
    sf = "/root/testdata/sf0.001"
    df = spark.read.parquet(f"{sf}/documents.parquet")
    langs, profile = langid.prototypes(df, F.lit(True))
    rows = df.collect()
    for k, name in enumerate(langs):  # all are learned from, as there are fewer than the bound
        total = langid.bundles([r.text for r in rows if r.lang == name], profile.shape[1], 7).astype(float).sum(axis=0)
        assert profile[k] == pytest.approx(total / np.linalg.norm(total), abs=1e-5)
    got = {r.doc_id: r for r in langid.identify(df, langs, profile).collect()}
    for r in rows:
        v = langid.bundles([r.text or ""], profile.shape[1], 7)[0]
        if v.any() and any(map(str.isalpha, r.text)):
            cosine = profile @ v / np.linalg.norm(v)
            assert got[r.doc_id].lang_pred == langs[int(cosine.argmax())] and got[r.doc_id].cosine == pytest.approx(cosine.max(), abs=1e-4)


def test_language_of_many_short_texts_in_bounded_memory():
    texts = pa.array([f"word{i % 9}x" for i in range(10_000)])
    tracemalloc.start()
    for _, some in langid._grouped(texts):
        langid.bundles(some, 1024, 7)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20


def test_labels_of_repeated_documents_count_once(spark):
    t = some_texts()
    df = docs(spark, [t[8], t[9], t[10]] + [t[11]] * 50, [1, 2, 3] + [4] * 50)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, 1, 0), (4, 0, 1), (4, 0, 1)], "doc_id long, quality int, toxic int")
    once = df.dropDuplicates(["doc_id"])
    a, b = (quality.learn(d, labels, F.lit(True)) for d in (df, once))
    assert a.intercept == b.intercept
    a, b = (toxicity.learn(d, labels, {"toxic": F.col("toxic") == 1}, F.lit(True)) for d in (df, once))
    assert a.weights[0].tolist() == b.weights[0].tolist()


def test_models_on_odd_texts(spark):
    texts = [None, "", "123 !!", "x" * 100_000, "plain words here"]
    df = docs(spark, texts)
    labels = spark.createDataFrame([(4, 1, 0), (3, None, None), (None, 1, 1), (4, 0, 1)], "doc_id long, quality int, toxic int")
    assert quality.classify(df, quality.learn(df, labels, F.lit(True))).count() == 5
    assert toxicity.score(df, toxicity.learn(df, labels, {"toxic": F.col("toxic") == 1}, F.lit(True))).count() == 5
    langs, profile = langid.prototypes(df, F.lit(True))
    got = {r.doc_id: r for r in langid.identify(df, langs, profile).collect()}
    assert [got[i].lang_pred for i in range(3)] == ["und"] * 3 and got[4].lang_pred == "en"


def test_a_very_long_text(spark):
    rnd = random.Random(12)
    text = " ".join(f"w{rnd.randrange(10**6)}" for _ in range(300_000))
    bench = text.split()[200_000:200_050]
    df = docs(spark, [text, text + " tail", "short"])
    one = lambda d: {r.doc_id: r for r in d.collect()}
    got = one(rules.judge(df, df.where("doc_id = 0").select("doc_id")))
    assert (got[0].n_words, got[0].n_repeat_words, got[1].n_words) == (300_000, 0, 300_001)
    got = one(substrings.dedup(df))
    assert [got[i].n_removed for i in range(3)] == [0, 300_000, 0]
    got = one(simhash.near_duplicates(df))
    assert got[1].component_id == 0 and got[2].component_id == 2
    got = one(decontaminate.matches(df, spark.createDataFrame([(1, " ".join(bench))], "item_id long, text string")))
    assert (got[0].n_hit, got[0].longest_match, got[0].match_at, got[2].n_hit) == (50, 50, 200_000, 0)
    got = one(mixing.mix(df))
    assert sum(r.taken for r in got.values()) == pytest.approx(1.5 * 600_002, abs=2)


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.classify(df, quality.learn(df, labels, F.lit(True))).isEmpty()
    assert toxicity.score(df, toxicity.learn(df, labels, {"toxic": F.col("toxic") == 1}, F.lit(True))).isEmpty()
    assert langid.identify(df, *langid.prototypes(df, F.lit(True))).isEmpty()
    assert simhash.near_duplicates(df).isEmpty() and substrings.dedup(df).isEmpty() and mixing.mix(df).isEmpty()
    assert tokens.token_counts(df, VOCABULARY).isEmpty()
    assert decontaminate.matches(df, spark.createDataFrame([], "item_id long, text string")).isEmpty()
    assert rules.judge(df, labels.select("doc_id"), buckets=64).isEmpty()
    assert chat.rotate(spark.createDataFrame([], CHAT)).isEmpty()


def test_first_of_each_loses_no_text(spark):
    t = some_texts()
    texts, ids = [t[8], t[9], t[9], t[11], t[12], t[12], None, ""], [None, 5, 7, 7, None, None, 3, 4]
    df = docs(spark, texts, ids).withColumn("k", F.lit(1)).withColumn("h_", F.lit("x"))
    out = simhash.first_of_each(df)
    assert out.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(None, t[8]), (5, t[9]), (7, t[11]), (None, t[12]), (3, None)], key=str)
    kept = rules.kept_documents(df.withColumns({"k_": F.lit(2), "words": F.lit(3), "kept": F.lit(4), "table": F.lit(5)}), df.select("doc_id"), buckets=64)
    assert kept.columns == [*df.columns, "k_", "words", "kept", "table"] and kept.count() > 0 and kept.first()["kept"] == 4


def test_null_and_repeated_ids(spark):
    t = some_texts()
    df = docs(spark, [t[8], t[8], t[9], t[9]], [None, None, 5, 5])
    out = simhash.near_duplicates(df).collect()
    assert len(out) == 4 and {r.component_id for r in out if r.doc_id == 5} == {5}
    assert [r.n_removed for r in substrings.dedup(df).collect()] == [0, 0, 0, 0]  # equal rows are one document to each other
    assert mixing.mix(df).count() == 4 and rules.judge(df, df.select("doc_id"), buckets=64).count() == 4


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in df.select(*cols).collect())


def test_mixing_of_documents_without_ids(spark):
    rnd = random.Random(2)
    texts = [" ".join(rnd.choices("abc", k=rnd.randint(0, 30))) or None for _ in range(300)]
    df = spark.createDataFrame([(None if i % 3 else 7, t, "s", i % 5, "x") for i, t in enumerate(texts)], "doc_id long, text string, source string, size int, target string")
    first, again = (sorted(map(str, mixing.mix(d, keep=True, share=0.5).select("taken", "row.text").collect())) for d in (df, df.repartition(7)))
    assert first == again
    placed = mixing.mix(df, share=0.5).where("part > 0 AND part < size").count()
    assert placed <= 1
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.md5(F.coalesce("text", F.lit("")))))
    assert df.select(F.substring(key, 1, mixing.BUCKET_DIGITS)).distinct().count() > 200  # no bucket holds those without an id


def test_ranks_of_many_sources(spark):
    sizes = spark.range(2000).selectExpr("CASE WHEN id = 5 THEN NULL ELSE concat('s', id) END AS source", "id % 50 + 1 AS size").repartition(5)
    got = {r.source: r.weight for r in mixing.targets(sizes).collect()}
    order = sorted((k for k in got if k), key=lambda x: x.encode()) + [None]
    assert [got[k] for k in order] == [(5, 2, 1)[i % 3] for i in range(2000)]


def test_stages_on_odd_documents(spark, tmp_path):
    import corpus_pipeline

    t = some_texts()
    texts, ids = [None, "", " ", t[9], t[9], t[9], t[11], "word " * 30_000, t[12], t[13]], [1, 2, None, 3, 3, None, None, 4, 5, 5]
    rows = [(i, x, None if k % 4 else "en", None if k % 3 else "s", None, "a", 1, "b", 2, "c", "d") for k, (i, x) in enumerate(zip(ids, texts, strict=True))]
    schema = "doc_id long, text string, lang string, source string, n_chars long, target string, size int, part string, taken int, row string, words string"
    spark.createDataFrame([(3, 1, 0), (None, 1, 0), (3, None, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(None, t[13]), (1, None), (2, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for some in (rows, []):
        docs_ = spark.createDataFrame(some, schema)
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs_, str(tmp_path))
            path = f"{tmp_path}/{k}-{len(some)}"
            out.write.parquet(path)
            got = spark.read.parquet(path)
            assert got.columns[: len(docs_.columns)] == docs_.columns and (k == 4 or len(got.columns) == len(docs_.columns)), name
            found = [r.asDict() for r in got.collect()]
            assert len(found) <= len(some) and all((r["target"], r["size"], r["row"]) == ("a", 1, "c") for r in found)
            if some:
                n = {0: None, 1: 6, 2: 10, 3: 9, 4: None}[k]
                assert n is None or len(found) == n, (name, len(found))
                assert k != 2 or [r["text"] for r in found if r["doc_id"] == 1] == [None]
                assert k != 4 or all(r["mix_taken"] > 0 for r in found) and len(found) <= 7


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    keep, counts = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, keep, SF)
        if k < 4:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(f"{tmp_path}/{k}")
        before, keep = keep, spark.read.parquet(f"{tmp_path}/{k}")
        counts.append(keep.count())
        if k == 0:
            verdict = {r.doc_id for r in rules.judge(before, spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id")).where("kept").collect()}
            assert {r.doc_id for r in keep.collect()} == verdict
        if k == 1:
            assert {r.doc_id for r in keep.collect()} == {r.component_id for r in simhash.near_duplicates(before).collect()}
        if k == 3:
            assert not decontaminate.matches(keep, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").count()
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute_rules(rows, trusted):
    """Rows that the base rules and the likelihood ratio keep, counted word by word."""
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    one = lambda x: xxhash.xxh64_intdigest(x, 42)
    grams = [[signed(one(x)) % 65536 for x in words(r["text"])] + [signed(xxhash.xxh64_intdigest(y, one(x))) % 65536 for x, y in zip(words(r["text"]), words(r["text"])[1:])] for r in rows]
    raw = collections.Counter(g for x in grams for g in x)
    good = collections.Counter(g for r, x in zip(rows, grams) if r["doc_id"] in trusted for g in x)
    share = sum(good.values()) / sum(raw.values())
    kept = []
    for r, x in zip(rows, grams):
        w = words(r["text"])
        five = [tuple(w[a : a + 5]) for a in range(len(w) - 4)]
        many = collections.Counter(five)
        repeat = len({p for a, g in enumerate(five) if many[g] > 1 for p in range(a, a + 5)})
        score = sum(round(math.log((good[g] + 4) / (raw[g] * share + 4)), 6) for g in x) / max(1, len(x))
        if len(w) >= 10 and 100 * repeat <= 20 * len(w) and score >= -0.2:
            kept.append(r)
    return kept


def brute_near(rows):
    """The smallest id of each group of fingerprints within four bits."""
    fps = []
    for r in rows:
        w = words(lower(r["text"]))
        sh = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
        h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return [min((r for r, g in zip(rows, group) if g == k), key=lambda r: r["doc_id"]) for k in set(group)]


def brute_text(text, gone):
    """The text with each kept word and the white space after it; what precedes the first word stays."""
    if not gone:
        return text
    found = [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    return (text[: found[0]] + "".join(text[a:b] for p, (a, b) in enumerate(zip(found, [*found[1:], len(text)])) if p not in gone)).rstrip(" \t\n\x0b\x0c\r")


def brute_clean(rows, items):
    """Rows without a window of ten words, or a shorter item, of the benchmark."""
    cut = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t)) if w]
    bad = {tuple(v[a : a + min(10, len(v))]) for v in map(cut, items) for a in range(len(v) - min(10, len(v)) + 1) if v}
    sizes = {len(b) for b in bad}
    return [r for r in rows if not any(tuple(w[a : a + n]) in bad for w in [cut(r["text"])] for n in sizes for a in range(len(w) - n + 1))]


def brute_mix(rows):
    """doc_id, size, source's size, target, words taken, epochs and words of the cut one."""
    size = {r["doc_id"]: len(words(r["text"])) for r in rows}
    total = collections.Counter()
    for r in rows:
        total[r["source"]] += size[r["doc_id"]]
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5.0, 2.0, 1.0)[k % 3] for k, s in enumerate(order)}
    target, left, open_ = {}, 1.5 * sum(total.values()), set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= 2 * total[s]}
        for s in full or open_:
            target[s] = 2.0 * total[s] if full else weight[s] * level
            left -= target[s]
        open_ -= full or open_
    out = []
    for s in order:
        budget = math.floor(target[s] + 0.5)
        epochs, rest = divmod(budget, total[s]) if total[s] else (0, 0)
        mine = [r for r in rows if r["source"] == s]
        for r in sorted(mine, key=lambda r: hashlib.md5(f"{r['doc_id']}|{hashlib.md5(r['text'].encode()).hexdigest()}".encode()).hexdigest()):
            n = size[r["doc_id"]]
            part = max(0, min(n, rest))
            rest -= part
            out.append((r["doc_id"], n, total[s], round(target[s], 4), epochs * n + part, epochs, part))
    return [r for r in out if r[4] > 0]


def test_pipeline_bruteforce(spark):
    import corpus_pipeline

    rows = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    trusted = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = sorted(brute_near(brute_rules(rows, trusted)), key=lambda r: r["doc_id"])
    gone = brute_repeats([r["text"] for r in rows])
    rows = brute_clean([r | {"text": brute_text(r["text"], gone[i])} for i, r in enumerate(rows)], items)
    got = corpus_pipeline.run(spark, SF).collect()
    text = {r["doc_id"]: r["text"] for r in rows}
    assert all(r.text == text[r.doc_id] and r.n_chars == len(r.text) for r in got)
    assert sorted((r.doc_id, r["size"], r.source_size, round(r.target, 4), r.taken, r.epochs, r.part) for r in got) == sorted(brute_mix(rows))
