"""Substring dedup by seed and extend.

Seed: a window is ``window`` consecutive words.  Its anchor is the smallest hash of
the ``seed``-word grams inside it (winnowing), so equal windows have equal anchors
and neighbouring windows mostly share one.  Every document sends its anchors with
their places, no words; those that occur once in all documents end there.

Extend: the others go back to their documents, which send for each anchor the words
that the windows around it span, to the left and to the right.  Where spans of one
anchor meet, their words are compared: windows are found by hash, and every stretch
of windows that seems to repeat an earlier one is compared word by word as a whole.
Every window but the earliest is marked, and adjacent marks join into maximal
repeats of at least ``window`` words.

A passage in a third of all documents is no hot key: tasks send an anchor once for a
chunk of documents, and of equal windows in a chunk only the earliest.  An anchor
that a sample of documents shows under more than ``most`` windows (a frequent line in
ever other surroundings) is split: each of its windows is a seed of its own.  That
decides only where windows meet.

The texts are shuffled once, by a hash of the whole key; both joins read that shuffle.

Edge cases: null, empty and short texts (under ``window`` words) have no windows
and lose nothing; a text of any length is read in segments; ids may be of any atomic type
that has an order; a null doc_id orders before all others; rows with one doc_id but
other texts are ordered by a hash of the two; equal rows (same id and text) are one
document to each other: neither is the earlier one, and each gets a row; an empty
table gives no rows; other columns, whatever their names, come back as they were in
the struct ``row``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow, chunks, whole_row

CHUNK_BYTES = 3 << 20
SEGMENT = 4 << 20  # bytes hashed at a time
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_random = np.random.default_rng(20)
BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit over all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _segment(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    solid = ~BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], solid, [False])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64)
    longest = int((ends - starts).max())
    powers = np.cumprod(np.full(longest, FACTOR, np.uint64))
    inside = np.flatnonzero(solid)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    terms = BYTE[data[inside]] * powers[np.arange(len(inside)) - np.repeat(first, lengths)]
    return starts, ends, mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each word in the bytes, a segment at a time; segments end at white space."""
    if len(data) <= SEGMENT:
        return _segment(data)
    parts, a = [], 0
    while a < len(data):
        b = min(a + SEGMENT, len(data))
        while b < len(data) and not BLANK[data[b - 1]]:  # a word goes on: back to white space, or else on to it
            gaps = np.flatnonzero(BLANK[data[a:b]])
            b = a + int(gaps[-1]) + 1 if len(gaps) else min(b + SEGMENT, len(data))
        starts, ends, h = _segment(data[a:b])
        parts.append((starts + a, ends + a, h))
        a = b
    return tuple(map(np.concatenate, zip(*parts, strict=True)))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive words."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(h) - n + 1, np.uint64)
    for i, power in enumerate(np.cumprod(np.full(n, FACTOR, np.uint64))):
        total += h[i : len(h) - n + 1 + i] * power
    return mix(total)


def sliding_least(v: np.ndarray, n: int) -> np.ndarray:
    """Smallest of each n consecutive values, by doubling."""
    span = 1
    while span * 2 <= n:
        v = np.minimum(v[: len(v) - span], v[span:])
        span *= 2
    return np.minimum(v[: len(v) - (n - span)], v[n - span :]) if n > span else v


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edge[::2], edge[1::2]


def window_seeds(h: np.ndarray, seed: int, window: int, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The seed of each window: its anchor, or for a wide anchor one of its own content.  Also whether it is the latter, and the grams."""
    if len(h) < window:
        return np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, np.uint64)
    grams = gram_hashes(h, seed)
    out = sliding_least(grams, window - seed + 1)
    split = np.isin(out, wide) if len(wide) else np.zeros(len(out), bool)
    if split.any():
        out[split] = mix(out[split] + gram_hashes(h, window)[split] * FACTOR)
    return out, split, grams


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Places where any of the columns differs from the row before."""
    change = np.ones(len(columns[0]), bool)
    change[1:] = False
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def _texts(column: pa.Array, least: int) -> Iterator[list[int]]:
    """Chunks of the rows whose texts have ``least`` bytes or more."""
    sizes = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes >= least)
    for a, b in chunks(sizes[rows], CHUNK_BYTES):
        yield rows[a:b].tolist()


#: What is known of an anchor's row before it meets others: nothing, that its chunk has more of it (or that its run repeats itself), or that it needs no meeting.
ALONE, FIRST, KNOWN = range(3)


def _anchors(seed: int, window: int, wide: np.ndarray):
    """From key and text to anchor, key and place: each anchor of a chunk once, its further places as known to be repeated."""
    span = window - seed + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for rows in _texts(batch.column(1), 2 * window - 1):
                anchor, owner, place, alone, grams = [], [], [], [], []
                for i in {keys[i]: i for i in rows}.values():
                    s, split, g = window_seeds(word_hashes(np.frombuffer(batch.column(1)[i].as_buffer(), np.uint8))[2], seed, window, wide)
                    if len(s):
                        at = _starts(s)
                        n = np.append(at[1:], len(s)) - at
                        anchor.append(s[at])
                        owner.append(np.full(len(at), keys[i]))
                        place.append(at)
                        alone.append(n <= np.where(split[at], 1, span))  # a gram is in no more windows than that: a longer run holds it again
                        grams.append(g)
                if anchor:
                    anchor, owner, place, alone, grams = map(np.concatenate, (anchor, owner, place, alone, grams))
                    close = [grams[d:][grams[d:] == grams[:-d]] for d in range(1, span)]  # grams that one window may hold twice
                    alone &= ~np.isin(anchor, np.unique(np.concatenate(close)))
                    _, first, count = np.unique(anchor, return_index=True, return_counts=True)
                    state = np.full(len(anchor), KNOWN)
                    state[first] = np.where((count > 1) | ~alone[first], FIRST, ALONE)
                    yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(owner), pa.array(place * 4 + state)], ["anchor", "key", "at"])

    return work


def _tally(seed: int, window: int):
    """From key and text to the anchors and how many windows each has."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _texts(batch.column(1), 2 * window - 1):
                found = [window_seeds(word_hashes(np.frombuffer(batch.column(1)[i].as_buffer(), np.uint8))[2], seed, window, np.zeros(0, np.uint64))[0] for i in rows]
                anchor, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(n)], ["anchor", "n"])

    return work


def settle(data: bytes, words: tuple[np.ndarray, np.ndarray, np.ndarray], at: np.ndarray, window: int) -> np.ndarray:
    """For each window (``at``: its first word), given in order, the first window of the same words.

    Words in ``data`` are apart by one space.  Equal hashes only propose; stretches of
    windows that go along with an earlier stretch are compared as a whole.
    """
    starts, ends, h = words
    content = gram_hashes(h, window)[at]
    order = np.argsort(content, kind="stable")
    fresh = np.concatenate(([True], content[order][1:] != content[order][:-1]))
    src = np.empty(len(at), np.int64)
    src[order] = order[fresh][np.cumsum(fresh) - 1]
    again = np.flatnonzero(src != np.arange(len(at)))
    if not len(again):
        return src
    first = _starts(again - np.arange(len(again)), at[again] - np.arange(len(again)), at[src[again]] - np.arange(len(again)))
    w, v = at[again[first]], at[src[again[first]]]
    m = np.append(first[1:], len(again)) - first + window - 2  # from a stretch's first word to its last
    wrong = [k for k, (a, b, c, d) in enumerate(zip(starts[w].tolist(), ends[w + m].tolist(), starts[v].tolist(), ends[v + m].tolist(), strict=True)) if data[a:b] != data[c:d]]
    if wrong:  # other words of one hash: tell all windows of those hashes apart by their words
        stop = np.append(first[1:], len(again))
        bad = np.unique(np.concatenate([content[again[first[k] : stop[k]]] for k in wrong]))
        known: dict[bytes, int] = {}
        for i in np.flatnonzero(np.isin(content, bad)).tolist():
            src[i] = known.setdefault(data[starts[at[i]] : ends[at[i] + window - 1]], i)
    return src


def _extend(seed: int, window: int, wide: np.ndarray, names: list[str]):
    """From documents with the places of repeated anchors to the words around them, and marks of what repeats within the chunk."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, (keys, who) = batch.column(names.index("id")), (batch.column(names.index(c)).to_numpy() for c in ("key", "who"))
            texts, places = batch.column(names.index("t")), batch.column(names.index("seeds"))
            for rows in _texts(texts, 2 * window - 1):
                found = {(keys[i], who[i]): i for i in rows}.values()
                order = sorted(found, key=lambda i: ((v := ids[i].as_py()) is not None, 0 if v is None else v, who[i]))
                plain, base, owner, place, group = [], [], [], [], []
                hashes, size, n_words = [], 0, 0
                for i in order:
                    own = b" ".join(texts[i].as_py().split())
                    starts, ends, h = word_hashes(np.frombuffer(own, np.uint8))
                    if len(h) < window:
                        continue
                    s = window_seeds(h, seed, window, wide)[0]
                    first = _starts(s)
                    stop = np.append(first[1:], len(s))
                    wanted = np.isin(first, places[i].values.to_numpy(zero_copy_only=False))
                    at = np.repeat(first[wanted] - np.cumsum(np.append(0, (stop - first)[wanted]))[:-1], (stop - first)[wanted])
                    at += np.arange(len(at))
                    hashes.append((starts + size, ends + size, h))
                    plain.append(own)
                    base.append(at + n_words)
                    owner.append(np.full(len(at), i))
                    place.append(at)
                    group.append(s[at])
                    size, n_words = size + len(own) + 1, n_words + len(h)
                if not plain:
                    continue
                data = b" ".join(plain)
                words = tuple(map(np.concatenate, zip(*hashes, strict=True)))
                base, owner, place, group = map(np.concatenate, (base, owner, place, group))
                if not len(base):
                    continue
                kept = settle(data, words, base, window) == np.arange(len(base))
                first = _starts(owner, kept, np.where(kept, group, 0), place - np.arange(len(place)))
                n = np.append(first[1:], len(base)) - first
                a, b = words[0][base[first]].tolist(), words[1][base[first] + n + window - 2].tolist()
                spans = [data[x:y] if k else None for x, y, k in zip(a, b, kept[first].tolist(), strict=True)]
                who_sends = pa.array(owner[first])
                yield pa.RecordBatch.from_arrays([pa.array(group[first].view(np.int64)), ids.take(who_sends), pa.array(keys[owner[first]]), pa.array(who[owner[first]]), pa.array(place[first].astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(spans, pa.binary())], SPANS)

    return work


SPANS = ["anchor", "id", "key", "who", "at", "n", "words"]


def _decide(rows: pa.RecordBatch, old: int, window: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """Marks of the rows from ``old`` on, and which rows hold a window not seen before them."""
    anchor, key, who, at, n = (rows.column(SPANS.index(c)).to_numpy() for c in ("anchor", "key", "who", "at", "n"))
    sent = rows.column(SPANS.index("words"))
    marked = sent.is_null().to_numpy(zero_copy_only=False)
    out = [(key[marked], who[marked], at[marked], n[marked])]
    same = np.concatenate(([False], anchor[1:] == anchor[:-1], [False]))
    meet = np.flatnonzero(~marked & (same[:-1] | same[1:]))
    fresh = ~marked
    if len(meet):
        data = b" ".join(sent.take(pa.array(meet)).to_pylist())
        many = n[meet].astype(np.int64)
        own = np.repeat(meet, many)
        inside = np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many)
        word = np.cumsum(many + window - 1) - (many + window - 1)
        src = settle(data, word_hashes(np.frombuffer(data, np.uint8)), np.repeat(word, many) + inside, window)
        place = at[own] + inside
        flag = ((key[own] != key[own[src]]) | (who[own] != who[own[src]]) | (place != place[src])) & (own >= old)
        fresh[meet] = False
        fresh[own[src == np.arange(len(src))]] = True
        first = _starts(own, flag)
        stop = np.append(first[1:], len(own))
        hit = flag[first]
        first, stop = first[hit], stop[hit]
        out.append((key[own[first]], who[own[first]], place[first], stop - first))
    key, who, at, n = map(np.concatenate, zip(*out, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(who), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))], ["key", "who", "at", "n"]), fresh


def _repeats(window: int):
    """Marked runs of windows; rows come sorted by anchor, id, who, at within a partition."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows = None  # rows of the anchor that may go on, those with a first window
        for batch in batches:
            if not batch.num_rows:
                continue
            old = 0
            if open_rows is not None and open_rows.num_rows and open_rows.column(0)[0] == batch.column(0)[0]:
                old = open_rows.num_rows
                batch = pa.concat_batches([open_rows, batch.cast(open_rows.schema)])
            marks, fresh = _decide(batch, old, window)
            yield marks
            anchor = batch.column(0).to_numpy()
            open_rows = batch.take(pa.array(np.flatnonzero(fresh & (anchor == anchor[-1]))))

    return work


def wide_anchors(plain: DataFrame, seed: int, window: int, most: int, sample: int = 4_000, bound: int = 4_096) -> np.ndarray:
    """Anchors of more than about ``most`` windows, by about ``sample`` documents; the ``bound`` largest."""
    rate = min(1.0, sample / max(1, plain.count()))
    some = plain.where(F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1 << 30)) < rate * (1 << 30)).limit(2 * sample)
    found = arrow(some.select("key", "t"), _tally(seed, window), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    rows = found.where(F.col("n") > most * rate).orderBy(F.desc("n"), "anchor").limit(bound).collect()
    return np.array([r["anchor"] for r in rows], np.int64).view(np.uint64)


def repeats(plain: DataFrame, dealt: DataFrame, window: int = 20, seed: int = 8, most: int = 20_000) -> DataFrame:
    """Runs of repeated windows: key, who, at (first word) and n (windows), in pieces.

    ``plain`` holds key and t of all documents, ``dealt`` id, key, who, t and whatever else, partitioned by key.
    """
    wide = wide_anchors(plain, seed, window, most)
    rows = arrow(plain.select("key", "t"), _anchors(seed, window, wide), "anchor long, key long, at long")
    state = F.col("at").bitwiseAND(F.lit(3).cast("long"))
    # places that are known to be repeated need no partner: they go anywhere
    rows = rows.withColumn("anchor", F.when(state == KNOWN, F.xxhash64("key", "at")).otherwise(F.col("anchor")))
    met = rows.withColumn("many", F.count(F.lit(1)).over(Window.partitionBy("anchor")))
    repeated = met.where((F.col("many") > 1) | (state != ALONE)).groupBy("key").agg(F.collect_set(F.shiftright("at", 2)).alias("seeds"))  # a document's own places
    seeded = dealt.join(repeated.hint("shuffle_hash"), "key").select(*dealt.columns, "seeds")
    schema = T.StructType.fromDDL("anchor long, id long, key long, who long, at int, n int, words binary")
    schema["id"].dataType = dealt.schema["id"].dataType
    spans = arrow(seeded, _extend(seed, window, wide, seeded.columns), schema)
    spread = F.when(F.col("words").isNull(), F.xxhash64("key", "at")).otherwise(F.col("anchor"))
    spans = spans.withColumn("anchor", spread).repartition("anchor").sortWithinPartitions("anchor", F.col("id").asc_nulls_first(), "who", "at")
    return arrow(spans, _repeats(window), "key long, who long, at int, n int")


def _cutter(window: int, names: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_removed, digest, kept_text, full = [], [], [], [], "row" in names
            pieces = b.column(names.index("pieces"))
            ends = np.cumsum(pc.fill_null(pc.list_value_length(pieces), 0).to_numpy(zero_copy_only=False))
            first, count, marked = (pieces.flatten().field(f).to_numpy() for f in ("at", "n", "who"))
            for t, a, e, who in zip(b.column(names.index("t")), np.concatenate(([0], ends[:-1])).tolist(), ends.tolist(), b.column(names.index("who")).to_pylist(), strict=True):
                text = t.as_py() or b""
                words = text.split()
                own = a + np.flatnonzero(marked[a:e] == who)
                gone = np.zeros(len(words) + 1, np.int32)
                np.add.at(gone, first[own], 1)
                np.add.at(gone, first[own] + count[own] + window - 1, -1)
                covered = np.cumsum(gone)[: len(words)] > 0
                removed = int(covered.sum())
                kept = [w for w, c in zip(words, covered.tolist(), strict=True) if not c] if removed else words
                n_words.append(len(words))
                n_removed.append(removed)
                digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                if full:
                    kept_text.append(_without(text, covered) if removed else t.as_py())
            own = [b.column(names.index("id")), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string())]
            more = [pa.array(kept_text, pa.binary()), b.column(names.index("row"))] if full else []
            yield pa.RecordBatch.from_arrays([*own, *more], ["id", "n_words", "n_removed", "kept_sha256", *(["kept", "row"] if full else [])])

    return work


def _without(text: bytes, covered: np.ndarray) -> bytes:
    """The text without the covered words and the white space after them."""
    found = list(re.finditer(rb"[^\x20\x09-\x0D]+", text))
    out, at = [], 0
    for a, b in zip(*runs(covered), strict=True):
        out.append(text[at : found[a].start()])
        at = found[b].start() if b < len(found) else len(text)
    return b"".join([*out, text[at:]]).rstrip(b" \t\n\x0b\x0c\r") if len(out) else text


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, seed: int = 8, keep: bool = False, most: int = 20_000) -> DataFrame:
    """``id_col``, n_words, n_removed and kept_sha256 for each document.

    With ``keep`` the text without its repeats comes back too, as ``kept_text``, and
    the other columns of the input row as the struct ``row``.
    """
    held = [whole_row(docs, text_col).alias("row")] if keep else []
    ident = lambda n: F.xxhash64(F.lit(n), id_col, text_col)  # noqa: E731  # two of them tell documents apart
    plain = docs.select(F.col(id_col).alias("id"), ident(0).alias("key"), ident(1).alias("who"), F.col(text_col).cast("binary").alias("t"), *held)
    dealt = plain.repartition("key")  # both joins read this shuffle: they take the same columns of it
    marks = repeats(plain, dealt, window, seed, most).groupBy("key").agg(F.collect_set(F.struct("at", "n", "who")).alias("pieces"))  # a document's own pieces
    joined = dealt.join(marks.hint("shuffle_hash"), "key", "left").select(*dealt.columns, "pieces")
    schema = T.StructType().add("id", docs.schema[id_col].dataType)
    for f in T.StructType.fromDDL("n_words long, n_removed long, kept_sha256 string" + ", kept binary" * keep).fields + ([joined.schema["row"]] if keep else []):
        schema.add(f)
    out = arrow(joined, _cutter(window, joined.columns), schema)
    return out.select(F.col("id").alias(id_col), "n_words", "n_removed", "kept_sha256", *([F.col("kept").cast("string").alias("kept_text"), "row"] if keep else []))
