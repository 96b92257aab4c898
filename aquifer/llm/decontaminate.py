"""Benchmark decontamination with suffix arrays of the training text.

Every chunk of documents is a shard.  Its words become numbers of the benchmark's
vocabulary (0: any other word), and its suffix array holds, in sorted order, the
places of all stretches that are long enough to match.  Every benchmark suffix, cut at a
window, is binary-searched in every shard; suffixes that agree there are searched
once.  Suffixes with a window in the shard are then searched whole, by hashes of stretches: where they
would stand in the shard's array tells which of them each place found lies next to, and with
those it has its longest verbatim match.  The longest of each document is compared word by word.
Windows are ``window`` words, or a whole item if it is shorter.

The benchmark is dealt into blocks of about ``block_bytes`` of text (or one longer
item), which tasks prepare and write to the shared folder; nothing of it passes the driver.
A block takes memory in proportion to its words: items are one sequence, and
suffixes are places in it.  A worker holds one block at a time, read from its file; documents are never
shuffled.

Edge cases: null and empty texts have no words and match nothing; a document or item
of any length is searched whole, in memory in proportion to it; items without words
are ignored; items whose id is null count as one item with an empty name; repeated
items with one id count once; repeated documents and ids each get a row; without
items, or without documents, nothing matches; other columns, whatever their names,
come back as they were in the struct ``row``.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow, chunks, whole_row, written

#: All bytes but 0-9, a-z and those above ASCII separate words; applied after lower-casing A-Z.
SEPARATE = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

CHUNK_BYTES = 4 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
UNBASE = np.uint64(pow(int(BASE), -1, 1 << 64))


def item_words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().translate(SEPARATE).split()


class Sequence:
    """Numbers of words, 0 where stretches end, and hashes of any stretch."""

    def __init__(self, ids: np.ndarray):
        self.ids = np.append(ids, 0)
        stop = np.flatnonzero(self.ids == 0)
        self.run = stop[np.searchsorted(stop, np.arange(len(self.ids)))] - np.arange(len(self.ids))  # words ahead
        spread = (self.ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        spread = (spread ^ (spread >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        power = np.cumprod(np.full(len(self.ids), BASE))
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((spread ^ (spread >> np.uint64(32))) * power)))
        self.unpower = np.cumprod(np.full(len(self.ids), UNBASE))

    def hashes(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return (self.sums[at + n] - self.sums[at]) * self.unpower[at]


def agree(a: Sequence, at: np.ndarray, b: Sequence, to: np.ndarray) -> np.ndarray:
    """Words that agree from each place of one sequence and of the other on, by their hashes."""
    low, high = np.zeros(len(at), np.int64), np.minimum(a.run[at], b.run[to])
    while (low < high).any():
        middle = (low + high + 1) // 2
        same = a.hashes(at, middle) == b.hashes(to, middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def suffix_array(ids: np.ndarray, longest: int) -> np.ndarray:
    """Places in the order of what follows, up to ``longest`` numbers, by doubling."""
    rank, span = ids.astype(np.int64), 1
    while True:
        after = np.concatenate((rank[span:], np.zeros(min(span, len(rank)), np.int64)))
        values, rank = np.unique(rank * (int(rank.max()) + 1) + after, return_inverse=True)
        span *= 2
        if span > longest or len(values) == len(ids):
            return np.argsort(rank, kind="stable")


def stretches(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of each range, and which range they are of."""
    n = high - low
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(int(n.sum())) + np.repeat(low - (np.cumsum(n) - n), n), of


class Probe:
    """A block of the benchmark, ready to be searched for."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int):
        self.window = window
        self.names: list[str] = sorted({name for name, _ in items})
        number = {n: i for i, n in enumerate(self.names)}
        self.vocabulary: dict[bytes, int] = {}
        ids, starts, lengths, owners, size = [np.zeros(1, np.int64)], [], [], [], 1
        for name, text in items:
            own = np.fromiter((self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in item_words(text)), np.int64)
            if len(own):
                starts.append(size)
                lengths.append(len(own))
                owners.append(number[name])
                ids += [own, np.zeros(1, np.int64)]
                size += len(own) + 1
        self.text = Sequence(np.concatenate(ids))
        starts, lengths, self.owners = (np.array(x, np.int64) for x in (starts, lengths, owners))
        self.starts = starts
        self.least = int(min(window, lengths.min())) if len(starts) else 0
        if not self.least:
            return
        rank = np.argsort(suffix_array(self.text.ids, int(lengths.max())), kind="stable")
        n = np.minimum(window, lengths)
        at, item = stretches(starts, starts + lengths - n + 1)
        keys, first, number = np.unique(self._keys(self.text, at), return_index=True, return_inverse=True)
        # suffixes in their order, and the window that each begins with
        order = np.argsort(rank[at], kind="stable")
        self.suffixes, self.begins = at[order], number[order]
        self.windows, self.lengths = self.text.ids[np.minimum(at[first][:, None] + np.arange(window), len(self.text.ids) - 1)].astype(">u4"), n[item][first]
        self.windows[np.arange(window) >= self.lengths[:, None]] = 0
        # the items of each window; equal lists of items are one
        pairs = np.unique(number * (len(self.names) + 1) + self.owners[item])
        of, name = pairs // (len(self.names) + 1), pairs % (len(self.names) + 1)
        edge = np.searchsorted(of, np.arange(len(keys) + 1))
        known: dict[bytes, int] = {}
        self.lists: list[np.ndarray] = []
        self.list_of = np.empty(len(keys), np.int64)
        for k in range(len(keys)):
            own = name[edge[k] : edge[k + 1]]
            self.list_of[k] = known.setdefault(own.tobytes(), len(self.lists))
            if self.list_of[k] == len(self.lists):
                self.lists.append(own)

    def _keys(self, text: Sequence, at: np.ndarray) -> np.ndarray:
        """The next words of each place, as far as its stretch goes, as bytes that sort like them."""
        out = np.zeros((len(at), self.window), ">u4")
        for k in range(self.window):
            out[:, k] = np.where(k < text.run[at], text.ids[np.minimum(at + k, len(text.ids) - 1)], 0)
        return out.view(f"S{4 * self.window}").ravel()

    def shard(self, text: Sequence) -> np.ndarray:
        """The shard's suffix array: the places of stretches of ``least`` words or more, in the order of all that follows in the stretch, by doubling."""
        end = np.arange(len(text.ids)) + text.run  # where each place's stretch ends
        whole = np.zeros(len(text.ids), np.int64)
        begin = np.flatnonzero((text.run > 0) & np.concatenate(([True], text.run[:-1] == 0)))
        whole[end[begin]] = text.run[begin]
        at = np.flatnonzero((text.run > 0) & (whole[end] >= self.least)) if self.least else np.zeros(0, np.int64)
        if not len(at):
            return at
        rank = np.unique(self._keys(text, at), return_inverse=True)[1] + 1
        span, most, of = self.window, int(text.run[at].max()), np.zeros(len(text.ids), np.int64)
        while span < most:
            of[at] = rank
            after = np.where(text.run[at] > span, of[np.minimum(at + span, len(of) - 1)], 0)
            values, rank = np.unique(rank * (int(rank.max()) + 1) + after, return_inverse=True)
            rank += 1
            span *= 2
            if len(values) == len(at):
                break
        return at[np.argsort(rank, kind="stable")]

    def search(self, text: Sequence, array: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every window that lies somewhere in the shard: its number, its place there and its length."""
        none = np.zeros(0, np.int64)
        if not len(array):
            return none, none, none
        key = self._keys(text, array)
        found = []
        for n in np.unique(self.lengths):
            which = np.flatnonzero(self.lengths == n)
            # the last number of the prefix plus one bounds the range from above
            lower = self.windows[which]
            upper = lower.copy()
            upper[:, n - 1] += 1
            # as bytes that sort like numbers; a pickled array comes back in the machine's own order
            low, high = (np.searchsorted(key, np.ascontiguousarray(x.astype(">u4")).view(f"S{4 * self.window}").ravel(), "left") for x in (lower, upper))
            inside, of = stretches(low, high)
            found.append((which[of], array[inside], np.full(len(of), n)))
        return tuple(map(np.concatenate, zip(*found, strict=True)))

    def longest(self, text: Sequence, array: np.ndarray, found: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place found the longest match with any suffix, in words, and where in the block it lies; ``found`` are the windows that the shard has."""
        suffixes = self.suffixes[np.isin(self.begins, found)]
        low, high = np.zeros(len(suffixes), np.int64), np.full(len(suffixes), len(array))
        while (low < high).any():  # the first place of the shard that isn't below the suffix
            middle = np.minimum((low + high) // 2, len(array) - 1)
            to = array[middle]
            n = agree(self.text, suffixes, text, to)
            below = (np.where(n < text.run[to], text.ids[to + n], 0) < self.text.ids[suffixes + n]) & (low < high)
            high = np.where(below | (low >= high), high, middle)
            low = np.where(below, middle + 1, low)
        place = np.zeros(len(text.ids), np.int64)
        place[array] = np.arange(len(array))
        j = np.searchsorted(low, place[at], "right")
        near = [suffixes[np.clip(j + k, 0, len(suffixes) - 1)] for k in (-1, 0)]
        n = [agree(text, at, self.text, to) for to in near]
        return np.maximum(*n), np.where(n[1] > n[0], near[1], near[0])

    def best(self, text: Sequence, array: np.ndarray, owner: np.ndarray, found: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, str, int]]:
        """The longest match of each document that has a window found: document, words, item and place.  ``owner`` is the document of each place."""
        parts = []
        for n in np.unique(lengths):  # among suffixes with windows of one length the nearest has the longest match, and it covers a window
            places = np.unique(at[lengths == n])
            parts.append((places, *self.longest(text, array, np.unique(found[lengths == n]), places)))
        places, m, to = map(np.concatenate, zip(*parts, strict=True))
        item = self.owners[np.searchsorted(self.starts, to, "right") - 1]
        doc = owner[places]
        order = np.lexsort((places, item, -m, doc))
        for i in order[np.flatnonzero(np.concatenate(([True], doc[order][1:] != doc[order][:-1])))].tolist() if len(order) else []:
            differ = np.flatnonzero(text.ids[places[i] : places[i] + m[i]] != self.text.ids[to[i] : to[i] + m[i]])
            yield int(doc[i]), int(differ[0] if len(differ) else m[i]), self.names[item[i]], int(places[i])


def _build(window: int, block_bytes: int):
    """A partition's items as pickled blocks; one that is twice as large as meant becomes several."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = [], 0
        out = lambda: pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Probe(block, window))], pa.binary())], ["data"])
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                t = t.as_py()
                size = len(t or b"") + 16
                if block and held + size > 2 * block_bytes:
                    yield out()
                    block, held = [], 0
                block.append((i, t))
                held += size
        if block:
            yield out()

    return work


def blocks(benchmark: DataFrame, item_id: str, item_text: str, window: int, block_bytes: int) -> list[str]:
    """The files, in the shared folder, of the benchmark's blocks; each row of a file is one."""
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), F.col(item_text).cast("binary").alias("t"))
    items, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("t") + 16), F.lit(0))).first()
    dealt = rows.repartition(max(1, min(items, -(-size // block_bytes))), "i", "t").sortWithinPartitions("i", "t")
    return sorted(written(arrow(dealt, _build(window, block_bytes), "data binary"), "benchmark")[1].inputFiles())


_only: dict[str, Probe] = {}


def opened(files: list[str]) -> Iterator[Probe]:
    """The blocks, one in memory at a time; a worker keeps a block that is the only one."""
    if len(files) == 1 and files[0] in _only:
        yield _only[files[0]]
        return
    for f in files:
        system, path = fs.FileSystem.from_uri(f)
        with system.open_input_file(path) as source:
            rows = pq.ParquetFile(source)
            for batch in rows.iter_batches(batch_size=1):
                probe = pickle.loads(batch.column(0)[0].as_buffer())
                if len(files) == 1 and rows.metadata.num_rows == 1:
                    _only.clear()
                    _only[f] = probe
                yield probe


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, block_bytes: int = 4 << 20, keep: bool = False) -> DataFrame:
    """One row for each document: its words, the hit words, the items found and where the longest match lies.

    Columns: ``id_col``, n_words, n_hit, n_items, items_sha256, contaminated,
    longest_match, match_item, match_at (word offset; -1: none), and with ``keep`` the
    whole input row as the struct ``row``.
    """
    files = blocks(benchmark, item_id, item_text, window, block_bytes)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
            out: list[tuple] = []
            for a, b in chunks(sizes, CHUNK_BYTES):
                tokens = [item_words(texts[i].as_py()) for i in range(a, b)]
                lengths = np.array([len(t) for t in tokens], np.int64)
                starts = np.cumsum(lengths + 1) - lengths - 1
                hit = np.zeros(int((lengths + 1).sum()), bool)
                items: list[set[str]] = [set() for _ in tokens]
                best: list[tuple[int, str, int]] = [(0, "", -1) for _ in tokens]
                for probe in opened(files):
                    get = probe.vocabulary.get
                    ids = np.zeros(len(hit), np.int64)
                    for s, n, t in zip(starts.tolist(), lengths.tolist(), tokens, strict=True):
                        ids[s : s + n] = np.fromiter(map(get, t, repeat(0)), np.int64, n)
                    text = Sequence(ids)
                    array = probe.shard(text)
                    number, at, n = probe.search(text, array)
                    if not len(at):
                        continue
                    cover = np.zeros(len(hit) + 1, np.int64)
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + n, -1)
                    hit |= np.cumsum(cover)[:-1] > 0
                    of = np.searchsorted(starts, np.arange(len(hit)), "right") - 1  # the document of each place
                    owner = of[at]
                    found = np.unique(owner * len(probe.lists) + probe.list_of[number])
                    for d, k in zip((found // len(probe.lists)).tolist(), (found % len(probe.lists)).tolist(), strict=True):
                        items[d].update(probe.names[j] for j in probe.lists[k])
                    for d, m, name, p in probe.best(text, array, of, number, at, n):
                        p -= int(starts[d])
                        if m > best[d][0] or m == best[d][0] and (name, p) < best[d][1:]:
                            best[d] = (m, name, p)
                for s, n, found, (m, name, p) in zip(starts.tolist(), lengths.tolist(), items, best, strict=True):
                    out.append((n, int(hit[s : s + n].sum()), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), m, name if m else None, p))
            cols = list(zip(*out, strict=True)) if out else [[]] * 7
            found = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *found, *batch.columns[2:]], ["id", *names, *batch.schema.names[2:]])

    names = ["n_words", "n_hit", "n_items", "items_sha256", "longest_match", "match_item", "match_at"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    held = [whole_row(docs).alias("row")] if keep else []
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("bytes"), *held)
    schema = T.StructType().add("id", docs.schema[id_col].dataType)
    for f in T.StructType.fromDDL("n_words long, n_hit long, n_items long, items_sha256 string, longest_match long, match_item string, match_at long").fields + plain.schema.fields[2:]:
        schema.add(f)
    found = arrow(plain, scan, schema)
    return found.select(F.col("id").alias(id_col), "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"), "longest_match", "match_item", "match_at", *(["row"] if keep else []))
