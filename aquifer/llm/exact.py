"""Exact deduplication by Grace hashing.

Texts are equal when they are identical after lower-casing A-Z.  Each input partition
first combines its own equal texts, so that of a group of copies one record a stretch
of input travels, however large the group is.  Records are then dealt into buckets by
a hash of their text.  A bucket's task reads its records once, in a stream, into a
table with open addressing that compares whole texts and holds at most ``room`` bytes
of them.  A text that finds no place in a full table goes to a spill table in the
shared folder, as do all records equal to it; what spilled is dealt again, by another
hash and into as many buckets as its size asks for, until nothing spills.

What the tables find is one short row a group: its largest id and its size.  Documents
meet their groups by SHA-256.  Groups with over a thousandth of all rows (fewer than a
thousand by arithmetic) are broadcast, so no key of the shuffled join holds more.

Edge cases: null and empty texts are one group; a text of any length is compared
whole, and one longer than ``room`` has a table alone; a null id is smaller than all
others; of rows that are equal in text and id exactly one is kept; an empty table gives
no rows; ids are of any atomic type; other columns are ignored, whatever their names,
or come back as they came (``unique``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow, cut, whole_row, written

#: Bytes of text that a task's table holds, and that a bucket is meant to have.
ROOM, BUCKET = 64 << 20, 24 << 20


class Texts:
    """A table with open addressing and linear probing.  Each record holds a text, how many rows have it, and the largest id of those."""

    def __init__(self, room: int):
        self.room = room
        self.clear()

    def clear(self) -> None:
        self.slots = [-1] * 256
        self.hashes: list[int] = []
        self.texts: list[bytes] = []
        self.counts: list[int] = []
        self.largest: list = []
        self.held = 0

    def __len__(self) -> int:
        return len(self.texts)

    def _slot(self, h: int, text: bytes | None) -> int:
        """Where the text is, or the free slot where it would be; no text looks for a free slot only."""
        mask = len(self.slots) - 1
        at = h & mask
        while (k := self.slots[at]) >= 0 and (text is None or self.hashes[k] != h or self.texts[k] != text):
            at = (at + 1) & mask
        return at

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        for k, h in enumerate(self.hashes):
            self.slots[self._slot(h, None)] = k

    def add(self, h: int, text: bytes, n: int, largest) -> bool:
        """Count rows of a text; False if it is new and there is no room for it."""
        at = self._slot(h, text)
        if (k := self.slots[at]) < 0:
            if self.texts and self.held + len(text) > self.room:
                return False
            self.slots[at] = k = len(self.texts)
            self.hashes.append(h)
            self.texts.append(text)
            self.counts.append(0)
            self.largest.append(None)
            self.held += len(text) + 200  # a record's own weight
            if 2 * len(self.texts) > len(self.slots):
                self._grow()
        self.counts[k] += n
        if largest is not None and (self.largest[k] is None or largest > self.largest[k]):
            self.largest[k] = largest
        return True


def _hash(text: bytes, level: int) -> int:
    return xxhash.xxh3_64_intdigest(text, seed=level)


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Id, SHA-256 and bytes of each row's text, and what else came."""
    for b in batches:
        sha, size = [], []
        for x in b.column(1):
            t = (x.as_py() or b"").lower()  # of bytes: A-Z only
            sha.append(hashlib.sha256(t).digest())
            size.append(len(t))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sha, pa.binary()), pa.array(size, pa.int64()), *b.columns[2:]], ["id", "sha", "size", *b.schema.names[2:]])


def _combine(room: int):
    """The different texts of a stretch of input as records; a stretch ends when its texts fill the room."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, kind = Texts(room), None

        def records() -> Iterator[pa.RecordBatch]:
            step = 2048
            for a in range(0, len(table), step):
                cut = slice(a, a + step)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_signed(h) for h in table.hashes[cut]], pa.int64()), pa.array(table.texts[cut], pa.binary()), pa.array(table.counts[cut], pa.int64()), pa.array(table.largest[cut], kind)],
                    ["h", "text", "n", "largest"],
                )
            table.clear()

        for b in batches:
            kind = b.column(0).type
            for i, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                t = (x.as_py() or b"").lower()
                h = _hash(t, 0)
                if not table.add(h, t, 1, i):
                    yield from records()
                    table.add(h, t, 1, i)
        yield from records()

    return work


def _solve(room: int, level: int):
    """The groups of a bucket's records, without their texts; records without room come out with text and the next level's hash."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, kind = Texts(room), None

        def rows(sha: list, n: list, largest: list, h: list, text: list) -> pa.RecordBatch:
            size = [None if t is None else len(t) for t in text]
            return pa.RecordBatch.from_arrays([pa.array(sha, pa.binary()), pa.array(n, pa.int64()), pa.array(largest, kind), pa.array(h, pa.int64()), pa.array(text, pa.binary()), pa.array(size, pa.int64())], ["sha", "n", "largest", "h", "text", "size"])

        for b in batches:
            kind = b.column(3).type
            spilled = []
            for h, x, n, i in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                t = x.as_py()
                if not table.add(h & (1 << 64) - 1, t, n, i):
                    spilled.append((n, i, _signed(_hash(t, level + 1)), t))
            if spilled:
                n, i, h, t = map(list, zip(*spilled, strict=True))
                yield rows([None] * len(t), n, i, h, t)
        for a in range(0, len(table), 4096):
            cut = slice(a, a + 4096)
            none = [None] * len(table.texts[cut])
            yield rows([hashlib.sha256(t).digest() for t in table.texts[cut]], table.counts[cut], table.largest[cut], none, none)

    return work


def _schema(head: str, kind: T.DataType, tail: str) -> T.StructType:
    fields = T.StructType.fromDDL(head).fields + [T.StructField("largest", kind)] + T.StructType.fromDDL(tail).fields
    return T.StructType(fields)


def groups(plain: DataFrame, size: int, room: int = ROOM, bucket: int = BUCKET) -> DataFrame:
    """sha, n and largest of each different text of ``plain`` (id, t), whose texts have ``size`` bytes."""
    kind = plain.schema["id"].dataType
    records = arrow(plain, _combine(min(room, ROOM // 4)), T.StructType(T.StructType.fromDDL("h long, text binary, n long").fields + [T.StructField("largest", kind)]))
    found, level = None, 0
    while True:
        dealt = records.repartition(max(1, -(-size // bucket)), "h")
        _, out = written(arrow(dealt, _solve(room, level), _schema("sha binary, n long", kind, "h long, text binary, size long")), f"grace-{level}")
        done = out.where("sha IS NOT NULL").select("sha", "n", "largest")
        found = done if found is None else found.unionAll(done)
        spilled = out.where("sha IS NULL")
        size = spilled.agg(F.sum("size")).first()[0]
        if size is None:
            return found
        records, level = spilled.select("h", "text", "n", "largest"), level + 1


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", room: int = ROOM, bucket: int = BUCKET, keep: bool = False) -> DataFrame:
    """One row for each row: ``id_col``, keep_id, group_size, kept, text_sha256 and, with ``keep``, the whole input row as the struct ``row``."""
    held = [whole_row(docs).alias("row")] if keep else []
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t"), *held)
    schema = T.StructType([plain.schema["id"], *T.StructType.fromDDL("sha binary, size long").fields, *plain.schema.fields[2:]])
    rows = cut(arrow(plain, _digests, schema).withColumn("at", F.monotonically_increasing_id()), "digests")
    total, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    found = groups(plain.select("id", "t"), size, room, bucket).where("n > 1")
    # rows equal in text and id: the first of them stays
    again = rows.groupBy("sha", "id").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
    again = again.select(F.col("sha").alias("s"), "id", "first")
    found = cut(found.join(again, (F.col("sha") == F.col("s")) & F.col("largest").eqNullSafe(F.col("id")), "left").select("sha", "n", "largest", "first"), "groups")
    many = F.col("n") > max(1000, total // 1000)
    large = F.broadcast(found.where(many))  # fewer than 1,000 rows
    of = rows.join(large, "sha").unionByName(rows.join(large.select("sha"), "sha", "left_anti").join(found.where(~many), "sha", "left"))
    alone = F.col("n").isNull()
    kept = alone | (F.col("id").eqNullSafe(F.col("largest")) & F.coalesce(F.col("at") == F.col("first"), F.lit(True)))
    return of.select(F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("largest")).alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), *(["row"] if keep else []))


def unique(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", room: int = ROOM, bucket: int = BUCKET) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they came."""
    return deduplicate(docs, id_col, text_col, room, bucket, keep=True).where("kept").select("row.*")
