"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint of 64 bits is cut into segments of two bits; their bit counts are a
point in a 32-dimensional grid.  The Manhattan distance of two points is a lower
bound of the Hamming distance of the fingerprints, so fingerprints within ``most``
bits lie within that Manhattan distance.  The segments form ``most`` + ``AGREE`` blocks; of a
pair within the distance at most ``most`` blocks differ, so at least ``AGREE`` agree.  The
range join is therefore an equi-join on the grid cells of each choice of ``AGREE``
blocks.  Of the pairs that share a cell, those whose points are within the Manhattan
distance are candidates, and are verified by the exact Hamming distance.

Only distinct fingerprints are joined, so exact copies cost nothing, and links are
never gathered: components come from distributed star contraction.  Components need
no more of a cell's links than a tree over each set they connect (:func:`spanning`), so
a group of near copies gives links in proportion to its size; :func:`links` has all pairs.

Edge cases: a text of fewer than four words has one shingle, its whole word
sequence; null, empty and blank texts have fingerprint 0, which links like any
other; a text of any length is read whole, eight bytes a word.  A null doc_id keeps
its own row and is ignored when the smallest id of a component is chosen (null where
no id is left).  Repeated rows are copies, each with its row; an empty table gives no
rows; other columns are ignored or, whatever their names, come back as they came.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow, cut, remove, whole_row, written

LANES = np.uint64(0x0101010101010101)
SEGMENTS = 32  # of two bits
#: Blocks that a cell is made of.  One more makes cells smaller, by more than the number of cells grows.
AGREE = 4
#: Points of a cell that one task compares; of a larger cell, each two pieces meet in a task of their own.
PIECE = 1 << 16
#: Points of a cell up to which all its pairs are compared at once.
SHORT = 16


def fingerprint(text: bytes | None, shingle: int = 4, seed: int = 42) -> int:
    """Bits set in more than half of the shingles' XXH64, as an unsigned number."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, seed)
    starts = [0, *(ends[:-shingle] + 1).tolist()]
    hashes = np.fromiter([digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)], np.uint64, len(starts))
    n = len(hashes)
    blocks = np.arange(0, n, 255)  # a byte lane holds up to 255 ones
    ones = np.empty((8, 8), np.int64)
    for k in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(k)) & LANES, blocks)
        ones[:, k] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int(np.packbits((ones.ravel() * 2 > n), bitorder="little").view("<u8")[0])


def row_hash(docs: DataFrame) -> Column:
    """A hash of the whole row; nulls and their places count."""
    plain = [F.map_entries(f"`{f.name}`") if f.dataType.typeName() == "map" else F.col(f"`{f.name}`") for f in docs.schema.fields]
    return F.xxhash64(*plain, F.concat(*[F.when(F.col(f"`{c}`").isNull(), F.lit("0")).otherwise(F.lit("1")) for c in docs.columns]))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """``id_col``, fp (the fingerprint as a signed long), text_hash and row_hash (of the whole row)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), b.column(2), b.column(3)], ["id", "fp", "text_hash", "row_hash"])

    kind = docs.schema[id_col].dataType.simpleString()
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t"), F.xxhash64(text_col).alias("h"), row_hash(docs).alias("r"))
    return arrow(plain, work, f"id {kind}, fp long, text_hash long, row_hash long").select(F.col("id").alias(id_col), "fp", "text_hash", "row_hash")


def _edges(most: int) -> list[int]:
    return [SEGMENTS * k // (most + AGREE) for k in range(most + AGREE + 1)]


def blocks(fp: Column, most: int) -> Column:
    """The bit counts of the segments of each block, packed into a number a block."""
    out = []
    for a, b in zip(_edges(most), _edges(most)[1:], strict=False):
        ones = F.lit(int("01" * (b - a), 2)).cast("long")
        bits = F.shiftrightunsigned(fp, 2 * a).bitwiseAND(F.lit((1 << 2 * (b - a)) - 1).cast("long"))
        out.append(bits.bitwiseAND(ones) + F.shiftright(bits, 1).bitwiseAND(ones))
    return F.array(*out)


def cells(of: Column, most: int) -> Column:
    """The grid cells of a fingerprint's blocks: those of each choice of ``AGREE``, packed behind the choice's number.

    The choices are data, a literal array, not expressions, so the plan stays small.
    """
    width = 2 * max(b - a for a, b in zip(_edges(most), _edges(most)[1:], strict=False))
    choices = F.lit([[number, *choice] for number, choice in enumerate(combinations(range(most + AGREE), AGREE))])

    def cell(choice: Column) -> Column:
        out = F.get(choice, F.lit(0)).cast("long")
        for k in range(AGREE):
            out = F.shiftleft(out, width) + F.get(of, F.get(choice, F.lit(k + 1)))
        return out

    return F.transform(choices, cell)


def point(fp: Column) -> Column:
    """A fingerprint's place in the grid: each segment's bit count in unary (0, 1 or 11), so that the Manhattan distance of two points is the number of bits in which they differ."""
    ones = F.lit(int("01" * SEGMENTS, 2)).cast("long")
    left, right = F.shiftrightunsigned(fp, 1).bitwiseAND(ones), fp.bitwiseAND(ones)
    return F.shiftleft(left.bitwiseAND(right), 1).bitwiseOR(left.bitwiseOR(right))


def manhattan(a: Column, b: Column) -> Column:
    return F.bit_count(point(a).bitwiseXOR(point(b)))


def _in_cells(fps: DataFrame, most: int, name: str) -> DataFrame:
    """The fingerprints, as ``name``, in each of their cells."""
    # a generator of one row, so that the blocks are counted once and not for each cell
    counted = fps.select("fp", F.explode(F.array(blocks(F.col("fp"), most))).alias("of"))
    return counted.select(F.col("fp").alias(name), F.explode(cells(F.col("of"), most)).alias("cell"))


def neighbours(fps: DataFrame, most: int) -> DataFrame:
    """Pairs a < b of distinct fingerprints, once for each cell they share."""
    return _in_cells(fps, most, "a").join(_in_cells(fps, most, "b"), "cell").where("a < b")  # one shuffle serves both sides


def candidates(fps: DataFrame, most: int) -> DataFrame:
    """The neighbours whose points lie within the Manhattan distance."""
    return neighbours(fps, most).where(manhattan(F.col("a"), F.col("b")) <= most)


def links(fps: DataFrame, most: int = 4) -> DataFrame:
    """Pairs u < v of distinct fingerprints that differ in at most ``most`` (1 to 7) bits; ``fps`` has distinct ``fp``."""
    if not 1 <= most <= 7:
        raise ValueError("the grid covers distances from 1 to 7")
    found = candidates(fps, most).where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most)
    return found.select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()


def _points(fps: np.ndarray) -> np.ndarray:
    """:func:`point` of many unsigned fingerprints."""
    ones = np.uint64(int("01" * SEGMENTS, 2))
    left, right = (fps >> np.uint64(1)) & ones, fps & ones
    return ((left & right) << np.uint64(1)) | left | right


def _tree(fps: np.ndarray, points: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what the links among the fingerprints connect, one less than each connected set has members.

    A fingerprint is compared only with those that no link has reached yet.
    """
    while len(fps) > 1:
        reached, fps, points = [(fps[0], points[0])], fps[1:], points[1:]
        while reached and len(fps):
            fp, at = reached.pop()
            near = np.flatnonzero(np.bitwise_count(points ^ at) <= most)
            near = near[np.bitwise_count(fps[near] ^ fp) <= most]
            if len(near):
                yield np.full(len(near), fp), fps[near]
                reached += zip(fps[near], points[near], strict=True)
                fps, points = np.delete(fps, near), np.delete(points, near)


def _cell_links(keys: np.ndarray, fps: np.ndarray, most: int, piece: int | None) -> Iterator[pa.RecordBatch]:
    """u < v of links that connect each whole cell's fingerprints, which stand together; a cell of over ``piece`` gives its key and null."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    points, us, vs = _points(fps), [], []
    left = np.repeat(starts + sizes, sizes) - np.arange(len(keys))  # of the cell, from each place on
    short = np.flatnonzero((left > 1) & (np.repeat(sizes, sizes) <= SHORT))
    for lag in range(1, SHORT):
        short = short[left[short] > lag]
        near = short[np.bitwise_count(points[short] ^ points[short + lag]) <= most]
        near = near[np.bitwise_count(fps[near] ^ fps[near + lag]) <= most]
        us.append(fps[near])
        vs.append(fps[near + lag])
    over = sizes > (len(keys) if piece is None else piece)
    for at, n in zip(*(x[(sizes > SHORT) & ~over].tolist() for x in (starts, sizes)), strict=True):
        for u, v in _tree(fps[at : at + n], points[at : at + n], most):
            us.append(u)
            vs.append(v)
    u, v = np.concatenate(us).view(np.int64), np.concatenate(vs).view(np.int64)
    if len(u):
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["u", "v"])
    if over.any():
        yield pa.RecordBatch.from_arrays([pa.array(keys[starts[over]]), pa.nulls(int(over.sum()), pa.int64())], ["u", "v"])


def _linked(dealt: DataFrame, most: int, piece: int | None) -> DataFrame:
    """Distinct rows of :func:`_cell_links` over the cells of ``dealt`` (key, fp); a task holds one cell at most, and the others of a batch."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps, passed = np.empty(0, np.int64), np.empty(0, np.uint64), None
        for b in batches:
            k, f = b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64)
            if passed is not None:  # more of a cell that is over
                k, f = k[k != passed], f[k != passed]
            keys, fps = np.r_[keys, k], np.r_[fps, f]
            if not len(keys):
                continue
            at = int(np.searchsorted(keys, keys[-1]))  # the last cell may go on
            if at:
                yield from _cell_links(keys[:at], fps[:at], most, piece)
                keys, fps = keys[at:], fps[at:]
            if piece is not None and len(keys) > piece:
                yield from _cell_links(keys, fps, most, piece)
                keys, fps, passed = keys[:0], fps[:0], keys[0]
        if len(keys):
            yield from _cell_links(keys, fps, most, piece)

    return arrow(dealt.select("key", "fp").repartition("key").sortWithinPartitions("key"), work, "u long, v long").distinct()


def spanning(fps: DataFrame, most: int = 4, piece: int = PIECE) -> DataFrame:
    """Links u < v that connect what all :func:`links` connect, for each cell at most in proportion to its fingerprints.

    Cells of over ``piece`` fingerprints are cut by hash into pieces of half of it or less, and each two
    pieces are compared in a group of their own, so each link's ends meet.
    """
    if not 1 <= most <= 7:
        raise ValueError("the grid covers distances from 1 to 7")
    found = cut(_linked(_in_cells(fps, most, "fp").withColumnRenamed("cell", "key"), most, piece), "links")
    large = found.where("v IS NULL").select(F.col("u").alias("cell"))
    found = found.where("v IS NOT NULL")
    if large.isEmpty():
        return found
    # one cell at most for each ``piece`` rows, so they can be sent to every task
    rows = _in_cells(fps, most, "fp").join(F.broadcast(large), "cell", "left_semi")
    sizes = rows.groupBy("cell").agg(F.ceil(F.count("*") * 2 / piece).alias("pieces"))
    rows = rows.join(F.broadcast(sizes), "cell").withColumn("own", F.pmod(F.xxhash64("fp", F.lit("piece")), "pieces"))
    rows = rows.select("cell", "fp", "pieces", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("other")).where("own <> other")
    pair = F.least("own", "other") * F.col("pieces") + F.greatest("own", "other")
    # groups whose keys collide are compared together, which adds no link that isn't one
    return found.union(_linked(rows.select(F.xxhash64("cell", pair).alias("key"), "fp"), most, None)).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node it reaches), for each node of the edges u < v.

    Alternating large-star and small-star contraction; each round's edges are
    written to the shared folder.  Every min is a partial aggregate and every
    large neighbourhood sits on a join side that AQE can split.
    """
    spark = edges.sparkSession
    path, edges = written(edges.select("u", "v"), "edges")
    last = None
    while True:  # every round shortens the chains; it ends only when all edges lead to roots
        # large star: larger neighbours of a node move to its smallest neighbour (or the node itself)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v").where("u < v").distinct()
        # small star: a node's smaller neighbours move to the smallest of them
        down = large.select(F.col("v").alias("n"), F.col("u").alias("s"))
        least = down.groupBy("n").agg(F.min("s").alias("m"))
        moved = down.join(least, "n").select(F.col("m").alias("u"), F.col("s").alias("v")).where("u < v")
        last_path = path
        path, edges = written(moved.union(least.select(F.col("m").alias("u"), F.col("n").alias("v"))).distinct(), "edges")
        remove(spark, last_path)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.count_distinct("v")).first()
        if state == last or state[0] == state[2] and edges.select(F.col("u").alias("v")).join(edges, "v", "left_semi").isEmpty():
            break
        last = state
    roots = edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return roots.union(edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


def _named(marked: DataFrame, first: Column, most: int) -> DataFrame:
    """fp, root and first (the least value of the column ``first``) for each distinct fingerprint."""
    fps = cut(marked.groupBy("fp").agg(F.min(first).alias("first")), "distinct")
    roots = components(spanning(fps, most))
    return fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, most: int = 4) -> DataFrame:
    """``id_col``, fingerprint (16 hex digits) and component_id (the smallest id reachable over links) for each document."""
    marked = cut(fingerprints(docs, id_col, text_col, shingle).drop("row_hash"), "fingerprints")
    fps = _named(marked, F.col(id_col), most)  # a null id is no least one
    named = fps.groupBy("root").agg(F.min("first").alias("component_id"))
    named = fps.join(named, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, most: int = 4) -> DataFrame:
    """One row of each group of near-duplicates, all columns as they came.

    It is the row with the smallest id, null ids last; of rows with equal ids the
    one whose text, then whose whole row, has the smallest hash.  Rows equal in every
    column are one row, so the order of arrival decides nothing.
    """
    marked = cut(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "text_hash", "row_hash")
    chosen = _named(marked, order, most).groupBy("root").agg(F.min("first").alias("first"))
    keys = chosen.select(F.col("first.text_hash").alias("h"), F.col("first.row_hash").alias("r")).distinct()
    rows = docs.select(whole_row(docs).alias("row"), F.xxhash64(text_col).alias("h"), row_hash(docs).alias("r"))
    return rows.join(keys.hint("shuffle_hash"), ["h", "r"], "left_semi").dropDuplicates(["h", "r"]).select("row.*")
