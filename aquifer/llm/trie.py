"""A prefix trie of conversations by LCP-aware external mergesort.

A node is a distinct sequence of a conversation's first turns (role and text).  Tasks
sort what they have into runs, whose records carry the number of turns they share with
the record before them (LCP); the runs are written out, and dealt by range of turns, so
that each task merges its slices of all runs.  The merge is a loser tree that compares
two records only beyond the turns that both share with the last one put out.  Over the
merged stream lies a stack of open nodes, the path of the last record: a node is
finished, with its members, leaves and savings, when the stream leaves it.

A range's first and last paths may go on in its neighbours.  Their nodes, the seams,
come out as parts with a key (a digest of their turns), and meet by it; what they add to
the nodes above is summed along their paths.  Ranges are cut by conversation id too,
so conversations that are all alike, or share a turn, spread over as many tasks as
their rows need.

A record holds at most ``span`` turns.  Conversations that agree in all of those and go
on are compared further in another round, as members of the node where they stand; one
that stands there alone needs no comparing, as each of its further turns is a node with
itself as member.  So a round costs what two conversations share.

Edge cases: turns without a conversation id belong to none and make no node; null turns
come first; turns of one number follow by role, then text; null roles and texts are
empty; repeated rows are repeated turns; conversations without turns are members of
the root; texts of any length are compared whole; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow, cut, ranked

#: Turns of a record, bytes of a run, and bytes that a range is meant to have.
SPAN, RUN, RANGE = 1024, 16 << 20, 16 << 20

Turn = tuple[int, int, bytes, bytes]  # two hashes, which order turns before their words do, role and text
Record = tuple[tuple, int, bool]  # class and turns as one sequence, conversation, and whether it goes on


def shared(a: tuple, b: tuple, start: int = 0) -> int:
    """How many elements two sequences share from their beginning; ``start`` of them are known."""
    n = min(len(a), len(b))
    while start < n and a[start] == b[start]:
        start += 1
    return start


def merged(runs: list[list[tuple[Record, int]]]) -> Iterator[tuple[Record, int]]:
    """The records of sorted runs in order, each with what it shares with the one before; runs carry the same.

    A loser tree: each inner node holds the run that lost there.  Every run's ``lcp`` is
    what its record shares with the last one put out, so the longer one is the smaller, and
    only equal ones are compared, from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    at, lcp = [0] * k, [0] * k
    head: list[Record | None] = [r[0][0] if r else None for r in runs] + [None] * (k - len(runs))

    def play(i: int, j: int) -> tuple[int, int]:
        """Winner and loser; the loser's lcp becomes what it shares with the winner."""
        a, b = head[i], head[j]
        if a is None or b is None:
            return (j, i) if a is None else (i, j)
        if lcp[i] != lcp[j]:
            return (i, j) if lcp[i] > lcp[j] else (j, i)
        n = shared(a[0], b[0], lcp[i])
        x, y = a[0][n : n + 1], b[0][n : n + 1]
        won = (i, j) if (x, a[1]) <= (y, b[1]) else (j, i)
        lcp[won[1]] = n
        return won

    lost = [0] * k

    def first(node: int) -> int:
        if node >= k:
            return node - k
        won, lost[node] = play(first(2 * node), first(2 * node + 1))
        return won

    top = first(1)
    while (record := head[top]) is not None:
        yield record, lcp[top]
        at[top] += 1
        run = runs[top]
        head[top], lcp[top] = run[at[top]] if at[top] < len(run) else (None, 0)
        node = (top + k) // 2
        while node:
            top, lost[node] = play(top, lost[node])
            node //= 2


class Node:
    __slots__ = ("above", "children", "conv", "ends", "going", "key", "leaves", "members", "rows", "saved", "seam", "slot", "turn", "words")

    def __init__(self, above: Node | None, slot: int, turn: Turn | None, seam: bool):
        self.above, self.slot, self.turn, self.seam = above, slot, turn, seam
        self.key: bytes | None = None
        self.members = self.children = self.leaves = self.saved = 0
        self.conv: int | None = None
        self.words = len(turn[3].split()) if turn else 0  # of bytes: at \x20 and \x09-\x0D only
        self.ends: list[int] = []
        self.going: list[int] = []
        self.rows: list[tuple] = []

    def digest(self) -> bytes:
        if self.key is None:
            role, text = self.turn[2:]
            self.key = hashlib.blake2b(self.above.digest() + len(role).to_bytes(8, "big") + role + text, digest_size=20).digest()
        return self.key

    def path(self) -> list[bytes]:
        """Keys of the nodes above, the nearest first."""
        out, x = [], self.above
        while x is not None:
            out.append(x.digest())
            x = x.above
        return out


def sha(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


#: What a range gives: finished nodes (parent known, or by its slot), seams (with key), and conversations that go on (conv_id and key).
OUT = "kind int, part int, slot long, conv_id long, depth long, parent long, above long, n_convs long, n_children long, n_leaves long, saved long, ends string, key binary, path array<binary>, words long"
_ARROW = pa.schema([("kind", pa.int32()), ("part", pa.int32()), *[(n, pa.int64()) for n in "slot conv_id depth parent above n_convs n_children n_leaves saved".split()], ("ends", pa.string()), ("key", pa.binary()), ("path", pa.list_(pa.binary())), ("words", pa.int64())])
NODE, LOOSE, SEAM, GOING = range(4)


def grown(records: Iterator[tuple[Record, int]], part: int, depth: int) -> Iterator[tuple]:
    """Rows of ``OUT`` for the nodes of a merged stream; ``depth`` is that of the classes."""
    stack: list[Node] = []
    slots, begun = 0, False
    out: list[tuple] = []

    def leave(keep: int) -> None:
        while len(stack) > keep:
            x = stack.pop()
            d = depth + len(stack)
            up = x.above
            x.seam |= bool(x.going)
            if x.seam:
                ends = ",".join(map(str, x.ends))
                out.append((SEAM, part, x.slot, x.conv, d, None, None, x.members, x.children, x.leaves, x.saved, ends, x.digest(), x.path(), x.words))
                out.extend((LOOSE, part, x.slot, *row[:2], None, None, *row[2:], None, None, None) for row in x.rows)
                out.extend((GOING, part, x.slot, c, d, *[None] * 7, x.key, None, None) for c in x.going)
                if up is not None:
                    up.seam = True
            else:
                x.leaves = x.leaves or 1
                x.saved += (x.members - 1) * x.words
                out.extend((NODE, part, None, *row[:2], x.conv, None, *row[2:], None, None, None) for row in x.rows)
                up.rows.append((x.conv, d, x.members, x.children, x.leaves, x.saved, sha(x.ends)))
                up.children += 1
                up.leaves += x.leaves
                up.saved += x.saved
            if up is not None:
                up.members += x.members
                up.conv = x.conv if up.conv is None else min(up.conv, x.conv)

    for (seq, conv, more), n in records:
        leave(n)
        yield from out
        out.clear()
        for turn in seq[len(stack) :]:
            node = Node(stack[-1] if stack else None, slots, turn if stack else None, not begun or not stack)
            if not stack:
                node.key = turn  # the class
            stack.append(node)
            slots += 1
        begun = True
        last = stack[-1]
        last.members += 1
        last.conv = conv if last.conv is None else min(last.conv, conv)
        (last.going if more else last.ends).append(conv)
    for x in stack:
        x.seam = True
    leave(0)
    yield from out


def _sequence(cls: bytes, turns: list[dict]) -> tuple:
    return (cls, *[(t["a"], t["b"], t["role"], t["body"]) for t in turns])


def _runs(most: int):
    """Sorted runs of at most ``most`` bytes: each record with its run, its number there and its LCP."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held, rows = TaskContext.get().partitionId(), 0, 0, []

        def run() -> Iterator[pa.RecordBatch]:
            nonlocal made
            rows.sort(key=lambda r: (r[0], r[1]["conv"]))
            lcp = [0] + [shared(a[0], b[0]) for a, b in zip(rows, rows[1:])]
            for a in range(0, len(rows), 1024):
                some = rows[a : a + 1024]
                k = range(a, a + len(some))
                yield pa.RecordBatch.from_arrays([pa.array([part << 32 | made] * len(some), pa.int64()), pa.array(k, pa.int64()), pa.array(lcp[a : a + len(some)], pa.int64()), *[pa.array([r[1][f.name] for r in some], f.type) for f in schema]], ["run", "place", "lcp", *schema.names])
            made += 1
            rows.clear()

        for b in batches:
            schema = b.schema
            for r in b.to_pylist():
                rows.append((_sequence(r["cls"], r["turns"]), r))
                held += r["bytes"]
                if held > most:
                    yield from run()
                    held = 0
        if rows:
            yield from run()

    return work


def _grow(depth: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[int, list[tuple[Record, int]]] = {}
        place: dict[int, int] = {}
        for b in batches:
            for r in b.to_pylist():
                run, k = r["run"], r["place"]
                # what a record shares with one that another range has is found anew
                lcp = r["lcp"] if place.get(run) == k - 1 else 0
                place[run] = k
                runs.setdefault(run, []).append(((_sequence(r["cls"], r["turns"]), r["conv"], r["more"]), lcp))
        slices = list(runs.values())
        for s in slices:
            for i in range(1, len(s)):
                if not s[i][1]:
                    s[i] = s[i][0], shared(s[i - 1][0][0], s[i][0][0])
        rows = grown(merged(slices), TaskContext.get().partitionId(), depth)
        some: list[tuple] = []
        for row in rows:
            some.append(row)
            if len(some) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), _ARROW.types, strict=True)], schema=_ARROW)
                some = []
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), _ARROW.types, strict=True)], schema=_ARROW)

    return work


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's ids, which come in order; a hash has one order, so a key's parts pass through one task as a stream."""
    key, state = None, None
    for b in batches:
        keys, shas = [], []
        for k, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
            if k == key:
                state.update(b"," + ids.encode())
                continue
            if state is not None:
                keys.append(key)
                shas.append(state.hexdigest())
            key, state = k, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(shas, pa.string())], ["key", "ends"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["key", "ends"])


def _round(records: DataFrame, depth: int, run: int, size: int) -> DataFrame:
    """One round over records (cls, conv, more, turns, bytes)."""
    kinds = "run long, place long, lcp long, cls binary, conv long, more boolean, bytes long, turns array<struct<a: bigint, b: bigint, role: binary, body: binary>>"
    runs = cut(arrow(records.select("cls", "conv", "more", "bytes", "turns"), _runs(run), kinds), "runs")
    total = runs.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    order = F.flatten(F.transform("turns", lambda t: F.array(t["a"], t["b"])))
    dealt = runs.withColumn("order", order).repartitionByRange(max(1, -(-total // size)), "cls", "order", "conv").sortWithinPartitions("run", "place")
    return cut(arrow(dealt.drop("order", "bytes"), _grow(depth), OUT), "trie")


def _segments(turns: DataFrame, convs: DataFrame, span: int) -> DataFrame:
    """Records of at most ``span`` turns: conv, segment, m (turns of the conversation), turns and bytes; a conversation without turns has one, too."""
    a, b = F.xxhash64("role", "body"), F.xxhash64("body", "role", F.lit(1))
    turn = F.struct("pos", a.alias("a"), b.alias("b"), F.col("role").cast("binary").alias("role"), F.col("body").cast("binary").alias("body"))
    rows = turns.groupBy("conv", F.floor(F.col("pos") / span).alias("segment")).agg(F.array_sort(F.collect_list(turn)).alias("t"), F.max("m").alias("m"), F.sum(F.octet_length("role") + F.octet_length("body") + 64).alias("bytes"))
    bare = F.transform("t", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["role"].alias("role"), t["body"].alias("body")))
    rows = rows.select("conv", "segment", "m", bare.alias("turns"), "bytes")
    none = convs.where("m = 0").select("conv", F.lit(0).cast("long").alias("segment"), F.lit(0).cast("long").alias("m"), F.array().cast("array<struct<a:bigint,b:bigint,role:binary,body:binary>>").alias("turns"), F.lit(64).cast("long").alias("bytes"))
    return rows.unionByName(none)


def build(turns: DataFrame, convs: DataFrame, span: int = SPAN, run: int = RUN, size: int = RANGE) -> DataFrame:
    """The nodes of a trie, over turns (conv, pos from 0, role, body, m: the conversation's turns) of all ``convs`` (conv, m).

    Columns: conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256.
    """
    segments = cut(_segments(turns, convs, span), "segments")
    records = segments.where("segment = 0").withColumn("cls", F.lit(b"").cast("binary"))
    rounds: list[DataFrame] = []
    tails: list[DataFrame] = []
    while True:
        k = len(rounds)
        out = _round(records.withColumn("more", F.col("m") > (k + 1) * span), k * span, run, size)
        rounds.append(out)
        going = out.where(F.col("kind") == GOING).select(F.col("conv_id").alias("conv"), "key")
        if going.isEmpty():
            tails.append(None)
            break
        going = cut(going.join(going.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "key"), "going")
        tails.append(segments.where(F.col("segment") > k).join(going.where("n = 1").select("conv", "key"), "conv"))
        further = going.where("n > 1").select("conv", F.col("key").alias("cls"))
        if further.isEmpty():
            break
        records = segments.where(F.col("segment") == k + 1).join(further, "conv")
    return _joined(rounds, tails, span)


def _joined(rounds: list[DataFrame], tails: list[DataFrame | None], span: int) -> DataFrame:
    """Nodes of all rounds, seams put together from the last round to the first."""
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    nodes: DataFrame | None = None
    below: DataFrame | None = None  # key, children, leaves and saved of what continues in the next round or alone

    def add(df: DataFrame) -> None:
        nonlocal nodes
        df = df.select(*names)
        nodes = df if nodes is None else nodes.unionByName(df)

    seams = []
    for k, out in enumerate(rounds):
        parts = out.where(F.col("kind") == SEAM)
        s = parts.groupBy("key").agg(F.max("depth").alias("depth"), F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), total("n_children"), total("n_leaves"), total("saved"), F.max("words").alias("words"), F.any_value("path").alias("path"))
        if k:  # the class is a node of the round before, and has its smallest member
            s = s.join(seams[-1].select("key", F.col("conv_id").alias("c")), "key", "left").withColumn("conv_id", F.coalesce("c", "conv_id")).drop("c")
        seams.append(cut(s, "seams"))
    for k in reversed(range(len(rounds))):
        out, s = rounds[k], seams[k]
        conv = s.select("key", F.col("conv_id").alias("parent_conv_id"))
        if tails[k] is not None:
            turn = tails[k].join(conv, "key").select("conv", "m", "parent_conv_id", F.posexplode("turns").alias("i", "t"), "segment")
            d = F.col("segment") * span + F.col("i") + 1
            last, up = d == F.col("m"), F.when(d == (k + 1) * span + 1, F.col("parent_conv_id")).otherwise(F.col("conv"))
            ends = F.sha2(F.when(last, F.col("conv").cast("string")).otherwise(""), 256)
            zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
            add(turn.select(F.col("conv").alias("conv_id"), d.alias("depth"), up.alias("parent_conv_id"), one.alias("n_convs"), F.when(last, zero).otherwise(one).alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"), ends.alias("ends_sha256")))
            lone = tails[k].where(F.col("segment") == k + 1).select("key", one.alias("children"), one.alias("leaves"), zero.alias("more"))
            below = lone if below is None else below.unionByName(lone)
        fan = s.where(F.size("path") > 0).groupBy(F.get("path", F.lit(0)).alias("key")).agg(F.count(F.lit(1)).alias("fan"))
        s2 = s.join(fan, "key", "left")
        if below is not None:
            s2 = s2.join(below, "key", "left")
        else:
            s2 = s2.withColumns({c: F.lit(None).cast("long") for c in ("children", "leaves", "more")})
        n0 = lambda c: F.coalesce(c, F.lit(0))
        s2 = s2.withColumn("n_children", F.col("n_children") + n0("fan") + n0("children"))
        own = F.when(F.size("path") > 0, (F.col("n_convs") - 1) * F.col("words")).otherwise(0)
        s2 = s2.withColumns({"x": F.col("n_leaves") + n0("leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0), "y": F.col("saved") + n0("more") + own})
        s2 = cut(s2.select("key", "depth", "conv_id", "n_convs", "n_children", "path", "x", "y"), "counted")
        sums = s2.select(F.explode(F.concat(F.array("key"), "path")).alias("key"), "x", "y").groupBy("key").agg(F.sum("x").alias("n_leaves"), F.sum("y").alias("saved_tokens"))
        s3 = s2.drop("x", "y").join(sums, "key")
        below = s3.where(F.size("path") == 0).select("key", F.col("n_children").alias("children"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("more")) if k else None
        ids = out.where((F.col("kind") == SEAM) & (F.col("ends") != "")).select("key", "part", "ends")
        ends = arrow(ids.repartition("key").sortWithinPartitions("key", "part"), _hashed, "key binary, ends string")
        own_rows = s3.where((F.size("path") > 0) | (F.lit(k) == 0)).join(ends, "key", "left").withColumn("up", F.get("path", F.lit(0)))
        own_rows = own_rows.join(conv.withColumnRenamed("key", "up"), "up", "left").withColumn("ends_sha256", F.coalesce("ends", F.sha2(F.lit(""), 256)))
        add(own_rows)
        done = out.where(F.col("kind") == NODE).select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
        add(done)
        slots = out.where(F.col("kind") == SEAM).select("part", "slot", "key").join(conv, "key").drop("key")
        loose = out.where(F.col("kind") == LOOSE).join(slots, ["part", "slot"])  # a range's own rows only: no key is larger than a range
        add(loose.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256")))
    return nodes


def rebuilt(chats: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block: int = 20, lead: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with another's turns: (conv, pos, role, body, m) and (conv, m).

    Conversation c takes the first h turns of conversation c - c % ``block`` (the remainder has the sign of c), where h is
    crc32 of its decimal id modulo ``lead``, in place of its own first h.
    """
    rows = chats.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    rows, sizes = ranked(rows, "conv", ["turn", "role", "body"], [F.col("turn"), F.col("role"), F.substring("body", 1, 32)], "turns")
    h = (F.crc32(F.col("conv").cast("string")) % lead).alias("h")
    own = sizes.select("conv", "n", h, (F.col("conv") - F.col("conv") % block).alias("base"))
    of = sizes.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    taken = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = own.join(of, "base", "left").select("conv", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("long").alias("m"))
    convs = cut(convs, "conversations")
    kept = rows.join(convs, "conv").where("rank >= h").select("conv", (F.col("rank") - F.col("h") + F.col("taken")).alias("pos"), "role", "body", "m")
    first = rows.where(F.col("rank") < lead - 1).select(F.col("conv").alias("base"), "rank", "role", "body")
    given = convs.where("taken > 0").join(first, "base").where("rank < taken").select("conv", F.col("rank").alias("pos"), "role", "body", "m")
    return kept.unionByName(given), convs.select("conv", "m")


def nodes(chats: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The trie of conversations as they are."""
    rows = chats.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    rows, sizes = ranked(rows, "conv", ["turn", "role", "body"], [F.col("turn"), F.col("role"), F.substring("body", 1, 32)], "turns")
    return build(rows.join(sizes, "conv").select("conv", F.col("rank").alias("pos"), "role", "body", F.col("n").alias("m")), sizes.select("conv", F.col("n").alias("m")))
