"""Multi-party perspective rotation of dialogues, with DataFrame operations only.

Every participant of a conversation (each distinct role other than ``context``)
becomes the assistant once: their turns are rendered as the assistant's and
trained on, everyone else's as a named user's, masked out.  Turns of the context
role stand as system turns and are masked out.

A dialogue is rendered whole, unless a row can't hold it: one of more than ``room``
bytes (or of more than ``most`` turns, where that is given) is cut into pieces, in order.  Each later piece begins with
the context turns before it and the last ``overlap`` turns before it, all masked out,
and is rendered for the participants who speak in the piece itself: every turn is
trained on exactly once, and no piece has nothing to train.  Of context turns alone
beyond ``room`` bytes only the first ones up to there are repeated; ``lead`` narrows them to those among
the dialogue's first turns.

A turn's place comes from ranges of the dialogue's order (number, role, text), each of
which counts its own, so no task orders all of a long dialogue, whatever its turn
numbers are; only turns that are equal in number, role and the beginning of their
texts stay in one range.

Edge cases: null conversation ids form one conversation; null turns count as turn 0;
a null role is the participant ``unknown``; a null text is empty; turns with equal
numbers follow by role, then text; repeated rows are repeated turns; a conversation
with only context turns gives no row; an empty table gives no rows; a text of any
length is rendered whole; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ranked

OPEN, CLOSE = "<|", "|>"
#: Bytes of turns that one piece of a dialogue holds.
ROOM = 128 << 20


def placed(rows: DataFrame, context: str, room: int, most: int | None) -> tuple[DataFrame, DataFrame]:
    """Rows with c, rank, piece and lead_ (bytes of context turns in the ranges before), and of dialogues in pieces where each piece starts (c, piece, start)."""
    rows = rows.withColumn("c", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    size = F.octet_length("role") + F.octet_length("body") + 32
    of_context = F.when(F.col("role") == context, size).otherwise(0)
    rows, sizes = ranked(rows, "c", ["turn", "role", "body"], [F.col("turn"), F.col("role"), F.substring("body", 1, 32)], "dialogues", bytes=size, context=of_context)
    if most is None:  # ranges are whole in a piece; a dialogue that fits has one
        large = sizes.where(F.col("bytes") > room).select("c", F.lit(True).alias("large"))
        rows = rows.join(large, "c", "left").withColumn("piece", F.when(F.col("large"), F.floor(F.col("bytes_before") / room)).otherwise(0).cast("long")).drop("large")
    else:
        rows = rows.withColumn("piece", F.floor(F.col("rank") / most))
    starts = rows.groupBy("c", "piece").agg(F.min("rank").alias("start")).where("piece > 0")
    return rows.withColumnRenamed("context_before", "lead_").drop("bytes_before"), starts


def rotate(chats: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", context: str = "system", most: int | None = None, overlap: int = 8, lead: int | None = None, room: int = ROOM) -> DataFrame:
    """conv_id, piece, perspective, n_turns, n_trained (turns), text, spans (start and end of trained characters) and trained_chars."""
    turn = F.coalesce(F.col(turn_col).cast("long"), F.lit(0))
    rows = chats.select(F.col(conv_col).alias("conv_id"), turn.alias("turn"), F.coalesce(F.col(role_col), F.lit("unknown")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    rows, starts = placed(rows, context, room, most)
    rows = rows.withColumn("again", F.lit(False))
    # what later pieces repeat: joined on dialogues in pieces, of which there are few
    later = F.col("start") > F.col("rank")
    near = later & (F.col("rank") >= F.col("start") - overlap)
    leads = later & (F.col("role") == context) & (F.col("lead_") <= room) & (F.lit(True) if lead is None else F.col("rank") < lead)
    repeated = rows.drop("piece", "again").join(starts, "c").where(near | leads).withColumn("again", F.lit(True)).drop("start")
    rows = rows.unionByName(repeated.select(rows.columns))
    # lengths of the turns before, with everyone as a user: a perspective's own heads are shorter by the same each
    named = F.when(F.col("role") == context, F.lit("system")).otherwise(F.concat(F.lit("user name="), F.col("role")))
    frame = len(OPEN + CLOSE) + 1
    before = F.sum(F.length(named) + frame + F.length("body") + 1).over(Window.partitionBy("c", "piece").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("at", F.coalesce(before, F.lit(0)))
    # at most ``room`` bytes and a range, and what is repeated
    pieces = rows.groupBy("c", "piece").agg(F.first("conv_id").alias("conv_id"), F.array_sort(F.collect_list(F.struct("rank", "role", "body", "again", "at"))).alias("turns"))
    spoken = F.array_sort(F.array_distinct(F.transform(F.filter("turns", lambda t: ~t["again"] & (t["role"] != context)), lambda t: t["role"])))
    seen = pieces.withColumn("perspective", F.explode(spoken))
    who = F.col("perspective")

    def render(t):
        head = F.when(t["role"] == who, F.lit("assistant")).when(t["role"] == context, F.lit("system")).otherwise(F.concat(F.lit("user name="), t["role"]))
        return F.concat(F.lit(OPEN), head, F.lit(CLOSE + "\n"), t["body"], F.lit("\n"))

    head = len("assistant") + frame
    shorter = F.length(F.concat(F.lit("user name="), who)) - len("assistant")
    own = F.transform(F.filter("turns", lambda t: t["role"] == who), lambda t, k: F.struct(t["again"].alias("again"), (t["at"] - k * shorter + head).alias("start"), (t["at"] - k * shorter + head + F.length(t["body"]) + 1).alias("stop")))
    spans = F.transform(F.filter(own, lambda s: ~s["again"]), lambda s: F.struct(s["start"].cast("long").alias("start"), s["stop"].cast("long").alias("stop")))
    seen = seen.select("conv_id", "piece", "perspective", F.size("turns").cast("long").alias("n_turns"), F.array_join(F.transform("turns", render), "").alias("text"), spans.alias("spans"))
    trained = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return seen.select("conv_id", "piece", "perspective", "n_turns", F.size("spans").cast("long").alias("n_trained"), "text", "spans", trained.alias("trained_chars"))
