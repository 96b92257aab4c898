"""Mixing sources to target weights, with DataFrame operations only.

Sources by code point (null last) weigh ``weights`` in turn and share ``share`` of
all words.  A target stops at ``most`` times its source's size and the excess goes
to the others by weight until none is above: the level at which the targets add up
is found from sums over the sources, never from their rows on the driver.

Each document has a random key, a hash of its id and text.  Its leading digits are a
bucket of its source; sums of the buckets and their prefix sums give every bucket its
offset, and the words before a document are that offset plus a running sum inside
its bucket.  A hot source, and documents that share an id or have none, are thus cut
over all buckets.  A source's place among all sources comes from a range sort and the
counts of its parts, so no task holds all sources.  Whole epochs are taken as
long as the budget holds them; the last one is cut at the exact budget, inside a
document if need be.

Edge cases: null and empty texts have size 0 and give 0 words; a text of any length
counts whole and may be cut; null sources are one source, the last; a table without
words has targets 0, an empty one gives no rows; documents with equal ids are told
apart by their texts; rows equal in id, source and text each count, and which of them
is cut makes no difference; other columns, whatever their names, come back as they
were in the struct ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, whole_row, words

BUCKET_DIGITS = 3  # hex digits: 4096 buckets a source


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, weight and target, from the columns source and size."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # the place of each source: that of its part's first one, and its own in the part
    own = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    per = cut(per.orderBy(F.col("source").asc_nulls_last()).select("*", F.spark_partition_id().alias("in_part"), own.alias("place")), "sources")
    before = F.sum("n").over(Window.orderBy("in_part").rowsBetween(Window.unboundedPreceding, -1))  # one row a part
    parts = per.groupBy("in_part").agg(F.count(F.lit(1)).alias("n")).select("in_part", F.coalesce(before, F.lit(0)).alias("before"))
    per = per.join(F.broadcast(parts), "in_part")  # at most ``spark.sql.shuffle.partitions`` rows
    rank = F.col("before") + F.col("place") + 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    ratio = F.col("cap") / F.col("weight")
    total = per.agg(F.coalesce(F.sum("source_size") * F.lit(float(share)), F.lit(0.0))).first()[0]
    level, left = 0.0, None
    while True:  # Newton's steps on a concave sum: the level only rises, and a round in which no source reaches its cap ends them
        full = ratio <= F.lit(level)
        s = per.agg(F.sum(F.when(full, F.col("cap"))).alias("c"), F.sum(F.when(~full, F.col("weight"))).alias("w"), F.count_if(~full).alias("n")).first()
        if not s["n"] or s["n"] == left:
            break
        left, level = s["n"], (total - (s["c"] or 0.0)) / s["w"]
    return per.select("source", "source_size", "weight", F.least(F.col("cap"), F.lit(level) * F.col("weight")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, keep: bool = False) -> DataFrame:
    """``id_col``, source, size, source_size, target, taken, epochs (whole ones) and part (words of the cut one); with ``keep`` the whole input row as the struct ``row``."""
    held = ["row"] if keep else []
    key = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"), F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.size(words(F.col(text_col))).cast("long").alias("size"), key.alias("key"), *([whole_row(docs).alias("row")] if keep else []))
    # the source as a key without null, so that joins can use the windows' partitioning
    sized = sized.withColumn("src", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))).withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    if not keep:
        sized = cut(sized, "sizes")
    sums = cut(sized.groupBy("src", "source", "bucket").agg(F.sum("size").alias("size")), "bucket-sums")
    goal = targets(sums, weights, share, most).withColumn("src", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    # at most 4096 rows a source meet here
    before = F.sum("size").over(Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select("src", "bucket", F.coalesce(before, F.lit(0)).alias("offset")).join(goal.drop("source"), "src")
    inside = Window.partitionBy("src", "bucket").orderBy("key", F.col("id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(offsets, ["src", "bucket"])
    budget: Column = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = budget - F.col("epochs") * F.col("source_size")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("offset") - F.col("ahead")))
    placed = placed.withColumn("epochs", epochs).withColumn("part", part)
    return placed.select(F.col("id").alias(id_col), "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"), "epochs", "part", *held)
