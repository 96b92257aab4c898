"""Shared pieces of the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space besides the space that separates words.
BREAKS = "\t\n\x0b\x0c\r"

_fallback: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.  A temporary one serves only where the setting is absent."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not _fallback:
        _fallback.append("file://" + tempfile.mkdtemp(prefix="aquifer-"))
    return _fallback[0]


def written(df: DataFrame, tag: str) -> tuple[str, DataFrame]:
    """Write ``df`` to a new folder of the shared one; its path, and the rows read from there."""
    path = f"{shared_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and a lost executor loses nothing."""
    return written(df, tag)[1]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)


def words(text: Column) -> Column:
    """Maximal runs of characters other than space and \\t..\\r; null has none."""
    text = F.coalesce(text, F.lit(""))
    for c in BREAKS:  # plain replacements and a plain split are far faster than a pattern
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def fold(doc_id: Column, modulus: int) -> Column:
    return F.crc32(doc_id.cast("string")) % modulus


def bounded_ids(ids: DataFrame, bound: int, by: str | None = None) -> DataFrame:
    """About ``bound`` rows of ``ids`` (for each value of ``by``), the same at each run.

    Rows are taken by a hash of ``doc_id`` below a rate that a count gives, so no
    row is sorted or moved and the expected number is the bound at any size.
    """
    spread = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    if by is None:
        total = ids.count()
        return ids.where(spread < min(1.0, bound / max(1, total)))
    rates = {r[0]: min(1.0, bound / r[1]) for r in ids.groupBy(by).count().collect()}
    if not rates:
        return ids
    rate = F.create_map(*[F.lit(x) for kv in rates.items() for x in kv])
    return ids.where(spread < rate[F.col(by)])


def chunks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most ``most`` bytes together, or one longer row."""
    start = total = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def whole_row(df: DataFrame, but: str | None = None) -> Column:
    """All columns, as they came, as one struct: names in it clash with nothing."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c != but])


def arrow(df: DataFrame, work, schema) -> DataFrame:
    """``mapInArrow``, with this library on the Python workers' path where they share the driver's disk.

    On a cluster that doesn't, the package goes along by ``--py-files`` or the image.
    """
    env = df.sparkSession.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    there = env.get("PYTHONPATH", "")
    if root not in there.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, there) if x)
    return df.mapInArrow(work, schema)


def ranked(rows: DataFrame, group: str, order: list[str], spread: list[Column], tag: str, **sums: Column) -> tuple[DataFrame, DataFrame]:
    """``rows`` with rank, each one's place (from 0) among those of its group, and a table of groups with n, their rows.

    Rows are dealt out by range of the group and ``spread`` (columns that order as
    ``order`` does, as far as they tell rows apart), so no task has to order all of a
    long group; only rows that are equal in both stay together.  Each range counts its
    rows of a group, and the counts before it are one number a range.  Of each of
    ``sums`` rows get name_before, what the ranges before have of their group, and groups get name,
    what all have.
    """
    dealt = rows.repartitionByRange(F.col(group), *spread).sortWithinPartitions(group, *order)
    dealt = cut(dealt.withColumn("at_", F.monotonically_increasing_id()), tag)
    part = F.shiftright("at_", 33).alias("part_")
    sums = {"n": F.lit(1).cast("long"), **sums}
    per = dealt.groupBy(group, part).agg(F.min("at_").alias("first_"), *[F.sum(c).alias(n) for n, c in sums.items()])
    before = Window.partitionBy(group).orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    per = cut(per.withColumns({f"{n}_before": F.coalesce(F.sum(n).over(before), F.lit(0)) for n in sums}), f"{tag}-ranges")
    out = dealt.withColumn("part_", F.shiftright("at_", 33)).join(per.drop(*sums), [group, "part_"])
    out = out.withColumn("rank", F.col("n_before") + F.col("at_") - F.col("first_")).drop("at_", "part_", "first_", "n_before")
    return out, per.groupBy(group).agg(*[F.sum(n).alias(n) for n in sums])
