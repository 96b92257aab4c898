"""Relational operators that more than one plan needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the order; Spark prunes to it before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def latest_wins(df: DataFrame, keys: list[str], *times: str) -> DataFrame:
    """The row with the latest ``times`` of each key, nulls last."""
    return newest(df, keys, [F.col(t).desc_nulls_last() for t in times])


def canonical(df: DataFrame, column: str, keys: list[str], *times: str, bound: int = 10_000) -> DataFrame:
    """``column`` replaced by its value in the latest row of each key, ``times`` compared one after another, nulls last.

    The values of the keys come from a partial aggregate, one small row a key.  Up to
    ``bound`` of them are broadcast, so no row is shuffled; more are joined by key.
    """
    latest = df.groupBy(*keys).agg(F.max_by(column, F.struct(*times)).alias("_value"))
    few = latest.limit(bound + 1).collect()
    names = [f"_key{i}" for i in range(len(keys))]
    if len(few) <= bound:
        latest = F.broadcast(df.sparkSession.createDataFrame(few, latest.schema))
    same = F.lit(True)
    for k, n in zip(keys, names, strict=True):
        same = same & F.col(k).eqNullSafe(F.col(n))
    return df.join(latest.toDF(*names, "_value"), same, "left").withColumn(column, F.col("_value")).drop(*names, "_value")


def last_values(df: DataFrame, column: str, keys: list[str], *times: str, by: list[str] = ()) -> DataFrame:
    """The latest value of each key as a mergeable state: keys, ``by`` and latest, a struct of ``times`` and value that the later of two states is the larger of."""
    return df.groupBy(*keys, *by).agg(F.max(F.struct(*[F.col(t).alias(f"t{i}") for i, t in enumerate(times)], F.col(column).alias("value"))).alias("latest"))


def with_values(df: DataFrame, values: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """``column`` replaced by the value of the row's keys in ``values`` (keys and value).  A published table has a known size, by which Spark broadcasts it or doesn't."""
    names = [f"_key{i}" for i in range(len(keys))]
    same = F.lit(True)
    for k, n in zip(keys, names, strict=True):
        same = same & F.col(k).eqNullSafe(F.col(n))
    return df.join(values.select(*keys, "value").toDF(*names, "_value"), same, "left").withColumn(column, F.col("_value")).drop(*names, "_value")


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Insert, or update on a conflict of keys."""
    return incoming.unionByName(existing.join(incoming, keys, "left_anti"))


def insert_new(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Insert, or do nothing on a conflict of keys."""
    return upsert(incoming, existing, keys)


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one side only, once each, with the side they are on."""
    left = a.subtract(b).withColumn("side", F.lit("left"))
    return left.unionAll(b.subtract(a).withColumn("side", F.lit("right")))


def fan_out(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Tags each row with the first rule that holds, as ``route``; null if none does."""
    return df.withColumn("route", F.coalesce(*[F.when(c, F.lit(n)) for n, c in rules.items()]))
