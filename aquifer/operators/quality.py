"""Expectations as queries for violations, and gates that read a table once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateError(ValueError):
    """A table failed a gate."""


def null_rows(df: DataFrame, *columns: str) -> DataFrame:
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.col(c).isNull()
    return df.where(bad)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row, and their number."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def out_of_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Rows outside the closed range; nulls pass."""
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    return df.where(bad)


def unexpected(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values other than the accepted ones, and their rows."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(values)).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key the parent lacks; null keys pass."""
    other = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return child.where(F.col(key).isNotNull()).join(other, key, "left_anti")


def freshness(df: DataFrame, column: str, now: Column, warn_hours: int = 36, error_hours: int = 72) -> DataFrame:
    """One row: the latest instant, complete hours since, and pass, warn or error (no rows: error)."""
    out = df.agg(F.max(column).alias("latest")).withColumn("hours_since", F.timestamp_diff("HOUR", F.col("latest"), now))
    status = F.when(F.col("latest").isNull() | (F.col("hours_since") >= error_hours), "error").when(F.col("hours_since") >= warn_hours, "warn").otherwise("pass")
    return out.withColumn("status", status)


def same_lengths(lengths_of: Column, arrays: dict[str, Column]) -> Column:
    """Names of the arrays that are missing or not as long as the first."""
    return F.array_compact(F.array(*[F.when(F.coalesce(F.size(a) != F.size(lengths_of), F.lit(True)), F.lit(n)) for n, a in arrays.items()]))


def gate(df: DataFrame, checks: dict[str, Column], keys: list[str] | None = None) -> dict:
    """Counts the rows and what each check finds, in one pass, plus duplicated keys in another.

    ``checks`` maps names to aggregates; the result maps them to values.
    """
    found = df.agg(F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in checks.items()]).first().asDict()
    if keys:
        found["duplicate_keys"] = duplicate_keys(df, keys).count()
    return found


def require(found: dict, zero: list[str], rates: dict[str, float] | None = None) -> dict:
    """Raises if there are no rows, a count that must be 0 isn't, or a rate is over its limit."""
    bad = [f"{n}={found[n]}" for n in zero if found[n]] + [f"{n}={found[n]:.3f}" for n, most in (rates or {}).items() if (found[n] or 0) > most]
    if not found["rows"]:
        bad.insert(0, "no rows")
    if bad:
        raise GateError(", ".join(bad))
    return found
