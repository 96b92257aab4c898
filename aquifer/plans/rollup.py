"""The sensors' hourly rollup as a state that batches are merged into.

A batch becomes partial states, one row a city and hour: counts, sums, least and
greatest values.  Two states of an hour merge into one, so a batch costs its own rows
and the states of the days it touches, whatever the history.  Devices are counted
exactly: each gets a number at its first sight, and the devices of an hour are a bitmap
of numbers, in pieces of 32,768; bitmaps merge by or.

States are tables in parts, one a day.  Each pointer notes the last batch merged, so a
batch that is repeated after a failure changes nothing, and one that was merged into
some tables is merged into the others.  Batches have ascending numbers and one writer.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import sinks
from . import models

KEYS = ["city_id", "measured_at_utc"]


class State(NamedTuple):
    """One column of a partial state: what a batch's rows add up to, and how two states become one."""

    add: Column
    merge: Callable[[str], Column]


def states() -> dict[str, State]:
    out = {
        "city_name": State(F.max("city_name"), F.max),
        "country_code": State(F.max("country_code"), F.max),
        "n": State(F.count(F.lit(1)), F.sum),
        "first_sensor_event_at": State(F.min("event_time_utc"), F.min),
        "last_sensor_event_at": State(F.max("event_time_utc"), F.max),
        "sensor_data_updated_at": State(F.max("processed_at"), F.max),
    }
    for c in ("temperature_2m", "relative_humidity_2m", "pm2_5", "pm10", "carbon_monoxide", "nitrogen_dioxide"):
        out[f"sum_{c}"], out[f"count_{c}"] = State(F.sum(c), F.sum), State(F.count(c), F.sum)
    for c in ("pm2_5", "pm10"):
        out[f"min_{c}"], out[f"max_{c}"] = State(F.min(c), F.min), State(F.max(c), F.max)
    return out


def partial(readings: DataFrame) -> DataFrame:
    """Readings as states."""
    return readings.groupBy("city_id", F.date_trunc("hour", "event_time_utc").alias("measured_at_utc")).agg(*[s.add.alias(n) for n, s in states().items()])


def merged(both: DataFrame) -> DataFrame:
    return both.groupBy(*KEYS).agg(*[s.merge(n).alias(n) for n, s in states().items()])


def _day() -> Column:
    return F.to_date("measured_at_utc").cast("string")


def _put(spark: SparkSession, path: str, batch: int, fresh: DataFrame, merge: Callable[[DataFrame], DataFrame]) -> list[str]:
    """Merge fresh states into a table's days; the days touched."""
    old = sinks.pointed(spark, path) or {"batch": -1, "parts": {}, "schema": fresh.schema.jsonValue()}
    if batch <= old["batch"]:
        return []
    days = sorted(r[0] for r in fresh.select(_day().alias("d")).distinct().collect())  # a batch has few days
    held = [d for d in days if d in old["parts"]]
    both = fresh.unionByName(sinks.published(spark, path, held)) if held else fresh
    folders = sinks.write_parts(merge(both), path, _day())
    sinks.point(spark, path, {"schema": old["schema"], "batch": batch, "parts": old["parts"] | {d: {"folder": f} for d, f in folders.items()}})
    return days


def _numbered(spark: SparkSession, path: str, batch: int, devices: DataFrame) -> DataFrame:
    """Every device's number.  New ones are numbered without gaps: in their task's order, after the tasks before."""
    old = sinks.pointed(spark, path) or {"batch": -1, "parts": {}, "schema": None, "next": 1}
    if batch > old["batch"]:
        fresh = devices.where("device_id IS NOT NULL").distinct()
        if old["parts"]:
            fresh = fresh.join(sinks.published(spark, path).select("device_id"), "device_id", "left_anti")
        folder = sinks.write_parts(fresh.withColumn("at", F.monotonically_increasing_id()), f"{path}/drafts", None)[""]
        rows = spark.read.parquet(f"{path}/drafts/versions/{folder}").withColumn("task", F.shiftright("at", 33))
        per = rows.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))  # one row a task
        before = F.coalesce(F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        per = per.select("task", "first", before.alias("before"))
        numbered = rows.join(per, "task").select("device_id", (F.lit(old["next"]) + F.col("before") + F.col("at") - F.col("first")).cast("long").alias("number"))
        put = sinks.write_parts(numbered, path, None)[""]
        sinks.point(spark, path, {"schema": numbered.schema.jsonValue(), "batch": batch, "next": old["next"] + rows.count(), "parts": old["parts"] | {str(batch): {"folder": put}}})
    return sinks.published(spark, path)


def merge(readings: DataFrame, base: str, batch: int) -> list[str]:
    """Merge a batch of clean readings into the states below ``base``; the days it touched.  ``readings`` is read four times, so give it written or persisted."""
    spark = readings.sparkSession
    numbers = _numbered(spark, f"{base}/devices", batch, readings.select("device_id"))
    bits = readings.join(numbers, "device_id").groupBy("city_id", F.date_trunc("hour", "event_time_utc").alias("measured_at_utc"), F.bitmap_bucket_number("number").alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
    days = _put(spark, f"{base}/hours", batch, partial(readings), merged)
    _put(spark, f"{base}/bits", batch, bits, lambda both: both.groupBy(*KEYS, "piece").agg(F.bitmap_or_agg("bits").alias("bits")))
    return days


def hourly(spark: SparkSession, base: str, days: list[str] | None = None) -> DataFrame:
    """The rollup so far, with the columns of :func:`models.sensor_hourly`."""
    mean = lambda c: F.try_divide(f"sum_{c}", f"count_{c}")
    hours, bits = sinks.published(spark, f"{base}/hours", days), sinks.published(spark, f"{base}/bits", days)
    devices = bits.groupBy(*KEYS).agg(F.sum(F.bitmap_count("bits")).alias("devices"))
    rows = hours.join(devices, KEYS, "left")
    values = {n: mean(n.removeprefix("sensor_avg_")) if n.startswith("sensor_avg_") else F.col(n.removeprefix("sensor_")) for n in models.SENSOR}
    return rows.select(
        fn.key("city_id", fn.instant_text("measured_at_utc")).alias("city_hour_key"), "city_id", "city_name", "country_code", "measured_at_utc", F.col("n").alias("sensor_event_count"), F.coalesce("devices", F.lit(0)).alias("sensor_device_count"),
        *[v.alias(n) for n, v in values.items()], *models.SENSOR_TIMES,
    )
