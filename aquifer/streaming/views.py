"""The live views kept up to date by streams.

Each view is an aggregation in update mode: a batch gives the keys whose values it
changed, and those replace the keys' rows in a served table.  A served table is small,
a row a city, or those of an hour's minutes or of ten minutes' seconds; each batch
publishes a version that notes its number, so a batch that is repeated changes nothing
and a reader sees a version or the next one.  What the state store holds is bounded by
watermarks where keys are times.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import functions as fn
from ..operators import sinks, upsert
from .live import _trigger

#: Columns of the latest reading of a city, in output order: fixed values.
LATEST = ["city_id", "city_name", "country_code", "device_id", "sequence_number", "event_id", "event_time_utc", "processed_at", "temperature_2m", "relative_humidity_2m", "pm2_5", "pm10", "carbon_monoxide", "nitrogen_dioxide"]


class View(NamedTuple):
    """``rows`` aggregates readings by ``keys``; of the served table the rows of the last ``minutes`` by ``time`` stay, or all."""

    keys: list[str]
    rows: Callable[[DataFrame], DataFrame]
    time: str | None = None
    minutes: int = 0


def _by_city(readings: DataFrame) -> DataFrame:
    order = ["event_time_utc", "processed_at", "event_id"]
    row = F.struct(*order, *[c for c in LATEST if c not in order and c != "city_id"])
    return readings.groupBy("city_id").agg(F.max(row).alias("r"), F.max("processed_at").alias("last_processed_at"))


def _by_minute(readings: DataFrame) -> DataFrame:
    minute = F.date_trunc("minute", "event_time_utc").alias("minute_utc")
    rows = readings.withWatermark("event_time_utc", "61 minutes").groupBy(F.window("event_time_utc", "1 minute").alias("w"), "city_id", minute)
    stats = [getattr(F, k)(c).alias(f"{k}_{c}") for c, kinds in (("pm2_5", "avg min max"), ("pm10", "avg"), ("temperature_2m", "avg"), ("relative_humidity_2m", "avg")) for k in kinds.split()]
    out = rows.agg(F.max("city_name").alias("city_name"), F.max("country_code").alias("country_code"), F.count(F.lit(1)).alias("sensor_event_count"), F.size(F.collect_set("device_id")).cast("long").alias("sensor_device_count"), *stats, F.max("processed_at").alias("data_updated_at_utc"))
    return out.drop("w")


def _by_second(readings: DataFrame) -> DataFrame:
    rows = readings.withWatermark("processed_at", "10 minutes").groupBy(F.window("processed_at", "1 second")["start"].alias("second"))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.collect_set("city_id").alias("cities"))


VIEWS = {
    "by_city": View(["city_id"], _by_city),
    "by_minute": View(["city_id", "minute_utc"], _by_minute, "minute_utc", 120),
    "by_second": View(["second"], _by_second, "second", 10),
}


def merge(changed: DataFrame, batch: int, path: str, view: View) -> None:
    """Replace the changed keys' rows in a served table."""
    spark = changed.sparkSession
    old = sinks.pointed(spark, path)
    if old is not None and batch <= old["batch"]:
        return
    rows = changed if old is None else upsert(sinks.published(spark, path), changed, view.keys)
    version = uuid.uuid4().hex
    if view.time is not None and (top := rows.agg(F.max(view.time)).first()[0]) is not None:
        rows = rows.where(F.col(view.time) > F.lit(top - dt.timedelta(minutes=view.minutes)))
    rows.coalesce(8).write.parquet(f"{path}/versions/{version}")
    sinks.point(spark, path, {"version": version, "schema": rows.schema.jsonValue(), "batch": batch})


def serve(clean: DataFrame, base: str, every: str | None = None, names: Iterable[str] = tuple(VIEWS)) -> list[StreamingQuery]:
    """Start a query for each of the views ``names`` over a stream of clean readings, until its input ends or, with ``every``, on and on."""
    out = []
    for name, view in ((n, VIEWS[n]) for n in names):

        def work(df: DataFrame, n: int, name: str = name, view: View = view) -> None:
            fresh = f"{base}/{name}/changed"  # read more than once, and the store may be asked once only
            df.write.mode("overwrite").parquet(fresh)
            merge(df.sparkSession.read.schema(df.schema).parquet(fresh), n, f"{base}/{name}", view)

        query = view.rows(clean).writeStream.outputMode("update").foreachBatch(work).queryName(f"{name}-{uuid.uuid4().hex[:8]}")
        out.append(query.option("checkpointLocation", f"{base}/_checkpoints/{name}").trigger(**_trigger(every)).start())
    return out


def latest(spark: SparkSession, base: str, now: Column | None = None) -> DataFrame:
    """The latest reading of each city."""
    now = F.current_timestamp() if now is None else now
    rows = sinks.published(spark, f"{base}/by_city").select("city_id", *[f"r.{c}" for c in LATEST[1:]])
    return rows.select(*LATEST, fn.seconds_between("processed_at", now).alias("seconds_since_processed"), fn.is_live("processed_at", now).alias("is_live"))


def timeseries(spark: SparkSession, base: str, now: Column | None = None) -> DataFrame:
    """Cities' minutes of the last hour; the first minute is whole."""
    now = F.current_timestamp() if now is None else now
    rows = sinks.published(spark, f"{base}/by_minute").where(F.col("minute_utc") >= F.date_trunc("minute", now - F.expr("INTERVAL 60 MINUTES")))
    return rows.withColumn("city_minute_key", fn.key("city_id", fn.instant_text("minute_utc")))


def status(spark: SparkSession, base: str, now: Column | None = None) -> DataFrame:
    """One row, to the second."""
    now = F.current_timestamp() if now is None else now
    cities, seconds = sinks.published(spark, f"{base}/by_city"), sinks.published(spark, f"{base}/by_second")
    since = lambda m: F.col("second") >= F.date_trunc("second", now - F.expr(f"INTERVAL {m} MINUTES"))
    counted = seconds.agg(*[F.coalesce(F.sum(F.when(since(m), F.col("n"))), F.lit(0)).alias(f"events_last_{m}m") for m in (1, 5)])
    active = seconds.where(since(5)).select(F.explode("cities").alias("c")).agg(F.countDistinct("c").alias("active_cities_last_5m"))
    last = cities.agg(F.max("r.event_time_utc").alias("latest_event_at"), F.max("last_processed_at").alias("latest_processed_at"))
    row = last.crossJoin(counted).crossJoin(active)  # one row each
    return row.select("latest_event_at", "latest_processed_at", fn.seconds_between("latest_processed_at", now).alias("seconds_since_last_processed"), "events_last_1m", "events_last_5m", "active_cities_last_5m", fn.is_live("latest_processed_at", now).alias("is_live"))
