"""The stream on Structured Streaming.

One query reads the records, keeps the first arrival of each event id within a
horizon and, a batch at a time, writes bronze rows, dead letters, clean readings,
on-time and late events.  A second one reads the on-time folder into five-minute
windows.

Arrivals have one order over all partitions of the topic: the record's timestamp,
then partition and offset, so nothing depends on the order of rows.  (Partition and
offset alone would set all of one partition before the next, and call most of a
backlog late.)

``ingest_with_state`` keeps the ids that were seen in the state store; ``ingest`` keeps
them in folders:

What a batch needs of the past has a bound: the state that the batch before it wrote
(its latest event time, and the first batch within the horizon) and the ids of the
batches within the horizon.  A batch notes its own time before it decides anything;
each route is written to a folder of the batch's number in overwrite mode.  So a
replay decides as at first, and replaces rather than repeats.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.tables import clean_reading
from . import rules

ROUTES = ("bronze", "dlq", "clean", "on_time", "late")
ARRIVAL = ["kafka_timestamp", "kafka_partition", "kafka_offset"]
MINUTE = 60_000_000  # microseconds of arrivals that one task orders
HORIZON = dt.timedelta(hours=24)


def _read(spark: SparkSession, path: str, schema: str):
    """The one row of a batch's folder; None if the batch wrote none."""
    try:
        return spark.read.schema(schema).parquet(path).first()
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def _noted(spark: SparkSession, base: str, batch: int, now: Callable[[], dt.datetime]) -> dt.datetime:
    """When the batch first began; a replay keeps that time."""
    path = f"{base}/began/batch={batch}"
    row = _read(spark, path, "at timestamp")
    if row is None:
        spark.createDataFrame([(now(),)], "at timestamp").coalesce(1).write.mode("overwrite").parquet(path)
        row = _read(spark, path, "at timestamp")
    return row["at"]


def _past(spark: SparkSession, base: str, batch: int, at: dt.datetime, horizon: dt.timedelta) -> tuple[dt.datetime | None, int]:
    """The latest event time of earlier batches, and the first batch whose ids still count."""
    if not batch:
        return None, batch
    row = _read(spark, f"{base}/state/batch={batch - 1}", "top timestamp, first int")
    if row is None:
        raise ValueError(f"batch {batch - 1} left no state in {base}")
    first = row["first"]
    while first < batch and _noted(spark, base, first, dt.datetime.now) <= at - horizon:  # each batch is left behind once
        first += 1
    return row["top"], first


def _at_once(spark: SparkSession, work: list[Callable[[], None]]) -> None:
    """Run all of ``work`` at the same time, with the stream's own properties (a stopped stream stops its jobs); the first failure is raised when all have ended."""
    with ThreadPoolExecutor(len(work)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(f)) for f in work]:
            done.result()


def route_batch(raw: DataFrame, batch: int, base: str, horizon: dt.timedelta = HORIZON, now: Callable[[], dt.datetime] = dt.datetime.now, fresh: DataFrame | None = None) -> None:
    """Write one batch of bronze-shaped rows to its routes.

    ``fresh`` has the batch's ids that were not seen before, where a state store knows
    them; else the ids of earlier batches are read and this one's are kept.
    """
    spark = raw.sparkSession
    at = _noted(spark, base, batch, now)
    top, first = _past(spark, base, batch, at, horizon)
    first = batch if fresh is not None else first
    rows = rules.parsed(raw).withColumn("error_reason", rules.error_reason()).persist()
    put = lambda df, route: df.write.mode("overwrite").parquet(f"{base}/{route}/batch={batch}")
    try:
        good = rows.where("error_reason IS NULL").select("event.*", *ARRIVAL).drop("_corrupt")
        # the same id twice in this batch is settled by arrival; ids of earlier batches were first
        good = rules.first_seen(good, "event_id", ARRIVAL)
        if fresh is not None:
            good = good.join(fresh, "event_id", "left_semi")
        elif first < batch:
            known = spark.read.schema("event_id string").parquet(*[f"{base}/ids/batch={n}" for n in range(first, batch)])
            good = good.join(known, "event_id", "left_anti")
        good = clean_reading(good).persist()
        routed = rules.route_late(good, "event_time_utc", ARRIVAL, span=MINUTE, before=None if top is None else F.lit(top)).persist()
        latest = F.greatest(F.max("event_time_utc"), F.lit(top).cast("timestamp"))
        # each keeps to its own folder, and the batch ends when all are written, so they need no order
        _at_once(spark, [
            lambda: put(rows.select("raw_payload", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "ingested_at_utc"), "bronze"),
            lambda: put(rows.where("error_reason IS NOT NULL").select(rules.dead_letter(rows).alias("value")), "dlq"),
            lambda: put(good.drop(*ARRIVAL), "clean"),
            *([lambda: put(good.select("event_id"), "ids")] if fresh is None else []),
            lambda: put(good.agg(latest.alias("top")).withColumn("first", F.lit(first)), "state"),
            lambda: put(routed.where("NOT is_late").drop("is_late"), "on_time"),
            lambda: put(routed.where("is_late").select(F.col("event_id").alias("key"), rules.late_message().alias("value"), "event_id", "event_time_utc", "city_id"), "late"),
        ])
        routed.unpersist()
        good.unpersist()
    finally:
        rows.unpersist()


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def ingest(raw: DataFrame, base: str, horizon: dt.timedelta = HORIZON, every: str | None = None) -> StreamingQuery:
    """Route a stream of bronze-shaped rows until its input ends, or with ``every`` (such as 10 seconds) on and on."""
    work = lambda df, n: route_batch(df, n, base, horizon)
    return raw.writeStream.foreachBatch(work).option("checkpointLocation", f"{base}/_checkpoints/ingest").trigger(**_trigger(every)).start()


def windows(on_time: DataFrame, base: str, every: str | None = None, beats: DataFrame | None = None) -> StreamingQuery:
    """Five-minute windows of a stream of on-time readings, each written once, when it closes.

    A window closes when an event, of whichever partition, is 10 seconds past its end, so
    a partition that falls silent holds none open.  ``beats`` (column event_time_utc, such
    as :func:`heartbeat`) do the same when all are silent; they count in no window.
    """
    if beats is not None:
        on_time = on_time.unionByName(beats.select("event_time_utc"), allowMissingColumns=True)
    out = rules.tumbling(on_time.withWatermark("event_time_utc", "10 seconds"), arrival=F.struct(*ARRIVAL))
    out = out.where("reading_count > 0")  # no beats; a filter on the city would go below the watermark and take them from it
    out = out.withColumn("processed_at", F.current_timestamp())
    return out.writeStream.format("parquet").outputMode("append").option("path", f"{base}/five_minutes").option("checkpointLocation", f"{base}/_checkpoints/windows").trigger(**_trigger(every)).start()


def heartbeat(spark: SparkSession, idle: str = "30 seconds") -> DataFrame:
    """A stream of one row a second: the time ``idle`` ago.  Sources that have been silent for longer no longer hold a window open; events that come later than that are late."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load().select((F.col("timestamp") - F.expr(f"INTERVAL {idle}")).alias("event_time_utc"))


def first_sights(raw: DataFrame, arrival: str, horizon: dt.timedelta = HORIZON) -> DataFrame:
    """A stream of all rows (row) and, beside them, of the ids of valid events that are new (new_id).

    What was seen is kept in the state store, by id, until the horizon has passed: the
    watermark stays half of it behind the latest arrival, and an id is forgotten when the
    watermark is half of it past the id's arrival, as the batches before have moved it.  Arrivals more than half the horizon
    behind the latest one are none the store can tell; the time of ingestion never is.
    """
    half = f"{int(horizon.total_seconds() * 500)} milliseconds"
    good = rules.parsed(raw).where(rules.error_reason().isNull())
    ids = good.select(F.col("event.event_id").alias("new_id"), arrival).withWatermark(arrival, half).dropDuplicatesWithinWatermark(["new_id"])
    row = F.struct(*raw.columns).alias("row")
    return raw.select(row, F.lit(None).cast("string").alias("new_id")).unionByName(ids.select("new_id"), allowMissingColumns=True)


def ingest_with_state(raw: DataFrame, base: str, arrival: str = "ingested_at_utc", horizon: dt.timedelta = HORIZON, every: str | None = None) -> StreamingQuery:
    """Like :func:`ingest`, with the ids that were seen in the stream's state store instead of folders.

    The store says which ids of a batch are new; which of several rows with a new id was
    first is settled by arrival, in the batch.
    """

    def work(df: DataFrame, batch: int) -> None:
        both = df.persist()  # read twice, and the store may be asked once only
        try:
            route_batch(both.where("row IS NOT NULL").select("row.*"), batch, base, horizon, fresh=both.where("new_id IS NOT NULL").select(F.col("new_id").alias("event_id")))
        finally:
            both.unpersist()

    out = first_sights(raw, arrival, horizon)
    return out.writeStream.foreachBatch(work).option("checkpointLocation", f"{base}/_checkpoints/ingest").trigger(**_trigger(every)).start()
