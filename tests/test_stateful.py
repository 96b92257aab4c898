"""Streams with their memory in the state store: what is remembered, for how long, and over restarts."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from aquifer.plans import catalog
from aquifer.streaming import live

RAW = "raw_payload string, kafka_topic string, kafka_partition int, kafka_offset long, kafka_timestamp timestamp, ingested_at_utc timestamp"
DAY = dt.datetime(2026, 1, 1)


def payload(**over):
    base = {"schema_version": "1.0", "event_type": "environment.sensor_reading", "event_id": "e", "city_id": 1, "city_name": "c", "country_code": "VN", "event_time_utc": "2026-01-01T07:01:00Z", "temperature_2m": 20.0, "pm2_5": 1.0}
    return json.dumps(base | over)


class Topic:
    """Files of records, a batch each, and a stream over them that stops and goes on."""

    def __init__(self, spark, base):
        self.spark, self.base, self.offset = spark, str(base), 0

    def put(self, *records):
        rows = []
        for hours, record in records:
            rows.append((record, "t", self.offset % 2, self.offset, DAY + dt.timedelta(hours=hours), DAY))
            self.offset += 1
        self.spark.createDataFrame(rows[::-1], RAW).coalesce(1).write.mode("append").parquet(f"{self.base}/in")

    def run(self):
        raw = self.spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).parquet(f"{self.base}/in")
        assert live.ingest_with_state(raw, self.base, "kafka_timestamp").awaitTermination(120)

    def read(self, route):
        return self.spark.read.parquet(f"{self.base}/{route}")


def test_an_id_is_remembered_for_a_day(spark, tmp_path):
    topic = Topic(spark, tmp_path)
    for k, h in enumerate([0, 23, 25, 60, 61]):  # seen at 0, at 25 after it was forgotten at 24, and at 60
        topic.put((h - 0.01, payload(event_id=f"other{k}", pm2_5=100.0 + k)))
        topic.run()
        topic.put((h, payload(event_id="same", pm2_5=float(k))))
        topic.run()  # each run goes on from the checkpoint
    assert sorted(r.pm2_5 for r in topic.read("clean").where("event_id = 'same'").collect()) == [0.0, 2.0, 3.0]
    assert topic.read("clean").where("event_id <> 'same'").count() == 5 and topic.read("bronze").count() == 10


def test_the_first_arrival_of_a_new_id_stays(spark, tmp_path):
    """Of rows of one batch the first by arrival, whatever their order in files; of later batches none."""
    topic = Topic(spark, tmp_path)
    topic.put((0.2, payload(pm2_5=3.0)), (0.1, payload(pm2_5=1.0)), (0.1, payload(pm2_5=2.0)), (0.3, "{"), (0.3, payload(event_id=" ")))
    topic.put((0.0, payload(pm2_5=0.5)), (0.4, payload(event_id="f", pm2_5=7.0)))
    topic.run()
    # of two of one time the lower partition is first
    assert sorted((r.event_id, r.pm2_5) for r in topic.read("clean").collect()) == [("e", 2.0), ("f", 7.0)]
    assert topic.read("dlq").count() == 2 and not (tmp_path / "ids").exists()


def test_the_state_holds_no_more_than_the_horizon(spark, tmp_path):
    raw = lambda: spark.readStream.schema(RAW).parquet(f"{tmp_path}/in")
    topic, held = Topic(spark, tmp_path), []
    for h in range(0, 120, 12):
        topic.put(*[(h, payload(event_id=f"{h}-{k}")) for k in range(50)])
        query = live.ingest_with_state(raw(), str(tmp_path), "kafka_timestamp")
        query.awaitTermination(120)
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert max(held) <= 4 * 50 and topic.read("clean").count() == 500


READINGS = "event_id string, city_id int, city_name string, country_code string, event_time_utc timestamp, kafka_timestamp timestamp, kafka_partition int, kafka_offset long, temperature_2m double, relative_humidity_2m double, pm2_5 double, pm10 double, carbon_monoxide double, nitrogen_dioxide double"


def reading(k, minute, partition=0):
    at = DAY + dt.timedelta(minutes=minute)
    return (f"e{k}", 1 + partition, "c", "C", at, at, partition, k, 1.0, None, float(k), None, None, None)


def closed(spark, base):
    return {(r.city_id, r.window_start.minute, r.reading_count) for r in spark.read.parquet(f"{base}/five_minutes").collect()}


def run_windows(spark, base, batch, rows, beat=None):
    spark.createDataFrame(rows, READINGS).coalesce(1).write.parquet(f"{base}/on_time/{batch}")
    beats = spark.createDataFrame([] if beat is None else [(DAY + dt.timedelta(minutes=beat),)], "event_time_utc timestamp")
    beats.coalesce(1).write.parquet(f"{base}/beats/{batch}")
    of = lambda schema, name: spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{base}/{name}")
    assert live.windows(of(READINGS, "on_time"), base, beats=of("event_time_utc timestamp", "beats")).awaitTermination(120)


def test_windows_go_on_from_their_state(spark, tmp_path):
    """A window's readings may come before and after a restart; it is written once, when it closes."""
    base = str(tmp_path)
    run_windows(spark, base, 0, [reading(0, 1), reading(1, 2)])
    run_windows(spark, base, 1, [reading(2, 4), reading(3, 5.1)])
    assert closed(spark, base) == set()  # 5:06 isn't 10 seconds past 5:00
    run_windows(spark, base, 2, [reading(4, 5.2)])
    assert closed(spark, base) == {(1, 0, 3)}
    run_windows(spark, base, 3, [reading(5, 10.5)])
    assert closed(spark, base) == {(1, 0, 3), (1, 5, 2)}


def test_a_silent_partition_holds_no_window_open(spark, tmp_path):
    base = str(tmp_path)
    run_windows(spark, base, 0, [reading(0, 1, 0), reading(1, 2, 1)])
    run_windows(spark, base, 1, [reading(2, 6, 0)])  # partition 1 is silent
    assert closed(spark, base) == {(1, 0, 1), (2, 0, 1)}


def test_beats_close_windows_when_all_are_silent(spark, tmp_path):
    base = str(tmp_path)
    run_windows(spark, base, 0, [reading(0, 1)])
    run_windows(spark, base, 1, [], beat=5.1)
    assert closed(spark, base) == set()
    run_windows(spark, base, 2, [], beat=6)
    assert closed(spark, base) == {(1, 0, 1)}  # and no window of the beats
    run_windows(spark, base, 3, [], beat=60)
    assert closed(spark, base) == {(1, 0, 1)}


@pytest.mark.parametrize("idle", ["30 seconds", "2 minutes"])
def test_heartbeat_is_a_stream_of_times_that_are_idle_long_past(spark, tmp_path, idle):
    query = live.heartbeat(spark, idle).withColumn("now", F.current_timestamp()).writeStream.format("memory").queryName("beats_" + idle.replace(" ", "_")).trigger(processingTime="1 second").start()
    try:
        query.awaitTermination(4)
    finally:
        query.stop()
    rows = spark.table("beats_" + idle.replace(" ", "_")).collect()
    least = 30 if idle.startswith("30") else 120
    assert rows and all(least - 2 <= (r.now - r.event_time_utc).total_seconds() <= least + 20 for r in rows)


def test_five_minutes_take_every_file_of_a_batch(spark, tmp_path, monkeypatch):
    """A batch of more files than any limit, whose times are in no order."""
    names = "event_id string, event_time_utc timestamp, city_id int, city_name string, country_code string, temperature_2m double, relative_humidity_2m double, pm2_5 double, pm10 double, carbon_monoxide double, nitrogen_dioxide double, kafka_timestamp timestamp, kafka_partition int, kafka_offset long"
    minute = F.pmod(F.col("id") * 37, F.lit(100)) * 5
    values = {"event_id": F.col("id").cast("string"), "event_time_utc": F.timestamp_seconds(F.lit(1_700_000_100) + minute * 60), "city_id": F.lit(1), "kafka_timestamp": F.timestamp_seconds("id"), "kafka_partition": F.lit(0), "kafka_offset": F.col("id")}
    for batch, n in enumerate((100, 100, 0, 0)):
        rows = spark.range(batch * 100, batch * 100 + n, numPartitions=max(n, 1))
        rows.select(*[values.get(c.split()[0], F.lit(1.0) if c.endswith("double") else F.lit("x")).cast(c.split()[1]).alias(c.split()[0]) for c in names.split(", ")]).write.parquet(f"{tmp_path}/on_time/batch={batch}")
    monkeypatch.setattr(catalog, "_stream_with_state", lambda spark, d: str(tmp_path))
    got = catalog.stream_five_minutes(spark, "").collect()
    assert len(got) == 100 and {r.reading_count for r in got} == {2}
