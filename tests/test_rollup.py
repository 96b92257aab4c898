"""The mergeable rollup: increments, repeats, and what a batch reads."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from aquifer.operators import sinks
from aquifer.plans import models, rollup

SCHEMA = "event_id string, device_id string, city_id long, city_name string, country_code string, event_time_utc timestamp, processed_at timestamp, temperature_2m double, relative_humidity_2m double, pm2_5 double, pm10 double, carbon_monoxide double, nitrogen_dioxide double"
START = dt.datetime(2026, 1, 1)


def some(seed, n, days=3, devices=40):
    rnd = random.Random(seed)
    maybe = lambda: rnd.choice([None, round(rnd.uniform(0, 50), 2)])
    at = [START + dt.timedelta(minutes=rnd.randrange(days * 1440)) for _ in range(n)]
    return [(f"{seed}-{k}", rnd.choice([None, *(f"d{x}" for x in range(devices))]), rnd.randint(1, 3), f"c{rnd.randint(1, 2)}", "C", t, t + dt.timedelta(seconds=k), *[maybe() for _ in range(6)]) for k, t in enumerate(at)]


def read(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


def test_increments_equal_one_rollup(spark, tmp_path):
    batches = [some(k, 150, devices=30 * (k + 1)) for k in range(4)]
    for k, b in enumerate(batches):
        rollup.merge(spark.createDataFrame(b, SCHEMA), str(tmp_path), k)
        so_far = spark.createDataFrame([r for x in batches[: k + 1] for r in x], SCHEMA)
        want = models.sensor_hourly(so_far)
        assert read(rollup.hourly(spark, str(tmp_path)).select(*want.columns)) == read(want)


def test_a_repeated_batch_changes_nothing(spark, tmp_path, monkeypatch):
    a, b = (spark.createDataFrame(some(k, 80), SCHEMA) for k in range(2))
    rollup.merge(a, str(tmp_path), 0)
    # the second batch breaks off after its hours, before its devices' bitmaps
    put = rollup._put
    monkeypatch.setattr(rollup, "_put", lambda s, path, *x: (_ for _ in ()).throw(OSError("lost")) if path.endswith("bits") else put(s, path, *x))
    with pytest.raises(OSError, match="lost"):
        rollup.merge(b, str(tmp_path), 1)
    monkeypatch.undo()
    for _ in range(2):
        rollup.merge(b, str(tmp_path), 1)
    want = models.sensor_hourly(a.unionAll(b))
    assert read(rollup.hourly(spark, str(tmp_path)).select(*want.columns)) == read(want)
    assert rollup.merge(a, str(tmp_path), 0) == []


def test_a_batch_touches_its_own_days(spark, tmp_path):
    rollup.merge(spark.createDataFrame(some(1, 300), SCHEMA), str(tmp_path), 0)
    old = {t: sinks.pointed(spark, f"{tmp_path}/{t}")["parts"] for t in ("hours", "bits")}
    late = [(*r[:5], START + dt.timedelta(days=1, hours=2), *r[6:]) for r in some(2, 20)]
    assert rollup.merge(spark.createDataFrame(late, SCHEMA), str(tmp_path), 1) == ["2026-01-02"]
    for t, parts in old.items():
        now = sinks.pointed(spark, f"{tmp_path}/{t}")["parts"]
        assert {k for k in now if now[k] != parts[k]} == {"2026-01-02"} and len(now) == 3
    assert rollup.hourly(spark, str(tmp_path), ["2026-01-02"]).agg(F.min("measured_at_utc")).first()[0].day == 2


def test_devices_are_numbered_without_gaps(spark, tmp_path):
    """More than one piece of a bitmap, and devices that come back."""
    rows = spark.range(70_000).select(F.concat(F.lit("d"), F.col("id")).alias("device_id"), F.lit(1).cast("long").alias("city_id"))
    base = spark.createDataFrame(some(0, 1), SCHEMA).drop("device_id", "city_id")
    for k, part in enumerate((rows.where("device_id < 'd5'"), rows)):
        rollup.merge(part.repartition(5).crossJoin(base.withColumn("event_time_utc", F.lit(START))), str(tmp_path), k)
    numbers = sinks.published(spark, f"{tmp_path}/devices")
    assert numbers.agg(F.min("number"), F.max("number"), F.countDistinct("number"), F.count("number")).first() == (1, 70_000, 70_000, 70_000)
    assert sinks.published(spark, f"{tmp_path}/bits").count() == 3 and rollup.hourly(spark, str(tmp_path)).first().sensor_device_count == 70_000


def test_batches_without_rows(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    rollup.merge(none, str(tmp_path), 0)
    assert rollup.hourly(spark, str(tmp_path)).isEmpty()
    rollup.merge(spark.createDataFrame(some(3, 20), SCHEMA), str(tmp_path), 1)
    rollup.merge(none, str(tmp_path), 2)
    assert rollup.hourly(spark, str(tmp_path)).agg(F.sum("sensor_event_count")).first()[0] == 20
