"""Data sources of our own: offsets, retries, and batches that count once."""

import datetime as dt
import json
import os
import shutil

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aquifer import sources
from aquifer.operators import sinks
from aquifer.sources import custom
from aquifer.streaming import rules


@pytest.fixture(scope="module", autouse=True)
def known(spark):
    custom.register(spark)


def stream(spark, base, total, **options):
    reader = spark.readStream.format("sensor_events").option("rows", 7)
    for k, v in ({"total": total} | options).items():
        reader = reader.option(k, v)
    return reader.load().writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()


def test_generated_events_keep_the_contract(spark):
    e = spark.read.format("sensor_events").option("total", 500).option("rows", 60).load()
    assert e.schema.simpleString() == spark.createDataFrame([], sources.EVENT).schema.simpleString()
    assert e.count() == 500 and e.select("event_id").distinct().count() == 500 and e.rdd.getNumPartitions() == 9
    assert e.select(F.struct("*").alias("event")).where(F.size(rules.contract_violations()) > 0).isEmpty()
    assert rules.city_mismatch(e, sources.cities(spark)).isEmpty()
    row = e.agg(F.avg("pm2_5"), F.stddev("pm2_5"), F.corr("pm2_5", "pm10")).first()
    assert 24 < row[0] < 29 and 5 < row[1] < 9  # levels rise with the city's number


def test_a_stream_goes_on_at_its_offset(spark, tmp_path):
    """Runs that stop after 10 and 25 events, cut otherwise, give what one run of 40 gives; another seed doesn't."""
    for total, rows in ((10, 7), (25, 4), (40, 100)):
        assert stream(spark, tmp_path, total, rows=rows).awaitTermination(60)
    offsets = [json.loads(f.read_text().splitlines()[-1]) for f in sorted((tmp_path / "checkpoint/offsets").iterdir()) if f.name.isdigit()]
    assert [o["events"] for o in offsets] == [10, 25, 40]
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect()))
    whole = spark.read.format("sensor_events").option("total", 40)
    assert got == sorted(map(tuple, whole.load().collect())) and got != sorted(map(tuple, whole.option("seed", 2).load().collect()))


def test_the_offset_depends_on_the_clock_only():
    since = (dt.datetime.now() - dt.timedelta(seconds=100)).isoformat()
    assert custom.Events({"since": since, "rate": "3"}).latestOffset()["events"] in range(300, 320)
    assert custom.Events({"since": since, "rate": "3", "total": "50"}).latestOffset() == {"events": 50}
    assert custom.Events({"since": (dt.datetime.now() + dt.timedelta(hours=1)).isoformat()}).latestOffset() == {"events": 0}
    with pytest.raises(ValueError, match="total"):
        custom.Events({})


def test_a_crawl_has_a_partition_a_city(spark, tmp_path):
    tries = str(tmp_path)

    def fetch(city):
        with open(f"{tries}/{city['city_id']}", "a") as f:
            f.write("x")
        if city["city_id"] == 3 or city["city_id"] == 2 and os.path.getsize(f"{tries}/2") < 3:
            raise OSError("503")
        return json.dumps({"city": city["city_name"]})

    custom.register(spark, custom.crawl_source(fetch))
    cities = json.dumps([r.asDict() for r in sources.cities(spark).where("city_id <= 4").collect()])
    df = spark.read.format("crawl").option("cities", cities).option("wait", 0).load()
    assert df.rdd.getNumPartitions() == 4
    for f in tmp_path.iterdir():
        f.unlink()
    got = {r.city_id: (r.payload, r.error) for r in df.collect()}
    assert got == {1: ('{"city": "Chicago"}', None), 2: ('{"city": "Los Angeles"}', None), 3: (None, "OSError: 503"), 4: ('{"city": "Manchester"}', None)}
    assert (tmp_path / "2").stat().st_size == 3 and (tmp_path / "3").stat().st_size == 5


def batch(*keys):
    return pa.RecordBatch.from_pydict({"key": list(keys), "value": [f"v{k}" for k in keys]})


def test_a_task_that_is_repeated_counts_once(spark, tmp_path):
    log = custom.Log(str(tmp_path))

    def fails():
        yield batch("a", "b")
        raise OSError("executor lost")

    with pytest.raises(OSError, match="lost"):
        log.write(fails())
    twice = [log.write(iter([batch("a", "b")])) for _ in range(2)]  # a speculative copy, whose message the driver doesn't get
    log.commit([twice[0], log.write(iter([])), None, log.write(iter([batch("c")]))], "0")
    # the batch again, after its note: its files are taken away
    log.commit([log.write(iter([batch("a", "b", "c")]))], "0")
    log.commit([log.write(iter([batch("d"), batch("e")]))], "1")
    log.abort([log.write(iter([batch("x")]))])
    assert sorted((r.batch, r.key, r.value) for r in custom.messages(spark, str(tmp_path)).collect()) == [("0", k, f"v{k}") for k in "abc"] + [("1", k, f"v{k}") for k in "de"]


def test_a_repeated_batch_of_a_stream_counts_once(spark, tmp_path):
    """The stream's own note of the last batch is lost, as if the driver had died between the two."""

    def run():
        rows = spark.readStream.schema("key string, value string").parquet(f"{tmp_path}/in")
        assert rows.writeStream.format("messages").option("path", f"{tmp_path}/topic").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination(60)

    for k in range(2):
        spark.createDataFrame([(f"{k}{i}", "v") for i in range(20)], "key string, value string").repartition(3).write.mode("append").parquet(f"{tmp_path}/in")
        run()
    for f in (tmp_path / "checkpoint/commits").glob("*1*"):
        f.unlink()
    run()
    got = custom.messages(spark, f"file://{tmp_path}/topic")
    assert got.count() == 40 and got.select("key").distinct().count() == 40 and sorted(r.batch for r in got.select("batch").distinct().collect()) == [f"{k:09}" for k in range(2)]


def test_batches_of_a_table(spark, tmp_path):
    df = spark.range(10).select(F.col("id").cast("string").alias("key"), F.lit("v").alias("value"))
    for name in ("first", "first", "second"):  # a load that is repeated under its name adds nothing
        df.write.format("messages").mode("append").option("path", str(tmp_path)).option("batch", name).save()
    assert {r.batch: r["count"] for r in custom.messages(spark, str(tmp_path)).groupBy("batch").count().collect()} == {"first": 10, "second": 10}


def test_versions_and_files_as_rows(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    sinks.publish(df, path)
    folders = sinks.write_parts(df, path, F.col("p"))
    sinks.point(spark, path, {"schema": df.schema.jsonValue(), "parts": {k: {"folder": f, "inputs": {"x": {"": "1"}}} for k, f in folders.items()} | {"none": {"folder": None}}})
    rows = {(r.number, r.part): r.folder for r in sinks.history(spark, path).collect()}
    assert set(rows) == {(1, ""), (2, "a"), (2, "b"), (2, "none")} and rows[2, "none"] is None and rows[2, "a"] == folders["a"]
    files = sinks.file_rows(spark, path).collect()
    assert {r.part for r in files} == {"a", "b"} and all(r["size"] == os.path.getsize(f"{path}/versions/{folders[r.part]}/{r.file}") for r in files)
    assert {r.part for r in sinks.file_rows(spark, path, 1).collect()} == {""}
    shutil.rmtree(f"{path}/versions/{folders['a']}")
    assert {r.part for r in sinks.file_rows(spark, path).collect()} == {"b"}
