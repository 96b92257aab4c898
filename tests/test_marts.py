"""Marts in parts: what is built again, what is read, and what stops a version."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from aquifer.operators import quality, sinks
from aquifer.plans import catalog, marts, serving

SF = "/root/testdata/sf0.001"
BRONZE = "2024-01-05"


def jobs(spark):
    return spark.sparkContext._jsc.sc().statusStore().jobsList(None).size()


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("marts"))
    catalog.put_days(catalog.t(spark, SF, "events"), f"{base}/events")
    source = {"events": marts.Source(f"file://{base}/events", lambda e: catalog.timed(e).drop("day"))}
    return f"{base}/marts", source, marts.refresh(spark, f"{base}/marts", source, catalog.mart_steps())


def numbers(spark, base):
    return {n: sinks.versions(spark, f"{base}/{n}") for n in marts.TABLES}


def rows(df, *drop):
    return sorted(map(str, df.drop(*drop).collect()))


def test_first_load_equals_the_tables_of_one_part(spark, loaded):
    base, _, built = loaded
    assert len(built["air_quality_hourly"]) > 10 and built["gold_correlation"] == [""]
    for name in marts.TABLES:
        assert rows(marts.table(spark, base, name)) == rows(catalog.mart(spark, SF, name))


def test_unchanged_inputs_start_no_job(spark, loaded):
    base, source, _ = loaded
    before, old = jobs(spark), numbers(spark, base)
    built = marts.refresh(spark, base, source, catalog.mart_steps())
    assert not any(built.values()) and jobs(spark) == before and numbers(spark, base) == old


def test_a_range_of_days_reads_its_parts_only(spark, loaded):
    """Files of other days aren't opened, filters reach the scan, and a file's rows are sorted by country."""
    base, _, _ = loaded
    whole = marts.table(spark, base, "gold_hourly")
    some = serving.filtered(marts.days(spark, base, "gold_hourly", "2024-01-05", "2024-01-07"), "C1", first="2024-01-05", last="2024-01-07")
    read, every = {f.rsplit("/", 2)[1] for f in some.inputFiles()}, {f.rsplit("/", 2)[1] for f in whole.inputFiles()}
    assert read == {k for k in every if "part_=2024-01-04" <= k <= "part_=2024-01-08"} and len(read) <= 5 < len(every)
    assert rows(some) == rows(serving.filtered(whole, "C1", first="2024-01-05", last="2024-01-07"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = some.select("*")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(country_code,C1)" in plan and "GreaterThanOrEqual(measurement_date_local" in plan
    assert marts.days(spark, base, "gold_daily", "2024-01-05", "2024-01-05").select("measurement_date_local").distinct().count() <= 3
    for f in whole.inputFiles():
        found = [r.country_code for r in spark.read.parquet(f).select("country_code").collect()]
        assert found == sorted(found)


def test_buckets_join_without_an_exchange(spark, loaded):
    """No row moves under the joins of the enriched hours, and a version's copy is made once."""
    base, _, _ = loaded
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = marts.enriched_in_buckets(spark, base, 4)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Exchange" in marts.enriched(spark, base)._jdf.queryExecution().executedPlan().toString()
        assert rows(df) == rows(marts.enriched(spark, base))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    before = jobs(spark)
    marts.bucketed(spark, base, "sensor_hourly", 4)
    assert jobs(spark) == before


def test_one_day_changes(spark, loaded):
    """Only that day is built again, and the days of the local calendar around it; the second load repeats no business key."""
    base, source, _ = loaded
    old = sinks.pointed(spark, f"{base}/gold_hourly")
    day = catalog.t(spark, SF, "events").where(F.to_date("ts") == BRONZE).withColumn("value", F.col("value") + 1)
    catalog.put_days(day, f"{base}/../events")
    built = marts.refresh(spark, base, source, catalog.mart_steps())
    assert built["air_quality_hourly"] == built["sensor_hourly"] == built["gold_hourly"] == built["gold_alerts"] == [BRONZE]
    assert built["air_quality_cities"] == [BRONZE] and built["air_quality_city_ids"] == [""]  # found again, but the same
    assert built["gold_daily"] == ["2024-01-04", BRONZE, "2024-01-06"] and built["gold_correlation"] == [""]
    new = sinks.pointed(spark, f"{base}/gold_hourly")
    assert {k for k in new["parts"] if new["parts"][k] != old["parts"].get(k)} == {BRONZE}
    files = sinks.pointed(spark, f"{base}/sensor_hourly")["parts"][BRONZE]["files"]["events"]
    assert files and all(len(f) == 3 and f[1] > 0 for f in files)
    hourly = marts.table(spark, base, "gold_hourly")
    assert quality.duplicate_keys(hourly, ["city_id", "measured_at_utc"]).isEmpty()
    changed = catalog.hourly(spark, SF).where(F.to_date("measured_at_utc") == BRONZE).agg(F.sum("pm2_5"), F.count("pm2_5")).first()
    assert hourly.where(F.to_date("measured_at_utc") == BRONZE).agg(F.sum("pm2_5")).first()[0] == pytest.approx(changed[0] + changed[1])
    # readers of the earlier version see what they saw
    assert rows(sinks.published(spark, f"{base}/gold_hourly", number=1)) == rows(catalog.hourly(spark, SF))


def test_only_the_parts_that_are_needed_are_read(spark, loaded):
    base, source, _ = loaded
    filled = [k for k, p in sinks.pointed(spark, f"{base}/gold_hourly")["parts"].items() if p["folder"] and k != BRONZE]
    one, around = filled[3], set(marts.days_around(filled[3]))
    day = catalog.t(spark, SF, "events").where(F.to_date("ts") == one).withColumn("value", F.col("value") + 2)
    catalog.put_days(day, f"{base}/../events")
    read = []
    steps = [[m._replace(make=lambda f, m=m: read.extend((m.name, r, x.rsplit("/", 2)[1]) for r, df in f.items() for x in df.inputFiles()) or m.make(f)) for m in step] for step in catalog.mart_steps()]
    marts.refresh(spark, base, source, steps)
    assert {x[2] for x in read if x[1] == "events"} == {f"day={one}"}
    assert {x[2] for x in read if x[0] == "gold_hourly"} == {f"part_={one}"}
    needed = {x for k in around for x in marts.days_around(k)}  # the neighbours of the three local days
    assert {x[2] for x in read if x[0] == "gold_daily"} == {f"part_={k}" for k in needed if k in filled or k == BRONZE}


def test_cities_that_change_their_ids_are_built_anew_everywhere(spark, loaded):
    """Without the second half of the month, when ids changed, every day left has other ids; the sensors' days stay."""
    base, source, _ = loaded
    for folder in Path(f"{base}/../events").glob("day=*"):
        if folder.name >= "day=2024-01-16":
            shutil.rmtree(folder)
    built = marts.refresh(spark, base, source, catalog.mart_steps())
    left = {k for k in sinks.pointed(spark, f"{base}/sensor_hourly")["parts"]}
    assert built["sensor_hourly"] == [] and max(left) < "2024-01-16" and set(built["air_quality_hourly"]) == left
    assert marts.table(spark, base, "air_quality_hourly").where("city_id <= 12").isEmpty()


def test_a_replaced_file_is_seen_in_the_same_session(spark, tmp_path):
    events = catalog.t(spark, SF, "events")
    events.where("event_id % 2 = 0").write.parquet(f"{tmp_path}/events.parquet")
    few = catalog.QUERIES["gold_hourly"](spark, str(tmp_path)).count()
    events.write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
    assert catalog.QUERIES["gold_hourly"](spark, str(tmp_path)).count() == catalog.QUERIES["gold_hourly"](spark, SF).count() != few


def test_a_violation_adds_no_version(spark, tmp_path):
    """Checks are counted while the rows are written: one read of the input, and no pointer if one finds something."""
    spark.range(10).write.parquet(f"{tmp_path}/in")
    source, plans = {"x": marts.Source(f"{tmp_path}/in")}, []
    model = lambda low: marts.Model("m", ("x",), lambda f: plans.append(f["x"]) or f["x"], checks={"low": F.count_if(F.col("id") < low), "high": F.count_if(F.col("id") > 100)})
    before = jobs(spark)
    assert marts.refresh(spark, str(tmp_path / "out"), source, [[model(0)]]) == {"m": [""]}
    first = jobs(spark) - before
    spark.range(20).write.mode("overwrite").parquet(f"{tmp_path}/in")
    with pytest.raises(quality.GateError, match="low=5"):
        marts.refresh(spark, str(tmp_path / "out"), source, [[model(5)]])
    assert sinks.versions(spark, f"{tmp_path}/out/m") == [1] and marts.table(spark, str(tmp_path / "out"), "m").count() == 10
    assert marts.refresh(spark, str(tmp_path / "out"), source, [[model(0)]]) == {"m": [""]} and marts.table(spark, str(tmp_path / "out"), "m").count() == 20
    assert first <= 3  # a look at the schema, the write that counts, and a look whether there are rows


def test_other_columns_build_every_part_anew(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    df.write.partitionBy("k").parquet(f"{tmp_path}/in")
    source, out = {"x": marts.Source(f"{tmp_path}/in")}, str(tmp_path / "out")
    assert marts.refresh(spark, out, source, [[marts.Model("m", ("x",), lambda f: f["x"], "k")]]) == {"m": ["a", "b"]}
    wider = marts.Model("m", ("x",), lambda f: f["x"].withColumn("w", F.col("v") * 2), "k")
    assert marts.refresh(spark, out, source, [[wider]]) == {"m": []}  # inputs are what they were
    df.where("k = 'a'").drop("k").write.mode("overwrite").parquet(f"{tmp_path}/in/k=a")
    assert marts.refresh(spark, out, source, [[wider]]) == {"m": ["a", "b"]}
    assert {(r.k, r.w) for r in marts.table(spark, out, "m").collect()} == {("a", 2), ("b", 4)}


def test_tables_without_rows_and_without_inputs(spark, tmp_path):
    spark.range(0).write.parquet(f"{tmp_path}/in")
    model = marts.Model("m", ("x",), lambda f: f["x"])
    marts.refresh(spark, str(tmp_path / "out"), {"x": marts.Source(f"{tmp_path}/in")}, [[model]])
    assert marts.table(spark, str(tmp_path / "out"), "m").isEmpty()
    with pytest.raises(sinks.PutError):
        marts.table(spark, str(tmp_path / "out"), "other")


def test_bronze_columns_of_parts_survive(spark, tmp_path):
    """The value of a part's folder doesn't shadow or add a column."""
    df = spark.createDataFrame([("a/b", 1), ("c d", 2), (None, 3)], "k string, v int")
    folders = sinks.write_parts(df, f"{tmp_path}/t", F.coalesce("k", F.lit("none")))
    assert set(folders) == {"a/b", "c d", "none"}
    sinks.point(spark, f"{tmp_path}/t", {"schema": df.schema.jsonValue(), "parts": {k: {"folder": f} for k, f in folders.items()}})
    out = sinks.published(spark, f"{tmp_path}/t", ["a/b", "none"])
    assert out.columns == ["k", "v"] and {tuple(r) for r in out.collect()} == {("a/b", 1), (None, 3)}
