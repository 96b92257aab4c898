"""Live views kept by streams equal the batch queries after each batch, and a repeated batch changes nothing."""

from pyspark.sql import functions as F

from aquifer.operators import sinks
from aquifer.plans import catalog, models
from aquifer.streaming import views

SF = "/root/testdata/sf0.001"


def read(df, columns):
    return sorted(str(tuple(round(v, 6) if isinstance(v, float) else v for v in r)) for r in df.select(*columns).collect())


def test_views_equal_the_batch_queries_after_each_batch(spark):
    seen = []

    def after(base, rows):
        now = F.lit(rows.agg(F.date_trunc("minute", F.max("event_time_utc")) + F.expr("INTERVAL 1 MINUTE")).first()[0])
        for batch, kept in ((models.live_latest(rows, now), views.latest), (models.live_timeseries(rows, now), views.timeseries), (models.live_status(rows, now), views.status)):
            assert read(kept(spark, base, now), batch.columns) == read(batch, batch.columns)
        seen.append(sinks.published(spark, f"{base}/by_city").count())

    base = catalog.served(spark, SF, after=after)
    assert len(seen) == 3 and seen[-1] == 12
    assert [sinks.pointed(spark, f"{base}/by_city", n)["batch"] for n in sinks.versions(spark, f"{base}/by_city")] == sorted({sinks.pointed(spark, f"{base}/by_city", n)["batch"] for n in sinks.versions(spark, f"{base}/by_city")})
    # a batch that comes again is no new version
    before = sinks.versions(spark, f"{base}/by_city")
    views.merge(sinks.published(spark, f"{base}/by_city").limit(1), 0, f"{base}/by_city", views.VIEWS["by_city"])
    assert sinks.versions(spark, f"{base}/by_city") == before


def test_served_tables_stay_small(spark):
    base = catalog.served(spark, SF)
    spread = sinks.published(spark, f"{base}/by_minute").agg((F.max(F.unix_seconds("minute_utc")) - F.min(F.unix_seconds("minute_utc"))).alias("s")).first().s
    assert spread <= 7200 and sinks.published(spark, f"{base}/by_second").count() <= 600


def test_a_query_keeps_only_the_views_it_reads(spark, monkeypatch):
    kept = []
    serve = views.serve
    monkeypatch.setattr(views, "serve", lambda clean, base, **k: kept.append(base) or serve(clean, base, **k))
    assert catalog.QUERIES["live_latest_served"](spark, SF).count() == 12
    there = [spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{kept[-1]}/{n}") for n in views.VIEWS]
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    assert [p.getFileSystem(conf).exists(p) for p in there] == [n == "by_city" for n in views.VIEWS]
