"""Joined hourly models, marts and live views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import newest

#: The columns of the models, in output order: fixed values.
LOCATION = ["city_name", "country_code", "country_name", "latitude", "longitude", "timezone"]
AIR = ["pm2_5", "pm10", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide", "ozone", "us_aqi"]
STATUS = ["air_quality_status", "air_quality_status_rank", "air_quality_alert_level", "is_air_quality_alert"]
WEATHER = ["temperature_2m", "relative_humidity_2m", "precipitation", "rain", "surface_pressure", "cloud_cover", "wind_speed_10m", "wind_direction_10m", "visibility", "weather_code"]
SENSOR = ["sensor_avg_temperature_2m", "sensor_avg_relative_humidity_2m", "sensor_avg_pm2_5", "sensor_min_pm2_5", "sensor_max_pm2_5", "sensor_avg_pm10", "sensor_min_pm10", "sensor_max_pm10", "sensor_avg_carbon_monoxide", "sensor_avg_nitrogen_dioxide"]
SENSOR_TIMES = ["first_sensor_event_at", "last_sensor_event_at", "sensor_data_updated_at"]
LINEAGE = ["air_quality_source_system", "weather_source_system", "air_quality_crawled_at_utc", "weather_crawled_at_utc", "latest_crawled_at_utc"]
DATES = ["measured_at_local", "measurement_date_utc", "measurement_date_local"]
PARTS = ["measurement_year_local", "measurement_month_local", "measurement_day_local", "measurement_day_of_week_local", "measurement_hour_local"]
#: Sensor averages and the batch columns they are compared with.
COMPARED = ("pm2_5", "pm10", "temperature_2m", "relative_humidity_2m")


def joined(air: DataFrame, weather: DataFrame) -> DataFrame:
    """City hours present in both sources; the air side's description is preferred."""
    a, w = air.alias("a"), weather.alias("w")
    both = a.join(w, (F.col("a.city_id") == F.col("w.city_id")) & (F.col("a.measured_at_utc") == F.col("w.measured_at_utc")))
    either = [F.coalesce(F.col(f"a.{c}"), F.col(f"w.{c}")).alias(c) for c in [*LOCATION, "utc_offset_seconds", *DATES]]
    crawled = [F.col("a.crawled_at_utc").alias("air_quality_crawled_at_utc"), F.col("w.crawled_at_utc").alias("weather_crawled_at_utc"), fn.latest_of("a.crawled_at_utc", "w.crawled_at_utc").alias("latest_crawled_at_utc")]
    sources = [F.col(f"{x}.source_system").alias(f"{n}_source_system") for x, n in (("a", "air_quality"), ("w", "weather"))]
    key = fn.key("a.city_id", fn.instant_text("a.measured_at_utc")).alias("city_hour_key")
    return both.select(key, "a.city_id", *either, "a.measured_at_utc", *[f"a.{c}" for c in AIR], *[f"w.{c}" for c in WEATHER], *sources, *crawled)


def classified(df: DataFrame) -> DataFrame:
    """Adds status, rank, alert level and alert flag of the air-quality index."""
    return df.withColumns({"air_quality_status": fn.aqi_status("us_aqi"), "air_quality_status_rank": fn.aqi_rank("us_aqi"), "air_quality_alert_level": fn.aqi_alert_level("us_aqi"), "is_air_quality_alert": fn.aqi_alert("us_aqi")})


def _stats(column: str, kinds: str, prefix: str = "") -> list[Column]:
    return [getattr(F, k)(column).alias(f"{prefix}{k}_{column}") for k in kinds.split()]


def sensor_hourly(readings: DataFrame) -> DataFrame:
    """Readings of a city and hour: counts, exact distinct devices, averages and extremes."""
    hours = readings.groupBy("city_id", F.date_trunc("hour", "event_time_utc").alias("measured_at_utc")).agg(
        F.max("city_name").alias("city_name"),
        F.max("country_code").alias("country_code"),
        F.count(F.lit(1)).alias("sensor_event_count"),
        F.countDistinct("device_id").alias("sensor_device_count"),
        *_stats("temperature_2m", "avg", "sensor_"),
        *_stats("relative_humidity_2m", "avg", "sensor_"),
        *_stats("pm2_5", "avg min max", "sensor_"),
        *_stats("pm10", "avg min max", "sensor_"),
        *_stats("carbon_monoxide", "avg", "sensor_"),
        *_stats("nitrogen_dioxide", "avg", "sensor_"),
        F.min("event_time_utc").alias("first_sensor_event_at"),
        F.max("event_time_utc").alias("last_sensor_event_at"),
        F.max("processed_at").alias("sensor_data_updated_at"),
    )
    return hours.select(fn.key("city_id", fn.instant_text("measured_at_utc")).alias("city_hour_key"), "city_id", "city_name", "country_code", "measured_at_utc", "sensor_event_count", "sensor_device_count", *SENSOR, *SENSOR_TIMES)


def city_hourly(classified_rows: DataFrame, sensors: DataFrame) -> DataFrame:
    """Every classified city hour, with its sensors' rollup where there is one."""
    t, s = classified_rows.alias("t"), sensors.alias("s")
    rows = t.join(s, (F.col("t.city_id") == F.col("s.city_id")) & (F.col("t.measured_at_utc") == F.col("s.measured_at_utc")), "left")
    d, at = F.col("t.measurement_date_local"), F.col("t.measured_at_local")
    parts = [F.year(d).cast("long"), F.month(d).cast("long"), F.dayofmonth(d).cast("long"), fn.iso_dow(d), F.hour(at).cast("long")]
    apart = [(F.col(f"s.sensor_avg_{c}") - F.col(f"t.{c}")).alias(f"{c}_sensor_minus_batch") for c in COMPARED]
    return rows.select(
        "t.city_hour_key", "t.city_id", *[f"t.{c}" for c in LOCATION], "t.utc_offset_seconds", "t.measured_at_utc", *[f"t.{c}" for c in DATES], *[p.alias(n) for p, n in zip(parts, PARTS, strict=True)],
        *[f"t.{c}" for c in [*AIR, *STATUS, *WEATHER]], F.col("s.city_id").isNotNull().alias("has_sensor_data"), "s.sensor_event_count", "s.sensor_device_count", *[f"s.{c}" for c in SENSOR], *apart, *[f"s.{c}" for c in SENSOR_TIMES], *[f"t.{c}" for c in LINEAGE],
    )


def gold_hourly(city_hours: DataFrame) -> DataFrame:
    """The hourly mart; persist it once, the other marts read it."""
    apart = [f"{c}_sensor_minus_batch" for c in COMPARED]
    return city_hours.select(
        "city_hour_key", "city_id", *LOCATION, "measured_at_utc", *DATES, *PARTS, *AIR, *STATUS, *WEATHER, fn.has_precipitation("precipitation", "rain").alias("has_precipitation"),
        "has_sensor_data", "sensor_event_count", "sensor_device_count", *SENSOR, *apart, *SENSOR_TIMES, fn.latest_of("sensor_data_updated_at", "latest_crawled_at_utc").alias("data_updated_at_utc"),
    )


def _described() -> list[Column]:
    return [F.max_by(c, "measured_at_utc").alias(c) for c in LOCATION]


def gold_daily(hourly: DataFrame) -> DataFrame:
    """City and local date."""
    alerts = F.count_if("is_air_quality_alert")
    worst = [F.max_by(c, "air_quality_status_rank").alias(f"worst_{c}") for c in ("air_quality_status", "air_quality_alert_level")]
    d = F.col("measurement_date_local")
    days = hourly.groupBy("city_id", "measurement_date_local").agg(
        *_described(), F.count(F.lit(1)).alias("observed_hour_count"), *_stats("pm2_5", "avg min max"), *_stats("pm10", "avg min max"), *_stats("us_aqi", "avg min max"),
        alerts.alias("air_quality_alert_hour_count"), (alerts > 0).alias("has_air_quality_alert"), F.max("air_quality_status_rank").alias("worst_air_quality_status_rank"), *worst,
        *_stats("temperature_2m", "avg min max"), *_stats("relative_humidity_2m", "avg"), *[F.sum(F.coalesce(c, F.lit(0.0))).alias(f"total_{c}") for c in ("precipitation", "rain")],
        *_stats("surface_pressure", "avg"), *_stats("cloud_cover", "avg"), *_stats("wind_speed_10m", "avg max"), *_stats("visibility", "avg"), F.count_if("has_precipitation").alias("precipitation_hour_count"), F.max("data_updated_at_utc").alias("data_updated_at_utc"),
    )
    parts = {n: p for n, p in zip(PARTS[:4], (F.year(d).cast("long"), F.month(d).cast("long"), F.dayofmonth(d).cast("long"), fn.iso_dow(d)), strict=True)}
    return days.withColumns({"city_date_key": fn.key("city_id", d)} | parts)


def gold_alerts(hourly: DataFrame) -> DataFrame:
    """Hours over the alert bound, with their severity."""
    cols = ["city_id", *LOCATION, "measured_at_utc", *DATES, "measurement_hour_local", *AIR, *STATUS]
    return hourly.where("is_air_quality_alert").select(F.col("city_hour_key").alias("alert_id"), *cols, fn.alert_severity("air_quality_status_rank").alias("alert_severity"), *WEATHER, "has_precipitation", "data_updated_at_utc")


def gold_correlation(hourly: DataFrame) -> DataFrame:
    """City: averages, pair counts and correlations of particulates with the weather."""
    against = {"temperature": "temperature_2m", "humidity": "relative_humidity_2m", "precipitation": "precipitation", "wind_speed": "wind_speed_10m"}
    pairs = [F.count_if(F.col(p).isNotNull() & F.col(c).isNotNull()).alias(f"{p}_{n}_pair_count") for p in ("pm2_5", "pm10") for n, c in against.items()]
    corrs = [fn.safe_corr(p, c).alias(f"corr_{p}_{n}") for p in ("pm2_5", "pm10") for n, c in against.items()]
    means = [F.avg(c).alias(f"avg_{c}") for c in ("pm2_5", "pm10", "us_aqi", "temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m")]
    return hourly.groupBy("city_id").agg(*_described(), F.count(F.lit(1)).alias("observed_hour_count"), F.min("measured_at_utc").alias("min_measured_at_utc"), F.max("measured_at_utc").alias("max_measured_at_utc"), *means, *pairs, *corrs, F.max("data_updated_at_utc").alias("data_updated_at_utc"))


def live_status(readings: DataFrame, now: Column | None = None) -> DataFrame:
    """One row, also on no readings."""
    now = F.current_timestamp() if now is None else now
    since = lambda m: F.col("processed_at") >= now - F.expr(f"INTERVAL {m} MINUTES")
    row = readings.agg(F.max("event_time_utc").alias("latest_event_at"), F.max("processed_at").alias("latest_processed_at"), F.count_if(since(1)).alias("events_last_1m"), F.count_if(since(5)).alias("events_last_5m"), F.countDistinct(F.when(since(5), F.col("city_id"))).alias("active_cities_last_5m"))
    return row.select("latest_event_at", "latest_processed_at", fn.seconds_between("latest_processed_at", now).alias("seconds_since_last_processed"), "events_last_1m", "events_last_5m", "active_cities_last_5m", fn.is_live("latest_processed_at", now).alias("is_live"))


def live_latest(readings: DataFrame, now: Column | None = None) -> DataFrame:
    """The latest reading of each city."""
    now = F.current_timestamp() if now is None else now
    rows = newest(readings, ["city_id"], [F.desc("event_time_utc"), F.desc("processed_at"), F.desc("event_id")])
    cols = ["city_id", "city_name", "country_code", "device_id", "sequence_number", "event_id", "event_time_utc", "processed_at", "temperature_2m", "relative_humidity_2m", "pm2_5", "pm10", "carbon_monoxide", "nitrogen_dioxide"]
    return rows.select(*cols, fn.seconds_between("processed_at", now).alias("seconds_since_processed"), fn.is_live("processed_at", now).alias("is_live"))


def live_timeseries(readings: DataFrame, now: Column | None = None) -> DataFrame:
    """Cities' minutes of the last hour."""
    now = F.current_timestamp() if now is None else now
    rows = readings.where(F.col("event_time_utc") >= now - F.expr("INTERVAL 60 MINUTES")).groupBy("city_id", F.date_trunc("minute", "event_time_utc").alias("minute_utc"))
    out = rows.agg(F.max("city_name").alias("city_name"), F.max("country_code").alias("country_code"), F.count(F.lit(1)).alias("sensor_event_count"), F.countDistinct("device_id").alias("sensor_device_count"), *_stats("pm2_5", "avg min max"), *_stats("pm10", "avg"), *_stats("temperature_2m", "avg"), *_stats("relative_humidity_2m", "avg"), F.max("processed_at").alias("data_updated_at_utc"))
    return out.withColumn("city_minute_key", fn.key("city_id", fn.instant_text("minute_utc")))


def smoke(filled: dict[str, DataFrame], there: dict[str, DataFrame]) -> DataFrame:
    """One row: whether the tables of ``filled`` have rows and those of ``there`` can be counted; each count is its own scalar."""
    spark = next(iter(filled.values())).sparkSession
    n = lambda df: df.agg(F.count(F.lit(1)).alias("n")).scalar()
    fine = F.lit(True)
    for df in filled.values():
        fine = fine & (n(df) > 0)
    for df in there.values():
        fine = fine & (n(df) >= 0)
    return spark.range(1).select(fine.alias("all_have_rows"))
