"""Bronze, silver and staging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import iso_instant
from ..operators import canonical, latest_wins, sinks, with_values
from ..operators import quality as q

#: Silver's columns before its metrics, and its business key: fixed values.
SILVER = ["city_id", "city_name", "country_code", "country_name", "latitude", "longitude", "timezone", "utc_offset_seconds", "source", "source_system", "dataset_name", "dataset_kind", "record_type", "requested_past_days", "requested_forecast_days", "source_file", "crawled_at_utc", "measured_at_local", "measured_at_utc", "measurement_date_local", "measurement_date_utc"]
BUSINESS_KEY = ["city_id", "measured_at_utc", "source_system", "dataset_name"]


def payload_gaps(raw: DataFrame, metrics: dict[str, str]) -> DataFrame:
    """Documents with a metric that is missing or not as long as the time axis."""
    h = F.col("data.hourly")
    bad = q.same_lengths(h["time"], {m: h[m] for m in metrics})
    return raw.select("source_file", bad.alias("bad_metrics")).where(F.size("bad_metrics") > 0)


def bronze(raw: DataFrame, metrics: dict[str, str], defaults: tuple[str, str, str, str]) -> DataFrame:
    """One row a document and hour; ``defaults`` fill source, source_system, dataset_name and dataset_kind."""
    h = F.col("data.hourly")
    hours = raw.select("metadata", "data.timezone", "data.utc_offset_seconds", "source_file", F.posexplode_outer(F.arrays_zip(h["time"].alias("time"), *[h[m].alias(m) for m in metrics])).alias("hour_index", "hour"))
    m = F.col("metadata")
    names = ("source", "source_system", "dataset_name", "dataset_kind")
    return hours.select(
        *[m[c].alias(c) for c in ("city_id", "city_name", "country_code", "country_name", "latitude", "longitude")],
        *[F.coalesce(m[c], F.lit(d)).alias(c) for c, d in zip(names, defaults, strict=True)],
        m["requested_past_days"].alias("requested_past_days"),
        m["requested_forecast_days"].alias("requested_forecast_days"),
        "source_file",
        m["crawled_at_utc"].alias("crawled_at_utc_raw"),
        F.try_to_timestamp(m["crawled_at_utc"]).alias("crawled_at_utc"),
        "timezone",
        "utc_offset_seconds",
        F.col("hour.time").alias("measured_at_local_raw"),
        F.try_to_timestamp("hour.time").alias("measured_at_local"),
        *[F.col(f"hour.{c}").cast(t).alias(c) for c, t in metrics.items()],
        "hour_index",
    )


def to_utc(local: Column | str, zone: Column | str) -> Column:
    """The instant of a wall-clock time; in a repeated hour the first, in a skipped one an hour later."""
    return F.to_utc_timestamp(local, F.col(zone) if isinstance(zone, str) else zone)


#: What a city's id is known by, and which of two crawls is the later one.
CITY, LATER = ["country_code", "city_name"], ("crawled_at_utc", "source_file")


def observed(bronze_rows: DataFrame) -> DataFrame:
    """Hours that were over when they were crawled, in UTC."""
    t = bronze_rows.withColumn("measured_at_utc", to_utc("measured_at_local", "timezone"))
    t = t.withColumns({"measurement_date_local": F.to_date("measured_at_local"), "measurement_date_utc": F.to_date("measured_at_utc"), "record_type": F.lit("observed")})
    needed = ["city_id", "city_name", "country_code", "source_system", "dataset_name", "timezone", "crawled_at_utc", "measured_at_local", "measured_at_utc"]
    whole = F.lit(True)
    for c in needed:
        whole = whole & F.col(c).isNotNull()
    return t.where(whole & (F.col("measured_at_utc") < F.date_trunc("hour", "crawled_at_utc")))


def silver(bronze_rows: DataFrame, metrics: dict[str, str], ids: DataFrame | None = None) -> DataFrame:
    """Observed hours only, in UTC, with one city id a name and one row a business key: the latest crawl's.  ``ids`` has the cities' ids where they are known."""
    t = observed(bronze_rows)
    t = canonical(t, "city_id", CITY, *LATER, "city_id") if ids is None else with_values(t, ids, "city_id", CITY)
    order = [*LATER] + (["hour_index"] if "hour_index" in t.columns else [])
    t = latest_wins(t, BUSINESS_KEY, *order)
    return t.select(*SILVER, *metrics)


#: Closed ranges of silver's weather columns, None for open: fixed values.
WEATHER_RANGES = {"relative_humidity_2m": (0, 100), "cloud_cover": (0, 100), "precipitation": (0, None), "rain": (0, None), "surface_pressure": (1e-9, None), "wind_speed_10m": (0, None), "wind_direction_10m": (0, 360), "visibility": (0, None), "weather_code": (0, 99)}
POLLUTANTS = ("pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide", "ozone")


def outside(column: str, low: float | None, high: float | None) -> Column:
    c = F.col(column)
    bad = F.lit(False) if low is None else c < low
    return F.count_if(bad if high is None else bad | (c > high))


def bronze_gate(df: DataFrame, keys: tuple[str, ...] = ("source_file", "measured_at_local_raw")) -> DataFrame:
    """One row of what a bronze gate looks at, in one pass; duplicates are rows beyond the first of their keys."""
    missing = F.col("measured_at_local").isNull() | F.col("crawled_at_utc").isNull()
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(missing).alias("m"))
    counts = (F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.countDistinct("source_file").alias("source_files"), F.coalesce(F.sum("m"), F.lit(0)).alias("null_times"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))
    return per.agg(*counts)


def bronze_checks(df: DataFrame) -> dict:
    """The bronze gate: rows and source files must be there, the rest is reported."""
    found = bronze_gate(df).first().asDict()
    if not found["source_files"]:
        raise q.GateError("no source files")
    return q.require(found, [])


def silver_gate(df: DataFrame, kind: str) -> DataFrame:
    """One row of what the silver gate of ``air_quality`` or ``weather`` counts.

    Rows are read once into one row a business key; what is grouped otherwise (ids with
    several names, names with several ids) comes from the few pairs of those.
    """
    c = F.col
    main = "pm2_5" if kind == "air_quality" else "temperature_2m"
    ranges = {p: (0, None) for p in (*POLLUTANTS, "us_aqi")} if kind == "air_quality" else WEATHER_RANGES
    rows = {
        "null_keys": F.count_if(c("city_id").isNull() | c("measured_at_utc").isNull() | c("source_system").isNull() | c("dataset_name").isNull()),
        "future_rows": F.count_if(c("measured_at_utc") >= F.date_trunc("hour", "crawled_at_utc")),
        **{f"bad_{k}": outside(k, *v) for k, v in ranges.items()},
    }
    names = F.collect_set(F.struct("country_code", "city_name"))  # of one hour of one id
    per = df.groupBy(*BUSINESS_KEY).agg(F.count(F.lit(1)).alias("n"), F.count_if(c(main).isNull()).alias("m"), names.alias("names"), *[x.alias(k) for k, x in rows.items()])
    total = lambda x: F.coalesce(F.sum(x), F.lit(0))
    counts = per.agg(total("n").alias("rows"), *[total(k).alias(k) for k in rows], F.count_if(F.col("n") > 1).alias("duplicate_keys"), F.try_divide(F.sum("m").cast("double"), F.sum("n")).alias("null_rate"))
    pairs = per.select("city_id", F.explode("names").alias("name")).where("city_id IS NOT NULL").distinct()
    several = lambda by, other: pairs.groupBy(by).agg(F.countDistinct(other).alias("k")).agg(F.count_if(F.col("k") > 1).alias("k"))
    return counts.crossJoin(several("city_id", "name").select(F.col("k").alias("ids_of_several_names"))).crossJoin(several("name", "city_id").select(F.col("k").alias("names_of_several_ids")))


def silver_checks(df: DataFrame, kind: str) -> dict:
    """The silver gate; raises on a violation."""
    found = silver_gate(df, kind).first().asDict()
    return q.require(found, [k for k in found if k not in ("rows", "null_rate")], {"null_rate": 0.05})


def written_gate(spark: SparkSession, path: str, keys: list[str] | None = None) -> DataFrame:
    """One row about a published table, read anew: rows, duplicate keys, versions and data files."""
    df = sinks.published(spark, path)
    per = df.groupBy(*(keys or BUSINESS_KEY)).agg(F.count(F.lit(1)).alias("n"))
    row = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(F.col("n") > 1).alias("duplicate_keys"))
    return row.withColumns({"versions": F.lit(len(sinks.versions(spark, path))), "data_files": F.lit(sinks.data_files(df))})


def written_checks(spark: SparkSession, path: str, keys: list[str] | None = None) -> dict:
    """The gate after writing; raises on a violation."""
    found = written_gate(spark, path, keys).first().asDict()
    if not found["versions"] or not found["data_files"]:
        raise q.GateError("no version or data file")
    return q.require(found, ["duplicate_keys"])


def staged(df: DataFrame, metrics: dict[str, str]) -> DataFrame:
    """Silver with trimmed names, upper-case codes and fixed types."""
    text = {c: F.trim(c) for c in ("city_name", "country_name", "timezone", "source", "source_system", "dataset_name", "dataset_kind")}
    times = {c: F.col(c).cast("timestamp") for c in ("crawled_at_utc", "measured_at_local", "measured_at_utc")}
    return df.withColumns(text | times | {"country_code": F.upper(F.trim("country_code")), "city_id": F.col("city_id").cast("long")} | {m: F.col(m).cast(t) for m, t in metrics.items()})


def staged_sensors(clean: DataFrame) -> DataFrame:
    """Valid readings of the contract's source, dataset, type and version; the filter stands on raw columns, so files are pruned."""
    rows = clean.where("quality_status = 'VALID' AND source_system = 'iot_simulator' AND dataset_name = 'sensor_readings' AND event_type = 'environment.sensor_reading'")
    return rows.withColumns({"event_id": F.trim("event_id"), "device_id": F.trim("device_id"), "city_id": F.col("city_id").cast("long"), "city_name": F.trim("city_name"), "country_code": F.upper(F.trim("country_code"))})


def clean_reading(events: DataFrame) -> DataFrame:
    """Parsed events as clean rows: instants from text, and the columns that say they are valid."""
    return events.withColumns({"event_time_utc": iso_instant("event_time_utc"), "produced_at_utc": iso_instant("produced_at_utc"), "quality_status": F.lit("VALID"), "quality_error": F.lit(None).cast("string"), "processed_at": F.current_timestamp()})
