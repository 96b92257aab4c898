"""Queries of the gates and of the sources and sinks around them; the gates look at rows into which violations are planted."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as fn
from .. import sources
from ..operators import sinks
from ..streaming import rules
from . import catalog, expectations, marts, serving, tables
from .catalog import SQL_DAG, SQL_READINGS, query, rounded, t

# --- silver, bronze and what was written --------------------------------------------------------------------------


def _every(k: int) -> Column:
    return F.col("n") % k == 0


def planted(df: DataFrame, air: bool) -> DataFrame:
    """Silver rows with violations, by the number of their source file, and some rows twice."""
    df = df.withColumn("n", F.col("source_file").cast("long"))
    metric, value, main = ("pm10", -1.0, "pm2_5") if air else ("relative_humidity_2m", 100.5, "temperature_2m")
    changed = {
        "city_id": F.when(_every(101), None).when(_every(103), F.col("city_id") + 100).otherwise(F.col("city_id")),
        "city_name": F.when(_every(107), F.concat("city_name", F.lit("x"))).otherwise(F.col("city_name")),
        "crawled_at_utc": F.when(_every(109), F.col("measured_at_utc")).otherwise(F.col("crawled_at_utc")),
        metric: F.when(_every(97), value).otherwise(F.col(metric)),
        main: F.when(~_every(13), F.col(main)),
    }
    df = df.withColumns(changed)
    return df.unionAll(df.where("n % 17 = 0")).drop("n")


def _sql_planted(air: bool) -> str:
    metric, value, main, name = ("pm10", "-1", "pm2_5", "air") if air else ("relative_humidity_2m", "100.5", "temperature_2m", "weather")
    return f"""WITH {catalog._sql_silver(air)},
p AS (SELECT * EXCLUDE (n) REPLACE (CASE WHEN n % 101 = 0 THEN NULL WHEN n % 103 = 0 THEN city_id + 100 ELSE city_id END AS city_id, CASE WHEN n % 107 = 0 THEN city_name || 'x' ELSE city_name END AS city_name,
 CASE WHEN n % 109 = 0 THEN measured_at_utc ELSE crawled_at_utc END AS crawled_at_utc, CASE WHEN n % 97 = 0 THEN {value} ELSE {metric} END AS {metric}, CASE WHEN n % 13 <> 0 THEN {main} END AS {main})
 FROM (SELECT *, source_file::BIGINT AS n FROM {name} UNION ALL SELECT *, source_file::BIGINT FROM {name} WHERE source_file::BIGINT % 17 = 0))"""


#: What silver must not hold, written out once more: the SQL shares no bound with the code.
_BAD_AIR = {"pm10": "pm10 < 0", "pm2_5": "pm2_5 < 0", "carbon_monoxide": "carbon_monoxide < 0", "nitrogen_dioxide": "nitrogen_dioxide < 0", "sulphur_dioxide": "sulphur_dioxide < 0", "ozone": "ozone < 0", "us_aqi": "us_aqi < 0"}
_BAD_WEATHER = {
    "relative_humidity_2m": "relative_humidity_2m NOT BETWEEN 0 AND 100", "cloud_cover": "cloud_cover NOT BETWEEN 0 AND 100", "precipitation": "precipitation < 0", "rain": "rain < 0", "surface_pressure": "surface_pressure <= 0", "wind_speed_10m": "wind_speed_10m < 0",
    "wind_direction_10m": "wind_direction_10m NOT BETWEEN 0 AND 360", "visibility": "visibility < 0", "weather_code": "weather_code NOT BETWEEN 0 AND 99",
}


def _sql_gate(air: bool) -> str:
    bad = ", ".join(f"count(*) FILTER (WHERE {x}) AS bad_{k}" for k, x in (_BAD_AIR if air else _BAD_WEATHER).items())
    return f"""{_sql_planted(air)}
SELECT count(*) AS rows, count(*) FILTER (WHERE city_id IS NULL) AS null_keys, count(*) FILTER (WHERE measured_at_utc >= date_trunc('hour', crawled_at_utc)) AS future_rows, {bad},
 (SELECT count(*) FROM (SELECT 1 FROM p GROUP BY city_id, measured_at_utc HAVING count(*) > 1)) AS duplicate_keys, round(count(*) FILTER (WHERE {"pm2_5" if air else "temperature_2m"} IS NULL) / count(*)::DOUBLE, 6) AS null_rate,
 (SELECT count(*) FROM (SELECT city_id FROM p WHERE city_id IS NOT NULL GROUP BY city_id HAVING count(DISTINCT (country_code, city_name)) > 1)) AS ids_of_several_names,
 (SELECT count(*) FROM (SELECT 1 FROM p GROUP BY country_code, city_name HAVING count(DISTINCT city_id) > 1)) AS names_of_several_ids FROM p"""


@query(_sql_gate(True))
def silver_gate_air(spark, d):
    return rounded(tables.silver_gate(planted(catalog.mart(spark, d, "air_quality_hourly"), True), "air_quality"))


@query(_sql_gate(False))
def silver_gate_weather(spark, d):
    return rounded(tables.silver_gate(planted(catalog.mart(spark, d, "weather_hourly"), False), "weather"))


@query("""WITH b AS (SELECT (event_id // 10)::BIGINT AS f, CASE WHEN event_id % 23 = 0 THEN NULL ELSE date_trunc('hour', ts) END AS h, event_id % 29 = 0 AS early FROM events WHERE event_type IN ('click', 'view'))
SELECT count(*) AS rows, count(DISTINCT f) AS source_files, count(*) FILTER (WHERE h IS NULL OR early) AS null_times, count(*) - (SELECT count(*) FROM (SELECT DISTINCT f, h FROM b)) AS duplicate_rows FROM b""")
def bronze_gate(spark, d):
    """Ten events make a file; some of its hours repeat or are missing, some crawls have no time."""
    n = F.col("event_id")
    b = t(spark, d, "events").where("event_type IN ('click', 'view')").select(F.floor(n / 10).alias("source_file"), F.when(n % 23 != 0, F.date_trunc("hour", "ts")).alias("measured_at_local"), F.when(n % 29 != 0, F.col("ts")).alias("crawled_at_utc"))
    return tables.bronze_gate(b, ("source_file", "measured_at_local"))


@query(f"{_sql_planted(True)} SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT 1 FROM p GROUP BY city_id, measured_at_utc HAVING count(*) > 1)) AS duplicate_keys, 2 AS versions, true AS has_files FROM p")
def written_gate(spark, d):
    """The gate after writing, over the second version of a table."""
    path, air = catalog._work_dir(spark, "gated"), catalog.mart(spark, d, "air_quality_hourly")
    sinks.publish(air, path)
    sinks.publish(planted(air, True), path)
    return tables.written_gate(spark, path).select("rows", "duplicate_keys", "versions", (F.col("data_files") > 0).alias("has_files"))


# --- the contract -------------------------------------------------------------------------------------------------

_UUID = "substr({m}, 1, 8) || '-' || substr({m}, 9, 4) || '-' || substr({m}, 13, 4) || '-' || substr({m}, 17, 4) || '-' || substr({m}, 21, 12)"


#: The contract's cities, written out once more.
_CITIES = "(1, 'Chicago', 'US'), (2, 'Los Angeles', 'US'), (3, 'New York', 'US'), (4, 'Manchester', 'GB'), (5, 'London', 'GB'), (6, 'Munich', 'DE'), (7, 'Berlin', 'DE'), (8, 'Osaka', 'JP'), (9, 'Tokyo', 'JP'), (10, 'Busan', 'KR'), (11, 'Seoul', 'KR'), (12, 'Singapore', 'SG')"


@query(f"""WITH e AS (SELECT event_id, (user_id % 12 + 1)::INTEGER AS city, event_id % 41 AS f, {_UUID.format(m="md5(event_id::VARCHAR)")} AS u FROM events), x AS (SELECT e.*, c.name FROM e JOIN (VALUES {_CITIES}) AS c(id, name, country) ON city = c.id)
SELECT event_id, CASE f WHEN 1 THEN 'device_id' WHEN 2 THEN 'schema_version const' WHEN 3 THEN 'temperature_2m range' WHEN 4 THEN 'event_id uuid' WHEN 5 THEN 'country_code pattern' WHEN 6 THEN 'sequence_number minimum' WHEN 7 THEN 'event after production' WHEN 8 THEN 'pm2_5 range' WHEN 9 THEN 'city_id range' ELSE '' END AS violations,
 f IN (5, 9, 10) AS city_mismatch FROM x""")
def contract_gate(spark, d):
    """Generated events of the contract's cities, some broken, each in one way."""
    f = F.col("event_id") % 41
    e = t(spark, d, "events").withColumn("id", F.col("event_id")).withColumn("f", f).withColumn("city", (F.col("user_id") % 12 + 1).cast("int"))
    e = e.join(F.broadcast(sources.cities(spark)), e["city"] == F.col("city_id"))
    m = F.md5(F.col("id").cast("string"))
    uuid_ = F.concat_ws("-", F.substring(m, 1, 8), F.substring(m, 9, 4), F.substring(m, 13, 4), F.substring(m, 17, 4), F.substring(m, 21, 12))
    either = lambda k, bad, good: F.when(F.col("f") == k, bad).otherwise(good)
    event = {
        "schema_version": either(2, F.lit("2.0"), F.lit("1.0")), "event_type": F.lit("environment.sensor_reading"), "event_id": either(4, F.lit("x"), uuid_), "source_system": F.lit("iot_simulator"), "dataset_name": F.lit("sensor_readings"),
        "device_id": F.when(F.col("f") != 1, F.lit("d")), "sequence_number": either(6, F.lit(-1), F.col("id")).cast("long"), "city_id": either(9, F.lit(13), F.col("city_id")).cast("int"), "city_name": either(10, F.lit("Nowhere"), F.col("city_name")), "country_code": either(5, F.lit("us"), F.col("country_code")),
        "event_time_utc": either(7, F.lit("2024-01-02T00:00:00Z"), F.lit("2024-01-01T00:00:00Z")), "produced_at_utc": F.lit("2024-01-01T00:00:01Z"), "temperature_2m": either(3, F.lit(70.5), F.lit(70.0)), "relative_humidity_2m": F.lit(50.0),
        "pm2_5": either(8, F.lit(2000.5), F.lit(1.0)), "pm10": F.lit(1.0), "carbon_monoxide": F.lit(1.0), "nitrogen_dioxide": F.lit(1.0),
    }
    x = e.select("id", F.struct(*[c.alias(k) for k, c in event.items()]).alias("event"))
    wrong = rules.city_mismatch(x.select("id", "event.*"), sources.cities(spark)).select(F.col("id").alias("wrong"))
    x = x.join(wrong, F.col("id") == F.col("wrong"), "left")
    return x.select(F.col("id").alias("event_id"), F.array_join(rules.contract_violations(), ",").alias("violations"), F.col("wrong").isNotNull().alias("city_mismatch"))


# --- tests bound to models ----------------------------------------------------------------------------------------


def _tests_sql(frames: dict[str, str]) -> str:
    """A row for each test of the models; ``frames`` maps them to tables or subqueries."""
    parts = []
    for model, frm in frames.items():
        spec = expectations.MODELS[model]
        for kind, c in expectations.tests_of(model):
            if kind == "not_null":
                n = f"SELECT count(*) FROM {frm} WHERE {c} IS NULL"
            elif kind == "values":
                n = f"SELECT count(*) FROM {frm} WHERE {c} NOT IN ({', '.join(repr(v) for v in spec[kind][c])})"
            elif kind == "ranges":
                lo, hi = spec[kind][c]
                n = f"SELECT count(*) FROM {frm} WHERE {' OR '.join([f'{c} < {lo}'] * (lo is not None) + [f'{c} > {hi}'] * (hi is not None))}"
            elif kind == "unique":
                n = f"SELECT count(*) FROM (SELECT {c} FROM {frm} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
            elif spec[kind][c][0] in frames:
                other, key = spec[kind][c]
                n = f"SELECT count(*) FROM {frm} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {key} FROM {frames[other]})"
            else:
                continue
            parts.append(f"SELECT '{model}' AS model, '{kind}' AS test, '{c}' AS column, ({n}) AS n_failed")
    return "\nUNION ALL ".join(parts)


def _model_tests_sql() -> str:
    frames = {"int_sensor_environment_hourly": "s2", "int_weather_air_quality_joined": "j", "int_air_quality_threshold_status": "c2", "int_city_environment_hourly": "h", "gold_city_environment_hourly": "g", "gold_city_environment_daily": "dy", "gold_environmental_alerts": "al"}
    broken = """s2 AS (SELECT * REPLACE (CASE WHEN city_id % 5 = 0 THEN NULL ELSE city_name END AS city_name, CASE WHEN city_id % 7 = 0 THEN 0 ELSE sensor_event_count END AS sensor_event_count) FROM s UNION ALL SELECT * FROM s WHERE city_id = 3),
c2 AS (SELECT * REPLACE (CASE WHEN city_id % 5 = 0 THEN city_hour_key || '?' ELSE city_hour_key END AS city_hour_key, CASE WHEN city_id % 7 = 0 THEN 'fine' ELSE air_quality_status END AS air_quality_status) FROM c),
dy AS (SELECT city_id || '|' || measurement_date_local AS city_date_key, city_id, measurement_date_local, count(*) AS observed_hour_count, arg_max_null(air_quality_status, air_quality_status_rank) AS worst_air_quality_status, max(data_updated_at_utc) AS data_updated_at_utc FROM g GROUP BY city_id, measurement_date_local),
al AS (SELECT CASE WHEN city_id % 2 = 0 THEN city_hour_key || '?' ELSE city_hour_key END AS alert_id, city_id, measured_at_utc, is_air_quality_alert, CASE WHEN city_id % 3 = 0 THEN 'bad' WHEN air_quality_status_rank >= 6 THEN 'critical' WHEN air_quality_status_rank = 5 THEN 'severe' WHEN air_quality_status_rank = 4 THEN 'high' ELSE 'warning' END AS alert_severity FROM g WHERE is_air_quality_alert)"""
    return f"{SQL_DAG},\n{broken}\n" + _tests_sql(frames)


@query(_model_tests_sql())
def model_tests(spark, d):
    """The tests of the models from the rollup to the marts; three of them are broken first."""
    base = catalog.published(spark, d)
    s, c, by = marts.table(spark, base, "sensor_hourly"), marts.classified(spark, base), F.col("city_id")
    s2 = s.withColumns({"city_name": F.when(by % 5 != 0, F.col("city_name")), "sensor_event_count": F.when(by % 7 == 0, 0).otherwise(F.col("sensor_event_count"))}).unionAll(s.where("city_id = 3"))
    c2 = c.withColumns({"city_hour_key": F.when(by % 5 == 0, F.concat("city_hour_key", F.lit("?"))).otherwise(F.col("city_hour_key")), "air_quality_status": F.when(by % 7 == 0, "fine").otherwise(F.col("air_quality_status"))})
    al = marts.table(spark, base, "gold_alerts")
    al = al.withColumns({"alert_id": F.when(by % 2 == 0, F.concat("alert_id", F.lit("?"))).otherwise(F.col("alert_id")), "alert_severity": F.when(by % 3 == 0, "bad").otherwise(F.col("alert_severity"))})
    return expectations.run({"int_sensor_environment_hourly": s2, "int_weather_air_quality_joined": c, "int_air_quality_threshold_status": c2, "int_city_environment_hourly": marts.enriched(spark, base), "gold_city_environment_hourly": marts.table(spark, base, "gold_hourly"), "gold_city_environment_daily": marts.table(spark, base, "gold_daily"), "gold_environmental_alerts": al})


_SQL_STAGED = {
    "stg_air_quality_hourly": f"({_sql_planted(True)} SELECT *, 'air' AS dataset_name, 'observed' AS record_type FROM p) AS x",
    "stg_weather_hourly": f"({_sql_planted(False)} SELECT *, 'weather' AS dataset_name, 'observed' AS record_type FROM p) AS x",
    "stg_sensor_readings": f"(WITH {SQL_READINGS} SELECT * REPLACE (CASE WHEN sequence_number % 7 = 0 THEN 'e' ELSE event_id END AS event_id), CASE WHEN sequence_number % 5 = 0 THEN 'BAD' ELSE 'VALID' END AS quality_status, '1.0' AS schema_version, 'environment.sensor_reading' AS event_type, 'iot_simulator' AS source_system, 'sensor_readings' AS dataset_name FROM r) AS x",
}


@query(_tests_sql(_SQL_STAGED))
def staging_tests(spark, d):
    """The tests of the staged rows, all with planted violations."""
    n = F.col("sequence_number")
    sensors = catalog.readings(spark, d).withColumns({"event_id": F.when(n % 7 == 0, "e").otherwise(F.col("event_id")), "quality_status": F.when(n % 5 == 0, "BAD").otherwise("VALID"), "schema_version": F.lit("1.0"), "event_type": F.lit("environment.sensor_reading"), "source_system": F.lit("iot_simulator"), "dataset_name": F.lit("sensor_readings")})
    silver = {f"stg_{n}": planted(catalog.mart(spark, d, n), n == "air_quality_hourly") for n in ("air_quality_hourly", "weather_hourly")}
    return expectations.run(silver | {"stg_sensor_readings": sensors})


_SQL_VIEWS = {m: f"({catalog.ORACLE_SQL[q]}) AS x" for m, q in {"live_sensor_status": "live_status", "live_sensor_latest_by_city": "live_latest", "live_sensor_timeseries_1min": "live_timeseries", "gold_weather_air_quality_correlation": "gold_correlation"}.items()}


@query(_tests_sql(_SQL_VIEWS))
def view_tests(spark, d):
    """The tests of the live views and of the correlations."""
    q = catalog.QUERIES
    return expectations.run({"live_sensor_status": q["live_status"](spark, d), "live_sensor_latest_by_city": q["live_latest"](spark, d), "live_sensor_timeseries_1min": q["live_timeseries"](spark, d), "gold_weather_air_quality_correlation": q["gold_correlation"](spark, d)})


# --- sources and sinks --------------------------------------------------------------------------------------------


@query("""WITH e AS (SELECT user_id % 12 + 1 AS city_id, date_trunc('minute', ts) AS minute, event_id, value FROM events), p AS (SELECT *, (row_number() OVER (PARTITION BY city_id ORDER BY event_id) - 1)::INTEGER AS hour_index FROM e)
SELECT city_id, 'city' || city_id AS city_name, hour_index, minute AS measured_at_local, value AS pm2_5, floor(value)::INTEGER AS us_aqi, TIMESTAMP '2024-03-01 00:00:00' AS crawled_at_utc FROM p""")
def bronze_documents(spark, d):
    """Raw documents, one file a city, read and flattened into bronze rows."""
    path = catalog._work_dir(spark, "raw")
    e = t(spark, d, "events").select((F.col("user_id") % 12 + 1).alias("city_id"), F.struct("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"), "value").alias("r"))
    per = e.groupBy("city_id").agg(F.array_sort(F.collect_list("r")).alias("r"))  # a city's hours, as a document holds them
    of = lambda f: F.transform("r", f)
    value, whole = of(lambda r: r["value"]), of(lambda r: F.floor(r["value"]).cast("int"))
    metrics = {m: value if k == "double" else whole for m, k in sources.AIR_METRICS.items()}
    meta = F.struct("city_id", F.concat(F.lit("city"), F.col("city_id").cast("string")).alias("city_name"), F.lit("2024-03-01T00:00:00Z").alias("crawled_at_utc"))
    hours = F.struct(of(lambda r: r["time"]).alias("time"), *[m.alias(n) for n, m in metrics.items()])
    data = F.struct(F.lit("Asia/Bangkok").alias("timezone"), F.lit(25200).alias("utc_offset_seconds"), hours.alias("hourly"))
    per.select(F.to_json(F.struct(meta.alias("metadata"), data.alias("data"))).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    raw = sources.raw_documents(spark, path, sources.AIR_METRICS, files="*.txt")
    return tables.bronze(raw, sources.AIR_METRICS, ("api", "s", "d", "k")).select("city_id", "city_name", "hour_index", "measured_at_local", "pm2_5", "us_aqi", "crawled_at_utc")


_WEATHER_SQL = "k - 40 AS temperature_2m, k AS relative_humidity_2m, CASE WHEN k % 3 = 0 THEN k / 10 END AS precipitation, CASE WHEN k % 3 = 0 THEN k / 20 END AS rain, k + 1000 AS surface_pressure, k AS cloud_cover, value / 10 AS wind_speed_10m, k * 3 AS wind_direction_10m, value * 100 AS visibility, k::INTEGER AS weather_code"
_WEATHER_ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in ("precipitation", "rain", "wind_speed_10m", "visibility"))


@query(f"""WITH e AS (SELECT event_id, ts, value, user_id % 12 + 1 AS city_id, ts::DATE AS day, json_extract_string(props, '$.k')::DOUBLE AS k FROM events),
p AS (SELECT *, (row_number() OVER (PARTITION BY city_id, day ORDER BY event_id) - 1)::INTEGER AS hour_index, {_WEATHER_SQL} FROM e)
SELECT city_id, 'city' || city_id AS city_name, 'C' || (city_id % 3) AS country_code, 'country' || (city_id % 3) AS country_name, city_id::DOUBLE AS latitude, -city_id::DOUBLE AS longitude, 'api' AS source, CASE WHEN city_id % 2 = 0 THEN 'src' ELSE 's' END AS source_system, 'weather' AS dataset_name, 'forecast' AS dataset_kind, 7 AS requested_past_days, 0 AS requested_forecast_days,
 true AS has_file, strftime(day, '%Y-%m-%d') || 'T23:59:59Z' AS crawled_at_utc_raw, day::TIMESTAMP + INTERVAL 86399 SECOND AS crawled_at_utc, 'Asia/Bangkok' AS timezone, 25200 AS utc_offset_seconds, strftime(ts, '%Y-%m-%dT%H:%M') AS measured_at_local_raw, date_trunc('minute', ts) AS measured_at_local,
 temperature_2m, relative_humidity_2m, surface_pressure, cloud_cover, wind_direction_10m, weather_code, hour_index, {_WEATHER_ROUNDED} FROM p""")
def bronze_weather(spark, d):
    """Raw weather documents, one a city and day, read and flattened into bronze rows with all their columns; some fields come from the defaults."""
    path = catalog._work_dir(spark, "raw-weather")
    c, k = F.col, catalog.k_of()
    rain = F.when(k % 3 == 0, k / 10)
    metrics = {"temperature_2m": k - 40, "relative_humidity_2m": k, "precipitation": rain, "rain": rain / 2, "surface_pressure": k + 1000, "cloud_cover": k, "wind_speed_10m": c("value") / 10, "wind_direction_10m": k * 3, "visibility": c("value") * 100, "weather_code": k.cast("int")}
    hour = F.struct("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"), *[v.alias(n) for n, v in metrics.items()])
    e = t(spark, d, "events").select((c("user_id") % 12 + 1).alias("city_id"), F.to_date("ts").alias("day"), hour.alias("r"))
    docs = e.groupBy("city_id", "day").agg(F.array_sort(F.collect_list("r")).alias("r"))  # a city's hours of a day, as a document holds them
    number = c("city_id").cast("string")
    meta = F.struct("city_id", F.concat(F.lit("city"), number).alias("city_name"), F.concat(F.lit("C"), (c("city_id") % 3).cast("string")).alias("country_code"), F.concat(F.lit("country"), (c("city_id") % 3).cast("string")).alias("country_name"), c("city_id").cast("double").alias("latitude"), (-c("city_id")).cast("double").alias("longitude"), F.when(c("city_id") % 2 == 0, "src").alias("source_system"), F.lit(7).alias("requested_past_days"), F.lit(0).alias("requested_forecast_days"), F.concat(c("day").cast("string"), F.lit("T23:59:59Z")).alias("crawled_at_utc"))
    of = lambda n: F.transform("r", lambda r: r[n]).alias(n)
    hours = F.struct(*[of(n) for n in ("time", *metrics)])
    data = F.struct(F.lit("Asia/Bangkok").alias("timezone"), F.lit(25200).alias("utc_offset_seconds"), hours.alias("hourly"))
    docs.select(F.to_json(F.struct(meta.alias("metadata"), data.alias("data"))).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    rows = tables.bronze(sources.raw_documents(spark, path, sources.WEATHER_METRICS, files="*.txt"), sources.WEATHER_METRICS, ("api", "s", "weather", "forecast"))
    return rounded(rows.withColumn("has_file", (c("source_file") != "")).drop("source_file"))


@query("SELECT event_id::DOUBLE AS event_id, CASE WHEN event_id % 5 <> 0 THEN date_trunc('second', ts) END AS ts, CASE WHEN event_id % 3 <> 0 THEN (event_id % 100)::DOUBLE END AS v, event_id % 2 = 0 AS flag FROM events")
def csv_snapshot(spark, d):
    """A snapshot with fields that can't be read as their types."""
    path, n = catalog._work_dir(spark, "snapshot"), F.col("event_id")
    e = t(spark, d, "events").select(n.alias("event_id"), F.when(n % 5 == 0, "never").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ts"), F.when(n % 3 == 0, "n/a").otherwise((n % 100).cast("string")).alias("v"), F.when(n % 2 == 0, " TRUE ").otherwise("no").alias("flag"))
    e.write.option("header", True).csv(path)
    return sources.snapshot(spark, path, ["ts"], ["event_id", "v"], ["flag"])


@query("SELECT n_nationkey, n_name FROM nation UNION ALL SELECT -1, 'one more'")
def insert_overwrite_union(spark, d):
    """A table replaced by itself and one more row."""
    name = f"aquifer_{uuid.uuid4().hex}"
    sinks.create_table(spark, name, "n_nationkey BIGINT, n_name STRING")
    t(spark, d, "nation").select(F.col("n_nationkey").cast("long"), "n_name").write.insertInto(name)
    sinks.insert_overwrite(spark, name, spark.table(name).unionAll(spark.sql("SELECT -1L, 'one more'")))
    return spark.table(name)


@query(f"WITH {SQL_READINGS} SELECT event_id, sequence_number, device_id, city_id, 'city' || city_id AS city_name, upper(country_code) AS country_code, event_time_utc FROM r WHERE sequence_number % 4 <> 0 AND sequence_number % 5 <> 0")
def staged_sensors(spark, d):
    """Valid readings of the contract's source; every fourth row is invalid, every fifth of another system."""
    n = F.col("sequence_number")
    r = catalog.readings(spark, d).withColumns({"quality_status": F.when(n % 4 != 0, "VALID").otherwise("BAD"), "source_system": F.when(n % 5 != 0, "iot_simulator").otherwise("other"), "dataset_name": F.lit("sensor_readings"), "event_type": F.lit("environment.sensor_reading"), "city_name": F.concat(F.lit(" "), "city_name"), "country_code": F.lower("country_code")})
    return tables.staged_sensors(r).select("event_id", "sequence_number", "device_id", "city_id", "city_name", "country_code", "event_time_utc")


@query(f"{SQL_DAG} SELECT city_name, count(*) AS n, max(air_quality_status_rank) AS worst FROM g GROUP BY city_name")
def serving_sql(spark, d):
    """SQL over the registered views of the published tables."""
    prefix = f"v{uuid.uuid4().hex}_"
    marts.register(spark, catalog.published(spark, d), prefix)
    return spark.sql(f"SELECT city_name, count(*) AS n, max(air_quality_status_rank) AS worst FROM {prefix}gold_hourly GROUP BY city_name")


@query("SELECT n_nationkey AS city_id, n_name AS city_name, substr(r_name, 1, 2) AS country_code, r_name AS country_name, (row_number() OVER (ORDER BY substr(r_name, 1, 2), r_name, n_name))::INTEGER AS place FROM nation JOIN region ON n_regionkey = r_regionkey")
def reference_cities(spark, d):
    """The cities' query; each row's place in its order comes with it, so that the order is compared, too."""
    cities = t(spark, d, "nation").select(F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city_name"), F.col("n_regionkey").alias("country_id"))
    countries = t(spark, d, "region").select(F.col("r_regionkey").alias("country_id"), F.concat(F.substring("r_name", 1, 2), F.lit("|"), "r_name").alias("country_code"), F.col("r_name").alias("country_name"))
    rows = serving.reference_cities(cities, countries)
    place = F.row_number().over(Window.orderBy("at"))  # a dimension of a row a city
    return rows.select("city_id", "city_name", F.substring("country_code", 1, 2).alias("country_code"), "country_name", F.monotonically_increasing_id().alias("at")).withColumn("place", place).drop("at")


_kpis = ", ".join(f"round(avg({c}), 6) AS avg_{c}" for c in serving.KPIS)


@query(f"{SQL_DAG} SELECT max(measured_at_utc) AS snapshot_at, count(DISTINCT city_name) AS n_cities, count(*) AS n_rows, count(*) FILTER (WHERE is_air_quality_alert) AS n_alerts, {_kpis} FROM g WHERE measured_at_utc = (SELECT max(measured_at_utc) FROM g)")
def snapshot_kpis(spark, d):
    return rounded(serving.snapshot_kpis(catalog.mart(spark, d, "gold_hourly")))


@query(f"{SQL_DAG}, b AS (SELECT * REPLACE (CASE WHEN hour(measured_at_utc) % 7 = 0 THEN NULL ELSE sensor_device_count END AS sensor_device_count, CASE WHEN hour(measured_at_utc) % 5 = 0 THEN false ELSE has_sensor_data END AS has_sensor_data) FROM g) SELECT city_hour_key FROM b WHERE (has_sensor_data AND (sensor_event_count IS NULL OR sensor_device_count IS NULL OR sensor_data_updated_at IS NULL)) OR (NOT has_sensor_data AND (sensor_event_count IS NOT NULL OR sensor_device_count IS NOT NULL OR sensor_data_updated_at IS NOT NULL))".replace("sensor_data_updated_at IS", "last_sensor_event_at IS"))
def presence_check(spark, d):
    """Hours whose flag and sensor columns disagree; some are altered first."""
    hour = F.hour("measured_at_utc")
    broken = catalog.mart(spark, d, "gold_hourly").withColumns({"sensor_device_count": F.when(hour % 7 != 0, F.col("sensor_device_count")), "has_sensor_data": F.when(hour % 5 == 0, F.lit(False)).otherwise(F.col("has_sensor_data"))})
    some, every = F.lit(False), F.lit(True)
    for c in ("sensor_event_count", "sensor_device_count", "last_sensor_event_at"):
        some, every = some | F.col(c).isNotNull(), every & F.col(c).isNotNull()
    return broken.where((F.col("has_sensor_data") & ~every) | (~F.col("has_sensor_data") & some)).select("city_hour_key")


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false ELSE true END AS blank FROM events")
def blank_texts(spark, d):
    text = F.when(F.col("event_id") % 4 == 0, " \t\n").when(F.col("event_id") % 4 == 1, "").when(F.col("event_id") % 4 == 2, " x\t")
    return t(spark, d, "events").select("event_id", fn.blank(text).alias("blank"))
