"""Sources: raw documents, snapshots, event logs and generated events."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fields of a raw document's metadata: fixed values.
META = "run_id string, schema_version int, city_id bigint, city_name string, country_code string, country_name string, latitude double, longitude double, source string, source_system string, dataset_name string, dataset_kind string, requested_past_days int, requested_forecast_days int, crawled_at_utc string"
#: Metrics of each raw dataset, in output order: fixed values.
AIR_METRICS = {"pm10": "double", "pm2_5": "double", "carbon_monoxide": "double", "nitrogen_dioxide": "double", "sulphur_dioxide": "double", "ozone": "double", "us_aqi": "int"}
WEATHER_METRICS = {"temperature_2m": "double", "relative_humidity_2m": "double", "precipitation": "double", "rain": "double", "surface_pressure": "double", "cloud_cover": "double", "wind_speed_10m": "double", "wind_direction_10m": "double", "visibility": "double", "weather_code": "int"}
#: Fields of an event of the contract, and of a record of the topic: fixed values.
EVENT = "schema_version string, event_type string, event_id string, source_system string, dataset_name string, device_id string, sequence_number bigint, city_id int, city_name string, country_code string, event_time_utc string, produced_at_utc string, temperature_2m double, relative_humidity_2m double, pm2_5 double, pm10 double, carbon_monoxide double, nitrogen_dioxide double"
RECORD = "value binary, topic string, partition int, offset bigint, timestamp timestamp"


def raw_schema(metrics: dict[str, str]) -> T.StructType:
    arrays = ", ".join(f"{m}: array<{t}>" for m, t in metrics.items())
    meta = META.replace(" ", ":").replace(",:", ", ")
    return T.StructType.fromDDL(f"metadata struct<{meta}>, data struct<timezone: string, utc_offset_seconds: int, hourly: struct<time: array<string>, {arrays}>>")


def raw_documents(spark: SparkSession, path: str, metrics: dict[str, str], files: str = "*.json") -> DataFrame:
    """Nested documents, one a file, in any sub-folder; a malformed one fails the job.  Adds ``source_file``."""
    reader = spark.read.schema(raw_schema(metrics)).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", files).option("mode", "FAILFAST")
    return reader.json(path).withColumn("source_file", F.col("_metadata.file_path"))


def crawl(cities: DataFrame, fetch: Callable[[dict], str], retries: int = 4, wait: float = 1.0) -> DataFrame:
    """city_id, payload and error of a request for each city: a failure is tried again and concerns its city only.

    ``fetch`` takes a city's row and gives the response's text, or raises.  Waits double.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for row in b.to_dict("records"):
                payload, error = None, None
                for k in range(retries + 1):
                    try:
                        payload, error = fetch(row), None
                        break
                    except Exception as e:  # whatever a request can raise is the city's own
                        error = f"{type(e).__name__}: {e}"
                        time.sleep(wait * (1 << k) if k < retries else 0)
                out.append((row["city_id"], payload, error))
            yield pd.DataFrame(out, columns=["city_id", "payload", "error"])

    return cities.mapInPandas(work, "city_id long, payload string, error string")


def crawled_documents(cities: DataFrame, responses: DataFrame, metrics: dict[str, str], crawled_at: str, **meta: str) -> DataFrame:
    """Raw documents (metadata and data) of the responses that came; ``meta`` fills the metadata's other fields."""
    schema = raw_schema(metrics)
    rows = cities.join(responses.where("error IS NULL"), "city_id")
    known = {f: F.col(f) for f in cities.columns} | {k: F.lit(v) for k, v in meta.items()} | {"crawled_at_utc": F.lit(crawled_at), "schema_version": F.lit(1)}
    fields = [known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema["metadata"].dataType]
    return rows.select(F.struct(*fields).alias("metadata"), F.from_json("payload", schema["data"].dataType).alias("data"))


def snapshot(spark: SparkSession, path: str, times: list[str] = (), numbers: list[str] = (), flags: list[str] = ()) -> DataFrame:
    """A CSV snapshot read as text and coerced: what can't be read as its type is null."""
    df = spark.read.option("header", True).csv(path)
    to: dict[str, Column] = {c: F.try_to_timestamp(F.col(c)) for c in times}
    to |= {c: F.col(c).try_cast("double") for c in numbers}
    to |= {c: F.coalesce(F.lower(F.trim(F.col(c))) == "true", F.lit(False)) for c in flags}
    return df.withColumns(to)


def kafka(spark: SparkSession, servers: str, topic: str, group: str, starting: str = "latest") -> DataFrame:
    """The topic as a stream; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("kafka.group.id", group).option("startingOffsets", starting).load()


def record_files(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Parquet files with Kafka's columns as a stream, for where the connector is absent."""
    return spark.readStream.schema(RECORD).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def raw_events(records: DataFrame) -> DataFrame:
    """Records as bronze rows: the payload as text and where and when it came from."""
    return records.select(
        F.col("value").cast("string").alias("raw_payload"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.current_timestamp().alias("ingested_at_utc"),
    )


#: The twelve cities of the event contract and their countries: fixed values.
CITIES = {1: ("Chicago", "US"), 2: ("Los Angeles", "US"), 3: ("New York", "US"), 4: ("Manchester", "GB"), 5: ("London", "GB"), 6: ("Munich", "DE"), 7: ("Berlin", "DE"), 8: ("Osaka", "JP"), 9: ("Tokyo", "JP"), 10: ("Busan", "KR"), 11: ("Seoul", "KR"), 12: ("Singapore", "SG")}


def cities(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, *v) for k, v in CITIES.items()], "city_id int, city_name string, country_code string")


def generated_events(spark: SparkSession, n: int, start: str = "2026-01-01T00:00:00Z", seed: int = 1) -> DataFrame:
    """Synthetic sensor events, the same for a seed: normal values around a level for each city, 50 to 2500 ms late."""
    i = F.col("id")
    city = (i % len(CITIES) + 1).cast("int")
    named = F.create_map(*[F.lit(x) for k, v in CITIES.items() for x in (k, v[0])]), F.create_map(*[F.lit(x) for k, v in CITIES.items() for x in (k, v[1])])
    around = lambda level, spread, k, low, high: F.round(F.least(F.greatest(F.lit(level) + city + spread * F.randn(seed + k), F.lit(low)), F.lit(high)), 2)
    at = F.to_timestamp(F.lit(start)) + F.make_dt_interval(secs=i * F.lit(0.5))
    sent = at + F.make_dt_interval(secs=(50 + F.floor(F.rand(seed + 9) * 2451)) / 1000)
    iso = lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    h = F.md5(F.concat_ws("-", F.lit(seed), i))
    uuid = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))
    return spark.range(n).select(
        F.lit("1.0").alias("schema_version"), F.lit("environment.sensor_reading").alias("event_type"), uuid.alias("event_id"), F.lit("iot_simulator").alias("source_system"), F.lit("sensor_readings").alias("dataset_name"),
        F.format_string("device-%02d", city).alias("device_id"), F.floor(i / len(CITIES)).cast("long").alias("sequence_number"), city.alias("city_id"), named[0][city].alias("city_name"), named[1][city].alias("country_code"),
        iso(at).alias("event_time_utc"), iso(sent).alias("produced_at_utc"), around(22.0, 3.0, 1, -80, 70).alias("temperature_2m"), around(60.0, 8.0, 2, 0, 100).alias("relative_humidity_2m"),
        around(20.0, 6.0, 3, 0, 2000).alias("pm2_5"), around(35.0, 9.0, 4, 0, 3000).alias("pm10"), around(400.0, 60.0, 5, 0, 100000).alias("carbon_monoxide"), around(25.0, 5.0, 6, 0, 2000).alias("nitrogen_dioxide"),
    )
