"""What each model's columns must hold, and a run of those tests.

A test counts the rows (for unique: the values; for references: the rows without a
partner) that fail it; nulls fail only where they are not allowed.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality as q

#: Accepted values: fixed values.
STATUSES = ("unknown", "invalid", "good", "moderate", "unhealthy_for_sensitive_groups", "unhealthy", "very_unhealthy", "hazardous")
LEVELS = ("unknown", "none", "warning", "alert", "severe", "critical")
SEVERITIES = ("warning", "high", "severe", "critical")

_KEYS = "city_id measured_at_utc source_system dataset_name record_type"
_CORRELATIONS = {f"corr_{p}_{n}": (-1, 1) for p in ("pm2_5", "pm10") for n in ("temperature", "humidity", "precipitation", "wind_speed")}

#: The tests of each model: fixed values.  not_null and unique name columns; ranges are closed, None is open; references give model and column.
MODELS: dict[str, dict] = {
    "stg_air_quality_hourly": {"not_null": _KEYS, "values": {"record_type": ("observed",)}, "ranges": {"pm2_5": (0, 800), "pm10": (0, 1200)}},
    "stg_weather_hourly": {
        "not_null": _KEYS,
        "values": {"record_type": ("observed",)},
        "ranges": {"relative_humidity_2m": (0, 100), "precipitation": (0, None), "rain": (0, None), "cloud_cover": (0, 100), "wind_speed_10m": (0, None), "wind_direction_10m": (0, 360), "visibility": (0, None)},
    },
    "stg_sensor_readings": {
        "not_null": "event_id device_id sequence_number city_id event_time_utc processed_at schema_version event_type source_system dataset_name quality_status",
        "unique": "event_id",
        "values": {"schema_version": ("1.0",), "event_type": ("environment.sensor_reading",), "source_system": ("iot_simulator",), "dataset_name": ("sensor_readings",), "quality_status": ("VALID",)},
        "ranges": {"relative_humidity_2m": (0, 100), "pm2_5": (0, 800), "pm10": (0, 1200)},
    },
    "int_sensor_environment_hourly": {
        "not_null": "city_hour_key city_id measured_at_utc city_name country_code sensor_event_count sensor_device_count first_sensor_event_at last_sensor_event_at sensor_data_updated_at",
        "unique": "city_hour_key",
        "ranges": {"sensor_event_count": (1, None), "sensor_device_count": (1, None), "sensor_avg_relative_humidity_2m": (0, 100), "sensor_avg_pm2_5": (0, 800), "sensor_avg_pm10": (0, 1200)},
    },
    "int_weather_air_quality_joined": {"not_null": "city_hour_key city_id measured_at_utc", "unique": "city_hour_key"},
    "int_air_quality_threshold_status": {
        "not_null": "city_hour_key air_quality_status air_quality_alert_level is_air_quality_alert",
        "unique": "city_hour_key",
        "values": {"air_quality_status": STATUSES, "air_quality_alert_level": LEVELS},
        "references": {"city_hour_key": ("int_weather_air_quality_joined", "city_hour_key")},
    },
    "int_city_environment_hourly": {
        "not_null": "city_hour_key city_id measured_at_utc measurement_date_local air_quality_status is_air_quality_alert has_sensor_data",
        "unique": "city_hour_key",
        "values": {"has_sensor_data": (True, False)},
        "ranges": {"sensor_event_count": (1, None), "sensor_device_count": (1, None)},
        "references": {"city_hour_key": ("int_air_quality_threshold_status", "city_hour_key")},
    },
    "gold_city_environment_hourly": {
        "not_null": "city_hour_key city_id measured_at_utc air_quality_status air_quality_alert_level data_updated_at_utc has_sensor_data",
        "unique": "city_hour_key",
        "values": {"air_quality_status": STATUSES, "air_quality_alert_level": LEVELS, "has_sensor_data": (True, False)},
        "ranges": {"sensor_event_count": (1, None), "sensor_device_count": (1, None)},
        "references": {"city_hour_key": ("int_city_environment_hourly", "city_hour_key")},
    },
    "gold_city_environment_daily": {
        "not_null": "city_date_key city_id measurement_date_local observed_hour_count worst_air_quality_status data_updated_at_utc",
        "unique": "city_date_key",
        "values": {"worst_air_quality_status": STATUSES},
        "ranges": {"observed_hour_count": (1, None)},
    },
    "gold_environmental_alerts": {
        "not_null": "alert_id city_id measured_at_utc is_air_quality_alert alert_severity",
        "unique": "alert_id",
        "values": {"is_air_quality_alert": (True,), "alert_severity": SEVERITIES},
        "references": {"alert_id": ("gold_city_environment_hourly", "city_hour_key")},
    },
    "gold_weather_air_quality_correlation": {
        "not_null": "city_id observed_hour_count data_updated_at_utc",
        "unique": "city_id",
        "ranges": {"observed_hour_count": (1, None), **_CORRELATIONS},
        "references": {"city_id": ("gold_city_environment_hourly", "city_id")},
    },
    "live_sensor_status": {"not_null": "latest_processed_at seconds_since_last_processed events_last_1m events_last_5m active_cities_last_5m is_live"},
    "live_sensor_latest_by_city": {"not_null": "city_id event_id device_id event_time_utc processed_at is_live", "unique": "city_id event_id"},
    "live_sensor_timeseries_1min": {"not_null": "city_minute_key city_id minute_utc sensor_event_count", "unique": "city_minute_key", "ranges": {"sensor_event_count": (1, None)}},
}


def tests_of(model: str) -> Iterator[tuple[str, str]]:
    """Each test's kind and column."""
    for kind, columns in MODELS[model].items():
        for c in columns.split() if isinstance(columns, str) else columns:
            yield kind, c


def run(frames: dict[str, DataFrame]) -> DataFrame:
    """model, test, column and n_failed of every test of the models in ``frames``; tests of a row share one pass over their model."""
    out = None
    for model, df in frames.items():
        spec, counts = MODELS[model], {}
        for kind, c in tests_of(model):
            if kind == "not_null":
                counts[kind, c] = F.count_if(F.col(c).isNull())
            elif kind == "values":
                counts[kind, c] = F.count_if(~F.col(c).isin(*spec[kind][c]))
            elif kind == "ranges":
                low, high = spec[kind][c]
                bad = F.lit(False) if low is None else F.col(c) < low
                counts[kind, c] = F.count_if(bad if high is None else bad | (F.col(c) > high))
        row = df.agg(*[x.alias(f"{k} {c}") for (k, c), x in counts.items()])
        rows = row.select(F.explode(F.array(*[F.struct(F.lit(k).alias("test"), F.lit(c).alias("column"), F.col(f"{k} {c}").alias("n_failed")) for k, c in counts])).alias("t")).select("t.*")
        found = [rows]
        for kind, c in tests_of(model):
            if kind == "unique":
                bad = q.duplicate_keys(df.where(F.col(c).isNotNull()), [c])
            elif kind == "references":
                other, key = spec[kind][c]
                if other not in frames:
                    continue
                bad = q.orphans(df.select(F.col(c).alias("k_")), frames[other], "k_", key)
            else:
                continue
            found.append(bad.agg(F.count(F.lit(1)).alias("n_failed")).select(F.lit(kind).alias("test"), F.lit(c).alias("column"), "n_failed"))
        for f in found:
            f = f.select(F.lit(model).alias("model"), "test", "column", "n_failed")
            out = f if out is None else out.unionAll(f)
    return out
