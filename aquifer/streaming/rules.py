"""The stream's operators as expressions and batch queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import blank, iso_instant
from ..sources import EVENT

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType()}
# built by hand: a DDL string is read by a session, and there may be none yet
EVENT_SCHEMA = T.StructType([T.StructField(n, _TYPES[k]) for n, k in (x.split() for x in (EVENT + ", _corrupt string").split(", "))])
FIELDS = [f.name for f in EVENT_SCHEMA.fields[:-1]]
#: Why an event is routed as late: a fixed value.
LATE = "TOO_LATE_FOR_5MIN_WINDOW"


def parsed(raw: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """Adds ``event`` (the typed record) from the payload; unknown fields are ignored."""
    event = F.from_json(payload, EVENT_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    # a generator of one row: filters on the event can't be pushed below it, where each field would parse the payload again
    return raw.select("*", F.explode(F.array(event)).alias("event"))


#: The reasons below are part of the contract: fixed values.
def error_reason(event: str = "event", payload: str = "raw_payload") -> Column:
    """Why a record goes to the dead letters, the first rule that fails; null if it is valid."""
    e = F.col(event)
    broken = F.col(payload).isNull() | e["_corrupt"].isNotNull()
    rules = {
        "event is null": F.trim(payload) == "null",
        "missing event_id": blank(e["event_id"]),
        "missing schema_version": blank(e["schema_version"]),
        "missing city_id": e["city_id"].isNull(),
        "missing event_time_utc": blank(e["event_time_utc"]),
        "invalid event_time_utc": iso_instant(e["event_time_utc"]).isNull(),
        "temperature_2m out of range": ~F.coalesce(e["temperature_2m"].between(-100, 100), F.lit(True)),
    }
    return F.coalesce(
        F.when(F.col(payload).isNull(), "INVALID_JSON: no payload"),
        F.when(F.trim(payload) == "null", "VALIDATION_ERROR: event is null"),
        F.when(broken, "INVALID_JSON: not a record of the contract"),
        *[F.when(c, f"VALIDATION_ERROR: {n}") for n, c in rules.items()],
    )


#: Inclusive ranges and fixed texts of the strict contract: fixed values.
CONTRACT_RANGES = {"city_id": (1, 12), "temperature_2m": (-80, 70), "relative_humidity_2m": (0, 100), "pm2_5": (0, 2000), "pm10": (0, 3000), "carbon_monoxide": (0, 100000), "nitrogen_dioxide": (0, 2000)}
CONTRACT_TEXTS = {"schema_version": "1.0", "event_type": "environment.sensor_reading", "source_system": "iot_simulator", "dataset_name": "sensor_readings"}


def contract_violations(event: str = "event") -> Column:
    """Names of the strict contract's rules that a record breaks (the producer's gate)."""
    e = F.col(event)
    bad: dict[str, Column] = {f: e[f].isNull() for f in FIELDS}
    bad |= {f"{f} const": e[f] != v for f, v in CONTRACT_TEXTS.items()}
    bad |= {f"{f} range": ~e[f].between(*r) for f, r in CONTRACT_RANGES.items()}
    bad["event_id uuid"] = ~e["event_id"].rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")
    bad["device_id length"] = ~F.length(e["device_id"]).between(1, 100)
    bad["city_name length"] = ~F.length(e["city_name"]).between(1, 100)
    bad["country_code pattern"] = ~e["country_code"].rlike("^[A-Z]{2}$")
    bad["sequence_number minimum"] = e["sequence_number"] < 0
    bad["event after production"] = iso_instant(e["event_time_utc"]) > iso_instant(e["produced_at_utc"])
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in bad.items()]))


def city_mismatch(events: DataFrame, cities: DataFrame) -> DataFrame:
    """Events whose city name or country isn't the canonical one of their city id; ``cities`` has twelve rows."""
    c = F.broadcast(cities.select("city_id", F.col("city_name").alias("_n"), F.col("country_code").alias("_c")))
    return events.join(c, "city_id", "left").where("_n IS NULL OR _n <> city_name OR _c <> country_code").drop("_n", "_c")


def dead_letter(raw: DataFrame, now: Column | None = None) -> Column:
    """The message for a record that fails, as valid JSON."""
    at = F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return F.to_json(F.struct(at.alias("failedAtUtc"), F.col("error_reason").alias("errorReason"), F.col("raw_payload").alias("rawEvent"), F.col("kafka_topic").alias("sourceTopic")))


def late_message(now: Column | None = None) -> Column:
    """The message for a late event: nulls stand explicitly."""
    at = F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias(c)
    record = F.struct(*[iso(f) if f in ("event_time_utc", "produced_at_utc") else F.col(f) for f in FIELDS])
    return F.to_json(F.struct(F.lit(LATE).alias("late_reason"), at.alias("routed_at_utc"), record.alias("sensor_reading")), {"ignoreNullFields": "false"})


def first_seen(df: DataFrame, key: str, arrival: list[str]) -> DataFrame:
    """The first arrival of each key."""
    w = Window.partitionBy(key).orderBy(*arrival)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def window_start(time: str, minutes: int = 5) -> Column:
    return F.window(F.col(time), f"{minutes} minutes")["start"]


def is_late(time: str, seen: Column, minutes: int = 5, delay: int = 10) -> Column:
    """Whether the window of an event was closed by the latest event time ``seen`` before it."""
    end = F.window(F.col(time), f"{minutes} minutes")["end"]
    return F.coalesce(seen >= end + F.expr(f"INTERVAL {delay} SECONDS"), F.lit(False))


def route_late(df: DataFrame, time: str, arrival: str | list[str], minutes: int = 5, delay: int = 10, span: int = 1 << 16, before: Column | None = None) -> DataFrame:
    """Adds ``is_late``: judged by the running maximum of event times before each arrival.

    The order of arrivals, given by one or more columns, is global.  So that no task
    gets all rows, arrivals are cut into stretches of ``span`` numbers (microseconds, if
    the first column is a time): stretch maxima and their running maximum (one row a
    stretch) carry over, and only a stretch is ordered in a task.  ``before`` is the
    maximum carried in from earlier batches.  The rows are read twice.
    """
    order = [arrival] if isinstance(arrival, str) else arrival
    place = F.unix_micros(order[0]) if df.schema[order[0]].dataType == T.TimestampType() else F.col(order[0])
    df = df.withColumn("_s", F.coalesce(F.floor(place / span), F.lit(-(1 << 62))))  # no place: before all others, as in the order
    tops = df.groupBy("_s").agg(F.max(time).alias("_m"))
    carried = F.max("_m").over(Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1))
    tops = tops.select("_s", carried.alias("_before"))
    own = F.max(time).over(Window.partitionBy("_s").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumn("_own", own).join(tops, "_s")
    seen = F.greatest("_own", "_before", *([before] if before is not None else []))
    return df.withColumn("is_late", is_late(time, seen, minutes, delay)).drop("_s", "_own", "_before")


def tumbling(df: DataFrame, time: str = "event_time_utc", arrival: Column | None = None) -> DataFrame:
    """Five-minute windows of each city; names are those of the last arrival."""
    w = F.window(F.col(time), "5 minutes")
    last = (lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), arrival))) if arrival is not None else F.max
    rows = df.groupBy(w.alias("w"), "city_id").agg(
        last("city_name").alias("city_name"), last("country_code").alias("country_code"), F.count("city_id").alias("reading_count"), F.avg("temperature_2m").alias("avg_temperature_2m"), F.avg("relative_humidity_2m").alias("avg_relative_humidity_2m"),
        *[getattr(F, k)(c).alias(f"{k}_{c}") for c in ("pm2_5", "pm10") for k in ("avg", "min", "max")], F.avg("carbon_monoxide").alias("avg_carbon_monoxide"), F.avg("nitrogen_dioxide").alias("avg_nitrogen_dioxide"),
    )
    return rows.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *[c for c in rows.columns if c != "w"])
