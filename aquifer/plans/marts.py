"""The materialized marts: tables in parts that know what they were built from.

A part of a table (a day of it) notes the inputs it was built from: of a source the
names, sizes and times of its files, of another table the parts it read.  ``refresh``
compares them with what is there now, which needs file listings and pointers but no
job, and builds anew only parts with changed inputs, reading only the parts those need.
A new version points to the new parts and to the old ones that stay, so readers see all
of it or none.

Checks of a model are counted in the pass that writes its rows; if one finds
something, no version is added.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import last_values, sinks
from ..operators import quality as q
from ..sources import AIR_METRICS, WEATHER_METRICS
from . import models, tables

TABLES = ("air_quality_hourly", "weather_hourly", "sensor_hourly", "gold_hourly", "gold_daily", "gold_alerts", "gold_correlation")

Frames = dict[str, DataFrame]


class Source(NamedTuple):
    """Files below a path, in folders such as day=2024-01-01 (each a part) or in none (one part)."""

    path: str
    read: Callable[[DataFrame], DataFrame] = lambda df: df


def one(part: str) -> list[str]:
    return [part]


def days_around(part: str) -> list[str]:
    """A day and its neighbours: a local day's hours lie in these days of UTC, and the other way round."""
    if not part:
        return [part]
    day = dt.date.fromisoformat(part)
    return [str(day + dt.timedelta(days=k)) for k in (-1, 0, 1)]


class Model(NamedTuple):
    """``make`` gives rows from the frames named in ``reads``; ``part`` is the part of a row, None for a table of one part, which reads all parts."""

    name: str
    reads: tuple[str, ...]
    make: Callable[[Frames], DataFrame]
    part: str | None = None
    near: Callable[[str], list[str]] = one
    checks: dict[str, Column] | None = None
    #: A rebuilt table with the same rows counts as unchanged.
    settles: bool = False
    #: What the rows of a file are sorted by.
    cluster: tuple[str, ...] = ()


def _digest(x: object) -> str:
    return hashlib.sha256(json.dumps(x, sort_keys=True).encode()).hexdigest()[:32]


def _sources(spark: SparkSession, sources: dict[str, Source]) -> dict[str, dict[str, tuple[str, list]]]:
    """The parts of each source: folder and files."""
    return {n: {k.rpartition("=")[2]: (k, files) for k, files in sinks.listed(spark, s.path).items()} for n, s in sources.items()}


def refresh(spark: SparkSession, base: str, sources: dict[str, Source], steps: list[list[Model]]) -> dict[str, list[str]]:
    """Bring the tables below ``base`` up to date; the parts built of each.  Models of a step are built at the same time."""
    there = _sources(spark, sources)
    known: dict[str, dict[str, str]] = {n: {k: _digest(files) for k, (_, files) in parts.items()} for n, parts in there.items()}

    def read(name: str, parts: Iterable[str]) -> DataFrame:
        if name not in sources:
            return sinks.published(spark, f"{base}/{name}", parts)
        s = sources[name]
        folders = sorted({f"{s.path}/{there[name][k][0]}".rstrip("/") for k in parts})
        return s.read(spark.read.option("basePath", s.path).parquet(*folders) if folders != [s.path] else spark.read.parquet(s.path))

    def build(m: Model) -> list[str]:
        path = f"{base}/{m.name}"
        pointer = sinks.pointed(spark, path) or {"parts": {}}
        old = pointer["parts"]
        whole = m.part is None or all(set(known[r]) <= {""} for r in m.reads)
        own = [""] if whole else sorted({k for r in m.reads for p in known[r] if p for k in m.near(p)})
        inputs = {}
        for k in own:
            near = None if whole else set(m.near(k))
            inputs[k] = {r: {p: d for p, d in known[r].items() if near is None or not p or p in near} for r in m.reads}
        changed = [k for k in own if k not in old or old[k]["inputs"] != inputs[k]]
        parts = {k: old[k] for k in own if k not in changed}
        if changed:
            make = lambda keys: m.make({r: read(r, sorted({p for k in keys for p in inputs[k][r]})) for r in m.reads})
            df = make(changed)
            if old and df.schema.simpleString() != T.StructType.fromJson(pointer["schema"]).simpleString():
                changed, parts, df = own, {}, make(own)  # the columns are others than those of the parts that would stay
            schema = df.schema.jsonValue()
            by = None if whole else F.expr(m.part).cast("string")
            if by is not None:
                df = df.where(by.isin(changed))
            seen = None
            if m.checks:
                seen = Observation(f"{m.name}-{_digest(inputs)}")
                df = df.observe(seen, *[c.alias(n) for n, c in m.checks.items()])
            folders = sinks.write_parts(df, path, by, m.cluster)
            # of a result without rows the optimizer may leave no plan that counts
            filled = seen is not None and (bool(folders) if by is not None else not spark.read.schema(df.schema).parquet(f"{path}/versions/{folders['']}").isEmpty())
            if filled and (bad := {n: v for n, v in seen.get.items() if v}):
                raise q.GateError(f"{m.name}: " + ", ".join(f"{n}={v}" for n, v in bad.items()))
            files = {k: {r: there[r][p][1] for r in m.reads if r in sources for p in inputs[k][r]} for k in changed}
            for k in changed:
                parts[k] = {"folder": folders.get(k), "inputs": inputs[k], "files": files[k], "content": folders.get(k)}
            if m.settles:
                rows = spark.read.schema(T.StructType.fromJson(schema)).parquet(f"{path}/versions/{folders['']}")
                n, total = rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))).first()
                parts[""]["content"] = f"{n}:{total}"
            pointer = {"schema": schema}
        if changed or set(parts) != set(old):
            sinks.point(spark, path, {"schema": pointer["schema"], "parts": parts})
        known[m.name] = {k: p["content"] or "none" for k, p in parts.items()}
        return changed

    out: dict[str, list[str]] = {}
    for step in steps:
        with ThreadPoolExecutor(len(step)) as pool:
            out |= dict(zip([m.name for m in step], pool.map(build, step), strict=True))
    return out


def _checks(ranges: dict[str, tuple]) -> dict[str, Column]:
    c = F.col
    key = c("city_id").isNull() | c("measured_at_utc").isNull() | c("source_system").isNull() | c("dataset_name").isNull()
    return {"null_keys": F.count_if(key), "future_rows": F.count_if(c("measured_at_utc") >= F.date_trunc("hour", "crawled_at_utc")), **{f"bad_{k}": tables.outside(k, *v) for k, v in ranges.items()}}


def steps(air: Callable[[DataFrame], DataFrame], weather: Callable[[DataFrame], DataFrame], readings: Callable[[DataFrame], DataFrame], source: str = "events") -> list[list[Model]]:
    """The models from one source to the marts; the functions take its rows to bronze-shaped and clean rows."""
    sides = {"air_quality": (air, AIR_METRICS, {p: (0, None) for p in (*tables.POLLUTANTS, "us_aqi")}), "weather": (weather, WEATHER_METRICS, tables.WEATHER_RANGES)}
    day, seen, ids, silver = "measurement_date_utc", [], [], []
    for side, (rows, metrics, ranges) in sides.items():
        seen.append(Model(f"{side}_cities", (source,), lambda f, rows=rows: last_values(tables.observed(rows(f[source])), "city_id", tables.CITY, *tables.LATER, by=[day]), day))
        ids.append(Model(f"{side}_city_ids", (f"{side}_cities",), lambda f, n=f"{side}_cities": f[n].groupBy(*tables.CITY).agg(F.max("latest").alias("latest")).select(*tables.CITY, "latest.value"), settles=True))
        silver.append(Model(f"{side}_hourly", (source, f"{side}_city_ids"), lambda f, rows=rows, metrics=metrics, n=f"{side}_city_ids": tables.staged(tables.silver(rows(f[source]), metrics, f[n]), metrics), day, checks=_checks(ranges)))
    sensors = Model("sensor_hourly", (source,), lambda f: models.sensor_hourly(readings(f[source])), "to_date(measured_at_utc)")
    hourly = Model("gold_hourly", ("air_quality_hourly", "weather_hourly", "sensor_hourly"), lambda f: models.gold_hourly(_enriched(f)), day, cluster=("country_code", "city_name", "measured_at_utc"))
    daily = Model("gold_daily", ("gold_hourly",), lambda f: models.gold_daily(f["gold_hourly"]), "measurement_date_local", days_around, cluster=("country_code", "city_name"))
    alerts = Model("gold_alerts", ("gold_hourly",), lambda f: models.gold_alerts(f["gold_hourly"]), day)
    correlation = Model("gold_correlation", ("gold_hourly",), lambda f: models.gold_correlation(f["gold_hourly"]))
    return [[*seen, sensors], ids, silver, [hourly], [daily, alerts, correlation]]


def _enriched(f: Frames) -> DataFrame:
    return models.city_hourly(models.classified(models.joined(f["air_quality_hourly"], f["weather_hourly"])), f["sensor_hourly"])


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return sinks.published(spark, f"{base}/{name}")


def days(spark: SparkSession, base: str, name: str, first: str, last: str) -> DataFrame:
    """The rows of a table that can have local dates from ``first`` to ``last``: only parts of those days, and of their neighbours where parts are days of UTC, are read."""
    parts = (sinks.pointed(spark, f"{base}/{name}") or {"parts": {}})["parts"]
    low, high = days_around(first)[0], days_around(last)[-1]
    return sinks.published(spark, f"{base}/{name}", [k for k in parts if not k or low <= k <= high])


def classified(spark: SparkSession, base: str) -> DataFrame:
    """The joined and classified hours: a view over the published silver tables."""
    return models.classified(models.joined(table(spark, base, "air_quality_hourly"), table(spark, base, "weather_hourly")))


def enriched(spark: SparkSession, base: str) -> DataFrame:
    """The hours with their sensors: a view, too."""
    return models.city_hourly(classified(spark, base), table(spark, base, "sensor_hourly"))


#: What the hourly tables are joined by.
HOUR = ["city_id", "measured_at_utc"]


def bucketed(spark: SparkSession, base: str, name: str, buckets: int) -> DataFrame:
    """The version of a table that counts, dealt into buckets by city and hour and sorted in them: made once a version, for joins that come again."""
    number = sinks.versions(spark, f"{base}/{name}")[-1]
    copy = f"aquifer_{_digest(base)[:16]}_{name}_{number}_{buckets}"
    if not spark.catalog.tableExists(copy):
        rows = table(spark, base, name).repartition(buckets, *HOUR)  # the tasks are the buckets
        rows.write.mode("overwrite").bucketBy(buckets, *HOUR).sortBy(*HOUR).option("path", f"{base}/{name}/buckets/{number}-{buckets}").saveAsTable(copy)
    return spark.table(copy)


def enriched_in_buckets(spark: SparkSession, base: str, buckets: int = 200) -> DataFrame:
    """:func:`enriched` over bucketed copies: buckets meet where they lie, so the joins move no row."""
    air, weather, sensors = (bucketed(spark, base, n, buckets) for n in ("air_quality_hourly", "weather_hourly", "sensor_hourly"))
    return models.city_hourly(models.classified(models.joined(air, weather)), sensors)


def register(spark: SparkSession, base: str, prefix: str = "") -> list[str]:
    """Make the published tables, and the views between them, readable by SQL; gives their names."""
    frames = {name: table(spark, base, name) for name in TABLES} | {"int_classified": classified(spark, base), "int_city_hourly": enriched(spark, base)}
    for name, df in frames.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in frames]
