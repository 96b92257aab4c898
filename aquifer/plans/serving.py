"""Dashboard aggregates over the hourly mart, and reference dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import slug


def filtered(df: DataFrame, country: str | None = None, city: str | None = None, first: str | None = None, last: str | None = None, day: str = "measurement_date_local") -> DataFrame:
    """Rows of a country, a city and days, both ends included; None leaves a filter out."""
    if country is not None:
        df = df.where(F.col("country_code") == country)
    if city is not None:
        df = df.where(F.col("city_name") == city)
    if first is not None and last is not None:
        df = df.where(F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return df


def latest_snapshot(df: DataFrame, time: str = "measured_at_utc") -> DataFrame:
    """Rows at the latest instant of the table."""
    return df.where(F.col(time) == df.agg(F.max(time).alias("t")).scalar())


#: Columns whose means the dashboard's cards show: fixed values.
KPIS = ["us_aqi", "pm2_5", "pm10", "temperature_2m", "relative_humidity_2m", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide", "ozone", "precipitation", "surface_pressure", "cloud_cover", "wind_speed_10m", "visibility"]


def snapshot_kpis(df: DataFrame, time: str = "measured_at_utc") -> DataFrame:
    """One row: the latest instant, its cities, rows and alerts, and the means of its values."""
    rows = latest_snapshot(df, time)
    return rows.agg(F.max(time).alias("snapshot_at"), F.countDistinct("city_name").alias("n_cities"), F.count(F.lit(1)).alias("n_rows"), F.count_if("is_air_quality_alert").alias("n_alerts"), *[F.avg(c).alias(f"avg_{c}") for c in KPIS])


def reference_cities(cities: DataFrame, countries: DataFrame) -> DataFrame:
    """Cities with their countries, by country code and name; ``countries`` has a row a country."""
    return cities.join(countries, "country_id").orderBy("country_code", "city_name")


def means_by(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    return df.groupBy(by).agg(*[F.avg(c).alias(f"avg_{c}") for c in columns])


def ranking(df: DataFrame, by: str, column: str) -> DataFrame:
    """Means of each ``by``, lowest first."""
    return means_by(df, by, [column]).orderBy(F.col(f"avg_{column}"), by)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows of each value, null as ``unknown``, most first."""
    return df.groupBy(F.coalesce(column, F.lit("unknown")).alias(column)).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), column)


def detail(df: DataFrame, order: list, n: int = 500) -> DataFrame:
    """The first ``n`` rows in the order."""
    return df.orderBy(*order).limit(n)


#: Band, lower and upper bound (ug/m3) of fine particulates, 24 h: fixed values.
PM25_BANDS = [("Good", 0.0, 9.0), ("Moderate", 9.1, 35.4), ("Unhealthy for Sensitive Groups", 35.5, 55.4), ("Unhealthy", 55.5, 125.4), ("Very Unhealthy", 125.5, 225.4), ("Hazardous", 225.5, 500.4)]


def stations(cities: DataFrame, countries: DataFrame, provider: DataFrame) -> DataFrame:
    """One station a city for the only provider: a join by key, and a product with one row."""
    rows = cities.join(F.broadcast(countries), "country_id").crossJoin(F.broadcast(provider.limit(1)))
    return rows.select("city_id", "provider_id", F.concat("city_name", F.lit(" Station")).alias("station_name"), F.concat(F.lower("country_code"), F.lit("_"), slug("city_name")).alias("source_station_id"), "latitude", "longitude", F.lit(True).alias("is_active"))
