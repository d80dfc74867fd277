"""JSON payloads as landed text, unpacked to rows with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed payload shapes.
POLLUTION = """list array<struct<dt: bigint, components: struct<co: double, no: double, no2: double,
 o3: double, so2: double, pm2_5: double, pm10: double, nh3: double>>>"""
ARCHIVE = """hourly struct<time: array<string>, temperature_2m: array<double>,
 relative_humidity_2m: array<double>, pressure_msl: array<double>, windspeed_10m: array<double>,
 winddirection_10m: array<double>, cloudcover: array<double>, visibility: array<double>>"""
HOURLY = """hourly array<struct<dt: bigint, temp: double, humidity: double, pressure: double,
 wind_speed: double, wind_deg: double, clouds: double>>"""
WEATHER = """dt bigint, main struct<temp: double, humidity: double, pressure: double>,
 wind struct<speed: double, deg: double>, clouds struct<all: double>, visibility double"""
STATION = """status string, data struct<aqi: double, city: struct<name: string>,
 iaqi: map<string, struct<v: double>>>"""
TRAFFIC = """flowSegmentData struct<currentSpeed: bigint, freeFlowSpeed: bigint,
 currentTravelTime: bigint, freeFlowTravelTime: bigint, confidence: double, roadClosure: boolean>"""


def epoch(c: Column) -> Column:
    """Unix seconds to a zone-free UTC timestamp."""
    return F.timestamp_seconds(c).cast("timestamp_ntz")


def pollution_history(df: DataFrame, keys: list[str], body: str = "body", newest_only: bool = False) -> DataFrame:
    """One row per list element; ``newest_only`` takes the first element of each payload."""
    # Explode drops empty and missing lists by itself.
    items = F.from_json(body, POLLUTION)["list"]
    rows = df.select(*keys, F.explode(F.slice(items, 1, 1) if newest_only else items).alias("e"))
    return rows.select(*keys, epoch(F.col("e.dt")).alias("ts"), "e.components.*")


def archive_rows(df: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """Parallel arrays to one row per position."""
    h = F.from_json(body, ARCHIVE)["hourly"]
    names = ("time", "temperature_2m", "relative_humidity_2m", "pressure_msl", "windspeed_10m",
             "winddirection_10m", "cloudcover", "visibility")
    # A missing array would make the whole zip null; an empty one is padded with nulls.
    arrays = [F.coalesce(F.col(f"h.{n}"), F.array().cast("array<string>" if n == "time" else "array<double>")).alias(n)
              for n in names]
    parsed = df.select(*keys, h.alias("h")).select(*keys, *arrays)
    zipped = parsed.select(*keys, F.explode(F.arrays_zip(*names)).alias("e"))
    out = ("time", "temperature", "humidity", "pressure", "windspeed", "winddirection", "cloudiness", "visibility")
    return zipped.select(*keys, *[F.col(f"e.{n}").alias(o) for n, o in zip(names, out)])


def hourly_forecast(df: DataFrame, keys: list[str], body: str = "body", hours: int = 48) -> DataFrame:
    """The first ``hours`` entries with ISO times in UTC."""
    h = F.from_json(body, HOURLY)["hourly"]
    rows = df.select(*keys, F.posexplode(F.slice(h, 1, hours)).alias("step", "e"))
    iso = F.concat(F.date_format(epoch(F.col("e.dt")), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    return rows.select(
        *keys, "step", iso.alias("timestamp"), F.col("e.temp").alias("temperature"),
        F.col("e.humidity").alias("humidity"), F.col("e.pressure").alias("pressure"),
        F.col("e.wind_speed").alias("wind_speed"), F.col("e.wind_deg").alias("wind_direction"),
        F.col("e.clouds").alias("cloudiness"))


def current_weather(df: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """One flat row per payload; a missing path is null."""
    p = df.select(*keys, F.from_json(body, WEATHER).alias("p"))
    return p.select(
        *keys, epoch(F.col("p.dt")).alias("ts"), F.col("p.main.temp").alias("temperature"),
        F.col("p.main.humidity").alias("humidity"), F.col("p.main.pressure").alias("pressure"),
        F.col("p.wind.speed").alias("wind_speed"), F.col("p.wind.deg").alias("wind_direction"),
        F.col("p.clouds.all").alias("cloudiness"), F.col("p.visibility").alias("visibility"))


def station_feed(df: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """Index and pollutant values of answers whose status is ok."""
    p = df.where(F.get_json_object(body, "$.status") == "ok").select(*keys, F.from_json(body, STATION).alias("p"))
    species = ("pm25", "pm10", "no2", "o3", "so2", "co")
    return p.select(
        *keys, F.col("p.data.aqi").alias("aqi"), F.col("p.data.city.name").alias("city"),
        *[F.col("p.data.iaqi")[s]["v"].alias(s) for s in species])


def traffic_flow(df: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    p = df.select(*keys, F.from_json(body, TRAFFIC).alias("p"))
    return p.where("p.flowSegmentData is not null").select(*keys, "p.flowSegmentData.*")
