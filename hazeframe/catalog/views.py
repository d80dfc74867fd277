"""Feeds derived from the given tables, with gaps, copies and bad cells planted by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAYLOAD_ROWS = 500


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    return shape_events(table(spark, sf, "events"))


def shape_events(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "event_id as ord", "ts", "user_id div 6 as station", "user_id % 6 as sensor", "event_type",
        "value", "cast(get_json_object(props, '$.k') as int) as k")


def air_wide(spark: SparkSession, sf: str) -> DataFrame:
    return shape_air(events(spark, sf))


def shape_air(ev: DataFrame) -> DataFrame:
    return ev.where("event_type in ('view', 'click', 'signup')").selectExpr(
        "ord", "ts", "station",
        "case when ord % 11 = 0 then null when ord % 13 = 0 then -value else value end as pm25",
        "value * 1.5D as pm10",
        "cast((ord * 37) % 2000 as double) / 10D as no2",
        "cast((ord * 53) % 1800 as double) / 10D as o3",
        "cast((ord * 71) % 6000 as double) / 10D as so2",
        "cast(k as double) / 25D as co", "value * 0.3D as nh3")


def air_long(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).selectExpr(
        "ord", "ts", "station",
        "element_at(array('pm25', 'pm10', 'no2', 'o3', 'so2', 'co'), cast(sensor as int) + 1) as pollutant",
        "case when sensor = 5 then value / 10D else value end as conc")


def wx(spark: SparkSession, sf: str) -> DataFrame:
    return shape_wx(events(spark, sf))


def shape_wx(ev: DataFrame) -> DataFrame:
    return ev.where("event_type = 'purchase'").selectExpr(
        "ord", "ts", "station", "value / 10D - 5D as temperature", "cast(k as double) as humidity",
        "value / 50D as windspeed", "case when k % 10 = 0 then value / 20D else 0D end as precipitation",
        "value * 40D as visibility")


def traffic(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).where("event_type = 'error'").selectExpr(
        "ord", "ts", "station", "cast(k as bigint) as currentSpeed", "k + ord % 30 as freeFlowSpeed",
        "value * 2D as vehicle_count", "1D - k / 1000D as confidence", "ord % 50 = 0 as roadClosure")


def traffic_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Traffic with missing and negative cells and repeated rows."""
    rows = traffic(spark, sf).selectExpr(
        "ord", "ts as timestamp", "station",
        "case when ord % 6 = 0 then null when ord % 17 = 0 then -currentSpeed else currentSpeed end as currentSpeed",
        "freeFlowSpeed", "case when ord % 4 = 0 then null else vehicle_count end as vehicle_count",
        "confidence", "roadClosure")
    return rows.unionByName(rows.where("ord % 7 = 0"))


def wx_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Weather with missing cells and repeated rows."""
    rows = wx(spark, sf).selectExpr(
        "ord", "ts as timestamp", "station", "temperature as Temp_C",
        "case when ord % 5 = 0 then null else humidity end as `Rel Humidity`",
        "case when ord % 3 = 0 then null else windspeed end as wind_spd", "precipitation as rain_mm",
        "case when ord % 9 = 0 then -visibility else visibility end as visibility")
    return rows.unionByName(rows.where("ord % 7 = 0"))


DIRTY = """case ord % 12 when 0 then 'NA' when 1 then '' when 2 then 'NULL'
 when 3 then concat(' 1,', lpad(cast(k as string), 3, '0'), '.5 ') when 4 then 'abc'
 when 5 then cast(-value as string) when 6 then '1d' when 7 then '1_0' else cast(value as string) end"""
DIRTY_TS = """case ord % 10 when 0 then 'not a time'
 when 1 then concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), '+00:00')
 when 2 then date_format(ts, 'yyyy-MM-dd') else date_format(ts, 'yyyy-MM-dd HH:mm:ss') end"""


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).selectExpr("ord", "station", f"{DIRTY} as raw")


def dirty_ts(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).selectExpr("ord", "station", f"{DIRTY_TS} as raw_ts")


def dups(spark: SparkSession, sf: str) -> DataFrame:
    """Air rows, copies of some, and later corrections of others in batch 1."""
    air = air_wide(spark, sf).selectExpr("0 as batch", "ord", "ts", "station", "pm25", "pm10")
    copies = air.where("ord % 7 = 0")
    later = air.where("ord % 5 = 0").selectExpr("1 as batch", "ord", "ts", "station", "pm25 + 1D as pm25", "pm10 + 1D as pm10")
    return air.unionByName(copies).unionByName(later)


def null_rows(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["temperature", "humidity", "windspeed"]
    return wx(spark, sf).select(
        "ord", "ts", "station", *[F.when(F.col("ord") % 9 != 0, F.col(c)).alias(c) for c in cols],
        F.lit(None).cast("double").alias("pressure"))


def bounded_payloads(rows: DataFrame, items) -> DataFrame:
    """Landed JSON texts: at most PAYLOAD_ROWS consecutive readings of one station each."""
    part = F.expr(f"ord div {PAYLOAD_ROWS}").alias("part")
    packed = rows.groupBy("station", part).agg(F.sort_array(F.collect_list(F.struct("ord", items.alias("e")))).alias("l"))
    return packed.select("station", "part", F.transform("l", lambda x: x["e"]).alias("items"))


def pollution_payloads(spark: SparkSession, sf: str) -> DataFrame:
    air = air_wide(spark, sf)
    item = F.struct(
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("dt"),
        F.struct("co", F.lit(None).cast("double").alias("no"), "no2", "o3", "so2",
                 F.col("pm25").alias("pm2_5"), "pm10", "nh3").alias("components"))
    return bounded_payloads(air, item).select("station", "part", F.to_json(F.struct(F.col("items").alias("list"))).alias("body"))


def archive_payloads(spark: SparkSession, sf: str) -> DataFrame:
    w = wx(spark, sf)
    item = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"), "temperature", "humidity", "windspeed", "visibility")
    p = bounded_payloads(w, item)

    def pick(name):
        return F.transform("items", lambda x: x[name])

    hourly = F.struct(pick("time").alias("time"), pick("temperature").alias("temperature_2m"),
                      pick("humidity").alias("relative_humidity_2m"), pick("windspeed").alias("windspeed_10m"),
                      pick("visibility").alias("visibility"))
    return p.select("station", "part", F.to_json(F.struct(hourly.alias("hourly"))).alias("body"))


def hourly_payloads(spark: SparkSession, sf: str) -> DataFrame:
    rows = events(spark, sf)
    item = F.struct(F.unix_seconds(F.col("ts").cast("timestamp")).alias("dt"), F.col("value").alias("temp"),
                    F.col("k").cast("double").alias("humidity"))
    return bounded_payloads(rows, item).select("station", "part", F.to_json(F.struct(F.col("items").alias("hourly"))).alias("body"))


def current_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """One current-weather answer per event; some miss the wind part."""
    e = events(spark, sf)
    wind = F.when(F.col("ord") % 4 != 0, F.struct((F.col("value") / 50).alias("speed")))
    body = F.to_json(F.struct(
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("dt"),
        F.struct(F.col("value").alias("temp"), F.col("k").cast("double").alias("humidity")).alias("main"), wind.alias("wind")))
    return e.select("ord", "station", body.alias("body"))


def hourly_station(spark: SparkSession, sf: str) -> DataFrame:
    """pm25 averaged per station and hour on the full hourly grid."""
    from hazeframe.operators.grid import resample_hourly
    return resample_hourly(air_wide(spark, sf).select("station", "ts", "pm25"), ["station"], "ts", ["pm25"])


LIVE_AIR = {"Station Name": "case when ord % 17 = 0 then null else concat('S-', station) end",
            "Time-Stamp": DIRTY_TS, "PM25 Raw": DIRTY, "NO2": "cast((ord * 37) % 2000 as double) / 10D"}


def live_air(spark: SparkSession, sf: str) -> DataFrame:
    """Raw live air feed with text cells, loose names and repeated rows."""
    e = events(spark, sf).where("event_type in ('view', 'click', 'signup')")
    rows = e.selectExpr("ord as `Ord`", *[f"{x} as `{n}`" for n, x in LIVE_AIR.items()])
    return rows.unionByName(rows.where("Ord % 7 = 0"))


def live_weather(spark: SparkSession, sf: str) -> DataFrame:
    rows = wx(spark, sf).selectExpr(
        "ord as `Ord`", "station as `Station`", "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') as `Time-Stamp`",
        "case when ord % 3 = 0 then null when ord % 5 = 0 then 'abc' else cast(temperature as string) end as `Temp C`",
        "case when ord % 4 = 0 then null else windspeed end as `Wind-Speed`",
        "case when ord % 13 = 0 then null else concat('S-', station) end as `Label`")
    return rows.unionByName(rows.where("Ord % 7 = 0"))


def live_traffic(spark: SparkSession, sf: str) -> DataFrame:
    rows = traffic(spark, sf).selectExpr(
        "ord as `Ord`", "station as `Station`", "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') as `Timestamp`",
        "case when ord % 3 = 0 then null else cast(vehicle_count as string) end as `Vehicle Count`",
        "case when ord % 4 = 0 then null else cast(currentSpeed as double) end as `Speed`",
        "case when ord % 13 = 0 then null else concat('S-', station) end as `Label`")
    return rows.unionByName(rows.where("Ord % 7 = 0"))
