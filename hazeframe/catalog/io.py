"""Source, sink, payload and upsert queries."""

from pyspark.sql import functions as F

from hazeframe.catalog import views as V
from hazeframe.catalog.cleaning import LENIENT_TS, lenient
from hazeframe.catalog.registry import query, sql
from hazeframe.operators import columns as K
from hazeframe.operators import upsert as U
from hazeframe.plans.feeds import parse_time
from hazeframe.session import scratch_path
from hazeframe.sources import files, live, payloads


@query("scan_csv_typed", sql("dirty dirty_ts ev", f"SELECT ord, {lenient('raw')} AS reading, {LENIENT_TS} AS at, ev.k = 7 AS flag, 'é ' || ev.event_type AS label FROM ev JOIN dirty USING (ord) JOIN dirty_ts USING (ord)"))
def scan_csv_typed(spark, sf):
    path = scratch_path(spark, "csv")
    rows = V.events(spark, sf).selectExpr("ord", f"{V.DIRTY} as reading", f"{V.DIRTY_TS} as at", "cast(k = 7 as string) as flag", "concat('é ', event_type) as label")
    rows.write.option("header", True).option("encoding", "ISO-8859-1").option("emptyValue", "").csv(path)
    text = files.read_text_table(spark, path, ["ord", "reading", "at", "flag", "label"], "ISO-8859-1")
    return files.typed(text, {"ord": "bigint", "reading": "double", "at": "timestamp", "flag": "boolean"})


@query("csv_unknown_header", sql("air", "SELECT station, ord, ts AS timestamp, pm25 AS PM2_5, o3 AS ozone FROM air"))
def csv_unknown_header(spark, sf):
    """A feed whose columns nobody names: header scan, then the finders."""
    root = scratch_path(spark, "csv")
    rows = V.air_wide(spark, sf).select(
        "station", "ord", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Reading Time (é)"),
        F.col("pm25").alias("pm2.5"), F.col("o3").alias("O3_ugm3"))
    rows.write.option("header", True).option("encoding", "ISO-8859-1").csv(f"{root}/feed")
    raw = files.first_source(spark, [f"{root}/missing", f"{root}/feed"], "csv", encoding="ISO-8859-1")
    ozone = K.o3_column(raw)
    named = K.canonical_rename(parse_time(raw, "clean"), "aqi", skip=["timestamp"]).withColumnRenamed(ozone, "ozone")
    return files.typed(named.select("station", "ord", "timestamp", "PM2_5", "ozone"),
                       {"station": "bigint", "ord": "bigint", "PM2_5": "double", "ozone": "double"} | {"timestamp": "asis"})


@query("derived_csv_roundtrip", sql("air", "SELECT station, date_trunc('hour', ts) AS hour, round(avg(o3), 4) AS o3, count(*) AS n FROM air GROUP BY ALL"))
def derived_csv_roundtrip(spark, sf):
    """A derived table written as CSV in two appends, and read back."""
    path = scratch_path(spark, "derived")
    hours = V.air_wide(spark, sf).groupBy("station", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(
        F.round(F.avg("o3"), 4).alias("o3"), F.count("*").alias("n"))
    files.write_csv(hours.where("station % 2 = 0"), path)
    files.write_csv(hours.where("station % 2 = 1"), path, "append")
    return files.typed(files.read_text_table(spark, path), {"station": "bigint", "hour": "timestamp", "o3": "double", "n": "bigint"})


@query("sink_roundtrip", sql("air", "SELECT ord, ts, station, pm25, CAST(ts AS DATE) AS date FROM air"))
def sink_roundtrip(spark, sf):
    path = scratch_path(spark, "sink")
    files.write_by_date(V.air_wide(spark, sf).select("ord", "ts", "station", "pm25"), path, "ts")
    return spark.read.parquet(path)


@query("json_explode_history", sql("air", "SELECT station, date_trunc('second', ts) AS ts, co, CAST(NULL AS DOUBLE) AS no, no2, o3, so2, pm25 AS pm2_5, pm10, nh3 FROM air"))
def json_explode_history(spark, sf):
    return payloads.pollution_history(V.pollution_payloads(spark, sf), ["station"])


@query("json_latest_payload", sql("air", "SELECT station, CAST(ord // 500 AS BIGINT) AS part, arg_min(date_trunc('second', ts), ord) AS ts, arg_min(co, ord) AS co, arg_min(pm10, ord) AS pm10 FROM air GROUP BY station, ord // 500"))
def json_latest_payload(spark, sf):
    return payloads.pollution_history(V.pollution_payloads(spark, sf), ["station", "part"], newest_only=True).select("station", "part", "ts", "co", "pm10")


@query("json_parallel_arrays", sql("wx", "SELECT station, strftime(ts, '%Y-%m-%dT%H:%M') AS time, temperature, humidity, CAST(NULL AS DOUBLE) AS pressure, windspeed, CAST(NULL AS DOUBLE) AS winddirection, CAST(NULL AS DOUBLE) AS cloudiness, visibility FROM wx"))
def json_parallel_arrays(spark, sf):
    return payloads.archive_rows(V.archive_payloads(spark, sf), ["station"])


@query("json_hourly_top48", sql("ev", """SELECT station, ord // 500 AS part, CAST(rn - 1 AS INTEGER) AS step, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS timestamp, value AS temperature, CAST(k AS DOUBLE) AS humidity,
 CAST(NULL AS DOUBLE) AS pressure, CAST(NULL AS DOUBLE) AS wind_speed, CAST(NULL AS DOUBLE) AS wind_direction, CAST(NULL AS DOUBLE) AS cloudiness FROM (
 SELECT *, row_number() OVER (PARTITION BY station, ord // 500 ORDER BY ord) AS rn FROM ev) WHERE rn <= 48"""))
def json_hourly_top48(spark, sf):
    return payloads.hourly_forecast(V.hourly_payloads(spark, sf), ["station", "part"])


@query("json_nested_flatten", sql("ev", """SELECT ord, station, date_trunc('second', ts) AS ts, value AS temperature, CAST(k AS DOUBLE) AS humidity, CAST(NULL AS DOUBLE) AS pressure, CASE WHEN ord % 4 <> 0 THEN value / 50 END AS wind_speed,
 CAST(NULL AS DOUBLE) AS wind_direction, CAST(NULL AS DOUBLE) AS cloudiness, CAST(NULL AS DOUBLE) AS visibility FROM ev"""))
def json_nested_flatten(spark, sf):
    return payloads.current_weather(V.current_payloads(spark, sf), ["ord", "station"])


@query("json_station_feed", sql("ev", "SELECT ord, CAST(k AS DOUBLE) AS aqi, 'S' || station AS city, value AS pm25, CAST(NULL AS DOUBLE) AS pm10, CASE WHEN ord % 3 = 0 THEN value / 2 END AS no2, CAST(NULL AS DOUBLE) AS o3, CAST(NULL AS DOUBLE) AS so2, CAST(NULL AS DOUBLE) AS co FROM ev WHERE ord % 5 <> 0"))
def json_station_feed(spark, sf):
    def v(c):
        return F.struct(c.alias("v"))
    iaqi = F.struct(v(F.col("value")).alias("pm25"), F.when(F.col("ord") % 3 == 0, v(F.col("value") / 2)).alias("no2"))
    city = F.struct(F.concat(F.lit("S"), F.col("station").cast("string")).alias("name"))
    body = F.to_json(F.struct(F.when(F.col("ord") % 5 != 0, "ok").otherwise("error").alias("status"),
                              F.struct(F.col("k").alias("aqi"), city.alias("city"), iaqi.alias("iaqi")).alias("data")))
    return payloads.station_feed(V.events(spark, sf).select("ord", body.alias("body")), ["ord"])


@query("json_traffic_flow", sql("traffic", 'SELECT ord, currentSpeed AS "currentSpeed", freeFlowSpeed AS "freeFlowSpeed", CAST(NULL AS BIGINT) AS "currentTravelTime", CAST(NULL AS BIGINT) AS "freeFlowTravelTime", confidence, roadClosure AS "roadClosure" FROM traffic'))
def json_traffic_flow(spark, sf):
    segment = F.struct("currentSpeed", "freeFlowSpeed", "confidence", "roadClosure").alias("flowSegmentData")
    return payloads.traffic_flow(V.traffic(spark, sf).select("ord", F.to_json(F.struct(segment)).alias("body")), ["ord"])


LAST = "SELECT station, ts, ord, pm25, pm10 FROM (SELECT *, row_number() OVER (PARTITION BY station, ts ORDER BY batch DESC, ord DESC) AS rn FROM dups) WHERE rn = 1"


@query("upsert_keep_last", sql("dups", LAST))
def upsert_keep_last(spark, sf):
    rows = V.dups(spark, sf)
    old, new = (rows.where(f"batch = {b}").drop("batch") for b in (0, 1))
    return U.append_unique(old, new, ["station", "ts"], ["ord"])


@query("upsert_inserted_count", sql("air", "SELECT count(*) AS inserted FROM air WHERE ord % 5 = 0 AND ord % 2 <> 0"))
def upsert_inserted_count(spark, sf):
    rows = V.air_wide(spark, sf).select("station", "ts", "ord")
    return U.inserted_count(rows.where("ord % 2 = 0"), rows.where("ord % 5 = 0"), ["station", "ts"])


@query("append_counted", sql("air", "SELECT CAST(count(*) FILTER (WHERE ord % 2 = 0 OR ord % 5 = 0) AS BIGINT) AS rows, count(*) FILTER (WHERE ord % 5 = 0 AND ord % 2 <> 0) AS inserted FROM air"))
def append_counted(spark, sf):
    """Rows and additions of a keyed append, observed while it is written."""
    rows = V.air_wide(spark, sf).select("station", "ts", "ord", "pm25")
    both, seen = U.append_counted(rows.where("ord % 2 = 0"), rows.where("ord % 5 = 0"), ["station", "ts"], ["ord"])
    both.write.parquet(scratch_path(spark, "appended"))
    return spark.createDataFrame([(seen.get["rows"], seen.get["inserted"])], "rows long, inserted long")


@query("live_table", sql("air", """SELECT station, hour, min(ord) FILTER (WHERE part = first) AS first_ord, arg_max(pm25, ord) FILTER (WHERE part = last) AS pm25, arg_max(o3, ord) FILTER (WHERE part = last) AS o3
 FROM (SELECT *, min(part) OVER (PARTITION BY station, hour) AS first, max(part) OVER (PARTITION BY station, hour) AS last FROM (SELECT station, date_trunc('hour', ts) AS hour, ord, coalesce(pm25, -1) AS pm25, o3, ord % 3 AS part FROM air)) GROUP BY station, hour"""))
def live_table(spark, sf):
    """Station hours upserted into a table that is swapped three times."""
    root = scratch_path(spark, "live")
    rows = V.air_wide(spark, sf).select("station", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "ord",
                                        F.col("ord").alias("first_ord"), F.coalesce("pm25", F.lit(-1.0)).alias("pm25"), "o3")
    for part in range(3):
        batch = rows.where(F.col("ord") % 3 == part)
        first = batch.groupBy("station", "hour").agg(F.min("first_ord").alias("first_ord"), F.max("ord").alias("ord"),
                                                     F.max_by("pm25", "ord").alias("pm25"), F.max_by("o3", "ord").alias("o3"))
        live.upsert_live(first, root, ["station", "hour"], ["first_ord"], ["pm25", "o3"], ["ord"], token=part)
    return live.read_live(spark, root)


@query("first_source", sql("ev", "SELECT station, max(ts) AS ts, count(*) AS n FROM ev GROUP BY station"))
def first_source(spark, sf):
    """The first source that holds rows: one is missing, one is empty."""
    root = scratch_path(spark, "sources")
    rows = V.events(spark, sf).select("station", "ts")
    rows.limit(0).write.parquet(f"{root}/empty")
    rows.write.parquet(f"{root}/full")
    found = files.first_source(spark, [f"{root}/missing", f"{root}/empty", f"{root}/full"])
    return found.groupBy("station").agg(F.max("ts").alias("ts"), F.count("*").alias("n"))


@query("append_columns", sql("ev", "SELECT station, ts, value AS aqi, CAST(NULL AS VARCHAR) AS category FROM ev WHERE event_type IN ('view', 'click')"))
def append_columns(spark, sf):
    """Two feeds appended to a table store under the columns it expects."""
    path = scratch_path(spark, "store")
    rows = V.events(spark, sf)
    expected = [("station", "bigint"), ("ts", "timestamp_ntz"), ("aqi", "double"), ("category", "string")]
    for kind in ("view", "click"):
        part = rows.where(F.col("event_type") == kind).select("ts", F.col("value").alias("aqi"), "station", "sensor")
        files.append_table(part, expected, path=path)
    return spark.read.parquet(path)
