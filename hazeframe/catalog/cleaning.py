"""Casting, shaping, filtering and feed clean-up queries."""

from pyspark.sql import functions as F

from hazeframe.catalog import views as V
from hazeframe.catalog.registry import NUMBER_GUARD, query, sql
from hazeframe.functions import casts as C
from hazeframe.catalog.scoring import STRICT
from hazeframe.functions.aqi import score_aqi
from hazeframe.functions.places import match_places
from hazeframe.operators import columns as K
from hazeframe.operators import filters as FI
from hazeframe.operators import joins as J
from hazeframe.plans import feeds
from hazeframe.plans.daily import digits_where_numeric


def guarded(text: str) -> str:
    return f"CASE WHEN regexp_matches({text}, {NUMBER_GUARD}) THEN TRY_CAST({text} AS DOUBLE) END"


def lenient(col: str) -> str:
    return guarded(f"trim(replace({col}, ',', ''))")


LENIENT_TS = """CASE WHEN raw_ts = 'not a time' THEN NULL ELSE TRY_CAST(regexp_replace(raw_ts, '\\+00:00$', '') AS TIMESTAMP) END"""


@query("coerce_numeric", sql("dirty", f"SELECT ord, {lenient('raw')} AS value FROM dirty"))
def coerce_numeric(spark, sf):
    return V.dirty(spark, sf).select("ord", C.to_number("raw").alias("value"))


@query("parse_timestamps", sql("dirty_ts", f"SELECT ord, {LENIENT_TS} AS parsed FROM dirty_ts"))
def parse_timestamps(spark, sf):
    return V.dirty_ts(spark, sf).select("ord", C.to_timestamp("raw_ts").alias("parsed"))


@query("strip_tz", sql("ev", "SELECT ord, date_trunc('second', ts) AS local FROM ev"))
def strip_tz(spark, sf):
    zones = F.element_at(F.array(*map(F.lit, ("", "Z", "+05:30", "-0800"))), (F.col("ord") % 4 + 1).cast("int"))
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), zones)
    return V.events(spark, sf).select("ord", C.to_timestamp(text).alias("local"))


@query("regex_numeric", sql("ev", f"""SELECT ord, {guarded("regexp_replace(reading, '[^0-9.eE-]', '', 'g')")} AS reading, label FROM t""",
    t="""SELECT ord, CASE ord % 4 WHEN 0 THEN '~' || k || '.5 ug/m3' WHEN 1 THEN 'n/a' WHEN 2 THEN k || ' µg' ELSE NULL END AS reading,
 event_type AS label FROM ev"""))
def regex_numeric(spark, sf):
    rows = V.events(spark, sf).selectExpr(
        "ord", "case ord % 4 when 0 then concat('~', k, '.5 ug/m3') when 1 then 'n/a' when 2 then concat(k, ' µg') else null end as reading",
        "event_type as label")
    return digits_where_numeric(rows)


@query("robust_date", sql("ev", "SELECT ord, CASE WHEN ord % 6 IN (3, 5) THEN NULL ELSE CAST(ts AS DATE) END AS day FROM ev"))
def robust_date(spark, sf):
    text = F.expr("""case ord % 6 when 0 then date_format(ts, 'yyyy-MM-dd HH:mm:ss') when 1 then date_format(ts, 'MM/dd/yyyy')
     when 2 then date_format(ts, 'd MMM yyyy') when 3 then 'garbage' when 4 then date_format(ts, 'yyyyMMdd') else null end""")
    return V.events(spark, sf).select("ord", C.to_date(text).alias("day"))


@query("calendar_features", sql("ev", """SELECT ord, CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour,
 CAST(isodow(ts) - 1 AS INTEGER) AS dayofweek, isodow(ts) >= 6 AS is_weekend,
 CASE WHEN month(ts) IN (11, 12, 1, 2) THEN 'winter' WHEN month(ts) BETWEEN 3 AND 6 THEN 'summer' ELSE 'monsoon' END AS season FROM ev"""))
def calendar_features(spark, sf):
    return V.events(spark, sf).select("ord", *[c.alias(n) for n, c in C.calendar_parts("ts").items()])


@query("null_negatives", sql("air wx", """SELECT ord, CASE WHEN pm25 >= 0 THEN pm25 END AS value, 'air' AS feed FROM air
 UNION ALL SELECT ord, CASE WHEN temperature >= 0 THEN temperature END, 'wx' FROM wx"""))
def null_negatives(spark, sf):
    a = V.air_wide(spark, sf).select("ord", C.non_negative("pm25").alias("value"), F.lit("air").alias("feed"))
    w = V.wx(spark, sf).select("ord", C.non_negative("temperature").alias("value"), F.lit("wx").alias("feed"))
    return a.unionByName(w)


@query("clip_bounds", sql("air", """SELECT ord, CASE WHEN pm25 IS NULL THEN NULL WHEN pm25 < 0 THEN 0 WHEN pm25 > 200 THEN 200 ELSE pm25 END AS pm25_clip,
 CASE WHEN so2 > 500 THEN 500 ELSE so2 END AS so2_clip FROM air"""))
def clip_bounds(spark, sf):
    return V.air_wide(spark, sf).select("ord", C.clip("pm25", 0, 200).alias("pm25_clip"), C.clip("so2", 0, 500).alias("so2_clip"))


@query("station_key", sql("", """SELECT s_suppkey, printf('%s_%.4f_%.4f', n_name, CAST(10 + s_nationkey AS DOUBLE) / 7, CAST(70 + s_suppkey % 50 AS DOUBLE) / 3) AS station_name
 FROM supplier JOIN nation ON s_nationkey = n_nationkey"""))
def station_key(spark, sf):
    rows = V.table(spark, sf, "supplier").join(V.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    lat, lon = (10 + F.col("s_nationkey")).cast("double") / 7, (70 + F.col("s_suppkey") % 50).cast("double") / 3
    return rows.select("s_suppkey", C.station_key("n_name", lat, lon).alias("station_name"))


@query("station_coords", sql("", """SELECT c_custkey, n_name AS city, CAST(n_nationkey AS DOUBLE) / 2 + 10 AS latitude, CAST(n_regionkey AS DOUBLE) * 3 + 70 AS longitude
 FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""))
def station_coords(spark, sf):
    places = V.table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"),
        (F.col("n_nationkey").cast("double") / 2 + 10).alias("latitude"),
        (F.col("n_regionkey").cast("double") * 3 + 70).alias("longitude"))
    return J.attach(V.table(spark, sf, "customer"), places, ["c_nationkey"]).select("c_custkey", "city", "latitude", "longitude")


@query("congestion_index", sql("traffic", """SELECT ord, CASE WHEN freeFlowSpeed > 0 THEN round(greatest(0, 1 - CAST(currentSpeed AS DOUBLE) / freeFlowSpeed), 6) END AS congestion_index FROM traffic"""))
def congestion_index(spark, sf):
    return V.traffic(spark, sf).select("ord", F.round(C.congestion_index("currentSpeed", "freeFlowSpeed"), 6).alias("congestion_index"))


PLACE_QUERY = """CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) WHEN 2 THEN replace(p_name, ' ', '-')
 WHEN 3 THEN split_part(p_name, ' ', 2) || ' - ' || split_part(p_name, ' ', 1) ELSE 'zzz ' || p_brand END"""


@query("match_location", sql("", f"""SELECT p_partkey, query, CASE WHEN rank > 0 THEN name END AS place FROM (
 SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY rank DESC, name DESC) AS rn FROM scored) WHERE rn = 1""",
    q=f"SELECT p_partkey, {PLACE_QUERY} AS query FROM part",
    g="SELECT DISTINCT p_name AS name FROM part",
    scored="""SELECT p_partkey, query, name, CASE WHEN name = query THEN 2000 WHEN lower(name) = lower(query) THEN 1000 ELSE
 len(list_filter(string_split_regex(lower(replace(query, '-', ' ')), '\\s+'), lambda w: w <> '' AND contains(lower(name), w))) END AS rank FROM q, g"""))
def match_location(spark, sf):
    part = V.table(spark, sf, "part")
    rows = part.select("p_partkey", F.expr(PLACE_QUERY).alias("query"))
    return match_places(rows, "query", part, "p_name")


PARAMETERS = ("aqi", "pm25", "pm10", "no2", "o3")


@query("unpivot_parameters", sql("air", " UNION ALL ".join(
    f"SELECT ord, '{p}' AS parameter, CAST({p} AS DOUBLE) AS value FROM strict" for p in PARAMETERS), **STRICT))
def unpivot_parameters(spark, sf):
    rows = score_aqi(V.air_wide(spark, sf), "in_strict").withColumn("aqi", F.col("aqi").cast("double"))
    return rows.unpivot("ord", list(PARAMETERS), "parameter", "value")


@query("tidy_columns", sql("ev", "SELECT ord, value AS wind_speed_m_s, k AS rel_humidity_pct, event_type AS type_of_event FROM ev"))
def tidy_columns(spark, sf):
    e = V.events(spark, sf).select(F.col("ord").alias(" Ord "), F.col("value").alias("Wind Speed-m/s"), F.col("k").alias("Rel (Humidity) pct"), F.col("event_type").alias("Type Of Event"))
    return K.tidy_columns(K.tidy_columns(e, "daily"))


@query("canonical_rename", sql("traffic", """SELECT ord, ts, station, currentSpeed AS avg_speed, "freeFlowSpeed", vehicle_count, confidence, "roadClosure" FROM traffic"""))
def canonical_rename(spark, sf):
    return K.canonical_rename(V.traffic(spark, sf), "traffic", skip=["ord", "ts", "station"])


@query("normalize_aqi", sql("air", """SELECT 'S' || station AS "City", CAST(20 + station % 10 AS DOUBLE) AS "Latitude", CAST(NULL AS DOUBLE) AS "Longitude", ts AS "Timestamp", CAST(NULL AS DOUBLE) AS "AQI",
 pm25 AS "PM25", pm10 AS "PM10", co AS "CO", no2 AS "NO2", so2 AS "SO2", o3 AS "Ozone", 'Live' AS "Source" FROM air"""))
def normalize_aqi(spark, sf):
    raw = V.air_wide(spark, sf).selectExpr(
        "concat('S', station) as Station", "20 + station % 10 as Lat", "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') as Timestamp",
        "pm25 as PM2_5", "pm10 as PM10", "co as CO", "no2 as NO2", "so2 as SO2", "o3 as O3", "nh3 as NH3", "'Live' as Type")
    return K.normalize(raw, "aqi")


@query("normalize_weather", sql("wx", """SELECT 'S' || station AS "City", CAST(NULL AS DOUBLE) AS "Latitude", CAST(NULL AS DOUBLE) AS "Longitude", ts AS "Timestamp", temperature AS "Temperature",
 humidity AS "Humidity", CAST(NULL AS DOUBLE) AS "Pressure", windspeed AS "Wind_Speed", CAST(NULL AS DOUBLE) AS "Wind_Direction", CAST(NULL AS DOUBLE) AS "Cloudiness",
 visibility AS "Visibility", CAST(NULL AS VARCHAR) AS "Source" FROM wx"""))
def normalize_weather(spark, sf):
    raw = V.wx(spark, sf).select(
        F.concat(F.lit("S"), F.col("station").cast("string")).alias("City"), F.col("ts").alias("timestamp"),
        F.col("temperature").alias("Temperature (°C)"), F.col("humidity").alias("Humidity (%)"),
        F.col("windspeed").alias("Wind Speed (m/s)"), F.col("visibility").alias("Visibility (m)"))
    return K.normalize(raw, "weather")


@query("normalize_traffic", sql("traffic", """SELECT 'S' || station AS city, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude, ts AS timestamp,
 CAST(currentSpeed AS DOUBLE) AS "currentSpeed", CAST(NULL AS DOUBLE) AS "currentFlow", vehicle_count AS "vehicleCount", CAST(NULL AS VARCHAR) AS "linkId", CAST(NULL AS VARCHAR) AS "Source" FROM traffic"""))
def normalize_traffic(spark, sf):
    raw = V.traffic(spark, sf).select(
        F.concat(F.lit("S"), F.col("station").cast("string")).alias("City"), F.col("ts").alias("reading_time"),
        F.col("currentSpeed").alias("speed"), F.col("vehicle_count").alias("vehicleCount"), "confidence")
    return K.normalize(raw, "traffic")


@query("normalize_weather_raw", sql("wx", """SELECT 'S' || station AS "City", CAST(NULL AS DOUBLE) AS "Latitude", CAST(NULL AS DOUBLE) AS "Longitude", ts AS "Timestamp", temperature AS "Temperature (°C)",
 humidity AS "Humidity (%)", CAST(NULL AS DOUBLE) AS "Pressure (hPa)", windspeed AS "Wind Speed (m/s)", CAST(NULL AS DOUBLE) AS "Wind Direction (°)", CAST(NULL AS DOUBLE) AS "Cloudiness (%)",
 visibility AS "Visibility (m)", CAST(NULL AS VARCHAR) AS "Source" FROM wx"""))
def normalize_weather_raw(spark, sf):
    """The landing schema of weather rows; numbers arrive as text."""
    raw = V.wx(spark, sf).select(
        F.concat(F.lit("S"), F.col("station").cast("string")).alias("City"), F.col("ts").alias("Timestamp"),
        F.col("temperature").cast("string").alias("Temperature (°C)"), F.col("humidity").alias("Humidity (%)"),
        F.col("windspeed").alias("Wind Speed (m/s)"), F.col("visibility").alias("Visibility (m)"))
    return K.normalize(raw, "weather_raw")


@query("drop_all_null_cols", sql("null_rows", "SELECT ord, ts, station, temperature, humidity, windspeed FROM null_rows"))
def drop_all_null_cols(spark, sf):
    return K.drop_all_null_columns(V.null_rows(spark, sf))


@query("drop_all_null_rows", sql("null_rows", "SELECT * FROM null_rows WHERE temperature IS NOT NULL OR humidity IS NOT NULL OR windspeed IS NOT NULL OR pressure IS NOT NULL"))
def drop_all_null_rows(spark, sf):
    return FI.drop_all_null_rows(V.null_rows(spark, sf), ["temperature", "humidity", "windspeed", "pressure"])


@query("dedup_full", sql("dups", "SELECT DISTINCT * FROM dups"))
def dedup_full(spark, sf):
    return FI.drop_duplicate_rows(V.dups(spark, sf))


@query("dedup_keep_last", sql("dups", "SELECT station, ts, batch, ord, pm25, pm10 FROM (SELECT *, row_number() OVER (PARTITION BY station, ts ORDER BY batch DESC, ord DESC) AS rn FROM dups) WHERE rn = 1"))
def dedup_keep_last(spark, sf):
    return FI.keep_last(V.dups(spark, sf), ["station", "ts"], ["batch", "ord"])


@query("duplicate_count", sql("dups", "SELECT CAST((SELECT count(*) FROM dups) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dups)) AS BIGINT) AS duplicates"))
def duplicate_count(spark, sf):
    return FI.duplicate_count(V.dups(spark, sf))


@query("pair_series", sql("air", "SELECT ts, pm25, o3 FROM air WHERE pm25 IS NOT NULL AND o3 IS NOT NULL"))
def pair_series(spark, sf):
    return FI.pair_rows(V.air_wide(spark, sf), ["ts"], "pm25", "o3")


@query("last_24h", sql("air", "SELECT ord, ts, station, pm25 FROM air WHERE ts > (SELECT max(ts) FROM air) - INTERVAL 24 HOUR"))
def last_24h(spark, sf):
    return FI.last_hours(V.air_wide(spark, sf).select("ord", "ts", "station", "pm25"), "ts", 24)


@query("multi_source_union", sql("air", "SELECT CAST(0 AS INTEGER) AS source_no, ord, ts, pm25, CAST(NULL AS DOUBLE) AS o3 FROM air WHERE ord % 2 = 0 UNION ALL SELECT 2, ord, ts, pm25, o3 FROM air WHERE ord % 2 = 1"))
def multi_source_union(spark, sf):
    from hazeframe.session import scratch_path
    from hazeframe.sources.files import all_sources
    root, air = scratch_path(spark, "sources"), V.air_wide(spark, sf)
    air.where("ord % 2 = 0").select("ord", "ts", "pm25").write.parquet(f"{root}/historic")
    air.where("ord % 2 = 1").select("ord", "ts", "pm25", "o3").write.parquet(f"{root}/live")
    return all_sources(spark, [f"{root}/historic", f"{root}/missing", f"{root}/live"])


GRID = """SELECT station, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS timestamp FROM (SELECT station, min(timestamp) AS lo, max(timestamp) AS hi FROM h GROUP BY station)"""


@query("clean_aqi", sql("air", """SELECT g.station, g.timestamp, "PM2_5", "PM10", "NO2", "SO2", "CO", o3 FROM g LEFT JOIN h USING (station, timestamp)""",
    n="SELECT ts, station, CASE WHEN pm25 >= 0 THEN pm25 END AS pm25, pm10, no2, o3, so2, co FROM air",
    f="SELECT ts, station, coalesce(pm25, (SELECT median(pm25) FROM n)) AS pm25, pm10, no2, o3, so2, co FROM n",
    h="""SELECT station, date_trunc('hour', ts) AS timestamp, round(avg(pm25), 6) AS "PM2_5", round(avg(pm10), 6) AS "PM10", round(avg(no2), 6) AS "NO2",
 round(avg(so2), 6) AS "SO2", round(avg(co), 6) AS "CO", round(avg(o3), 6) AS o3 FROM f GROUP BY ALL""", g=GRID))
def clean_aqi(spark, sf):
    raw = V.air_wide(spark, sf).select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Timestamp"), "station", F.col("pm25").cast("string").alias("PM2.5"),
        F.col("pm10").alias("pm_10"), "no2", "o3", "so2", "co")
    out = feeds.clean_aqi(raw)
    return out.select("station", "timestamp", *[F.round(c, 6).alias(c) for c in ("PM2_5", "PM10", "NO2", "SO2", "CO", "o3")])


CARRY = "last_value({c} IGNORE NULLS) OVER (PARTITION BY station ORDER BY timestamp, ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query("clean_traffic", sql("traffic", """SELECT g.station, g.timestamp, avg_speed, "freeFlowSpeed", vehicle_count, confidence, "roadClosure" FROM g LEFT JOIN h USING (station, timestamp)""",
    n0="""SELECT ord, ts AS timestamp, station, CASE WHEN ord % 6 = 0 THEN NULL WHEN ord % 17 = 0 AND currentSpeed > 0 THEN NULL ELSE currentSpeed END AS s,
 freeFlowSpeed AS ffs, CASE WHEN ord % 4 = 0 THEN NULL ELSE vehicle_count END AS v, confidence AS c, roadClosure AS r FROM traffic""",
    n="SELECT * FROM n0 UNION ALL SELECT * FROM n0 WHERE ord % 7 = 0",
    f=f"""SELECT DISTINCT timestamp, station, coalesce({CARRY.format(c='s')}, (SELECT median(s) FROM n)) AS s, ffs, coalesce({CARRY.format(c='v')}, (SELECT median(v) FROM n)) AS v, c, r FROM n""",
    h="""SELECT station, date_trunc('hour', timestamp) AS timestamp, round(avg(s), 6) AS avg_speed, round(avg(ffs), 6) AS "freeFlowSpeed", round(avg(v), 6) AS vehicle_count,
 round(avg(c), 6) AS confidence, round(avg(CAST(r AS INTEGER)), 6) AS "roadClosure" FROM f GROUP BY ALL""", g=GRID))
def clean_traffic(spark, sf):
    out = feeds.clean_traffic(V.traffic_gaps(spark, sf), tie=["ord"])
    return out.select("station", "timestamp", *[F.round(c, 6).alias(c) for c in ("avg_speed", "freeFlowSpeed", "vehicle_count", "confidence", "roadClosure")])


WX_GAPS = """SELECT ord, ts AS timestamp, station, {t} AS t, CASE WHEN ord % 5 = 0 THEN NULL ELSE humidity END AS u,
 CASE WHEN ord % 3 = 0 THEN NULL ELSE windspeed END AS w, precipitation AS p, CASE WHEN ord % 9 = 0 AND visibility > 0 THEN NULL ELSE visibility END AS v FROM wx"""


def _clean_weather_sql(t):
    cols = "tuwpv"
    filled = ", ".join(f"coalesce({CARRY.format(c=c)}, (SELECT median({c}) FROM n)) AS {c}" for c in cols)
    return sql("wx", "SELECT g.station, g.timestamp, temperature, humidity, windspeed, precipitation, visibility FROM g LEFT JOIN h USING (station, timestamp)",
               n0=WX_GAPS.format(t=t), n="SELECT * FROM n0 UNION ALL SELECT * FROM n0 WHERE ord % 7 = 0",
               f=f"SELECT DISTINCT timestamp, station, {filled} FROM n",
               h="""SELECT station, date_trunc('hour', timestamp) AS timestamp, round(avg(t), 6) AS temperature, round(avg(u), 6) AS humidity, round(avg(w), 6) AS windspeed,
 round(avg(p), 6) AS precipitation, round(avg(v), 6) AS visibility FROM f GROUP BY ALL""", g=GRID)


def _clean_weather(spark, sf, strict):
    raw = V.wx_gaps(spark, sf).withColumnRenamed("Temp_C", "temp_c")
    out = feeds.clean_weather(raw.withColumnRenamed("temp_c", "temperature") if not strict else raw, tie=["ord"], strict=strict)
    return out.select("station", "timestamp", *[F.round(c, 6).alias(c) for c in ("temperature", "humidity", "windspeed", "precipitation", "visibility")])


@query("clean_weather", _clean_weather_sql("temperature"))
def clean_weather(spark, sf):
    return _clean_weather(spark, sf, False)


@query("clean_weather_strict", _clean_weather_sql("CASE WHEN temperature >= 0 THEN temperature END"))
def clean_weather_strict(spark, sf):
    return _clean_weather(spark, sf, True)


@query("preprocess_master", sql("dirty_ts", f"SELECT DISTINCT station, {LENIENT_TS} AS timestamp FROM dirty_ts WHERE {LENIENT_TS} IS NOT NULL"))
def preprocess_master(spark, sf):
    raw = V.dirty_ts(spark, sf).select("station", F.col("raw_ts").alias("timestamp"))
    return feeds.preprocess(raw)


@query("process_live_aqi", sql("dirty dirty_ts ev", f"""SELECT ord, coalesce(station_name, 'Unknown') AS station_name, time_stamp, coalesce(pm25_raw, (SELECT median(pm25_raw) FROM n), 0) AS pm25_raw, no2, 'aqi_live' AS source FROM n""",
    n=f"""SELECT e.ord, CASE WHEN e.ord % 17 = 0 THEN NULL ELSE 'S-' || e.station END AS station_name, {LENIENT_TS} AS time_stamp,
 {guarded("trim(raw)")} AS pm25_raw, CAST((e.ord * 37) % 2000 AS DOUBLE) / 10 AS no2
 FROM ev e JOIN dirty USING (ord) JOIN dirty_ts USING (ord) WHERE event_type IN ('view', 'click', 'signup')"""))
def process_live_aqi(spark, sf):
    return feeds.process_live(V.live_air(spark, sf), "aqi", [], ["ord"], "aqi_live")


def _live_fill(c):
    w = "PARTITION BY station ORDER BY t{d}, ord{d} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    return (f"coalesce(last_value({c} IGNORE NULLS) OVER ({w.format(d='')}), last_value({c} IGNORE NULLS) OVER ({w.format(d=' DESC')}), 0)")


@query("process_live_weather", sql("wx", f"""SELECT ord, station, t AS time_stamp, {_live_fill('temp_c')} AS temp_c, {_live_fill('wind_speed')} AS wind_speed, coalesce(label, 'Unknown') AS label, 'weather_live' AS source FROM n""",
    n="""SELECT ord, station, ts AS t, CASE WHEN ord % 3 = 0 OR ord % 5 = 0 THEN NULL ELSE temperature END AS temp_c,
 CASE WHEN ord % 4 = 0 THEN NULL ELSE windspeed END AS wind_speed, CASE WHEN ord % 13 = 0 THEN NULL ELSE 'S-' || station END AS label FROM wx"""))
def process_live_weather(spark, sf):
    return feeds.process_live(V.live_weather(spark, sf), "weather", ["station"], ["ord"], "weather_live")


@query("process_live_traffic", sql("traffic", f"""SELECT ord, station, t AS timestamp, {_live_fill('vehicle_count')} AS vehicle_count, {_live_fill('speed')} AS speed, coalesce(label, 'Unknown') AS label, 'traffic_live' AS source FROM n""",
    n="""SELECT ord, station, ts AS t, CASE WHEN ord % 3 = 0 THEN NULL ELSE vehicle_count END AS vehicle_count,
 CASE WHEN ord % 4 = 0 THEN NULL ELSE CAST(currentSpeed AS DOUBLE) END AS speed, CASE WHEN ord % 13 = 0 THEN NULL ELSE 'S-' || station END AS label FROM traffic"""))
def process_live_traffic(spark, sf):
    return feeds.process_live(V.live_traffic(spark, sf), "traffic", ["station"], ["ord"], "traffic_live")
