"""Imputation, window, grid and time-join queries."""

from pyspark.sql import functions as F

from hazeframe.catalog import views as V
from hazeframe.catalog.registry import query, sql
from hazeframe.catalog.scoring import STRICT
from hazeframe.functions.aqi import score_aqi
from hazeframe.operators import grid as G
from hazeframe.operators import impute as I
from hazeframe.operators import joins as J
from hazeframe.operators import windows as W
from hazeframe.plans import training as T

UP = "(PARTITION BY station ORDER BY ts, ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
DOWN = "(PARTITION BY station ORDER BY ts DESC, ord DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
GAPS = {"n": "SELECT ord, ts, station, CASE WHEN pm25 >= 0 THEN pm25 END AS pm25, CASE WHEN ord % 4 <> 0 THEN o3 END AS o3 FROM air"}


def gaps(spark, sf):
    return V.air_wide(spark, sf).selectExpr(
        "ord", "ts", "station", "case when pm25 >= 0 then pm25 end as pm25", "case when ord % 4 <> 0 then o3 end as o3")


@query("impute_median", sql("air", "SELECT ord, coalesce(pm25, (SELECT median(pm25) FROM n)) AS pm25, coalesce(o3, (SELECT median(o3) FROM n)) AS o3 FROM n", **GAPS))
def impute_median(spark, sf):
    return I.impute_median(gaps(spark, sf).select("ord", "pm25", "o3"), ["pm25", "o3"])


def _carry(c, frame):
    return f"last_value({c} IGNORE NULLS) OVER {frame}"


@query("impute_ffill_median", sql("air", f"SELECT ord, ts, station, coalesce({_carry('pm25', UP)}, (SELECT median(pm25) FROM n)) AS pm25, coalesce({_carry('o3', UP)}, (SELECT median(o3) FROM n)) AS o3 FROM n", **GAPS))
def impute_ffill_median(spark, sf):
    return I.impute_forward_median(gaps(spark, sf), ["station"], ["ts", "ord"])


@query("impute_ffill_bfill_zero", sql("air", f"SELECT ord, ts, station, coalesce({_carry('pm25', UP)}, {_carry('pm25', DOWN)}, 0) AS pm25, coalesce({_carry('o3', UP)}, {_carry('o3', DOWN)}, 0) AS o3 FROM n", **GAPS))
def impute_ffill_bfill_zero(spark, sf):
    return I.impute_neighbours(gaps(spark, sf), ["station"], ["ts", "ord"], zero=True)


@query("impute_ffill_bfill", sql("air", f"SELECT ord, ts, station, coalesce({_carry('pm25', UP)}, {_carry('pm25', DOWN)}) AS pm25, coalesce({_carry('o3', UP)}, {_carry('o3', DOWN)}) AS o3 FROM n", **GAPS))
def impute_ffill_bfill(spark, sf):
    return I.impute_neighbours(gaps(spark, sf), ["station"], ["ts", "ord"])


@query("impute_ffill_table", sql("air", f"SELECT ord, ts, station, {_carry('pm25', UP.replace('PARTITION BY station ', ''))} AS pm25 FROM n", **GAPS))
def impute_ffill_table(spark, sf):
    """Forward fill in time order over the whole table, stations mixed."""
    from hazeframe.scale import carry
    rows = gaps(spark, sf).select("ord", "ts", "station", "pm25")
    return carry(rows, [], ["ts", "ord"], {"_f": "pm25"}).select("ord", "ts", "station", F.col("_f").alias("pm25"))


@query("impute_zero", sql("air", "SELECT ord, coalesce(pm25, 0) AS pm25, coalesce(o3, 0) AS o3 FROM n", **GAPS))
def impute_zero(spark, sf):
    return I.impute_zero(gaps(spark, sf).select("ord", "pm25", "o3"), ["pm25", "o3"])


@query("impute_unknown", sql("ev", "SELECT ord, coalesce(CASE WHEN ord % 3 <> 0 THEN event_type END, 'Unknown') AS kind, value FROM ev"))
def impute_unknown(spark, sf):
    return I.impute_unknown(V.events(spark, sf).selectExpr("ord", "case when ord % 3 <> 0 then event_type end as kind", "value"))


@query("rolling_mean_8", sql("air", "SELECT ord, station, CASE WHEN count(pm25) OVER w >= 6 THEN round(avg(pm25) OVER w, 6) END AS pm25_mean_8 FROM n WINDOW w AS (PARTITION BY station ORDER BY ts, ord ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)", **GAPS))
def rolling_mean_8(spark, sf):
    out = W.rolling_mean(gaps(spark, sf), ["station"], ["ts", "ord"], "pm25", "m")
    return out.select("ord", "station", F.round("m", 6).alias("pm25_mean_8"))


@query("spike_detect", sql("air", """SELECT ord, station, coalesce(pm10 > m + 3 * s, false) AS is_spike FROM (
 SELECT *, avg(pm10) OVER w AS m, stddev_samp(pm10) OVER w AS s FROM air WINDOW w AS (PARTITION BY station ORDER BY ts, ord ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))"""))
def spike_detect(spark, sf):
    rows = V.air_wide(spark, sf).select("ord", "ts", "station", "pm10")
    return W.spikes(rows, ["station"], ["ts", "ord"], "pm10").select("ord", "station", "is_spike")


O3 = {
    "o": "SELECT * FROM air WHERE ord % 9 <> 0 AND (station % 3 <> 0 OR ord % 40 = 0)",
    "hh": "SELECT station, date_trunc('hour', ts) AS h, avg(o3) AS m FROM o GROUP BY ALL",
    "hr": "SELECT *, row_number() OVER (PARTITION BY station ORDER BY h DESC) AS rn FROM hh",
    "rr": "SELECT *, row_number() OVER (PARTITION BY station ORDER BY ts DESC, ord DESC) AS rn FROM o",
    "hs": "SELECT station, avg(m) AS hm, count(*) AS hn FROM hr WHERE rn <= 8 GROUP BY station",
    "rs": "SELECT station, avg(o3) AS rm, count(*) AS n, max(o3) FILTER (WHERE rn = 1) AS last FROM rr WHERE rn <= 8 GROUP BY station",
    "st": "SELECT DISTINCT station FROM air",
}


@query("o3_8hr_value", sql("air", """SELECT station, last AS o3_raw, CASE WHEN hn >= 8 THEN round_even(hm, 2) WHEN n >= 8 THEN round_even(rm, 2) ELSE last END AS o3_used,
 CASE WHEN hn >= 8 THEN '8hr_resample' WHEN n >= 8 THEN '8hr_rolling' ELSE 'instant' END AS o3_method FROM st LEFT JOIN rs USING (station) LEFT JOIN hs USING (station)""", **O3))
def o3_8hr_value(spark, sf):
    thin = F.expr("case when ord % 9 <> 0 and (station % 3 <> 0 or ord % 40 = 0) then o3 end")
    return W.o3_8hr(V.air_wide(spark, sf).select("station", "ts", "ord", thin.alias("o3")), ["station"], "ts", "ord")


@query("last_valid", sql("air", "SELECT station, arg_max(pm25, ord) FILTER (WHERE pm25 IS NOT NULL) AS pm25, arg_max(o3, ord) FILTER (WHERE o3 IS NOT NULL) AS o3 FROM n GROUP BY station", **GAPS))
def last_valid(spark, sf):
    return W.last_valid(gaps(spark, sf), ["station"], ["ts", "ord"], ["pm25", "o3"])


@query("latest_row", sql("air", "SELECT station, ord, ts, pm25, o3 FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY ts DESC, ord DESC) AS rn FROM n) WHERE rn = 1", **GAPS))
def latest_row(spark, sf):
    return W.latest_row(gaps(spark, sf), ["station"], ["ts", "ord"])


@query("lag_features", sql("hourly_station", """SELECT station, ts, round(pm25, 6) AS pm25, round(lag(pm25, 1) OVER w, 6) AS lag_1, round(lag(pm25, 2) OVER w, 6) AS lag_2,
 round(lag(pm25, 24) OVER w, 6) AS lag_24 FROM hourly_station WINDOW w AS (PARTITION BY station ORDER BY ts)"""))
def lag_features(spark, sf):
    out = W.lags(V.hourly_station(spark, sf), ["station"], "ts", "pm25", [1, 2, 24])
    return out.select("station", "ts", *[F.round(c, 6).alias(c) for c in ("pm25", "lag_1", "lag_2", "lag_24")])


@query("resample_hourly", sql("hourly_station", "SELECT station, ts, round(pm25, 6) AS pm25 FROM hourly_station"))
def resample_hourly(spark, sf):
    return V.hourly_station(spark, sf).withColumn("pm25", F.round("pm25", 6))


@query("hourly_mean", sql("air", "SELECT station, date_trunc('hour', ts) AS ts, round(avg(o3), 6) AS o3 FROM air GROUP BY ALL"))
def hourly_mean(spark, sf):
    return G.hourly_mean(V.air_wide(spark, sf), ["station"], "ts", ["o3"]).withColumn("o3", F.round("o3", 6))


@query("reindex_hourly", sql("air", """SELECT g.station, g.ts, l.ord, l.pm10 FROM g LEFT JOIN l ON g.station = l.station AND g.ts = l.h""",
    l="SELECT station, date_trunc('hour', ts) AS h, arg_max(ord, ord) AS ord, arg_max(pm10, ord) AS pm10 FROM air GROUP BY ALL",
    g="SELECT station, unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS ts FROM l GROUP BY station"))
def reindex_hourly(spark, sf):
    return G.reindex_hourly(V.air_wide(spark, sf).select("station", "ts", "ord", "pm10"), ["station"], "ts", ["ord"])


@query("reindex_first", sql("air", """SELECT g.station, g.ts, a.ord, a.pm10 FROM g LEFT JOIN a USING (station, ts)""",
    a="SELECT station, ord, pm10, date_trunc('minute', ts) AS ts FROM air QUALIFY row_number() OVER (PARTITION BY station, date_trunc('minute', ts) ORDER BY ord DESC) = 1",
    g="SELECT station, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM a GROUP BY station"))
def reindex_first(spark, sf):
    air = V.air_wide(spark, sf).select("station", F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("ts"), "ord", "pm10")
    return G.reindex_hourly(air, ["station"], "ts", ["ord"], align="first")


@query("future_grid", sql("air", "SELECT station, CAST(s AS INTEGER) AS step, hi + s * INTERVAL 1 HOUR AS ts FROM (SELECT station, max(ts) AS hi FROM air GROUP BY station), generate_series(1, 24) t(s)"))
def future_grid(spark, sf):
    return G.future_grid(V.air_wide(spark, sf), ["station"], "ts")


@query("asof_nearest", sql("air wx", """SELECT ord, station, wx_ord, wx_temperature FROM (
 SELECT a.ord, a.station, w.ord AS wx_ord, w.temperature AS wx_temperature,
 row_number() OVER (PARTITION BY a.ord ORDER BY abs(epoch_us(a.ts) - epoch_us(w.ts)), w.ts DESC) AS rn
 FROM air a LEFT JOIN wx w ON a.station = w.station AND w.ts BETWEEN a.ts - INTERVAL 1 HOUR AND a.ts + INTERVAL 1 HOUR) WHERE rn = 1"""))
def asof_nearest(spark, sf):
    right = V.wx(spark, sf).select("station", "ts", "ord", "temperature")
    left = V.air_wide(spark, sf).select("ord", "ts", "station")
    return J.asof(left, right, ["station"], "ts", ["ord"], ["ord"], "nearest", "1 hour", prefix="wx_").drop("ts", "wx_ts")


# Weather rows that lost their time, and readings that did.
HOLES = {
    "l": "SELECT ord, station, CASE WHEN ord % 17 <> 0 THEN ts END AS ts FROM air",
    "r": "SELECT ord, station, CASE WHEN ord % 3 <> 0 THEN ts END AS ts, temperature FROM wx",
}


def holes(spark, sf):
    left = V.air_wide(spark, sf).selectExpr("ord", "station", "case when ord % 17 <> 0 then ts end as ts")
    return left, V.wx(spark, sf).selectExpr("ord", "station", "case when ord % 3 <> 0 then ts end as ts", "temperature")


@query("asof_nearest_null_times", sql("air wx", """SELECT ord, station, wx_ord FROM (SELECT l.ord, l.station, r.ord AS wx_ord,
 row_number() OVER (PARTITION BY l.ord ORDER BY abs(epoch_us(l.ts) - epoch_us(r.ts)), r.ts DESC) AS rn
 FROM l LEFT JOIN r ON l.station = r.station AND r.ts BETWEEN l.ts - INTERVAL 1 HOUR AND l.ts + INTERVAL 1 HOUR) WHERE rn = 1""", **HOLES))
def asof_nearest_null_times(spark, sf):
    left, right = holes(spark, sf)
    return J.asof(left, right, ["station"], "ts", ["ord"], ["ord"], "nearest", "1 hour", prefix="wx_").select("ord", "station", "wx_ord")


@query("asof_backward_null_times", sql("air wx", "SELECT l.ord, l.station, r.ord AS wx_ord FROM l ASOF LEFT JOIN (SELECT * FROM r WHERE ts IS NOT NULL) r ON l.station = r.station AND l.ts >= r.ts", **HOLES))
def asof_backward_null_times(spark, sf):
    left, right = holes(spark, sf)
    return J.asof(left, right, ["station"], "ts", ["ord"], ["ord"], "backward", prefix="wx_").select("ord", "station", "wx_ord")


@query("asof_backward", sql("air wx", "SELECT a.ord, a.station, w.ord AS wx_ord, w.temperature AS wx_temperature FROM air a ASOF LEFT JOIN wx w ON a.station = w.station AND a.ts >= w.ts"))
def asof_backward(spark, sf):
    right = V.wx(spark, sf).select("station", "ts", "ord", "temperature")
    left = V.air_wide(spark, sf).select("ord", "ts", "station")
    return J.asof(left, right, ["station"], "ts", ["ord"], ["ord"], "backward", prefix="wx_").drop("ts", "wx_ts")


@query("outer_join_feeds", sql("air wx traffic", """SELECT coalesce(aw.station, t.station) AS station, coalesce(aw.hour, t.hour) AS hour, o3, value_aqi, temperature, value_weather, vehicle_count FROM (
 SELECT coalesce(a.station, w.station) AS station, coalesce(a.hour, w.hour) AS hour, o3, a.value AS value_aqi, temperature, w.value AS value_weather FROM a FULL JOIN w ON a.station = w.station AND a.hour IS NOT DISTINCT FROM w.hour) aw
 FULL JOIN t ON aw.station = t.station AND aw.hour IS NOT DISTINCT FROM t.hour""",
    a="SELECT station, CASE WHEN hour(ts) <> 5 THEN date_trunc('hour', ts) END AS hour, round(avg(o3), 6) AS o3, count(*) AS value FROM air GROUP BY ALL",
    w="SELECT station, CASE WHEN hour(ts) <> 5 THEN date_trunc('hour', ts) END AS hour, round(avg(temperature), 6) AS temperature, count(*) AS value FROM wx GROUP BY ALL",
    t="SELECT station, CASE WHEN hour(ts) <> 5 THEN date_trunc('hour', ts) END AS hour, round(avg(vehicle_count), 6) AS vehicle_count FROM traffic GROUP BY ALL"))
def outer_join_feeds(spark, sf):
    def hourly(df, col, count=True):
        hour = F.when(F.hour("ts") != 5, F.date_trunc("hour", "ts").cast("timestamp_ntz")).alias("hour")
        n = [F.count("*").alias("value")] if count else []
        return df.groupBy("station", hour).agg(F.round(F.avg(col), 6).alias(col), *n)
    return J.join_feeds(hourly(V.air_wide(spark, sf), "o3"), hourly(V.wx(spark, sf), "temperature"),
                        hourly(V.traffic(spark, sf), "vehicle_count", False), ["station", "hour"])


@query("scale_repair", sql("hourly_station traffic", """SELECT y.station, y.ts, floor(y.pm25 * s.scale * 1e6 + 0.5) / 1e6 AS pm25, round(s.scale, 6) AS scale FROM y JOIN s USING (station)""",
    y="SELECT station, ts, pm25 / 20 AS pm25 FROM hourly_station",
    l="SELECT station, arg_max(pm25, ts) FILTER (WHERE pm25 IS NOT NULL) AS last FROM y GROUP BY station",
    v="SELECT station, arg_max(vehicle_count, ord) AS live FROM traffic GROUP BY station",
    s="SELECT station, CASE WHEN abs(last) < 10 AND live > last * 3 + 10 THEN least(greatest(live / CASE WHEN last = 0 THEN 1 ELSE last END, 1), 1000) ELSE 1 END AS scale FROM l LEFT JOIN v USING (station)"))
def scale_repair(spark, sf):
    y = V.hourly_station(spark, sf).withColumn("pm25", F.col("pm25") / 20)
    live = V.traffic(spark, sf).select("station", "ts", "ord", "vehicle_count")
    out = T.repair_scale(y, live, ["station"], "ts", "pm25", "ts", "vehicle_count", ["ord"])
    # Compared to six decimals, cut the same way on both sides.
    return out.select("station", "ts", (F.floor(F.col("pm25") * 1e6 + 0.5) / 1e6).alias("pm25"), F.round("scale", 6).alias("scale"))


def training(spark, sf):
    """Training frame from two air sources, weather, and a live feed."""
    scored = score_aqi(V.air_wide(spark, sf), "in_strict").select("station", F.col("ts").alias("timestamp"), "aqi", "ord")
    sources = J.union_feeds(scored.where("ord % 2 = 0"), scored.where("ord % 2 = 1"))
    weather = V.wx(spark, sf).select("station", F.col("ts").alias("time"), "ord", "temperature", "humidity", "windspeed",
                                     F.lit(None).cast("double").alias("pressure"))
    live = V.traffic(spark, sf).select("station", F.col("ts").alias("timestamp"), "ord", F.col("vehicle_count").alias("aqi_value"))
    return T.training_frame(sources, weather, live, ["station"], ["ord"])


@query("training_series_text_time", sql("dirty_ts", """SELECT g.station, g.timestamp, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY g.station ORDER BY g.timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
 last_value(v IGNORE NULLS) OVER (PARTITION BY g.station ORDER BY g.timestamp DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS aqi FROM g LEFT JOIN h ON g.station = h.station AND g.timestamp = h.h""",
    p="SELECT station, ord, CAST(ord % 500 AS DOUBLE) AS v, CASE WHEN raw_ts = 'not a time' THEN NULL ELSE TRY_CAST(regexp_replace(raw_ts, '\\+00:00$', '') AS TIMESTAMP) END AS ts FROM dirty_ts",
    h="SELECT station, date_trunc('hour', ts) AS h, arg_max(v, struct_pack(ts := ts, ord := ord)) AS v FROM p WHERE ts IS NOT NULL GROUP BY ALL",
    g="SELECT station, unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS timestamp FROM h GROUP BY station"))
def training_series_text_time(spark, sf):
    """Times as text, some of them none: rows without a time are left out."""
    rows = V.dirty_ts(spark, sf).select("station", "ord", F.col("raw_ts").alias("time"), (F.col("ord") % 500).cast("string").alias("aqi"))
    return T.training_series(rows, ["station"], ["ord"])


@query("merge_masters", sql("air wx traffic", """SELECT coalesce(a.ts, w.ts, t.ts) AS timestamp, o3, a.station AS station_aqi_x, w.station AS station_weather, temperature, vehicle_count, t.station AS station
 FROM (SELECT ts, station, o3 FROM air) a FULL JOIN (SELECT ts, station, temperature FROM wx) w ON a.ts = w.ts FULL JOIN (SELECT ts, station, vehicle_count FROM traffic) t ON coalesce(a.ts, w.ts) = t.ts""".replace("station_aqi_x", "station_aqi")))
def merge_masters(spark, sf):
    """Three raw feeds, each with a time column of another name."""
    a = V.air_wide(spark, sf).select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("reading_time"), "station", "o3")
    w = V.wx(spark, sf).select(F.col("ts").alias("obs_date"), "station", "temperature")
    t = V.traffic(spark, sf).select("station", F.col("ts").alias("timestamp"), "vehicle_count")
    return J.merge_masters(a, w, t)


TRAINING = {
    **STRICT,
    "h": "SELECT station, date_trunc('hour', ts) AS h, arg_max(struct_pack(v := aqi), ord).v AS aqi FROM strict GROUP BY ALL",
    "g": "SELECT station, unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS timestamp FROM h GROUP BY station",
    "r": "SELECT g.station, g.timestamp, CAST(aqi AS DOUBLE) AS aqi FROM g LEFT JOIN h ON g.station = h.station AND g.timestamp = h.h",
    "y": """SELECT station, timestamp, coalesce(last_value(aqi IGNORE NULLS) OVER (PARTITION BY station ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
 last_value(aqi IGNORE NULLS) OVER (PARTITION BY station ORDER BY timestamp DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS aqi FROM r""",
    "lst": "SELECT station, arg_max(aqi, timestamp) FILTER (WHERE aqi IS NOT NULL) AS last FROM y GROUP BY station",
    "live": "SELECT station, arg_max(vehicle_count, ord) AS live FROM traffic GROUP BY station",
    "sc": "SELECT station, CASE WHEN abs(last) < 10 AND live > last * 3 + 10 THEN least(greatest(live / CASE WHEN last = 0 THEN 1 ELSE last END, 1), 1000) ELSE 1 END AS scale FROM lst LEFT JOIN live USING (station)",
    "z": "SELECT station, timestamp, least(greatest(aqi * scale, 0), 500) AS aqi, CAST(scale AS DOUBLE) AS scale FROM y JOIN sc USING (station) WHERE aqi IS NOT NULL",
    "nr": """SELECT z.station, z.timestamp, z.aqi, z.scale, w.temperature, w.humidity, w.windspeed,
 row_number() OVER (PARTITION BY z.station, z.timestamp ORDER BY abs(epoch_us(z.timestamp) - epoch_us(w.ts)), w.ts DESC) AS rn
 FROM z LEFT JOIN wx w ON z.station = w.station AND w.ts BETWEEN z.timestamp - INTERVAL 1 HOUR AND z.timestamp + INTERVAL 1 HOUR""",
    "tf": "SELECT station, timestamp, aqi, scale, " + ", ".join(
        f"coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY station ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), last_value({c} IGNORE NULLS) OVER (PARTITION BY station ORDER BY timestamp DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS {c}"
        for c in ("temperature", "humidity", "windspeed")) + " FROM nr WHERE rn = 1",
}


@query("training_frame", sql("air wx traffic", "SELECT station, timestamp, round(aqi, 6) AS aqi, round(scale, 6) AS scale, temperature, humidity, windspeed FROM tf", **TRAINING))
def training_frame(spark, sf):
    return training(spark, sf).withColumns({"aqi": F.round("aqi", 6), "scale": F.round("scale", 6)})
