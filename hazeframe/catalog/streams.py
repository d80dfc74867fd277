"""Streaming queries: drain the landed events and read the result back."""

from pyspark.sql import functions as F

from hazeframe.catalog import views as V
from hazeframe.catalog.registry import query, sql
from hazeframe.functions.casts import hour_of
from hazeframe.sources import live
from hazeframe.streaming import ingest as S
from hazeframe.streaming.silence import rocksdb, silent_stations

WIDE = "40 days"  # the events span 30 days, so no row of the test tables is late


def _events(spark, sf):
    schema = V.table(spark, sf, "events").schema
    # A pattern, as the source takes no plain file; it matches this one name only.
    return S.landed(spark, f"{sf}/events.parque[t]", schema), schema


def _air(spark, sf):
    return V.shape_air(V.shape_events(_events(spark, sf)[0]))


@query("stream_ingest", sql("air", "SELECT ord, ts, station, pm25 FROM air"))
def stream_ingest(spark, sf):
    out, check = S.folders(spark, "ingest")
    rows = _air(spark, sf).select("ord", F.col("ts").cast("timestamp_ntz").alias("ts"), "station", "pm25")
    S.append_rows(rows, out, check)
    return spark.read.parquet(out)


@query("stream_dedup", sql("ev", "SELECT DISTINCT station, date_trunc('minute', ts) AS minute FROM ev"))
def stream_dedup(spark, sf):
    out, check = S.folders(spark, "dedup")
    rows = V.shape_events(_events(spark, sf)[0]).withColumn("minute", F.date_trunc("minute", "ts").cast("timestamp_ntz"))
    S.append_rows(S.dedup_stream(rows.select("station", "minute", "ts"), ["station", "minute"], WIDE).select("station", "minute"), out, check)
    return spark.read.parquet(out)


@query("stream_hourly_mean", sql("air", "SELECT station, date_trunc('hour', ts) AS hour, round(avg(pm25), 6) AS pm25, round(avg(o3), 6) AS o3 FROM air GROUP BY ALL"))
def stream_hourly_mean(spark, sf):
    out, check = S.folders(spark, "hourly")
    S.change_log(S.hourly_mean_stream(_air(spark, sf), ["station"], ["pm25", "o3"], WIDE), out, check)
    return S.read_log(spark, out, ["station", "hour"]).withColumns({c: F.round(c, 6) for c in ("pm25", "o3")})


@query("stream_o3_8h", sql("air", """SELECT station, e AS window_end, round(avg(o3), 6) AS mean, count(o3) AS readings FROM (
 SELECT station, o3, unnest(generate_series(date_trunc('hour', ts) + INTERVAL 1 HOUR, date_trunc('hour', ts) + INTERVAL 8 HOUR, INTERVAL 1 HOUR)) AS e FROM air) GROUP BY ALL"""))
def stream_o3_8h(spark, sf):
    out, check = S.folders(spark, "o3")
    S.change_log(S.sliding_mean_stream(_air(spark, sf), ["station"], "o3", delay=WIDE), out, check)
    return S.read_log(spark, out, ["station", "window_end"]).withColumn("mean", F.round("mean", 6))


@query("stream_upsert", sql("air", "SELECT station, date_trunc('hour', ts) AS hour, min(ord) AS first_ord, max(ord) AS last_ord, arg_max(o3, ord) AS o3, arg_max(pm10, ord) AS pm10 FROM air GROUP BY ALL"))
def stream_upsert(spark, sf):
    out, check = S.folders(spark, "upsert")
    rows = _air(spark, sf).select("station", hour_of(F.col("ts")).alias("hour"), "ord", F.col("ord").alias("first_ord"),
                                  F.col("ord").alias("last_ord"), "o3", "pm10")
    S.upsert_stream(rows, out, check, ["station", "hour"], ["first_ord"], ["last_ord", "o3", "pm10"], ["ord"])
    return S.read_upserts(spark, out, ["station", "hour"])


@query("stream_interval_join", sql("air wx", """SELECT ord, station, wx_ord, wx_temperature FROM (SELECT a.ord, a.station, w.ord AS wx_ord, w.temperature AS wx_temperature,
 row_number() OVER (PARTITION BY a.ord ORDER BY abs(epoch_us(a.ts) - epoch_us(w.ts)), w.ts DESC) AS rn FROM air a LEFT JOIN wx w ON a.station = w.station AND w.ts BETWEEN a.ts - INTERVAL 1 HOUR AND a.ts + INTERVAL 1 HOUR) WHERE rn = 1"""))
def stream_interval_join(spark, sf):
    out, check = S.folders(spark, "interval")
    weather = V.shape_wx(V.shape_events(_events(spark, sf)[0])).select("station", "ts", "ord", "temperature")
    readings = _air(spark, sf).select("ord", "ts", "station")
    S.nearest_weather_stream(readings, weather, ["station"], "ts", ["ord"], out, check, delay=WIDE)
    return S.read_nearest(V.air_wide(spark, sf).select("ord", "station"), out, ["ord"]).select("ord", "station", "wx_ord", "wx_temperature")


FILES = 6
# The first file that a row lands in; every 50th row comes two files late.
LANDED = f"""SELECT *, CAST(least(({FILES} * (ord - lo)) // (hi - lo + 1), {FILES - 1}) AS BIGINT) AS own FROM ev, (SELECT min(ord) AS lo, max(ord) AS hi FROM ev)"""


@query("stream_late_rows", sql("ev", """SELECT station, date_trunc('hour', ts) AS hour, round(avg(value), 6) AS value FROM batched
 LEFT JOIN newest ON newest.own = file - 2 WHERE seen IS NULL OR date_trunc('hour', ts) + INTERVAL 1 HOUR > seen - INTERVAL 2 HOUR GROUP BY ALL""",
    landed=LANDED,
    batched=f"SELECT *, CASE WHEN ord % 50 = 0 THEN least(own + 2, {FILES - 1}) ELSE own END AS file FROM landed",
    top="SELECT file AS own, max(ts) AS newest FROM batched GROUP BY 1",
    newest="SELECT own, max(newest) OVER (ORDER BY own) AS seen FROM top"))
def stream_late_rows(spark, sf):
    """Hourly means over six landings with a delay of two hours. A row is cut off when its
    hour lies behind the watermark, which Spark raises one batch after the rows that set it."""
    out, check = S.folders(spark, "late")
    stream = _landings(spark, sf, f"{out}-inbox")
    S.change_log(S.hourly_mean_stream(stream, ["station"], ["value"], "2 hours"), out, check)
    return S.read_log(spark, out, ["station", "hour"]).withColumn("value", F.round("value", 6))


def _landings(spark, sf, inbox):
    """The events in six landings, as LANDED deals them."""
    events = V.events(spark, sf)
    span = events.agg(F.min("ord").alias("lo"), F.max("ord").alias("hi")).first()
    own = F.least(F.floor(F.lit(FILES) * (F.col("ord") - F.lit(span["lo"])) / F.lit(span["hi"] - span["lo"] + 1)), F.lit(FILES - 1))
    file = F.when(F.col("ord") % 50 == 0, F.least(own + 2, F.lit(FILES - 1))).otherwise(own)
    rows = events.select("ord", "ts", "station", "value").withColumn("_file", file)
    for k in range(FILES):
        rows.where(F.col("_file") == k).drop("_file").coalesce(1).write.parquet(f"{inbox}/{k}")
    return S.landed(spark, inbox, rows.drop("_file").schema, files_per_trigger=1, nested=True)


BATCHED = {
    "landed": LANDED,
    "batched": f"SELECT *, CASE WHEN ord % 50 = 0 THEN least(own + 2, {FILES - 1}) ELSE own END AS file FROM landed",
    "top": "SELECT file AS own, max(ts) AS newest FROM batched GROUP BY 1",
    "newest": "SELECT own, max(newest) OVER (ORDER BY own) AS seen FROM top",
}


@query("stream_silence", sql("ev", """SELECT station, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS readings, arg_max(round(value, 6), ts) FILTER (WHERE value IS NOT NULL) AS value
 FROM spells GROUP BY station, spell HAVING max(ts) + INTERVAL 2 HOUR < (SELECT date_trunc('millisecond', max(ts)) FROM batched) - INTERVAL 2 HOUR""", **BATCHED,
    kept="SELECT station, date_trunc('millisecond', ts) AS ts, value FROM batched LEFT JOIN newest ON newest.own = file - 2 WHERE seen IS NULL OR ts >= seen - INTERVAL 2 HOUR",
    marked="SELECT *, ts > lag(ts) OVER (PARTITION BY station ORDER BY ts) + INTERVAL 2 HOUR AS fresh FROM kept",
    spells="SELECT *, count(*) FILTER (fresh) OVER (PARTITION BY station ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS spell FROM marked"))
def stream_silence(spark, sf):
    """Stations that sent nothing for two hours, over six landings with late rows."""
    out, check = S.folders(spark, "silence")
    with rocksdb(spark):
        S.append_rows(silent_stations(_landings(spark, sf, f"{out}-inbox"), ["station"], "ts", "value", "2 hours", "2 hours"), out, check)
    return spark.read.parquet(out).withColumn("value", F.round("value", 6))


@query("stream_live_table", sql("air", "SELECT station, date_trunc('hour', ts) AS hour, max(ord) AS last_ord, arg_max(o3, ord) AS o3 FROM air GROUP BY ALL"))
def stream_live_table(spark, sf):
    """A stream upserted into a live table: each batch is one swap, numbered by its id."""
    out, check = S.folders(spark, "live")
    rows = _air(spark, sf).select("station", hour_of(F.col("ts")).alias("hour"), "ord", F.col("ord").alias("last_ord"), "o3")
    S.live_upserts(rows, out, check, ["station", "hour"], [], ["last_ord", "o3"], ["ord"])
    return live.read_live(spark, out)


@query("stream_last_valid", sql("air", "SELECT station, arg_max(pm25, ord) FILTER (WHERE pm25 IS NOT NULL) AS pm25, arg_max(o3, ord) AS o3 FROM air GROUP BY station"))
def stream_last_valid(spark, sf):
    out, check = S.folders(spark, "last")
    S.change_log(S.last_valid_stream(_air(spark, sf), ["station"], ["ts", "ord"], ["pm25", "o3"]), out, check)
    return S.read_log(spark, out, ["station"])
