"""Current state, advice and what-if queries."""

from pyspark.sql import functions as F

from hazeframe.catalog import views as V
from hazeframe.catalog.ordered import O3
from hazeframe.catalog.registry import query, sql
from hazeframe.catalog.scoring import IN_CATEGORY, LINE, REPORT_BANDS, STRICT, US_CATEGORY, bands_cte, long_cte
from hazeframe.functions.aqi import category, score_aqi
from hazeframe.plans import report as R


def snap(spark, sf):
    """Snapshot inputs: some stations lack weather or traffic, ozone is thinned out."""
    air = V.air_wide(spark, sf).withColumn("o3", F.expr("case when ord % 9 <> 0 and (station % 3 <> 0 or ord % 40 = 0) then o3 end"))
    weather = V.wx(spark, sf).where("station % 5 <> 1")
    traffic = V.traffic(spark, sf).where("station % 4 <> 2").withColumn("avg_speed", F.col("currentSpeed").cast("double"))
    return R.snapshot(air, weather, traffic, ["station"], "ts", "ord")


def _arg(c, view, name=None):
    return f"arg_max({c}, ord) FILTER (WHERE {c} IS NOT NULL) AS {name or c}"


SNAP = {
    **O3,
    "o8": """SELECT station, last AS o3_raw, CASE WHEN hn >= 8 THEN round_even(hm, 2) WHEN n >= 8 THEN round_even(rm, 2) ELSE last END AS o3_used,
 CASE WHEN hn >= 8 THEN '8hr_resample' WHEN n >= 8 THEN '8hr_rolling' ELSE 'instant' END AS o3_method FROM st LEFT JOIN rs USING (station) LEFT JOIN hs USING (station)""",
    "lv": "SELECT station, " + ", ".join(_arg(c, "air") for c in ("pm25", "pm10", "no2", "so2", "nh3")) + " FROM air GROUP BY station",
    "lw": "SELECT station, arg_max(windspeed, ord) AS windspeed, arg_max(humidity, ord) AS humidity, arg_max(precipitation, ord) AS precipitation, arg_max(visibility, ord) AS visibility, true AS hw FROM wx WHERE station % 5 <> 1 GROUP BY station",
    "lt": "SELECT station, arg_max(vehicle_count, ord) AS vehicle_count, arg_max(CAST(currentSpeed AS DOUBLE), ord) AS avg_speed, true AS ht FROM traffic WHERE station % 4 <> 2 GROUP BY station",
    "snap": """SELECT lv.station, pm25, pm10, no2, so2, nh3, o3_raw, o3_used, o3_method, windspeed, humidity, precipitation, visibility, coalesce(hw, false) AS has_weather,
 vehicle_count, avg_speed, coalesce(ht, false) AS has_traffic FROM lv JOIN o8 USING (station) LEFT JOIN lw USING (station) LEFT JOIN lt USING (station)""",
    "bp": bands_cte(REPORT_BANDS),
    "long": long_cte("snap", {"pm25": "pm25", "pm10": "pm10", "no2": "no2", "so2": "so2", "o3": "o3_used", "nh3": "nh3"}, "station"),
    "si": f"""SELECT station, l.pollutant, pos, CASE WHEN conc > (SELECT max(hi) FROM bp b WHERE b.pollutant = l.pollutant) THEN (SELECT max(i_hi) FROM bp b WHERE b.pollutant = l.pollutant)
 ELSE round_even({LINE}, 2) END AS s FROM long l LEFT JOIN bp ON l.pollutant = bp.pollutant AND conc BETWEEN lo AND hi""",
    "sc": "SELECT station, CAST(round_even(max(s), 0) AS INTEGER) AS aqi, (list(pollutant ORDER BY s DESC, pos) FILTER (WHERE s IS NOT NULL))[1] AS dominant FROM si GROUP BY station",
}


@query("current_snapshot", sql("air wx traffic", f"SELECT snap.*, aqi, dominant, {IN_CATEGORY} AS category FROM snap JOIN sc USING (station)", **SNAP))
def current_snapshot(spark, sf):
    out = R.scored(snap(spark, sf))
    return out.select(*[c for c in out.columns if not c.startswith("si_")])


@query("reason_codes", sql("air wx traffic", """SELECT station, array_to_string(list_filter([CASE WHEN dominant IS NOT NULL THEN 'DOMINANT' END, 'O3_DIAGNOSTIC',
 CASE WHEN windspeed < 2 THEN 'LOW_WIND' END, CASE WHEN windspeed >= 2 AND windspeed < 4 THEN 'LIGHT_WIND' END, CASE WHEN windspeed >= 4 THEN 'HELPFUL_WIND' END,
 CASE WHEN humidity > 75 THEN 'HIGH_HUMIDITY' END, CASE WHEN precipitation > 0 THEN 'RAIN' END, CASE WHEN visibility < 2000 THEN 'LOW_VISIBILITY' END,
 CASE WHEN vehicle_count > 400 THEN 'HIGH_TRAFFIC' WHEN vehicle_count > 200 THEN 'MODERATE_TRAFFIC' END, CASE WHEN avg_speed < 20 THEN 'LOW_SPEED' END,
 CASE WHEN NOT has_weather THEN 'NO_WEATHER' END, CASE WHEN NOT has_traffic THEN 'NO_TRAFFIC' END], lambda x: x IS NOT NULL), ',') AS reasons FROM snap JOIN sc USING (station)""", **SNAP))
def reason_codes(spark, sf):
    return R.scored(snap(spark, sf)).select("station", F.array_join(R.reason_codes(), ",").alias("reasons"))


@query("suggestion_codes", sql("air wx traffic", """SELECT station, array_to_string(list_filter([CASE WHEN dominant = 'pm25' THEN 'AVOID_EXERCISE' WHEN dominant = 'pm10' THEN 'LIMIT_DUST' WHEN dominant IS NOT NULL THEN 'MONITOR' END,
 CASE WHEN windspeed < 2 THEN 'CUT_LOCAL_EMISSIONS' END, CASE WHEN precipitation > 0 THEN 'EXPECT_WASHOUT' END], lambda x: x IS NOT NULL), ',') AS suggestions FROM snap JOIN sc USING (station)""", **SNAP))
def suggestion_codes(spark, sf):
    return R.scored(snap(spark, sf)).select("station", F.array_join(R.suggestion_codes(), ",").alias("suggestions"))


REPORT_LABELS = {"pm25": "PM2.5", "pm10": "PM10", "no2": "NO2", "so2": "SO2", "o3": "O3", "nh3": "NH3"}
NOW = "2024-02-01 00:00:00"


def _text(code, *cols):
    """A report text as SQL, its places filled with columns."""
    parts = R.REASONS[code].replace("%%", "%").split("%s")
    out = []
    for k, part in enumerate(parts):
        out.append("'" + part.replace("'", "''") + "'")
        if k < len(cols):
            out.append(f"coalesce(CAST({cols[k]} AS VARCHAR), 'null')")
    return " || ".join(out)


REPORT = {
    **SNAP,
    "wide": "SELECT station, " + ", ".join(f"max(s) FILTER (WHERE pollutant = '{p}') AS si_{p}" for p in REPORT_LABELS) + " FROM si GROUP BY station",
    "doc": "SELECT snap.*, sc.aqi, sc.dominant, " + ", ".join(f"si_{p}" for p in REPORT_LABELS) + f""",
 CASE dominant {' '.join(f"WHEN '{p}' THEN '{l}'" for p, l in REPORT_LABELS.items())} END AS label, CASE dominant {' '.join(f"WHEN '{p}' THEN si_{p}" for p in REPORT_LABELS)} END AS top,
 {IN_CATEGORY} AS category FROM snap JOIN sc USING (station) JOIN wide USING (station) WHERE aqi IS NOT NULL""",
}


@query("current_report", sql("air wx traffic", f"""SELECT station, TIMESTAMP '{NOW}' AS timestamp, aqi, category, label AS dominant,
 pm25 AS v_pm25, pm10 AS v_pm10, no2 AS v_no2, so2 AS v_so2, o3_used AS v_o3, nh3 AS v_nh3, {', '.join(f'si_{p}' for p in REPORT_LABELS)}, o3_raw, o3_used, o3_method, 'o3' AS o3_column,
 windspeed, humidity, precipitation, visibility, vehicle_count, avg_speed,
 array_to_string(list_filter([CASE WHEN dominant IS NOT NULL THEN {_text('DOMINANT', 'label', 'top')} END, {_text('O3_DIAGNOSTIC', 'o3_raw', 'o3_used', 'o3_method', "'o3'")},
 CASE WHEN windspeed < 2 THEN {_text('LOW_WIND', 'windspeed')} WHEN windspeed < 4 THEN {_text('LIGHT_WIND', 'windspeed')} WHEN windspeed >= 4 THEN {_text('HELPFUL_WIND', 'windspeed')} END,
 CASE WHEN humidity > 75 THEN {_text('HIGH_HUMIDITY', 'humidity')} END, CASE WHEN precipitation > 0 THEN {_text('RAIN', 'precipitation')} END, CASE WHEN visibility < 2000 THEN {_text('LOW_VISIBILITY', 'visibility')} END,
 CASE WHEN vehicle_count > 400 THEN {_text('HIGH_TRAFFIC', 'vehicle_count')} WHEN vehicle_count > 200 THEN {_text('MODERATE_TRAFFIC', 'vehicle_count')} END,
 CASE WHEN avg_speed < 20 THEN {_text('LOW_SPEED', 'avg_speed')} END, CASE WHEN NOT has_weather THEN {_text('NO_WEATHER')} END, CASE WHEN NOT has_traffic THEN {_text('NO_TRAFFIC')} END], lambda x: x IS NOT NULL), '|') AS reasons,
 array_to_string(list_filter([CASE WHEN dominant = 'pm25' THEN '{R.SUGGESTIONS["AVOID_EXERCISE"]}' WHEN dominant = 'pm10' THEN '{R.SUGGESTIONS["LIMIT_DUST"]}' WHEN dominant IS NOT NULL THEN '{R.SUGGESTIONS["MONITOR"]}' END,
 CASE WHEN windspeed < 2 THEN '{R.SUGGESTIONS["CUT_LOCAL_EMISSIONS"]}' END, CASE WHEN precipitation > 0 THEN '{R.SUGGESTIONS["EXPECT_WASHOUT"]}' END], lambda x: x IS NOT NULL), '|') AS suggestions FROM doc""", **REPORT))
def current_report(spark, sf):
    """The report documents at a given time, unfolded into plain columns."""
    doc = R.report(R.scored(snap(spark, sf)), ["station"], now=F.lit(NOW).cast("timestamp_ntz"))
    values = {"pm25": "PM2.5", "pm10": "PM10", "no2": "NO2", "so2": "SO2", "o3": "O3_used_µg/m3", "nh3": "NH3"}
    return doc.select(
        "station", "timestamp", "aqi", "category", "dominant",
        *[F.col("pollutant_values_last")[l].alias(f"v_{p}") for p, l in values.items()],
        *[F.col("subindices")[l].alias(f"si_{p}") for p, l in REPORT_LABELS.items()],
        F.col("o3_diag.raw").alias("o3_raw"), F.col("o3_diag.used").alias("o3_used"), F.col("o3_diag.method").alias("o3_method"),
        F.col("o3_diag.column").alias("o3_column"), F.col("weather_snapshot.wind").alias("windspeed"), "weather_snapshot.humidity",
        F.col("weather_snapshot.precip").alias("precipitation"), "weather_snapshot.visibility",
        "traffic_snapshot.vehicle_count", "traffic_snapshot.avg_speed",
        F.array_join("reasons", "|").alias("reasons"), F.array_join("suggestions", "|").alias("suggestions"))


@query("current_snapshot_loose_names", sql("air wx traffic", f"SELECT station, snap.pm25, snap.no2, o3_method, windspeed, vehicle_count, aqi, dominant FROM snap JOIN sc USING (station)",
    **{**SNAP, "lv": "SELECT station, " + ", ".join(_arg(c, "air") for c in ("pm25", "no2")) + ", CAST(NULL AS DOUBLE) AS pm10, CAST(NULL AS DOUBLE) AS so2, CAST(NULL AS DOUBLE) AS nh3 FROM air GROUP BY station",
       "o8": "SELECT station, CAST(NULL AS DOUBLE) AS o3_raw, CAST(NULL AS DOUBLE) AS o3_used, 'no_o3_column' AS o3_method FROM st"}))
def current_snapshot_loose_names(spark, sf):
    """Raw feeds with other names, numbers as text, and no ozone column."""
    air = V.air_wide(spark, sf).select("station", "ts", "ord", F.col("pm25").cast("string").alias("PM2.5 (ug)"), F.col("no2").alias("avg_no2"))
    weather = V.wx(spark, sf).where("station % 5 <> 1").select("station", "ts", "ord", F.col("windspeed").alias("Wind_Speed (m/s)"))
    traffic = V.traffic(spark, sf).where("station % 4 <> 2").select("station", "ts", "ord", F.col("vehicle_count").alias("Vehicle Count"))
    keep = ["station", "ts", "ord"]
    snap_rows = R.snapshot(R.named(air, "air", keep), R.named(weather, "weather", keep), R.named(traffic, "traffic", keep), ["station"], "ts", "ord")
    return R.scored(snap_rows).select("station", "pm25", "no2", "o3_method", "windspeed", "vehicle_count", "aqi", "dominant")


def _advice_sql(part):
    return " ".join(f"WHEN '{row[0]}' THEN '{row[part]}'" for row in R.ADVICE)


@query("health_advisory", sql("air", f"""SELECT ord, category, CASE category {_advice_sql(1)} END AS advice, CASE category {_advice_sql(2)} END AS sensitive_advice
 FROM (SELECT ord, {US_CATEGORY} AS category FROM strict)""", **STRICT))
def health_advisory(spark, sf):
    rows = score_aqi(V.air_wide(spark, sf), "in_strict").select("ord", category(F.col("aqi")).alias("category"))
    return R.with_advice(rows, "category").select("ord", "category", "advice", "sensitive_advice")


SCENARIOS = {"baseline": 1.0, "traffic_cut": 0.8, "ev_shift": 0.7}


@query("what_if_delta", sql("air", """SELECT station, scenario, round(avg(10 + 0.6 * pm10 + 0.5 * no2 * factor + 4 * co * factor - (10 + 0.6 * pm10 + 0.5 * no2 + 4 * co)), 6) + 0 AS mean_delta,
 round(avg(10 + 0.6 * pm10 + 0.5 * no2 * factor + 4 * co * factor), 6) AS mean_predicted FROM air, (VALUES ('baseline', CAST(1.0 AS DOUBLE)), ('traffic_cut', 0.8), ('ev_shift', 0.7)) s(scenario, factor) GROUP BY ALL"""))
def what_if_delta(spark, sf):
    rows = V.air_wide(spark, sf).select("station", "pm10", "no2", "co")
    out = R.what_if(rows, SCENARIOS, ["no2", "co"], {"pm10": 0.6, "no2": 0.5, "co": 4.0}, 10.0)
    return out.groupBy("station", "scenario").agg(
        F.round(F.avg("delta"), 6).alias("mean_delta"), F.round(F.avg("predicted"), 6).alias("mean_predicted"))
