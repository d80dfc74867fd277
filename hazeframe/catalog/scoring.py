"""Index scoring queries."""

from pyspark.sql import functions as F

from hazeframe.catalog import views as V
from hazeframe.catalog.registry import query, sql
from hazeframe.functions import aqi as A
from hazeframe.functions.casts import hour_of, station_key
from hazeframe.operators.filters import keep_last
from hazeframe.operators.joins import join_bands
from hazeframe.operators.upsert import merge_measures

# The band tables of the oracle, written out so that they do not share the engine's generator.
STRICT_BANDS = """SELECT * FROM (VALUES
 ('pm25',0,30,0,50),('pm25',31,60,51,100),('pm25',61,90,101,200),('pm25',91,120,201,300),('pm25',121,250,301,400),('pm25',251,500,401,500),
 ('pm10',0,50,0,50),('pm10',51,100,51,100),('pm10',101,250,101,200),('pm10',251,350,201,300),('pm10',351,430,301,400),('pm10',431,600,401,500),
 ('no2',0,40,0,50),('no2',41,80,51,100),('no2',81,180,101,200),('no2',181,280,201,300),('no2',281,400,301,400),('no2',401,1000,401,500),
 ('o3',0,50,0,50),('o3',51,100,51,100),('o3',101,168,101,200),('o3',169,208,201,300),('o3',209,748,301,400),('o3',749,1000,401,500),
 ('so2',0,40,0,50),('so2',41,80,51,100),('so2',81,380,101,200),('so2',381,800,201,300),('so2',801,1600,301,400),('so2',1601,2000,401,500),
 ('co',0,1,0,50),('co',1.1,2,51,100),('co',2.1,10,101,200),('co',10.1,17,201,300),('co',17.1,34,301,400),('co',34.1,50,401,500)
) t(pollutant, lo0, hi0, i_lo, i_hi)"""
REPORT_BANDS = """SELECT * FROM (VALUES
 ('pm25',0,30,0,50),('pm25',31,60,51,100),('pm25',61,90,101,200),('pm25',91,120,201,300),('pm25',121,250,301,400),('pm25',251,500,401,500),
 ('nh3',0,30,0,50),('nh3',31,60,51,100),('nh3',61,90,101,200),('nh3',91,120,201,300),('nh3',121,250,301,400),('nh3',251,500,401,500),
 ('pm10',0,50,0,50),('pm10',51,100,51,100),('pm10',101,250,101,200),('pm10',251,350,201,300),('pm10',351,430,301,400),('pm10',431,600,401,500),
 ('no2',0,50,0,50),('no2',51,100,51,100),('no2',101,250,101,200),('no2',251,350,201,300),('no2',351,430,301,400),('no2',431,600,401,500),
 ('so2',0,50,0,50),('so2',51,100,51,100),('so2',101,250,101,200),('so2',251,350,201,300),('so2',351,430,301,400),('so2',431,600,401,500),
 ('o3',0,50,0,50),('o3',51,100,51,100),('o3',101,168,101,200),('o3',169,208,201,300),('o3',209,748,301,500)
) t(pollutant, lo0, hi0, i_lo, i_hi)"""
US_BANDS = """SELECT * FROM (VALUES
 ('pm25',0,12,0,50),('pm25',12.1,35.4,51,100),('pm25',35.5,55.4,101,150),('pm25',55.5,150.4,151,200),('pm25',150.5,250.4,201,300),('pm25',250.5,350.4,301,400),('pm25',350.5,500.4,401,500),
 ('pm10',0,54,0,50),('pm10',55,154,51,100),('pm10',155,254,101,150),('pm10',255,354,151,200),('pm10',355,424,201,300),('pm10',425,504,301,400),('pm10',505,604,401,500),
 ('no2',0,53,0,50),('no2',54,100,51,100),('no2',101,360,101,150),('no2',361,649,151,200),('no2',650,1249,201,300),
 ('so2',0,35,0,50),('so2',36,75,51,100),('so2',76,185,101,150),('so2',186,304,151,200),('so2',305,604,201,300),
 ('o3',0,54,0,50),('o3',55,70,51,100),('o3',71,85,101,150),('o3',86,105,151,200),('o3',106,200,201,300)
) t(pollutant, lo0, hi0, i_lo, i_hi)"""


def bands_cte(text: str) -> str:
    return f"SELECT pollutant, CAST(lo0 AS DOUBLE) AS lo, CAST(hi0 AS DOUBLE) AS hi, CAST(i_lo AS DOUBLE) AS i_lo, CAST(i_hi AS DOUBLE) AS i_hi FROM ({text})"


LINE = "(i_hi - i_lo) / (hi - lo) * (conc - lo) + i_lo"
CAPS = "CASE pollutant WHEN 'pm25' THEN 1000 WHEN 'pm10' THEN 2000 WHEN 'no2' THEN 500 WHEN 'o3' THEN 500 WHEN 'so2' THEN 2000 ELSE 50 END"


def long_cte(source: str, names: dict[str, str], key: str = "ord") -> str:
    return " UNION ALL ".join(
        f"SELECT {key}, '{p}' AS pollutant, {c} AS conc, {i} AS pos FROM {source}" for i, (p, c) in enumerate(names.items()))


STRICT_NAMES = {p: p for p in ("pm25", "pm10", "no2", "o3", "so2", "co")}
STRICT = {
    "bp": bands_cte(STRICT_BANDS),
    "long": long_cte("air", STRICT_NAMES),
    "si": f"SELECT ord, l.pollutant, pos, CAST(round_even({LINE}, 0) AS INTEGER) AS s FROM long l LEFT JOIN bp ON l.pollutant = bp.pollutant AND conc BETWEEN lo AND hi AND conc >= 0 AND conc <= ({CAPS.replace('pollutant', 'l.pollutant')})",
    "ok": "SELECT ord, max(s) AS m, count(*) AS n, count(*) FILTER (WHERE pollutant IN ('pm25', 'pm10')) AS pm, arg_max(pollutant, s * 10 - pos) AS dom FROM si WHERE s <> 0 GROUP BY ord",
    "strict": "SELECT air.*, CASE WHEN n >= 3 AND pm > 0 THEN m END AS aqi, CASE WHEN n >= 3 AND pm > 0 THEN dom END AS dominant FROM air LEFT JOIN ok USING (ord)",
}


@query("subindex_in_strict", sql("air", """SELECT ord, max(s) FILTER (WHERE pollutant = 'pm25') AS si_pm25, max(s) FILTER (WHERE pollutant = 'pm10') AS si_pm10,
 max(s) FILTER (WHERE pollutant = 'no2') AS si_no2, max(s) FILTER (WHERE pollutant = 'o3') AS si_o3,
 max(s) FILTER (WHERE pollutant = 'so2') AS si_so2, max(s) FILTER (WHERE pollutant = 'co') AS si_co FROM si GROUP BY ord""",
    **{k: STRICT[k] for k in ("bp", "long", "si")}))
def subindex_in_strict(spark, sf):
    out = A.sub_indices(V.air_wide(spark, sf), "in_strict", {p: p for p in A.IN_STRICT})
    return out.select("ord", *[f"si_{p}" for p in A.IN_STRICT])


@query("aqi_in_strict", sql("air", """SELECT ord, station, aqi, dominant,
 CASE WHEN aqi IS NULL THEN NULL ELSE (SELECT string_agg(pollutant || '=' || s, ',' ORDER BY pos) FROM si WHERE si.ord = strict.ord AND s <> 0) END AS breakdown FROM strict""", **STRICT))
def aqi_in_strict(spark, sf):
    out = A.score_aqi(V.air_wide(spark, sf), "in_strict", breakdown=True)
    m = F.col("sub_indices")
    text = F.concat_ws(",", *[F.concat(F.lit(f"{p}="), m[p].cast("string")) for p in A.IN_STRICT])
    return out.select("ord", "station", "aqi", "dominant", F.when(m.isNotNull(), text).alias("breakdown"))


REPORT_NAMES = {p: p for p in ("pm25", "pm10", "no2", "so2", "o3", "nh3")}
REPORT_SI = f"""SELECT l.*, CASE WHEN conc > (SELECT max(hi) FROM bp b WHERE b.pollutant = l.pollutant) THEN (SELECT max(i_hi) FROM bp b WHERE b.pollutant = l.pollutant)
 ELSE round_even({LINE}, 2) END AS s FROM long l LEFT JOIN bp ON l.pollutant = bp.pollutant AND conc BETWEEN lo AND hi"""


@query("subindex_in_report", sql("air", """SELECT ord, max(s) FILTER (WHERE pollutant = 'pm25') AS si_pm25, max(s) FILTER (WHERE pollutant = 'pm10') AS si_pm10,
 max(s) FILTER (WHERE pollutant = 'no2') AS si_no2, max(s) FILTER (WHERE pollutant = 'so2') AS si_so2,
 max(s) FILTER (WHERE pollutant = 'o3') AS si_o3, max(s) FILTER (WHERE pollutant = 'nh3') AS si_nh3 FROM si GROUP BY ord""",
    bp=bands_cte(REPORT_BANDS), long=long_cte("air", REPORT_NAMES), si=REPORT_SI.replace("l.*", "ord, l.pollutant, pos")))
def subindex_in_report(spark, sf):
    out = A.sub_indices(V.air_wide(spark, sf), "in_report", {p: p for p in A.IN_REPORT})
    return out.select("ord", *[f"si_{p}" for p in A.IN_REPORT])


IN_CATEGORY = "CASE WHEN aqi IS NULL THEN NULL WHEN aqi <= 50 THEN 'Good' WHEN aqi <= 100 THEN 'Satisfactory' WHEN aqi <= 200 THEN 'Moderate' WHEN aqi <= 300 THEN 'Poor' WHEN aqi <= 400 THEN 'Very Poor' ELSE 'Severe' END"
US_CATEGORY = "CASE WHEN aqi IS NULL THEN 'Unknown' WHEN aqi < 0 THEN 'Out of Range' WHEN aqi <= 50 THEN 'Good' WHEN aqi <= 100 THEN 'Moderate' WHEN aqi <= 150 THEN 'Unhealthy for Sensitive Groups' WHEN aqi <= 200 THEN 'Unhealthy' WHEN aqi <= 300 THEN 'Very Unhealthy' ELSE 'Hazardous' END"
US_COLOR = "CASE WHEN aqi IS NULL OR aqi < 0 THEN '#9E9E9E' WHEN aqi <= 50 THEN '#00E400' WHEN aqi <= 100 THEN '#FFFF00' WHEN aqi <= 150 THEN '#FF7E00' WHEN aqi <= 200 THEN '#FF0000' WHEN aqi <= 300 THEN '#8F3F97' ELSE '#7E0023' END"


@query("aqi_in_report", sql("air", f"""SELECT ord, aqi, dominant, {IN_CATEGORY} AS category FROM (
 SELECT ord, CAST(round_even(max(s), 0) AS INTEGER) AS aqi, (list(pollutant ORDER BY s DESC, pos) FILTER (WHERE s IS NOT NULL))[1] AS dominant FROM si GROUP BY ord)""",
    bp=bands_cte(REPORT_BANDS), long=long_cte("air", REPORT_NAMES), si=REPORT_SI.replace("l.*", "ord, l.pollutant, pos")))
def aqi_in_report(spark, sf):
    out = A.score_aqi(V.air_wide(spark, sf), "in_report")
    return out.select("ord", "aqi", "dominant", A.category(F.col("aqi"), "in").alias("category"))


@query("aqi_us", sql("air", """SELECT ord, max(s) FILTER (WHERE pollutant = 'pm25') AS pm25_aqi, max(s) FILTER (WHERE pollutant = 'pm10') AS pm10_aqi,
 max(s) FILTER (WHERE pollutant = 'no2') AS no2_aqi, max(s) FILTER (WHERE pollutant = 'so2') AS so2_aqi,
 max(s) FILTER (WHERE pollutant = 'o3') AS o3_aqi, max(s) FILTER (WHERE s <> 0) AS final_aqi FROM si GROUP BY ord""",
    bp=bands_cte(US_BANDS), long=long_cte("air", {p: p for p in ("pm25", "pm10", "no2", "so2", "o3")}),
    si=f"SELECT ord, l.pollutant, pos, CAST(round_even({LINE}, 0) AS INTEGER) AS s FROM long l LEFT JOIN bp ON l.pollutant = bp.pollutant AND conc BETWEEN lo AND hi AND conc <> 0"))
def aqi_us(spark, sf):
    air = V.air_wide(spark, sf)
    seen = air.withColumns({p: F.when(F.col(p) != 0, F.col(p)) for p in A.US})
    out = A.score_aqi(seen, "us")
    return out.select("ord", *[F.col(f"si_{p}").alias(f"{p}_aqi") for p in A.US], F.col("aqi").alias("final_aqi"))


@query("aqi_category", sql("ev", f"""SELECT ord, {US_CATEGORY} AS category, {US_COLOR} AS color,
 CASE WHEN ord % 3 = 0 THEN 'Invalid' ELSE {US_CATEGORY} END AS text_category FROM a""",
    a="SELECT ord, CASE WHEN ord % 10 = 0 THEN NULL ELSE CAST(trunc(CASE WHEN ord % 7 = 0 THEN -value - 1 ELSE value END) AS INTEGER) END AS aqi FROM ev"))
def aqi_category(spark, sf):
    a = V.events(spark, sf).selectExpr(
        "ord", "case when ord % 10 = 0 then null when ord % 7 = 0 then -value - 1D else value end as aqi")
    text = F.when(F.col("ord") % 3 == 0, F.lit("n/a")).otherwise(F.col("aqi").cast("int").cast("string"))
    return a.select("ord", A.category(F.col("aqi")).alias("category"), A.category_color(F.col("aqi")).alias("color"),
                    A.category_of_text(text)[0].alias("text_category"))


@query("aqi_history", sql("air", "SELECT station, date_trunc('second', ts) AS ts, pm25, CASE WHEN pm25 IS NOT NULL THEN aqi END AS aqi FROM strict", **STRICT))
def aqi_history(spark, sf):
    from hazeframe.sources.payloads import pollution_history
    rows = pollution_history(V.pollution_payloads(spark, sf), ["station"]).withColumnRenamed("pm2_5", "pm25")
    out = A.score_aqi(rows, "in_strict")
    return out.select("station", "ts", "pm25", F.when(F.col("pm25").isNotNull(), F.col("aqi")).alias("aqi"))


MEASURES = ["aqi", "pm25", "pm10", "no2", "o3", "so2", "co"]
KEYED = """SELECT *, CASE WHEN ord % 2 = 1 THEN 'NEW' ELSE 'ST' END || station AS city, CAST(20 + station % 10 AS DOUBLE) AS latitude, CAST(70 + station % 20 AS DOUBLE) AS longitude,
 printf('ST%d_%.4f_%.4f', station, CAST(20 + station % 10 AS DOUBLE), CAST(70 + station % 20 AS DOUBLE)) AS station_name, date_trunc('hour', ts) AS timestamp_hour FROM strict"""
NEWEST = "SELECT * FROM keyed WHERE ord % 2 = {odd} QUALIFY row_number() OVER (PARTITION BY station_name, timestamp_hour ORDER BY ord DESC) = 1"


@query("station_hour_upsert", sql("air", "SELECT station_name, timestamp_hour, coalesce(t.city, u.city) AS city, coalesce(t.latitude, u.latitude) AS latitude, coalesce(t.longitude, u.longitude) AS longitude, "
    + ", ".join(f"CASE WHEN u.ord IS NOT NULL THEN u.{c} ELSE t.{c} END AS {c}" for c in MEASURES) + " FROM t FULL JOIN u USING (station_name, timestamp_hour)",
    **STRICT, keyed=KEYED, t=NEWEST.format(odd=0), u=NEWEST.format(odd=1)))
def station_hour_upsert(spark, sf):
    """Odd readings are merged into a table built from the even ones; its city names stay."""
    rows = keyed_rows(A.score_aqi(V.air_wide(spark, sf), "in_strict"))
    keys, ident = ["station_name", "timestamp_hour"], ["city", "latitude", "longitude"]
    rows = rows.select(*keys, *ident, *MEASURES, "ord")
    target = keep_last(rows.where("ord % 2 = 0"), keys, ["ord"])
    updates = rows.where("ord % 2 = 1").withColumn("city", F.regexp_replace("city", "^ST", "NEW"))
    return merge_measures(target, updates, keys, ident, MEASURES, ["ord"])


def keyed_rows(scored):
    rows = scored.withColumns({
        "city": F.concat(F.lit("ST"), F.col("station").cast("string")),
        "latitude": (20 + F.col("station") % 10).cast("double"), "longitude": (70 + F.col("station") % 20).cast("double")})
    return rows.withColumns({"station_name": station_key("city", "latitude", "longitude"), "timestamp_hour": hour_of("ts")})


@query("breakpoint_join", sql("air_long", f"SELECT ord, l.pollutant, conc, lo, hi, round({LINE}, 6) AS score FROM air_long l LEFT JOIN bp ON l.pollutant = bp.pollutant AND conc BETWEEN lo AND hi",
                              bp=bands_cte(STRICT_BANDS)))
def breakpoint_join(spark, sf):
    out = join_bands(V.air_long(spark, sf), "in_strict")
    line = (F.col("i_hi") - F.col("i_lo")) / (F.col("hi") - F.col("lo")) * (F.col("conc") - F.col("lo")) + F.col("i_lo")
    return out.select("ord", "pollutant", "conc", "lo", "hi", F.round(line, 6).alias("score"))


@query("aqi_category_counts", sql("air", f"SELECT station, {US_CATEGORY} AS category, count(*) AS readings FROM strict GROUP BY ALL", **STRICT))
def aqi_category_counts(spark, sf):
    out = A.score_aqi(V.air_wide(spark, sf), "in_strict")
    return out.groupBy("station", A.category(F.col("aqi")).alias("category")).agg(F.count("*").alias("readings"))


@query("aqi_station_hour", sql("air", f"""SELECT station, hour, aqi, dominant, {US_CATEGORY} AS category FROM (
 SELECT h.station, h.hour, CASE WHEN n >= 3 AND pm > 0 THEN m END AS aqi, CASE WHEN n >= 3 AND pm > 0 THEN dom END AS dominant FROM h LEFT JOIN ok USING (ord))""",
    h="""SELECT row_number() OVER (ORDER BY station, hour) AS ord, * FROM (SELECT station, date_trunc('hour', ts) AS hour, round(avg(CASE WHEN pm25 >= 0 THEN pm25 END), 6) AS pm25, round(avg(pm10), 6) AS pm10,
 round(avg(no2), 6) AS no2, round(avg(o3), 6) AS o3, round(avg(so2), 6) AS so2, round(avg(co), 6) AS co FROM air GROUP BY ALL)""",
    bp=STRICT["bp"], long=long_cte("h", STRICT_NAMES), si=STRICT["si"], ok=STRICT["ok"]))
def aqi_station_hour(spark, sf):
    """Flagship: hourly station means, scored and named."""
    air = V.air_wide(spark, sf).withColumn("pm25", F.when(F.col("pm25") >= 0, F.col("pm25")))
    hours = air.groupBy("station", hour_of("ts").alias("hour")).agg(
        *[F.round(F.avg(p), 6).alias(p) for p in A.IN_STRICT])
    out = A.score_aqi(hours, "in_strict")
    return out.select("station", "hour", "aqi", "dominant", A.category(F.col("aqi")).alias("category"))
