"""Profile, ranking, daily and correlation queries."""

from pyspark.sql import functions as F

from hazeframe.catalog import views as V
from hazeframe.catalog.registry import query, sql
from hazeframe.operators import joins as J
from hazeframe.operators import profile as P
from hazeframe.operators import sketches as S
from hazeframe.plans.daily import combined_daily as combine
from hazeframe.plans.daily import daily_table
from hazeframe.session import stored

NUMS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def nums(spark, sf):
    return V.table(spark, sf, "lineitem").select(*NUMS)


@query("daily_median", sql("", """SELECT CAST(l_shipdate AS DATE) AS date, median(l_quantity) AS l_quantity, median(l_extendedprice) AS l_extendedprice, median(l_discount) AS l_discount,
 median(l_tax) AS l_tax FROM lineitem GROUP BY 1"""))
def daily_median(spark, sf):
    return P.daily_median(V.table(spark, sf, "lineitem"), "l_shipdate", NUMS)


@query("daily_outer_join", sql("", """SELECT coalesce(a.date, b.date) AS date, l_quantity, l_extendedprice, o_totalprice FROM
 (SELECT CAST(l_shipdate AS DATE) AS date, median(l_quantity) AS l_quantity, median(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY 1) a
 FULL JOIN (SELECT CAST(o_orderdate AS DATE) AS date, median(o_totalprice) AS o_totalprice FROM orders GROUP BY 1) b ON a.date = b.date"""))
def daily_outer_join(spark, sf):
    """Daily medians of two tables side by side."""
    a = P.daily_median(V.table(spark, sf, "lineitem"), "l_shipdate", NUMS[:2])
    return J.outer_join(a, P.daily_median(V.table(spark, sf, "orders"), "o_orderdate", ["o_totalprice"]), ["date"])


@query("hour_of_day_mean", sql("traffic", "SELECT CAST(hour(ts) AS INTEGER) AS hour, round(avg(vehicle_count), 6) AS vehicle_count FROM traffic GROUP BY 1"))
def hour_of_day_mean(spark, sf):
    return P.hour_of_day_mean(V.traffic(spark, sf), "ts", ["vehicle_count"]).withColumn("vehicle_count", F.round("vehicle_count", 6))


@query("station_median_top10", sql("air", "SELECT station, median(pm25) AS pm25 FROM air GROUP BY station ORDER BY pm25 DESC, station LIMIT 10"))
def station_median_top10(spark, sf):
    return P.top_medians(V.air_wide(spark, sf), "station", "pm25")


@query("describe_numeric", sql("", " UNION ALL ".join(f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min,
 quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS max FROM lineitem""" for c in NUMS)))
def describe_numeric(spark, sf):
    return P.describe(nums(spark, sf), NUMS).withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query("boxplot_stats", sql("", " UNION ALL ".join(f"""SELECT '{c}' AS column_name, q1, median, q3, min({c}) FILTER (WHERE {c} BETWEEN lo AND hi) AS whisker_low,
 max({c}) FILTER (WHERE {c} BETWEEN lo AND hi) AS whisker_high, count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS outliers
 FROM lineitem, (SELECT q1, median, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3 FROM lineitem)) GROUP BY q1, median, q3""" for c in NUMS)))
def boxplot_stats(spark, sf):
    return P.boxplot(nums(spark, sf), NUMS)


SKETCHED = (0.05, 0.25, 0.5, 0.9, 0.99)


@query("sketch_quantiles", sql("", " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST(p AS DOUBLE) AS prob, count({c}) AS n, true AS within FROM lineitem, (VALUES {', '.join(f'({p})' for p in SKETCHED)}) v(p) GROUP BY p" for c in NUMS)))
def sketch_quantiles(spark, sf):
    """Quantiles of the whole table from its daily sketches, and whether the true rank of
    each lies within the sketch's error."""
    rows = V.table(spark, sf, "lineitem")
    daily = stored(S.daily_sketches(rows, "l_shipdate", NUMS), "daily-sketches")
    answers = stored(S.sketch_quantiles(S.merged(daily, ["column_name"]), SKETCHED), "answers")
    values = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in NUMS])).alias("_e"))
    ranks = values.select("_e.*").join(F.broadcast(answers), F.col("c") == F.col("column_name")).groupBy("column_name", "prob").agg(
        F.max("n").alias("n"), F.count_if(F.col("v") < F.col("value")).alias("below"), F.count_if(F.col("v") <= F.col("value")).alias("upto"))
    error = S.rank_error() * F.col("n") + 1
    at = F.col("prob") * F.col("n")
    return ranks.select("column_name", "prob", "n", ((F.col("below") - error <= at) & (F.col("upto") + error >= at)).alias("within"))


NULLED = ("ord", "ts", "station", "temperature", "humidity", "windspeed", "pressure")


@query("null_profile", sql("null_rows", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM null_rows" for c in NULLED)))
def null_profile(spark, sf):
    return P.null_profile(V.null_rows(spark, sf))


def _cover(name, view, ts):
    return f"SELECT '{name}' AS feed, count(*) AS rows_total, count({ts}) AS rows_with_time, CAST(min({ts}) AS DATE) AS first_date, CAST(max({ts}) AS DATE) AS last_date, count(DISTINCT CAST({ts} AS DATE)) AS dates FROM {view}"


@query("coverage_profile", sql("air wx traffic", " UNION ALL ".join([_cover("aqi", "air", "ts"), _cover("weather", "wx", "(CASE WHEN ord % 10 <> 0 THEN ts END)"), _cover("traffic", "traffic", "ts")])))
def coverage_profile(spark, sf):
    w = V.wx(spark, sf).selectExpr("case when ord % 10 <> 0 then ts end as ts")
    return P.coverage({"aqi": (V.air_wide(spark, sf), "ts"), "weather": (w, "ts"), "traffic": (V.traffic(spark, sf), "ts")})


def _corr_sql(cols, source):
    return " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM {source}" for a in cols for b in cols)


@query("corr_matrix", sql("", _corr_sql(NUMS, "lineitem")))
def corr_matrix(spark, sf):
    return P.corr_matrix(nums(spark, sf), NUMS).withColumn("corr", F.round("corr", 6))


DAILY = {
    "dw": "SELECT CAST(ts AS DATE) AS date, median(temperature) AS temperature, median(humidity) AS humidity, median(n) AS n FROM (SELECT *, value AS n FROM wx JOIN (SELECT ord, value FROM ev) USING (ord)) GROUP BY 1",
    "dt": "SELECT CAST(ts AS DATE) AS date, median(vehicle_count) AS vehicle_count, median(confidence) AS confidence, median(k) AS n FROM (SELECT * FROM traffic JOIN (SELECT ord, k FROM ev) USING (ord)) WHERE day(ts) <> 5 GROUP BY 1",
    "da": "SELECT CAST(ts AS DATE) AS date, median(pm25) AS pm25, median(o3) AS o3 FROM air WHERE day(ts) <> 7 GROUP BY 1",
    "comb": """SELECT coalesce(wt.date, da.date) AS date, temperature, humidity, n_w, vehicle_count, confidence, n_t, pm25, o3 FROM (
 SELECT coalesce(dw.date, dt.date) AS date, temperature, humidity, dw.n AS n_w, vehicle_count, confidence, dt.n AS n_t FROM dw FULL JOIN dt ON dw.date = dt.date) wt FULL JOIN da ON wt.date = da.date""",
}
DAILY_COLS = ["temperature", "humidity", "n_w", "vehicle_count", "confidence", "n_t", "pm25", "o3"]


def daily(spark, sf):
    ev = V.events(spark, sf)
    w = ev.where("event_type = 'purchase'").selectExpr("ts as `Recorded Time`", "concat(cast(value / 10D - 5D as string), ' C') as Temperature", "cast(k as double) as Humidity", "value as N")
    t = ev.where("event_type = 'error' and day(ts) <> 5").selectExpr("ts as timestamp", "value * 2D as vehicle_count", "1D - k / 1000D as confidence", "k as n")
    a = V.air_wide(spark, sf).where("day(ts) <> 7").select("ts", "pm25", "o3").withColumnRenamed("ts", "Timestamp")
    return combine(daily_table(w), daily_table(t), daily_table(a))


@query("combined_daily", sql("ev air wx traffic", "SELECT * FROM comb", **DAILY))
def combined_daily(spark, sf):
    return daily(spark, sf)


@query("top_corr_pairs", sql("ev air wx traffic", f"SELECT a, b, abs_corr FROM (SELECT a, b, round(abs(corr), 6) AS abs_corr FROM cc) WHERE abs_corr IS NOT NULL AND NOT isnan(abs_corr) ORDER BY abs_corr DESC, a, b LIMIT 12", **DAILY,
    cc=" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM comb" for i, a in enumerate(DAILY_COLS) for b in DAILY_COLS[i + 1:])))
def top_corr_pairs(spark, sf):
    return P.top_pairs(daily(spark, sf), DAILY_COLS)


@query("sort_nulls_last", sql("wx", "SELECT ord, CASE WHEN ord % 10 <> 0 THEN ts END AS ts, temperature FROM wx ORDER BY ts ASC NULLS LAST, ord"))
def sort_nulls_last(spark, sf):
    rows = V.wx(spark, sf).selectExpr("ord", "case when ord % 10 <> 0 then ts end as ts", "temperature")
    return rows.orderBy(F.col("ts").asc_nulls_last(), "ord")


@query("tail_10", sql("air", "SELECT ord, ts, station, pm25 FROM air ORDER BY ts DESC, ord DESC LIMIT 10"))
def tail_10(spark, sf):
    return P.tail(V.air_wide(spark, sf).select("ord", "ts", "station", "pm25"), ["ts", "ord"])


@query("join_ranges", sql("", """SELECT c_custkey, c_nationkey, c_acctbal, s_suppkey, lo, hi FROM customer LEFT JOIN
 (SELECT s_suppkey, s_nationkey, s_acctbal AS lo, CASE WHEN s_suppkey % 10 <> 0 THEN s_acctbal + (s_suppkey % 50) * 10 END AS hi FROM supplier)
 ON c_nationkey = s_nationkey AND c_acctbal >= lo AND (hi IS NULL OR c_acctbal <= hi)"""))
def join_ranges(spark, sf):
    """A table of bands that belongs to the user, some open above, by group."""
    bands = V.table(spark, sf, "supplier").select(
        "s_suppkey", F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("lo"),
        F.when(F.col("s_suppkey") % 10 != 0, F.col("s_acctbal") + (F.col("s_suppkey") % 50) * 10).alias("hi"))
    rows = V.table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return J.join_ranges(rows, bands, ["c_nationkey"], "c_acctbal")
