"""Forecast and regression queries."""

import datetime

from pyspark.sql import functions as F

from hazeframe.catalog import views as V
from hazeframe.catalog.ordered import TRAINING, training
from hazeframe.catalog.registry import query, sql
from hazeframe.catalog.scoring import STRICT, US_CATEGORY
from hazeframe.functions.aqi import category, score_aqi
from hazeframe.operators.grid import resample_hourly
from hazeframe.operators.impute import impute_neighbours
from hazeframe.plans import forecast as M
from hazeframe.plans import learn as L
from hazeframe.plans import modelstore
from hazeframe.plans import report as R
from hazeframe.plans.orders import stepwise_orders
from hazeframe.plans.training import feature_frame as features_of
from hazeframe.session import stored


def series(spark, sf):
    """Gap-free hourly pm25 per station."""
    rows = V.hourly_station(spark, sf)
    return impute_neighbours(rows, ["station"], ["ts"], ["pm25"], bounded=True).where("pm25 is not null")


SERIES = {
    "y": """SELECT * FROM (SELECT station, ts, coalesce(last_value(pm25 IGNORE NULLS) OVER (PARTITION BY station ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
 last_value(pm25 IGNORE NULLS) OVER (PARTITION BY station ORDER BY ts DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS pm25 FROM hourly_station) WHERE pm25 IS NOT NULL""",
    "p": "SELECT station, ts, pm25, lag(pm25) OVER (PARTITION BY station ORDER BY ts) AS prev_y FROM y",
    "fit": "SELECT station, regr_slope(pm25, prev_y) AS phi, regr_intercept(pm25, prev_y) AS c, arg_max(pm25, ts) AS last_y, max(ts) AS last_ts, count(*) AS n FROM p GROUP BY station",
    "ins": "SELECT p.station, p.ts, p.pm25, p.prev_y, c + phi * prev_y AS y_pred FROM p JOIN fit USING (station)",
    "fc": "SELECT station, CAST(s AS INTEGER) AS step, last_ts + s * INTERVAL 1 HOUR AS ts, c / (1 - phi) + pow(phi, s) * (last_y - c / (1 - phi)) AS yhat FROM fit, generate_series(1, 24) t(s) WHERE n >= 10",
}


@query("ar1_insample", sql("hourly_station", "SELECT station, ts, round(pm25, 6) AS y, round(y_pred, 6) AS y_pred FROM ins", **SERIES))
def ar1_insample(spark, sf):
    out = M.ar1_insample(series(spark, sf), ["station"], "ts", "pm25")
    return out.select("station", "ts", F.round("pm25", 6).alias("y"), F.round("y_pred", 6).alias("y_pred"))


@query("ar1_forecast_24h", sql("hourly_station", "SELECT station, step, ts, round(yhat, 6) AS yhat FROM fc", **SERIES))
def ar1_forecast_24h(spark, sf):
    return M.ar1_forecast(series(spark, sf), ["station"], "ts", "pm25").withColumn("yhat", F.round("yhat", 6))


@query("forecast_eval", sql("hourly_station", """SELECT model, count(*) AS n, round(sqrt(avg((y - f) * (y - f))), 6) AS rmse, round(avg(abs(y - f)), 6) AS mae,
 round(1 - sum((y - f) * (y - f)) / (var_pop(y) * count(*)), 6) AS r2 FROM (SELECT 'ar1' AS model, pm25 AS y, y_pred AS f FROM ins UNION ALL SELECT 'naive', pm25, prev_y FROM ins) WHERE f IS NOT NULL GROUP BY model""", **SERIES))
def forecast_eval(spark, sf):
    ins = M.ar1_insample(series(spark, sf), ["station"], "ts", "pm25")
    long = ins.select(F.col("pm25").alias("y"), F.explode(F.array(
        F.struct(F.lit("ar1").alias("model"), F.col("y_pred").alias("f")),
        F.struct(F.lit("naive").alias("model"), F.col("prev_y").alias("f")))).alias("e")).select("y", "e.*")
    return M.evaluate(long, ["model"], "y", "f").withColumns({c: F.round(c, 6) for c in ("rmse", "mae", "r2")})


@query("forecast_risk", sql("hourly_station", f"""SELECT station, worst, risk, rank FROM (SELECT station, aqi AS worst, {US_CATEGORY} AS risk, CAST(row_number() OVER (ORDER BY aqi DESC, station) AS INTEGER) AS rank
 FROM (SELECT station, CAST(trunc(max(round(yhat, 4))) AS INTEGER) AS aqi FROM fc GROUP BY station)) WHERE rank <= 10""", **SERIES))
def forecast_risk(spark, sf):
    fc = M.ar1_forecast(series(spark, sf), ["station"], "ts", "pm25")
    worst = fc.groupBy("station").agg(F.max(F.round("yhat", 4)).cast("int").alias("worst"))
    top = worst.orderBy(F.desc("worst"), "station").limit(10)
    named = top.agg(F.sort_array(F.collect_list(F.struct((-F.col("worst")).alias("neg"), "station"))).alias("l"))
    rows = named.select(F.posexplode("l").alias("i", "e"))
    return rows.select("e.station", (-F.col("e.neg")).alias("worst"), category(-F.col("e.neg")).alias("risk"), (F.col("i") + 1).alias("rank"))


NOW = datetime.datetime(2024, 2, 1)


@query("stale_series", sql("ev", """SELECT s.station, s.parameter, m.trained_at FROM (SELECT DISTINCT station, CASE WHEN sensor < 3 THEN 'pm25' ELSE 'o3' END AS parameter FROM ev) s
 LEFT JOIN m ON s.station = m.station AND s.parameter = m.parameter WHERE m.trained_at IS NULL OR TIMESTAMP '2024-02-01 00:00:00' - m.trained_at > INTERVAL 6 HOUR""",
    m="SELECT station, CASE WHEN sensor < 3 THEN 'pm25' ELSE 'o3' END AS parameter, max(ts) AS trained_at FROM ev WHERE event_type = 'purchase' GROUP BY ALL"))
def stale_series(spark, sf):
    ev = V.events(spark, sf).withColumn("parameter", F.when(F.col("sensor") < 3, "pm25").otherwise("o3"))
    models = ev.where("event_type = 'purchase'").groupBy("station", "parameter").agg(F.max("ts").alias("trained_at"))
    names = ev.select("station", "parameter").distinct()
    return M.stale_series(names, models, ["station", "parameter"], F.lit(NOW).cast("timestamp_ntz"))


PARAMETERS = ("aqi", "pm25", "pm10", "no2", "o3")


def parameter_series(spark, sf):
    """Gap-free hourly values per station and parameter."""
    rows = score_aqi(V.air_wide(spark, sf), "in_strict").withColumn("aqi", F.col("aqi").cast("double"))
    long = rows.unpivot(["station", "ts"], list(PARAMETERS), "parameter", "value")
    hours = resample_hourly(long, ["station", "parameter"], "ts", ["value"])
    filled = impute_neighbours(hours, ["station", "parameter"], ["ts"], ["value"], bounded=True)
    return filled.where("value is not null")


@query("forecast_24h")
def forecast_24h(spark, sf):
    """All five parameters of every station."""
    return M.forecast_24h(parameter_series(spark, sf), ["station", "parameter"], "ts", "value")


# Order (1, 1, 0): the step follows its predecessor, so its forecast has a closed form.
STEPS = {
    **STRICT,
    "lng": " UNION ALL ".join(f"SELECT station, '{p}' AS parameter, date_trunc('hour', ts) AS ts, avg({p}) AS v FROM strict GROUP BY ALL" for p in PARAMETERS),
    "lgrid": "SELECT station, parameter, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM lng GROUP BY station, parameter",
    "lall": "SELECT g.station, g.parameter, g.ts, v FROM lgrid g LEFT JOIN lng l ON g.station = l.station AND g.parameter = l.parameter AND g.ts = l.ts",
    "lv": """SELECT * FROM (SELECT station, parameter, ts, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY station, parameter ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
 last_value(v IGNORE NULLS) OVER (PARTITION BY station, parameter ORDER BY ts DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS v FROM lall) WHERE v IS NOT NULL""",
    "ld": "SELECT station, parameter, ts, v, v - lag(v) OVER w AS d FROM lv WINDOW w AS (PARTITION BY station, parameter ORDER BY ts)",
    "lp": "SELECT *, lag(d) OVER (PARTITION BY station, parameter ORDER BY ts) AS d0 FROM ld",
    "lf": "SELECT station, parameter, regr_slope(d, d0) AS phi, regr_intercept(d, d0) AS c, arg_max(v, ts) AS lastv, arg_max(d, ts) AS lastd, max(ts) AS last_ts, count(*) AS n FROM lp GROUP BY station, parameter",
}


@query("forecast_110", sql("air", """SELECT station, parameter, CAST(s AS INTEGER) AS step, last_ts + s * INTERVAL 1 HOUR AS ts,
 round(lastv + s * c / (1 - phi) + (lastd - c / (1 - phi)) * phi * (1 - pow(phi, s)) / (1 - phi), 4) AS yhat FROM lf, generate_series(1, 24) t(s) WHERE n >= 10""", **STEPS))
def forecast_110(spark, sf):
    out = M.forecast_24h(parameter_series(spark, sf), ["station", "parameter"], "ts", "value", order=((1, 1, 0), (0, 0, 0)))
    return out.withColumn("yhat", F.round("yhat", 4))


@query("arima_grid_best")
def arima_grid_best(spark, sf):
    return M.best_orders(series(spark, sf), ["station"], "ts", "pm25")


@query("arima_wide_search")
def arima_wide_search(spark, sf):
    """Search beyond the small grid: every order up to (4, 2, 4) without a seasonal part."""
    return M.best_orders(series(spark, sf), ["station"], "ts", "pm25", grid=[g for g in M.wide_grid() if g[1] == (0, 0, 0)])


AR_GRID = [((p, d, 0), (0, 0, 0)) for d in range(2) for p in range(2)]


@query("ar_order_search", sql("hourly_station", """SELECT station, ord[1] AS p, ord[2] AS d, round(aic, 4) AS aic FROM (SELECT station, ord, aic, row_number() OVER (PARTITION BY station ORDER BY aic, nr) AS rn FROM cand) WHERE rn = 1""",
    **SERIES,
    i="SELECT station, ts, pm25 AS y, row_number() OVER (PARTITION BY station ORDER BY ts) - 1 AS i FROM y",
    d1="SELECT *, y - lag(y) OVER w AS d, lag(y) OVER w AS y0 FROM i WINDOW w AS (PARTITION BY station ORDER BY i)",
    d2="SELECT *, lag(d) OVER (PARTITION BY station ORDER BY i) AS d0 FROM d1",
    u="SELECT station, count(*) AS n, var_pop(y) AS vy, var_pop(d) AS vd, regr_r2(y, y0) AS ry, regr_r2(d, d0) AS rd FROM d2 WHERE i >= 6 GROUP BY station",
    cand="""SELECT station, 0 AS nr, [0, 0] AS ord, n * ln(greatest(vy, 1e-12)) + 4 AS aic FROM u WHERE n > 1 UNION ALL SELECT station, 1, [1, 0], n * ln(greatest(vy * (1 - ry), 1e-12)) + 6 FROM u WHERE n > 2
 UNION ALL SELECT station, 2, [0, 1], n * ln(greatest(vd, 1e-12)) + 4 FROM u WHERE n > 1 UNION ALL SELECT station, 3, [1, 1], n * ln(greatest(vd * (1 - rd), 1e-12)) + 6 FROM u WHERE n > 2"""))
def ar_order_search(spark, sf):
    """The order search on candidates whose fits have a closed form."""
    out = M.best_orders(series(spark, sf), ["station"], "ts", "pm25", grid=AR_GRID)
    return out.select("station", F.col("order")[0].alias("p"), F.col("order")[1].alias("d"), F.round("aic", 4).alias("aic"))


@query("arima_stepwise")
def arima_stepwise(spark, sf):
    """Stepwise search over the whole wide grid, seasonal part included."""
    return stepwise_orders(series(spark, sf), ["station"], "ts", "pm25")


@query("ar_stepwise", sql("hourly_station", """SELECT station, CASE WHEN m < s1 AND a11 < m THEN 1 WHEN m < s1 AND a10 <= a01 THEN 1 WHEN m < s1 THEN 0 ELSE 0 END AS p,
 CASE WHEN m < s1 AND a11 < m THEN 1 WHEN m < s1 AND a10 <= a01 THEN 0 WHEN m < s1 THEN 1 ELSE 0 END AS d,
 round(CASE WHEN m < s1 THEN least(m, a11) ELSE s1 END, 4) AS aic, CASE WHEN m < s1 THEN 4 ELSE 3 END AS fits
 FROM (SELECT *, a00 AS s1, least(a10, a01) AS m FROM (SELECT station, n * ln(greatest(vy, 1e-12)) + 4 AS a00, n * ln(greatest(vy * (1 - ry), 1e-12)) + 6 AS a10,
 n * ln(greatest(vd, 1e-12)) + 4 AS a01, n * ln(greatest(vd * (1 - rd), 1e-12)) + 6 AS a11 FROM u WHERE n > 3))""", **{**SERIES,
    "i": "SELECT station, ts, pm25 AS y, row_number() OVER (PARTITION BY station ORDER BY ts) - 1 AS i FROM y",
    "d1": "SELECT *, y - lag(y) OVER w AS d, lag(y) OVER w AS y0 FROM i WINDOW w AS (PARTITION BY station ORDER BY i)",
    "d2": "SELECT *, lag(d) OVER (PARTITION BY station ORDER BY i) AS d0 FROM d1",
    "u": "SELECT station, count(*) AS n, var_pop(y) AS vy, var_pop(d) AS vd, regr_r2(y, y0) AS ry, regr_r2(d, d0) AS rd FROM d2 WHERE i >= 6 GROUP BY station"}))
def ar_stepwise(spark, sf):
    """The stepwise search from (0, 0, 0) on candidates whose fits have a closed form, with
    the number of fits."""
    out = stepwise_orders(series(spark, sf), ["station"], "ts", "pm25", grid=AR_GRID, starts=[AR_GRID[0]])
    return out.select("station", F.col("order")[0].alias("p"), F.col("order")[1].alias("d"), F.round("aic", 4).alias("aic"), "fits")


@query("forecast_refresh", sql("air", f"""SELECT station, parameter, CASE WHEN station % 3 = 2 THEN TIMESTAMP '{NOW - datetime.timedelta(hours=2)}' ELSE TIMESTAMP '{NOW}' END AS trained_at,
 CAST(s AS INTEGER) AS step, last_ts + s * INTERVAL 1 HOUR AS ts,
 round(lastv + s * c / (1 - phi) + (lastd - c / (1 - phi)) * phi * (1 - pow(phi, s)) / (1 - phi), 4) AS yhat FROM lf, generate_series(1, 24) t(s) WHERE n >= 10""", **STEPS))
def forecast_refresh(spark, sf):
    """A store with fresh, stale and missing models, after one refresh, and its forecasts."""
    rows = stored(parameter_series(spark, sf), "series")
    keys, order = ["station", "parameter"], ((1, 1, 0), (0, 0, 0))

    def at(hours):
        return F.lit(NOW - datetime.timedelta(hours=hours)).cast("timestamp_ntz")

    old = modelstore.fit_models(rows.where("station % 3 = 1"), keys, "ts", "value", at(8), order)
    kept = modelstore.fit_models(rows.where("station % 3 = 2"), keys, "ts", "value", at(2), order)
    store = stored(old.unionByName(kept), "models")
    store = stored(modelstore.refresh_models(rows, store, keys, "ts", "value", at(0), order), "models")
    ahead = modelstore.forecast_models(store, keys)
    return ahead.join(store.select(*keys, "trained_at"), keys).select(
        *keys, "trained_at", "step", "ts", F.round("yhat", 4).alias("yhat"))


EXOG = ["temperature", "humidity", "windspeed"]


def _fitted(spark, sf):
    frame = training(spark, sf)
    exog = [c for c in EXOG if c in frame.columns]
    orders = M.best_orders(frame, ["station"], "timestamp", "aqi", exog)
    return frame, M.fit_insample(frame, orders, ["station"], "timestamp", "aqi", exog)


@query("insample_fit")
def insample_fit(spark, sf):
    """Order search over all 36 candidates, then the fit."""
    return _fitted(spark, sf)[1]


@query("model_metadata", sql("air wx traffic", """SELECT station, max(timestamp) AS training_end, concat_ws(',', CASE WHEN count(temperature) = count(*) THEN 'temperature' END, CASE WHEN count(humidity) = count(*) THEN 'humidity' END,
 CASE WHEN count(windspeed) = count(*) AND 1 - abs(corr(temperature, windspeed)) > 1e-9 THEN 'windspeed' END) AS exog_cols, round(max(scale), 6) AS applied_scale, max(scale) <> 1 AS scaled FROM tf GROUP BY station""", **TRAINING))
def model_metadata(spark, sf):
    """What a table of fitted models says beside order and AIC (see ``insample_fit``). Wind
    speed is a multiple of temperature in the test feeds, so no fit can use both."""
    frame, insample = _fitted(spark, sf)
    return M.model_table(insample, frame, ["station"]).select(
        "station", "training_end", "exog_cols", F.round("applied_scale", 6).alias("applied_scale"), "scaled")


@query("insample_fixed_order", sql("hourly_station", "SELECT station, ts, round(pm25, 6) AS y, round(y_pred, 6) AS y_pred FROM ins", **SERIES))
def insample_fixed_order(spark, sf):
    """The numeric solver at order (1, 0, 0) against the closed form."""
    rows = series(spark, sf)
    orders = rows.select("station").distinct().selectExpr("station", "array(1, 0, 0) as order", "array(0, 0, 0) as seasonal", "0D as aic")
    out = M.fit_insample(rows, orders, ["station"], "ts", "pm25")
    return out.select("station", "ts", F.round("y", 6).alias("y"), F.round("y_pred_in_sample", 6).alias("y_pred"))


@query("regr_sql", sql("air", "SELECT station, round(regr_slope(pm25, pm10), 6) AS slope, round(regr_intercept(pm25, no2), 6) AS intercept_no2, round(regr_r2(pm25, no2), 6) AS r2_no2, regr_count(pm25, no2) AS n FROM (SELECT station, CASE WHEN pm25 >= 0 THEN pm25 END AS pm25, pm10 + no2 AS pm10, no2 FROM air) GROUP BY station"))
def regr_sql(spark, sf):
    rows = V.air_wide(spark, sf).select(
        "station", F.when(F.col("pm25") >= 0, F.col("pm25")).alias("pm25"), (F.col("pm10") + F.col("no2")).alias("pm10"), "no2")
    return rows.groupBy("station").agg(
        F.round(F.regr_slope("pm25", "pm10"), 6).alias("slope"), F.round(F.regr_intercept("pm25", "no2"), 6).alias("intercept_no2"),
        F.round(F.regr_r2("pm25", "no2"), 6).alias("r2_no2"), F.regr_count("pm25", "no2").alias("n"))


@query("standardize", sql("", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_samp(l_quantity) FROM lineitem), 6) AS l_quantity_z,
 round((l_tax - (SELECT avg(l_tax) FROM lineitem)) / (SELECT stddev_samp(l_tax) FROM lineitem), 6) AS l_tax_z FROM lineitem"""))
def standardize(spark, sf):
    out = M.standardize(V.table(spark, sf, "lineitem"), ["l_quantity", "l_tax"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round("l_quantity_z", 6).alias("l_quantity_z"), F.round("l_tax_z", 6).alias("l_tax_z"))


FEATURES = ["pm10", "no2", "so2", "co", "nh3", "temperature", "humidity", "windspeed", "hour", "dayofweek"]


def frame(spark, sf):
    """Features of both feeds with the mean index of the hour as target."""
    air = score_aqi(V.air_wide(spark, sf), "in_strict").select("station", "ts", "pm10", "no2", "so2", "co", "nh3", F.col("aqi").cast("double").alias("aqi"))
    return features_of(air, V.wx(spark, sf).select("station", "ts", "temperature", "humidity", "windspeed"), "aqi", "ts", ["station"])


MEASURES = ("pm10", "no2", "so2", "co", "nh3", "temperature", "humidity", "windspeed")


@query("feature_frame", sql("air wx", "SELECT station, ts, " + ", ".join(f"round({c}, 6) AS {c}" for c in MEASURES) + """, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS dayofweek,
 round(aqi, 6) AS aqi FROM a LEFT JOIN w USING (station, ts)""", **STRICT,
    a="SELECT station, date_trunc('hour', ts) AS ts, " + ", ".join(f"avg({c}) AS {c}" for c in (*MEASURES[:5], "aqi")) + " FROM strict GROUP BY ALL",
    w="SELECT station, date_trunc('hour', ts) AS ts, " + ", ".join(f"avg({c}) AS {c}" for c in MEASURES[5:]) + " FROM wx GROUP BY ALL"))
def feature_frame(spark, sf):
    rounded = {c: F.round(c, 6) for c in (*MEASURES, "aqi")}
    return frame(spark, sf).withColumns(rounded)


def learning_rows(spark, sf):
    """Training and test part. Stored, because iterative training reads the frame many times."""
    rows = stored(frame(spark, sf).where("aqi is not null"), "features")
    return L.fill_from_training(*L.split_by_time(rows, "ts"), FEATURES)


@query("linreg_two_features", sql("air", """SELECT 'linear' AS model, count(*) AS n, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae, round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2
 FROM (SELECT aqi AS y, aqi - (my + b1 * (pm10 - m1) + b2 * (no2 - m2)) AS e FROM h, fit, cut WHERE epoch_us(ts) > "at")""", **STRICT,
    h="SELECT station, date_trunc('hour', ts) AS ts, avg(pm10) AS pm10, avg(no2) AS no2, avg(aqi) AS aqi FROM strict GROUP BY ALL HAVING avg(aqi) IS NOT NULL",
    cut="SELECT epoch_us(min(ts)) + (epoch_us(max(ts)) - epoch_us(min(ts))) * 0.8 AS \"at\" FROM h",
    mo="""SELECT avg(pm10) AS m1, avg(no2) AS m2, avg(aqi) AS my, var_pop(pm10) AS s11, var_pop(no2) AS s22, covar_pop(pm10, no2) AS s12, covar_pop(pm10, aqi) AS s1, covar_pop(no2, aqi) AS s2
 FROM h, cut WHERE epoch_us(ts) <= "at" """,
    fit="SELECT m1, m2, my, (s1 * s22 - s2 * s12) / (s11 * s22 - s12 * s12) AS b1, (s2 * s11 - s1 * s12) / (s11 * s22 - s12 * s12) AS b2 FROM mo"))
def linreg_two_features(spark, sf):
    """The linear model on two features, against the normal equations."""
    train, test = learning_rows(spark, sf)
    out = L.metrics(L.fit_linear(train, ["pm10", "no2"], "aqi", scale=True), test, "aqi", "linear")
    return out.withColumns({c: F.round(c, 6) for c in ("rmse", "mae", "r2")})


@query("what_if_fitted", sql("air", """SELECT scenario, count(*) AS n, round(avg((factor - 1) * b2 * no2), 4) + 0 AS mean_delta, round(avg(my + b1 * (pm10 - m1) + b2 * (no2 * factor - m2)), 4) AS mean_predicted
 FROM h, fit, cut, (VALUES ('baseline', CAST(1.0 AS DOUBLE)), ('traffic_cut', 0.8), ('ev_shift', 0.7)) s(scenario, factor) WHERE epoch_us(ts) > "at" GROUP BY scenario""", **STRICT,
    h="SELECT station, date_trunc('hour', ts) AS ts, avg(pm10) AS pm10, avg(no2) AS no2, avg(aqi) AS aqi FROM strict GROUP BY ALL HAVING avg(aqi) IS NOT NULL",
    cut="SELECT epoch_us(min(ts)) + (epoch_us(max(ts)) - epoch_us(min(ts))) * 0.8 AS \"at\" FROM h",
    mo="""SELECT avg(pm10) AS m1, avg(no2) AS m2, avg(aqi) AS my, var_pop(pm10) AS s11, var_pop(no2) AS s22, covar_pop(pm10, no2) AS s12, covar_pop(pm10, aqi) AS s1, covar_pop(no2, aqi) AS s2
 FROM h, cut WHERE epoch_us(ts) <= "at" """,
    fit="SELECT m1, m2, my, (s1 * s22 - s2 * s12) / (s11 * s22 - s12 * s12) AS b1, (s2 * s11 - s1 * s12) / (s11 * s22 - s12 * s12) AS b2 FROM mo"))
def what_if_fitted(spark, sf):
    """The fitted linear model scored again under each scenario."""
    train, test = learning_rows(spark, sf)
    model = L.fit_linear(train, ["pm10", "no2"], "aqi", scale=True)
    out = R.what_if_fitted(test.select("station", "pm10", "no2"), model, {"baseline": 1.0, "traffic_cut": 0.8, "ev_shift": 0.7}, ["no2"])
    return out.groupBy("scenario").agg(
        F.count("*").alias("n"), (F.round(F.avg("delta"), 4) + 0).alias("mean_delta"), F.round(F.avg("predicted"), 4).alias("mean_predicted"))


@query("linreg_metrics")
def linreg_metrics(spark, sf):
    train, test = learning_rows(spark, sf)
    model = L.fit_linear(train, FEATURES, "aqi", scale=True)
    return L.metrics(model, test, "aqi", "linear")


@query("gbt_metrics")
def gbt_metrics(spark, sf):
    train, test = learning_rows(spark, sf)
    return L.metrics(L.fit_trees(train, FEATURES, "aqi"), test, "aqi", "boosted_trees")


@query("feature_importance")
def feature_importance(spark, sf):
    train, _ = learning_rows(spark, sf)
    return L.importances(L.fit_trees(train, FEATURES, "aqi"), FEATURES, train)
