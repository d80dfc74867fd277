"""Short-term forecasts of many series in parallel.

Series are hourly, so a series is as long as its time span in hours. That bounds what a
task holds whatever the number of raw readings. Series longer than ``MAX_HOURS`` are not
fitted; ``too_long`` lists them and the others go on.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeframe.scale import one_row
from hazeframe.session import ship

HORIZON = 24
MIN_POINTS = 10
SEASON = 24
MAX_HOURS = 200_000
RETRAIN_HOURS = 6
FORECAST_ORDER = ((2, 1, 2), (0, 0, 0))
DEFAULT_ORDER = ((1, 0, 0), (0, 0, 0))


def small_grid() -> list[tuple]:
    """p 0-2, d 0-1, q 0-2, each plain and with the seasonal part (1, 0, 1)."""
    return [((p, d, q), s) for p, d, q in product(range(3), range(2), range(3))
            for s in ((0, 0, 0), (1, 0, 1))]


def wide_grid() -> list[tuple]:
    """p, q 0-4, d 0-2, P, Q 0-2, D 0-1: the range of the wider search."""
    return [((p, d, q), (P, D, Q)) for p, d, q, P, D, Q in
            product(range(5), range(3), range(5), range(3), range(2), range(3))]


# --- least-squares solver, one series at a time -------------------------------------

def _lagged(x: np.ndarray, steps: Sequence[int]) -> list[np.ndarray]:
    out = []
    for k in steps:
        shifted = np.zeros_like(x)
        shifted[k:] = x[:-k]
        out.append(shifted)
    return out


def _difference(x: np.ndarray, d: int, seasonal: int) -> np.ndarray:
    for _ in range(seasonal):
        x = x[SEASON:] - x[:-SEASON]
    return np.diff(x, n=d, axis=0) if d else x


def fit_series(y: np.ndarray, order: tuple, seasonal: tuple, exog: np.ndarray | None = None,
               start: int | None = None) -> dict:
    """Two-stage least squares: a long autoregression gives the shocks, then the lags of
    series and shocks are fitted together. Raises LinAlgError when the design is singular."""
    (p, d, q), (P, D, Q) = order, seasonal
    w = _difference(y, d, D)
    n = len(w)
    x = _difference(exog, d, D) if exog is not None else None
    ar = list(range(1, p + 1)) + [SEASON * k for k in range(1, P + 1)]
    ma = list(range(1, q + 1)) + [SEASON * k for k in range(1, Q + 1)]
    shocks = np.zeros(n)
    burn = max(ar + [0])
    if ma:
        m = min(max(4, p + q + 2), max(1, n // 4))
        first = np.column_stack([np.ones(n)] + _lagged(w, range(1, m + 1)))[m:]
        beta, *_ = np.linalg.lstsq(first, w[m:], rcond=None)
        shocks[m:] = w[m:] - first @ beta
        burn = max(burn, m, max(ma))
    begin = max(burn, start or 0)
    design = np.column_stack(
        [np.ones(n)] + _lagged(w, ar) + _lagged(shocks, ma) + ([x] if x is not None else []))
    if n - begin <= design.shape[1]:
        raise np.linalg.LinAlgError("too few points")
    beta, _, rank, _ = np.linalg.lstsq(design[begin:], w[begin:], rcond=None)
    if rank < design.shape[1]:
        raise np.linalg.LinAlgError("singular design")
    resid = w[begin:] - design[begin:] @ beta
    used = len(resid)
    var = max(float(np.mean(resid ** 2)), 1e-12)
    return {"beta": beta, "ar": ar, "ma": ma, "w": w, "shocks": shocks, "begin": begin,
            "offset": len(y) - n, "resid": resid, "aic": used * np.log(var) + 2 * (design.shape[1] + 1),
            "d": d, "D": D, "x_last": x[-1] if x is not None else None}


def model_state(y: np.ndarray, fit: dict) -> dict:
    """What a forecast needs of a fitted series: coefficients and lags, the last differenced
    values and shocks, and the levels that undo the differences."""
    levels = [y]
    for _ in range(fit["D"]):
        levels.append(levels[-1][SEASON:] - levels[-1][:-SEASON])
    return {"beta": fit["beta"], "ar": fit["ar"], "ma": fit["ma"],
            "recent": fit["w"][len(fit["w"]) - max(fit["ar"], default=0):],
            "shocks": fit["shocks"][len(fit["shocks"]) - max(fit["ma"], default=0):],
            "outside": fit["x_last"] if fit["x_last"] is not None else np.empty(0),
            "ends": [np.diff(levels[-1], n=k)[-1] for k in range(fit["d"])],
            "seasons": [level[-SEASON:] for level in levels[:-1]]}


def forecast_state(state: dict, steps: int = HORIZON) -> np.ndarray:
    """Recursive forecast; future shocks are zero and outside columns keep their last value."""
    w, e, outside = list(state["recent"]), list(state["shocks"]), list(state["outside"])
    for _ in range(steps):
        terms = [1.0] + [w[-k] for k in state["ar"]] + [e[-k] for k in state["ma"]] + outside
        w.append(float(np.dot(state["beta"], terms)))
        e.append(0.0)
    out = np.array(w[-steps:])
    for last in reversed(state["ends"]):
        out = last + np.cumsum(out)
    for level in reversed(state["seasons"]):
        known = list(level)
        for v in out:
            known.append(v + known[-SEASON])
        out = np.array(known[-steps:])
    return out


def forecast_series(y: np.ndarray, fit: dict, steps: int = HORIZON) -> np.ndarray:
    """Forecast of the series a fit was made on."""
    return forecast_state(model_state(y, fit), steps)


def _fit_or_mean(y, order, seasonal, exog=None):
    """Fit; a constant or too short series falls back to its mean."""
    for o, s, x in ((order, seasonal, exog), (*DEFAULT_ORDER, None)):
        try:
            return fit_series(y, o, s, x), o, s
        except np.linalg.LinAlgError:
            continue
    return None, (0, 0, 0), (0, 0, 0)


# --- Spark operators ----------------------------------------------------------------

def _rows(keys: dict, n: int, **columns) -> pd.DataFrame:
    """``n`` result rows; keys as plain objects, which Arrow takes in any type."""
    out = {k: pd.Series([v] * n, dtype=object) for k, v in keys.items()}
    return pd.DataFrame({**out, **columns})


def too_long(df: DataFrame, keys: Sequence[str], most: int = MAX_HOURS) -> DataFrame:
    """The error output of the fits: series with more than ``most`` rows and their lengths."""
    return df.groupBy(*keys).agg(F.count("*").alias("hours")).where(F.col("hours") > most)


def within_length(df: DataFrame, keys: Sequence[str], most: int = MAX_HOURS) -> DataFrame:
    """The rows of all other series, counted in the partitioning that the fit needs anyway."""
    n = F.count("*").over(Window.partitionBy(*keys))
    return df.withColumn("_n", n).where(F.col("_n") <= most).drop("_n")


def forecast_24h(df: DataFrame, keys: Sequence[str], ts: str, y: str, steps: int = HORIZON,
                 order: tuple = FORECAST_ORDER) -> DataFrame:
    """Fixed-order forecast per series; series with fewer than 10 values give no rows."""
    keys = list(keys)
    schema = ", ".join(f"{k} {t}" for k, t in df.select(*keys).dtypes) + ", step int, ts timestamp_ntz, yhat double"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ts)
        known = pdf[y].dropna().to_numpy(float)
        if len(known) < MIN_POINTS:
            return _rows({k: None for k in keys}, 0, step=np.empty(0, "int32"),
                         ts=np.empty(0, "datetime64[us]"), yhat=np.empty(0))
        fit, _, _ = _fit_or_mean(known, *order)
        values = forecast_series(known, fit, steps) if fit else np.full(steps, known.mean())
        ahead = np.arange(1, steps + 1, dtype="int32")
        return _rows({k: pdf[k].iloc[0] for k in keys}, steps, step=ahead,
                     ts=pdf[ts].iloc[-1] + pd.to_timedelta(ahead, unit="h"), yhat=values)

    ship(df.sparkSession)
    return within_length(df.select(*keys, ts, y), keys).groupBy(*keys).applyInPandas(run, schema)


def stale_series(series: DataFrame, models: DataFrame, keys: Sequence[str], now, trained: str = "trained_at",
                 hours: int = RETRAIN_HOURS) -> DataFrame:
    """Series without a model or with one older than ``hours``."""
    joined = series.join(models, list(keys), "left")
    old = now - F.col(trained) > F.expr(f"interval {int(hours)} hours")
    return joined.where(F.col(trained).isNull() | old)


def _pack(df: DataFrame, keys, ts, cols) -> DataFrame:
    """One row per series, each column as an array in time order.

    Arrays of plain numbers reach the Python worker as numpy arrays.
    """
    points = F.sort_array(F.collect_list(F.struct(ts, *cols)))
    packed = df.groupBy(*keys).agg(points.alias("_p"))
    return packed.select(*keys, *[F.col(f"_p.{c}").alias(f"_a_{c}") for c in (ts, *cols)])


def _unpack(row, y, exog):
    """Series values, the outside columns used, and their names. A column with a gap, or one
    that the constant and the columns before it determine, is left out for this series."""
    values = np.asarray(row[f"_a_{y}"], dtype=float)
    names, used = [], np.empty((len(values), 0))
    for c in exog:
        x = np.asarray(row[f"_a_{c}"], dtype=float)
        if np.isnan(x).any():
            continue
        more = np.column_stack([used, (x - x.mean()) / (x.std() or 1.0)])
        if np.linalg.matrix_rank(more, tol=1e-6 * np.sqrt(len(x))) == more.shape[1]:
            names.append(c)
            used = more
    taken = [np.asarray(row[f"_a_{c}"], dtype=float) for c in names]
    return values, np.column_stack(taken) if taken else None, names


def widest_lag(grid: Sequence[tuple]) -> int:
    """The longest lag that any candidate needs."""
    return max(max(p + q + 2, p, q, 4, SEASON * max(P, Q)) for (p, _, q), (P, _, Q) in grid)


def candidate_aic(values: np.ndarray, exog: np.ndarray | None, candidate: tuple, widest: int) -> float:
    """AIC of one candidate, NaN where it can't be fitted. A common first point makes the
    candidates of a grid comparable."""
    order, seasonal = candidate
    lost = order[1] + SEASON * seasonal[1]
    try:
        return fit_series(values, order, seasonal, exog, start=max(0, widest + 2 - lost))["aic"]
    except np.linalg.LinAlgError:
        return np.nan


def spelled(grid: Sequence[tuple]) -> Column:
    """The candidates as an array of (o, s)."""
    return F.array(*[F.struct(F.array(*map(F.lit, o)).alias("o"), F.array(*map(F.lit, s)).alias("s")) for o, s in grid])


def search_orders(df: DataFrame, keys: Sequence[str], ts: str, y: str, exog: Sequence[str] = (),
                  grid: list[tuple] | None = None, blocks: int | None = None, partitions: int | None = None) -> DataFrame:
    """AIC of every candidate order of every series, null where it can't be fitted.

    The candidates of a series are dealt out to ``blocks`` groups (one per six candidates),
    so that a few long series still use many cores and many short ones do not pay for a
    group per fit.
    """
    keys, exog, grid = list(keys), list(exog), grid or small_grid()
    spark = df.sparkSession
    blocks = min(blocks or max(1, len(grid) // 6), len(grid))
    ship(spark)
    packed = _pack(within_length(df.where(F.col(y).isNotNull()), keys), keys, ts, [y, *exog])
    numbers = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block")
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    # An explicit count keeps adaptive execution from merging small but slow partitions.
    fan = packed.drop(f"_a_{ts}").select("*", numbers).repartition(n, *keys, "_block")
    types = dict(df.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", candidate int, aic double"
    widest = widest_lag(grid)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        values, x, _ = _unpack(row, y, exog)
        done = [(number, candidate_aic(values, x, grid[number], widest)) for number in range(int(row["_block"]), len(grid), blocks)]
        return _rows({k: row[k] for k in keys}, len(done), candidate=np.array([c for c, _ in done], "int32"),
                     aic=np.array([a for _, a in done], float))

    tried = fan.groupBy(*keys, "_block").applyInPandas(run, schema)
    return tried.withColumn("aic", F.nanvl("aic", F.lit(None).cast("double")))


def best_orders(df: DataFrame, keys: Sequence[str], ts: str, y: str, exog: Sequence[str] = (),
                grid: list[tuple] | None = None) -> DataFrame:
    """Order with the least AIC per series, the first candidate on ties, else (1, 0, 0)."""
    keys, grid = list(keys), grid or small_grid()
    tried = search_orders(df, keys, ts, y, exog, grid)
    known = F.when(F.col("aic").isNotNull(), F.struct("aic", "candidate"))
    best = tried.groupBy(*keys).agg(F.min(known).alias("_b"))
    pick = F.when(F.col("_b").isNotNull(), spelled(grid)[F.col("_b.candidate")]).otherwise(spelled([DEFAULT_ORDER])[0])
    return (best.withColumn("_p", pick)
            .select(*keys, F.col("_p.o").alias("order"), F.col("_p.s").alias("seasonal"), F.col("_b.aic").alias("aic")))


def fit_insample(df: DataFrame, orders: DataFrame, keys: Sequence[str], ts: str, y: str,
                 exog: Sequence[str] = ()) -> DataFrame:
    """Final fit per series: y and its in-sample prediction, with the order and the outside
    columns used, the AIC of this fit and the AIC by which the order was chosen. The two
    differ: the search compares all candidates from one common first point."""
    keys, exog = list(keys), list(exog)
    ship(df.sparkSession)
    rows = within_length(df.where(F.col(y).isNotNull()), keys)
    packed = _pack(rows, keys, ts, [y, *exog]).join(orders.withColumnRenamed("aic", "search_aic"), keys)
    types = dict(df.dtypes)
    schema = (", ".join(f"{k} {types[k]}" for k in keys)
              + ", ts timestamp_ntz, y double, y_pred_in_sample double, order string, seasonal string, exog_cols string, aic double, search_aic double")
    columns = [*keys, "ts", "y", "y_pred_in_sample", "order", "seasonal", "exog_cols", "aic", "search_aic"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, row in pdf.iterrows():
                values, x, used = _unpack(row, y, exog)
                fit, order, seasonal = _fit_or_mean(
                    values, tuple(map(int, row["order"])), tuple(map(int, row["seasonal"])), x)
                pred = np.full(len(values), np.nan)
                if fit:
                    at = fit["offset"] + fit["begin"]
                    pred[at:] = values[at:] - fit["resid"]
                else:
                    pred[:] = values.mean()
                names = {**{k: row[k] for k in keys}, "order": str(order),
                         "seasonal": str((*seasonal, SEASON if any(seasonal) else 0)),
                         "exog_cols": ",".join(used) if fit and fit["x_last"] is not None else ""}
                chosen = row["search_aic"]
                out = _rows(names, len(values), ts=row[f"_a_{ts}"], y=values, y_pred_in_sample=pred,
                            aic=np.full(len(values), fit["aic"] if fit else np.nan),
                            search_aic=np.full(len(values), np.nan if chosen is None else float(chosen)))
                yield out[columns]

    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.sparkSession.sparkContext.defaultParallelism)
    done = packed.repartition(n, *keys).mapInPandas(run, schema)
    return done.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in ("y_pred_in_sample", "aic", "search_aic")})


def model_table(insample: DataFrame, frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One metadata row per fitted series: order, both AICs, training end, outside columns
    and scale used."""
    same = ("order", "seasonal", "aic", "search_aic", "exog_cols")
    fits = insample.groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in same], F.max("ts").alias("training_end"))
    scales = frame.groupBy(*keys).agg(F.max("scale").alias("applied_scale"))
    return fits.join(scales, list(keys)).withColumn("scaled", F.col("applied_scale") != 1)


def ar1_fit(df: DataFrame, keys: Sequence[str], ts: str, y: str) -> DataFrame:
    """Slope and intercept of y on its previous value, with the last value and time."""
    w = Window.partitionBy(*keys).orderBy(ts)
    pairs = df.where(F.col(y).isNotNull()).select(*keys, ts, y, F.lag(y).over(w).alias("_prev"))
    return pairs.groupBy(*keys).agg(
        F.regr_slope(y, "_prev").alias("phi"), F.regr_intercept(y, "_prev").alias("c"),
        F.max_by(y, ts).alias("last_y"), F.max(ts).alias("last_ts"), F.count("*").alias("n"))


def ar1_insample(df: DataFrame, keys: Sequence[str], ts: str, y: str) -> DataFrame:
    """One-step predictions of the closed-form model."""
    w = Window.partitionBy(*keys).orderBy(ts)
    whole = Window.partitionBy(*keys)  # the same partitioning: no second pass, no join
    pairs = df.where(F.col(y).isNotNull()).select(*keys, ts, y, F.lag(y).over(w).alias("prev_y"))
    fitted = pairs.select("*", F.regr_slope(y, "prev_y").over(whole).alias("phi"),
                          F.regr_intercept(y, "prev_y").over(whole).alias("c"))
    return fitted.withColumn("y_pred", F.col("c") + F.col("phi") * F.col("prev_y"))


def ar1_forecast(df: DataFrame, keys: Sequence[str], ts: str, y: str, steps: int = HORIZON) -> DataFrame:
    """mu + phi^k (y - mu) for k = 1..steps."""
    fit = ar1_fit(df, keys, ts, y).where((F.col("n") >= MIN_POINTS) & F.col("phi").isNotNull())
    rows = fit.select("*", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    mu = F.col("c") / F.when(F.col("phi") != 1, 1 - F.col("phi"))
    value = F.coalesce(mu + F.pow("phi", "step") * (F.col("last_y") - mu), F.col("last_y") + F.col("c") * F.col("step"))
    return rows.select(*keys, "step", F.timestamp_add("HOUR", "step", "last_ts").alias("ts"), value.alias("yhat"))


def evaluate(df: DataFrame, by: Sequence[str], y: str, pred: str) -> DataFrame:
    """RMSE, MAE and R2 per group in one pass; rows without a prediction do not count."""
    rows = df.where(F.col(y).isNotNull() & F.col(pred).isNotNull())
    e = F.col(y) - F.col(pred)
    return rows.groupBy(*by).agg(
        F.count("*").alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        (1 - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count("*"))).alias("r2"))


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """z-scores with the sample deviation, both moments read through one scalar subquery."""
    stats = one_row(df.agg(*[f(c).alias(f"{p}_{c}") for c in cols for p, f in (("m", F.avg), ("s", F.stddev_samp))]))
    return df.withColumns({f"{c}_z": (F.col(c) - stats[f"m_{c}"]) / F.when(stats[f"s_{c}"] != 0, stats[f"s_{c}"]) for c in cols})
