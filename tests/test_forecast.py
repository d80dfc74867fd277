import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazeframe.plans import forecast as M


def ar1(n=400, phi=0.7, c=3.0, seed=1):
    rng = np.random.default_rng(seed)
    y = np.empty(n)
    y[0] = 10
    for t in range(1, n):
        y[t] = c + phi * y[t - 1] + rng.normal()
    return y


def frame(spark, series):
    rows = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), float(v)) for k, y in series.items() for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, y double")


def test_solver_finds_the_coefficients():
    y = ar1(5000)
    fit = M.fit_series(y, (1, 0, 0), (0, 0, 0))
    assert fit["beta"] == pytest.approx([3.0, 0.7], abs=0.05)
    values = M.forecast_series(y, fit)
    c, phi = fit["beta"]
    want, last = [], y[-1]
    for _ in range(24):
        last = c + phi * last
        want.append(last)
    assert values == pytest.approx(want)


def test_differences_are_undone():
    t = np.arange(120.0)
    fit = M.fit_series(2 * t + 5, (0, 1, 0), (0, 0, 0))
    assert M.forecast_series(2 * t + 5, fit) == pytest.approx(2 * np.arange(120, 144) + 5)
    fit = M.fit_series(t ** 2, (0, 2, 0), (0, 0, 0))
    assert M.forecast_series(t ** 2, fit) == pytest.approx(np.arange(120, 144.0) ** 2)
    daily = np.tile(np.arange(24.0), 6)
    fit = M.fit_series(daily, (0, 0, 0), (0, 1, 0))
    assert M.forecast_series(daily, fit) == pytest.approx(np.arange(24.0))


def test_outside_column_is_used():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 1))
    y = 4 + 2 * x[:, 0] + 0.01 * rng.normal(size=300)
    assert M.fit_series(y, (0, 0, 0), (0, 0, 0), x)["beta"] == pytest.approx([4, 2], abs=0.01)


def test_forecast_contract(spark):
    df = frame(spark, {"long": ar1(), "short": ar1(9), "flat": np.full(50, 7.0)})
    got = M.forecast_24h(df, ["k"], "ts", "y")
    per = {r.k: (r.n, r.lo, r.hi) for r in got.groupBy("k").agg(F.count("*").alias("n"), F.min("yhat").alias("lo"), F.max("yhat").alias("hi")).collect()}
    assert set(per) == {"long", "flat"}
    assert per["flat"] == (24, 7.0, 7.0) and per["long"][0] == 24


def test_order_search(spark):
    assert len(M.small_grid()) == 36 and len(M.wide_grid()) == 5 * 3 * 5 * 3 * 2 * 3
    df = frame(spark, {"ar": ar1(600, 0.8), "flat": np.full(80, 7.0)})
    best = {r.k: (r.order, r.seasonal) for r in M.best_orders(df, ["k"], "ts", "y").collect()}
    assert best["ar"][0][0] >= 1
    assert best["flat"] == ([1, 0, 0], [0, 0, 0]) or best["flat"][0][0] == 0


def test_search_equals_a_plain_loop(spark):
    y = ar1(200)
    df = frame(spark, {"a": y})
    got = {r.candidate: r.aic for r in M.search_orders(df, ["k"], "ts", "y").collect()}
    grid = M.small_grid()
    widest = max(max(p + q + 2, 4, M.SEASON * max(P, Q)) for (p, _, q), (P, _, Q) in grid)
    for i, (o, s) in enumerate(grid):
        want = M.fit_series(y, o, s, start=widest + 2 - o[1])["aic"]
        assert got[i] == pytest.approx(want)


def test_insample_prediction(spark):
    y = ar1(300)
    df = frame(spark, {"a": y})
    orders = spark.createDataFrame([("a", [1, 0, 0], [0, 0, 0], 0.0)], "k string, order array<int>, seasonal array<int>, aic double")
    out = M.fit_insample(df, orders, ["k"], "ts", "y").orderBy("ts").collect()
    c, phi = M.fit_series(y, (1, 0, 0), (0, 0, 0))["beta"]
    assert out[0].y_pred_in_sample is None
    assert [r.y_pred_in_sample for r in out[1:]] == pytest.approx(list(c + phi * y[:-1]))


def test_closed_form_equals_recursion(spark):
    y = ar1(300)
    got = [r.yhat for r in M.ar1_forecast(frame(spark, {"a": y}), ["k"], "ts", "y").orderBy("step").collect()]
    phi, c = np.polyfit(y[:-1], y[1:], 1)
    last, want = y[-1], []
    for _ in range(24):
        last = c + phi * last
        want.append(last)
    assert got == pytest.approx(want)


def plain_stepwise(y, grid, starts):
    """The stepwise search as a loop over one series: (order, aic, fits)."""
    from hazeframe.plans.orders import neighbours
    near, widest = neighbours(grid), M.widest_lag(grid)
    tried, todo, best = [], [grid.index(c) for c in starts if c in grid], None
    while todo:
        tried += todo
        found = [(M.candidate_aic(y, None, grid[c], widest), c) for c in todo]
        found = min((f for f in found if not np.isnan(f[0])), default=None)
        if found is None or (best is not None and found[0] >= best[0]):
            break
        best = found
        todo = [c for c in near[best[1]] if c not in tried]
    return (grid[best[1]] if best else M.DEFAULT_ORDER), best and best[0], len(tried)


def test_stepwise_equals_a_plain_loop(spark):
    from hazeframe.plans.orders import STARTS, stepwise_orders
    rng = np.random.default_rng(9)
    daily = 5 * np.sin(np.arange(400) * 2 * np.pi / 24) + rng.normal(size=400)
    series = {"ar": ar1(300), "walk": np.cumsum(rng.normal(size=300)), "daily": daily, "short": ar1(30), "flat": np.full(200, 3.0)}
    df = frame(spark, series)
    got = {r.k: ((tuple(r.order), tuple(r.seasonal)), r.aic, r.fits) for r in stepwise_orders(df, ["k"], "ts", "y").collect()}
    grid = M.wide_grid()
    for k, y in series.items():
        order, aic, fits = plain_stepwise(y, grid, STARTS)
        assert got[k][0] == order and got[k][2] == fits < 200
        assert (got[k][1] is None) == (aic is None)
        assert aic is None or got[k][1] == pytest.approx(aic)
    assert got["short"][0] == M.DEFAULT_ORDER


def test_neighbours():
    from hazeframe.plans.orders import neighbours
    grid = M.wide_grid()
    near = neighbours(grid)
    assert all(i in near[j] for i in range(len(grid)) for j in near[i])
    at = grid.index(((2, 1, 2), (1, 0, 1)))
    assert {grid[i] for i in near[at]} >= {((3, 1, 2), (1, 0, 1)), ((1, 1, 1), (1, 0, 1)), ((2, 1, 2), (2, 0, 2)), ((2, 0, 2), (1, 0, 1)), ((2, 1, 2), (1, 1, 1))}
    assert len(near[at]) == 15


def test_refresh_fits_stale_series_only(spark):
    from hazeframe.plans import modelstore as S
    from hazeframe.session import stored
    keys, order = ["k"], ((2, 1, 2), (1, 0, 0))
    series = {"a": ar1(200), "b": ar1(200, seed=2), "c": np.full(60, 7.0), "d": ar1(9), "e": ar1(150, seed=5)}
    df = frame(spark, series)

    def at(hour):
        return F.lit(dt.datetime(2024, 2, 1) + dt.timedelta(hours=hour)).cast("timestamp_ntz")

    first = stored(S.fit_models(df.where("k <> 'e'"), keys, "ts", "y", at(0), order), "models")
    whole = {(r.k, r.step): (r.ts, r.yhat) for r in M.forecast_24h(df.where("k <> 'e'"), keys, "ts", "y", order=order).collect()}
    assert {(r.k, r.step): (r.ts, r.yhat) for r in S.forecast_models(first, keys).collect()} == whole
    # six hours later all stay, though the readings changed; the missing one is fitted
    later = df.withColumn("y", F.col("y") * 2)
    same = stored(S.refresh_models(later, first, keys, "ts", "y", at(6), order), "models")
    trained = {r.k: r.trained_at.hour for r in same.collect()}
    assert trained == {"a": 0, "b": 0, "c": 0, "e": 6}
    got = {(r.k, r.step): (r.ts, r.yhat) for r in S.forecast_models(same.where("k <> 'e'"), keys).collect()}
    assert got == whole
    # seven hours later the old ones are stale
    new = stored(S.refresh_models(later, same, keys, "ts", "y", at(7), order), "models")
    assert {r.k: r.trained_at.hour for r in new.collect()} == {"a": 7, "b": 7, "c": 7, "e": 6}
    want = {(r.k, r.step): r.yhat for r in M.forecast_24h(later, keys, "ts", "y", order=order).collect()}
    assert {(r.k, r.step): r.yhat for r in S.forecast_models(new, keys).collect()} == want


def test_refresh_with_null_keys_and_an_empty_store(spark):
    from hazeframe.plans import modelstore as S
    from hazeframe.session import stored
    df = frame(spark, {"a": ar1(50)}).unionByName(frame(spark, {"b": ar1(60)}).withColumn("k", F.lit(None).cast("string")))
    now = F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz")
    none = S.fit_models(df.limit(0), ["k"], "ts", "y", now)
    store = stored(S.refresh_models(df, none, ["k"], "ts", "y", now), "models")
    assert {r.k for r in store.collect()} == {"a", None}
    again = stored(S.refresh_models(df.limit(0), store, ["k"], "ts", "y", now + F.expr("interval 9 hours")), "models")
    assert {r.k for r in again.collect()} == {"a", None}
