"""Fitted models as a table: forecasts without refitting, and refits of stale series only.

A row holds all a forecast needs: coefficients, the last values and shocks, and the levels
that undo the differences. Readings of a series that is still fresh are never touched.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeframe.plans import forecast as M
from hazeframe.scale import null_safe
from hazeframe.session import ship

_STATE = ("beta", "ar", "ma", "recent", "shocks", "ends")
_FIELDS = ("trained_at timestamp_ntz, last_ts timestamp_ntz, points long, mean double, beta array<double>, ar array<int>, ma array<int>, "
           "recent array<double>, shocks array<double>, ends array<double>, seasons array<array<double>>")
_NAMES = [f.split()[0] for f in _FIELDS.split(", ")]


def _schema(df: DataFrame, keys: Sequence[str]) -> str:
    return ", ".join(f"{k} {t}" for k, t in df.select(*keys).dtypes)


def fit_models(df: DataFrame, keys: Sequence[str], ts: str, y: str, now: Column, order: tuple = M.FORECAST_ORDER) -> DataFrame:
    """One model row per series of at least ``forecast.MIN_POINTS`` values; a series that
    cannot be fitted keeps its mean and no coefficients. ``now`` becomes trained_at."""
    keys = list(keys)
    names = [*keys, *(n for n in _NAMES if n != "trained_at")]
    made = ", ".join([_schema(df, keys), *(f for f in _FIELDS.split(", ") if not f.startswith("trained_at"))])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ts)
        known = pdf[y].dropna().to_numpy(float)
        out = pd.DataFrame({c: pd.Series([], dtype=object) for c in names})
        if len(known) < M.MIN_POINTS:
            return out
        fit, _, _ = M._fit_or_mean(known, *order)
        state = M.model_state(known, fit) if fit else {}
        row = {**{k: pdf[k].iloc[0] for k in keys}, "last_ts": pdf[ts].iloc[-1], "points": len(known), "mean": known.mean(),
               **{c: list(state[c]) if fit else None for c in _STATE}, "seasons": [list(s) for s in state["seasons"]] if fit else None}
        return pd.DataFrame({c: pd.Series([row[c]], dtype=object if c not in ("last_ts", "points", "mean") else None) for c in names})

    ship(df.sparkSession)
    fitted = M.within_length(df.select(*keys, ts, y), keys).groupBy(*keys).applyInPandas(run, made)
    return fitted.select(*keys, now.cast("timestamp_ntz").alias("trained_at"), *[n for n in _NAMES if n != "trained_at"])


def forecast_models(models: DataFrame, keys: Sequence[str], steps: int = M.HORIZON) -> DataFrame:
    """(keys, step, ts, yhat) of every stored model, as ``forecast.forecast_24h`` gives them
    on the readings it was trained on."""
    keys = list(keys)
    schema = _schema(models, keys) + ", step int, ts timestamp_ntz, yhat double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ahead = np.arange(1, steps + 1, dtype="int32")
        for pdf in batches:
            for row in pdf.to_dict("records"):
                if row["beta"] is None:
                    values = np.full(steps, row["mean"])
                else:
                    state = {c: list(row[c]) for c in _STATE}
                    values = M.forecast_state({**state, "outside": [], "seasons": [list(s) for s in row["seasons"]]}, steps)
                yield M._rows({k: row[k] for k in keys}, steps, step=ahead,
                              ts=row["last_ts"] + pd.to_timedelta(ahead, unit="h"), yhat=values)

    ship(models.sparkSession)
    return models.mapInPandas(run, schema)


def refresh_models(df: DataFrame, models: DataFrame, keys: Sequence[str], ts: str, y: str, now: Column,
                   order: tuple = M.FORECAST_ORDER, hours: int = M.RETRAIN_HOURS) -> DataFrame:
    """The store after a run at ``now``: models up to ``hours`` old stay as they are, series
    without one or with an older one are fitted. Models of series that ``df`` no longer
    holds stay. Only rows of stale series are shuffled to a fit."""
    keys = list(keys)
    ages = null_safe(df.select(*keys).distinct(), models.select(*keys, "trained_at"), keys, "left")
    fresh = F.coalesce(now.cast("timestamp_ntz") - F.col("trained_at") <= F.expr(f"interval {int(hours)} hours"), F.lit(False))
    stale = ages.where(~fresh).select(*keys)
    fitted = fit_models(null_safe(df, stale, keys, "left_semi"), keys, ts, y, now, order)
    return null_safe(models, stale, keys, "left_anti").select(*keys, *_NAMES).unionByName(fitted)
