"""Training series: union, one row per time, hourly grid, fill, scale repair, weather."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeframe.functions.casts import calendar_parts, clip, to_number
from hazeframe.operators import columns as K
from hazeframe.operators.grid import hourly_mean, reindex_hourly
from hazeframe.operators.impute import impute_neighbours
from hazeframe.operators.joins import asof
from hazeframe.session import stored


def repair_scale(series: DataFrame, live: DataFrame, by: Sequence[str], ts: str, col: str,
                 live_ts: str, live_col: str, live_tie: Sequence[str] = ()) -> DataFrame:
    """Rescale a key's series when its last value is tiny next to the newest live value.

    Applies when abs(last) < 10 and live > 3 * last + 10. The factor is live / last
    (last counts as 1 when 0), held within [1, 1000].
    """
    by = list(by)
    # The series is hourly, so a window over a whole key is small, and it reuses the
    # partitioning of the fills before it.
    whole = Window.partitionBy(*by)
    last = F.max_by(col, F.when(F.col(col).isNotNull(), F.col(ts))).over(whole)
    now = live.groupBy(*by).agg(F.max_by(live_col, F.struct(live_ts, *live_tie)).alias("_live"))
    ratio = F.col("_live") / F.when(F.col("_last") == 0, F.lit(1.0)).otherwise(F.col("_last"))
    off = (F.abs("_last") < 10) & (F.col("_live") > F.col("_last") * 3 + 10)
    factor = F.when(off, F.least(F.greatest(ratio, F.lit(1.0)), F.lit(1000.0))).otherwise(F.lit(1.0))
    both = series.withColumn("_last", last).join(now, by, "left").withColumn("scale", factor)
    return both.withColumn(col, F.col(col) * F.col("scale")).drop("_last", "_live")


def training_series(sources: DataFrame, by: Sequence[str], tie: Sequence[str], align: str = "hour") -> DataFrame:
    """(key, timestamp, aqi) on an hourly grid without gaps.

    The last row of a time wins, gaps take the value before, leading gaps the one after.
    """
    ts, aqi = K.time_column(sources, "train"), K.aqi_column(sources)
    number = to_number(aqi) if dict(sources.dtypes)[aqi] == "string" else F.col(aqi).cast("double")
    rows = sources.select(*by, K.as_time(sources, ts).alias("timestamp"), number.alias("aqi"), *tie)
    grid = reindex_hourly(rows.where("timestamp is not null"), by, "timestamp", tie, align).drop(*tie)
    return impute_neighbours(grid, by, ["timestamp"], ["aqi"], bounded=True)


def training_frame(sources: DataFrame, weather: DataFrame, live: DataFrame | None, by: Sequence[str],
                   tie: Sequence[str], align: str = "hour") -> DataFrame:
    """Series, scale-repaired and held in [0, 500], with the nearest weather within 1 hour."""
    y = training_series(sources, by, tie, align)
    if live is not None:
        lts, value = K.time_column(live, "train"), K.aqi_column(live)
        live = live.withColumn(lts, K.as_time(live, lts)).where(F.col(lts).isNotNull())
        if dict(live.dtypes)[value] == "string":
            live = live.withColumn(value, to_number(value))
        y = repair_scale(y, live, by, "timestamp", "aqi", lts, value, tie)
    else:
        y = y.withColumn("scale", F.lit(1.0))
    y = y.withColumn("aqi", clip("aqi", 0, 500)).where("aqi is not null")
    wts = K.time_column(weather, "train")
    exog = K.exog_columns(weather)
    right = weather.select(*by, K.as_time(weather, wts).alias("timestamp"), *exog, *tie)
    near = asof(y, right, by, "timestamp", [], tie, "nearest", "1 hour",
                time_name="_weather_time", hourly_left=True)
    near = near.drop("_weather_time", *tie)
    filled = impute_neighbours(near, by, ["timestamp"], exog, bounded=True)
    # Hourly rows only, so small next to the readings; stored because the check below and
    # every fit read it again.
    filled = stored(filled, "training")
    return K.drop_all_null_columns(filled, exog)


def feature_frame(aqi: DataFrame, weather: DataFrame, target: str, ts: str, by: Sequence[str]) -> DataFrame:
    """Hourly features of both feeds and calendar parts next to the target, target last."""
    keys = [*by, ts]
    left = hourly_mean(aqi, by, ts)
    both = left.join(hourly_mean(weather, by, ts), keys, "left")
    parts = calendar_parts(ts)
    wide = both.withColumns({"hour": parts["hour"], "dayofweek": parts["dayofweek"]})
    names = [c for c in wide.columns if c not in (*keys, target)]
    return wide.select(*keys, *names, target)
