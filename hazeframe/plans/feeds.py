"""Feed cleaning plans: what a user calls on a raw feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeframe.functions.casts import clip, finite, non_negative, to_number, to_timestamp
from hazeframe.operators import columns as K
from hazeframe.operators.filters import with_time
from hazeframe.operators.grid import resample_hourly
from hazeframe.operators.impute import (
    impute_forward_median, impute_median, impute_neighbours, impute_unknown, impute_zero)

# Pollutant columns that cannot be negative.
POLLUTANTS = ("AQI", "PM2_5", "PM10", "NO2", "SO2", "CO")
SIGNED = ("temperature", "latitude", "longitude", "lat", "lon")
# Keywords of the live measures.
LIVE_KEYWORDS = {
    "aqi": ("pm2", "pm25", "pm10", "no2", "so2", "o3", "co", "aqi", "index"),
    "weather": ("temp", "temperature", "humidity", "pressure", "wind", "rain", "precip", "visibility"),
    "traffic": ("count", "vehicle", "speed", "flow", "occupancy", "volume"),
}


def parse_time(df: DataFrame, rules: str, name: str = "timestamp") -> DataFrame:
    """Find the time column, parse it in place under ``name`` and drop rows without one."""
    found = K.time_column(df, rules)
    if found is None:
        raise ValueError("no time column found")
    parsed = K.as_time(df, found)
    rest = [F.col(f"`{x}`") for x in df.columns if x not in (found, name)]
    return with_time(df.select(parsed.alias(name), *rest), name)


def _numbers(df: DataFrame, skip: Sequence[str]) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in skip or isinstance(f.dataType, T.BooleanType):
            out.append(c)
        elif isinstance(f.dataType, T.StringType):
            out.append(to_number(c).alias(f.name))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(finite(c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def _clean(df, feed, by, tie, time_rules, strict):
    keep = ["timestamp", *by, *tie]
    rows = K.canonical_rename(parse_time(df, time_rules), feed, skip=keep)
    rows = _numbers(rows, keep)
    numeric = K.numeric_columns(rows, keep)
    if feed == "aqi":
        at_least_zero = [c for c in POLLUTANTS if c in numeric]
    else:
        at_least_zero = [c for c in numeric if strict or c.lower() not in SIGNED]
    rows = rows.withColumns({c: non_negative(c) for c in at_least_zero})
    if "AQI" in numeric:
        rows = rows.withColumn("AQI", clip("AQI", 0, 1000))
    return rows, numeric


def clean_aqi(df: DataFrame, by: Sequence[str] = ("station",), tie: Sequence[str] = (),
              time_rules: str = "clean") -> DataFrame:
    """Hourly air-quality series: cast, drop negatives, median fill, hourly mean on a full grid."""
    rows, numeric = _clean(df, "aqi", by, tie, time_rules, False)
    filled = impute_median(rows, numeric)
    return resample_hourly(filled.drop(*tie), by, "timestamp")


def _clean_flow(df, feed, by, tie, time_rules, strict):
    rows, numeric = _clean(df, feed, by, tie, time_rules, strict)
    filled = impute_forward_median(rows, by, ["timestamp", *tie], numeric)
    return resample_hourly(filled.drop(*tie).dropDuplicates(), by, "timestamp")


def clean_traffic(df: DataFrame, by: Sequence[str] = ("station",), tie: Sequence[str] = (),
                  time_rules: str = "clean", strict: bool = False) -> DataFrame:
    """Hourly traffic series: last value then median fill, duplicate rows removed."""
    return _clean_flow(df, "traffic", by, tie, time_rules, strict)


def clean_weather(df: DataFrame, by: Sequence[str] = ("station",), tie: Sequence[str] = (),
                  time_rules: str = "clean", strict: bool = False) -> DataFrame:
    """Hourly weather series. ``strict`` also drops temperatures below zero."""
    return _clean_flow(df, "weather", by, tie, time_rules, strict)


def preprocess(df: DataFrame, required: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Check columns, parse times without their zone, drop rows without one and copies."""
    K.require_columns(df, required)
    text = isinstance(df.schema["timestamp"].dataType, T.StringType)
    ts = to_timestamp("timestamp") if text else F.col("timestamp").cast("timestamp_ntz")
    return with_time(df.withColumn("timestamp", ts), "timestamp").dropDuplicates()


def process_live(df: DataFrame, feed: str, by: Sequence[str], tie: Sequence[str], source: str,
                 strategy: str | None = None, dedup: bool = True) -> DataFrame:
    """Row-preserving clean-up of a live feed: tidy names, copies out, casts, fills, source.

    ``strategy`` is ``median`` (air quality), ``ffill`` (weather, traffic) or ``zero``.
    """
    strategy = strategy or ("median" if feed == "aqi" else "ffill")
    rows = K.tidy_columns(df)
    rows = rows.dropDuplicates() if dedup else rows
    times = K.time_columns(rows)
    out = []
    for f in rows.schema.fields:
        text = isinstance(f.dataType, T.StringType)
        if f.name in times:
            out.append((to_timestamp(f.name) if text else F.col(f.name).cast("timestamp_ntz")).alias(f.name))
        elif f.name not in (*by, *tie) and text and any(k in f.name for k in LIVE_KEYWORDS[feed]):
            out.append(to_number(f.name, commas=False).alias(f.name))
        else:
            out.append(F.col(f.name))
    rows = rows.select(*out)
    numeric = K.numeric_columns(rows, [*by, *tie])
    if strategy == "median":
        rows = impute_median(rows, numeric, zero_if_empty=True)
    elif strategy == "ffill":
        # Rows without a time sort last, so a null time must not sort first.
        late = rows.withColumn("_late", F.col(times[0]).isNull()) if times else rows
        order = (["_late", times[0]] if times else []) + list(tie)
        rows = impute_neighbours(late, by, order, numeric, zero=True).drop("_late")
    else:
        rows = impute_zero(rows, numeric)
    rows = impute_unknown(rows, K.text_columns(rows))
    return K.add_source(rows, source, bool(times))
