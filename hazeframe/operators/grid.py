"""Hourly grids and resampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeframe.functions.casts import hour_of
from hazeframe.operators.columns import numeric_columns
from hazeframe.operators.filters import keep_last

MAX_GAP_HOURS = 200_000


def _hours(n: int = 1) -> Column:
    return F.expr(f"interval {int(n)} hours")


def hourly_mean(df: DataFrame, by: Sequence[str], ts: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Mean per key and clock hour; hours without rows are absent."""
    if cols is None:
        cols = numeric_columns(df, [*by, ts]) + [
            f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    means = []
    for c in cols:
        flag = isinstance(df.schema[c].dataType, T.BooleanType)
        means.append(F.avg(F.col(c).cast("int") if flag else F.col(c)).alias(c))
    return df.groupBy(*by, hour_of(ts).alias(ts)).agg(*means)


def _hours_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("HOUR", start, end)


def fill_hours(df: DataFrame, by: Sequence[str], ts: str, end: str | None = None,
               max_gap: int = MAX_GAP_HOURS) -> DataFrame:
    """Add null rows for the missing hours of a series with one row per hour.

    Each row yields itself and the hours up to the next one, so no grid is joined. A
    gap longer than ``max_gap`` hours (a stray far-off time) is left open, and
    ``long_gaps`` lists it.
    """
    w = Window.partitionBy(*by).orderBy(ts)
    step = F.lead(ts).over(w) - _hours()
    until = F.coalesce(step, F.col(end) if end else F.col(ts))
    rows = df.withColumn("_until", until)
    gap = _hours_between(F.col(ts), F.col("_until"))
    hours = F.sequence(F.col(ts), F.when(gap > max_gap, F.col(ts)).otherwise(F.col("_until")), _hours())
    rest = [c for c in df.columns if c not in (*by, ts, end)]
    spread = rows.select(*by, *[F.col(c).alias(f"_v_{c}") for c in rest], F.posexplode(hours).alias("_at", ts))
    return spread.select(
        *by, ts, *[F.when(F.col("_at") == 0, F.col(f"_v_{c}")).alias(c) for c in rest])


def long_gaps(df: DataFrame, by: Sequence[str], ts: str, max_gap: int = MAX_GAP_HOURS) -> DataFrame:
    """The error output of ``fill_hours``: key, start, end and hours of every gap it leaves open."""
    w = Window.partitionBy(*by).orderBy(ts)
    rows = df.select(*by, F.col(ts).alias("gap_start"), F.lead(ts).over(w).alias("gap_end"))
    return rows.withColumn("hours", _hours_between(F.col("gap_start"), F.col("gap_end"))).where(F.col("hours") > max_gap)


def resample_hourly(df: DataFrame, by: Sequence[str], ts: str, cols: Sequence[str] | None = None,
                    max_gap: int = MAX_GAP_HOURS) -> DataFrame:
    """Hourly mean with null rows for empty hours between a key's first and last hour."""
    return fill_hours(hourly_mean(df, by, ts, cols), by, ts, max_gap=max_gap)


def reindex_hourly(df: DataFrame, by: Sequence[str], ts: str, order: Sequence[str],
                   align: str = "hour", max_gap: int = MAX_GAP_HOURS) -> DataFrame:
    """One row per hour, the last of its time, null where there is none.

    ``align="hour"`` moves rows to their clock hour. ``align="first"`` anchors the grid
    on the first time of a key and drops rows that miss it.
    """
    if align == "hour":
        at = df.withColumn("_at", hour_of(ts))
        rest = [c for c in df.columns if c not in (*by, ts)]
        last = F.max_by(F.struct(*rest), F.struct(ts, *order)).alias("_r")
        rows = at.groupBy(*by, "_at").agg(last).select(*by, F.col("_at").alias(ts), "_r.*")
        return fill_hours(rows.select(*df.columns), by, ts, max_gap=max_gap)
    span = df.groupBy(*by).agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    unique = keep_last(df, [*by, ts], order)
    placed = unique.join(span, list(by)).withColumn("_off", F.timestamp_diff("MICROSECOND", F.col("_first"), F.col(ts)))
    whole = _hours_between(F.col("_first"), F.col("_last"))
    placed = placed.where(F.col("_off") % 3_600_000_000 == 0).withColumn(
        "_end", F.timestamp_add("HOUR", whole.cast("int"), F.col("_first")).cast("timestamp_ntz"))
    return fill_hours(placed.drop("_first", "_last", "_off"), by, ts, end="_end", max_gap=max_gap)


def future_grid(df: DataFrame, by: Sequence[str], ts: str, steps: int = 24) -> DataFrame:
    """The next ``steps`` hours after the newest time of each key."""
    last = df.groupBy(*by).agg(F.max(ts).alias("_last"))
    hours = F.sequence(F.col("_last") + _hours(), F.col("_last") + _hours(steps), _hours())
    return last.select(*by, F.posexplode(hours).alias("step", ts)).withColumn("step", F.col("step") + 1)
