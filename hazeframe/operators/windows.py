"""Rolling, lag and last-value operators per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeframe.functions.aqi import half_even
from hazeframe.functions.casts import hour_of
from hazeframe.scale import ranking, trailing


def rolling_mean(df: DataFrame, by: Sequence[str], order: Sequence[str], col: str, out: str,
                 rows: int = 8, least: int = 6) -> DataFrame:
    """Mean of the last ``rows`` rows, null while fewer than ``least`` hold a value."""
    done = trailing(df, by, order, rows - 1, {
        "_mean": (F.avg(col), -(rows - 1), 0), "_have": (F.count(col), -(rows - 1), 0)})
    return done.select(*df.columns, F.when(F.col("_have") >= least, F.col("_mean")).alias(out))


def spikes(df: DataFrame, by: Sequence[str], order: Sequence[str], col: str,
           rows: int = 24, sigmas: float = 3.0) -> DataFrame:
    """Flag values above the mean plus ``sigmas`` deviations of the ``rows`` rows before."""
    done = trailing(df, by, order, rows, {
        "prev_mean": (F.avg(col), -rows, -1), "prev_std": (F.stddev_samp(col), -rows, -1)})
    limit = F.col("prev_mean") + sigmas * F.col("prev_std")
    return done.withColumn("is_spike", F.coalesce(F.col(col) > limit, F.lit(False)))


def lags(df: DataFrame, by: Sequence[str], ts: str, col: str, steps: Sequence[int]) -> DataFrame:
    """Lag columns of an hourly series (one row per hour, so groups are small)."""
    w = Window.partitionBy(*by).orderBy(ts)
    return df.select("*", *[F.lag(col, k).over(w).alias(f"lag_{k}") for k in steps])


def last_valid(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Last non-null value of each column on its own; partial aggregates, no sort."""
    rank = ranking(order)
    return df.groupBy(*by).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c) for c in cols])


def latest_row(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key as a unit."""
    rest = [c for c in df.columns if c not in by]
    return (df.groupBy(*by).agg(F.max_by(F.struct(*rest), ranking(order)).alias("_r"))
            .select(*by, "_r.*"))


def _newest(df, by, order, n):
    # A row_number limit is applied before the shuffle as well, so at most n rows per
    # key and task travel.
    w = Window.partitionBy(*by).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)


def o3_8hr(df: DataFrame, by: Sequence[str], ts: str, tie: str, col: str = "o3") -> DataFrame:
    """Eight-hour ozone per key: raw last value, value used, method.

    The mean of the last 8 hours that hold data; with fewer hours the mean of the last
    8 readings; with fewer readings the last one.
    """
    raw = df.where(F.col(col).isNotNull())
    hourly = raw.groupBy(*by, hour_of(ts).alias("_hour")).agg(F.avg(col).alias("_mean"))
    hours = _newest(hourly, by, ["_hour"], 8).groupBy(*by).agg(
        F.avg("_mean").alias("_hours_mean"), F.count("*").alias("_hours"))
    reads = _newest(raw.select(*by, ts, tie, col), by, [ts, tie], 8).groupBy(*by).agg(
        F.avg(col).alias("_reads_mean"), F.count("*").alias("_reads"),
        F.max(F.when(F.col("_rn") == 1, F.col(col))).alias("o3_raw"))
    keys = df.groupBy(*by).agg(F.max(ts).alias("_newest"))
    both = keys.join(reads, list(by), "left").join(hours, list(by), "left")
    method = (F.when(F.col("_hours") >= 8, "8hr_resample")
              .when(F.col("_reads") >= 8, "8hr_rolling").otherwise("instant"))
    used = (F.when(F.col("_hours") >= 8, half_even(F.col("_hours_mean"), 2))
            .when(F.col("_reads") >= 8, half_even(F.col("_reads_mean"), 2)).otherwise(F.col("o3_raw")))
    return both.select(*by, "o3_raw", used.alias("o3_used"), method.alias("o3_method"))
