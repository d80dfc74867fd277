"""Mergeable quantile sketches: kept per day, merged over any span of days.

A KLL sketch answers any quantile of the values it has seen with a bounded rank error,
and two sketches merge into the sketch of both. A table of them (one row per day and
column, a few kilobytes each) answers for months without a look at the readings, and a
new day adds its rows and touches no other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size parameter of the sketches.
K = 4096


def rank_error(k: int = K) -> float:
    """Error of a rank as a share of all values, kept with 99 % confidence (the fitted
    power law that the sketch's authors publish for single quantiles)."""
    return 2.296 / k ** 0.9021


def sketch(value: Column, k: int = K) -> Column:
    """Aggregate: the sketch of a column; nulls and NaN are not counted."""
    return F.kll_sketch_agg_double(F.nanvl(value.cast("double"), F.lit(None).cast("double")), F.lit(k))


def daily_sketches(df: DataFrame, ts: str, cols: Sequence[str], by: Sequence[str] = (), k: int = K) -> DataFrame:
    """(by, date, column_name, n, sketch): one row per day and column that has values.
    Rows without a time are left out."""
    dated = df.where(F.col(ts).isNotNull()).groupBy(*by, F.to_date(ts).alias("date"))
    wide = dated.agg(*[x for i, c in enumerate(cols) for x in (
        F.count(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))).alias(f"_n{i}"), sketch(F.col(c), k).alias(f"_s{i}"))])
    items = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("n"), F.col(f"_s{i}").alias("sketch"))
                      for i, c in enumerate(cols)])
    return wide.select(*by, "date", F.explode(items).alias("_e")).select(*by, "date", "_e.*").where("n > 0")


def merged(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of each ``by`` group as one, with the number of values."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """One row per sketch and probability, with the quantile in ``value``."""
    probs = F.array(*[F.lit(float(p)) for p in probs])
    found = F.arrays_zip(probs.alias("prob"), F.kll_sketch_get_quantile_double("sketch", probs).alias("value"))
    cols = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*cols, F.explode(found).alias("_e")).select(*cols, "_e.*")
