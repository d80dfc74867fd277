"""Row filters and duplicate handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe.operators.columns import numeric_columns
from hazeframe.scale import one_row, ranking


def with_time(df: DataFrame, ts: str) -> DataFrame:
    return df.where(F.col(ts).isNotNull())


def drop_all_null_rows(df: DataFrame, among: Sequence[str] | None = None) -> DataFrame:
    """Drop rows in which every numeric column is null."""
    return df.na.drop(how="all", subset=list(among or numeric_columns(df)))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last in ``order``. An aggregate: copies shrink before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), ranking(order)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, "_last.*").select(*df.columns)


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in full; nulls are equal."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicates"))


def pair_rows(df: DataFrame, keep: Sequence[str], a: str, b: str) -> DataFrame:
    """Rows in which both members of a pair have a value."""
    return df.select(*keep, a, b).na.drop(subset=[a, b])


def last_hours(df: DataFrame, ts: str, hours: int = 24) -> DataFrame:
    """Rows of the last ``hours`` before the newest time in the table."""
    newest = df.agg(F.max(ts).alias("newest"))
    return df.where(F.col(ts) > one_row(newest)["newest"] - F.expr(f"interval {int(hours)} hours"))
