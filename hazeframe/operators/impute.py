"""Filling of missing values. Ordered fills work per key in (time, tie-break) order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe.operators.columns import numeric_columns, text_columns
from hazeframe.scale import carry, group_sizes, medians, one_row


def _targets(df: DataFrame, cols: Sequence[str] | None, skip: Sequence[str]) -> list[str]:
    return list(cols) if cols is not None else numeric_columns(df, skip)


def impute_median(df: DataFrame, cols: Sequence[str] | None = None, skip: Sequence[str] = (),
                  zero_if_empty: bool = False, approx: bool = False) -> DataFrame:
    """Fill with the median of the whole column, read through a scalar subquery."""
    cols = _targets(df, cols, skip)
    med = one_row(medians(df, [], cols, approx))
    parts = [F.lit(0.0)] if zero_if_empty else []
    return df.withColumns({c: F.coalesce(F.col(c), med[c], *parts) for c in cols})


def _filled(df, by, order, cols, forward, backward, bounded, sizes=None):
    ahead = {f"_ff_{c}": c for c in cols} if forward else {}
    behind = {f"_bf_{c}": c for c in cols} if backward else {}
    return carry(df, by, order, ahead, behind, bounded, sizes)


def impute_forward_median(df: DataFrame, by: Sequence[str], order: Sequence[str],
                          cols: Sequence[str] | None = None, skip: Sequence[str] = ()) -> DataFrame:
    """Last value before, then the column median taken before any filling."""
    cols = _targets(df, cols, list(skip) + list(by) + list(order))
    total, largest = group_sizes(df, by)
    med = one_row(medians(df, [], cols, sizes=(total, total)))
    filled = _filled(df, by, order, cols, True, False, False, (total, largest))
    return filled.select(*[F.coalesce(F.col(f"_ff_{c}"), med[c]).alias(c) if c in cols else c
                           for c in df.columns])


def impute_neighbours(df: DataFrame, by: Sequence[str], order: Sequence[str],
                      cols: Sequence[str] | None = None, skip: Sequence[str] = (),
                      zero: bool = False, bounded: bool = False) -> DataFrame:
    """Last value before, else first value after, else 0 if ``zero``."""
    cols = _targets(df, cols, list(skip) + list(by) + list(order))
    filled = _filled(df, by, order, cols, True, True, bounded)
    rest = [F.lit(0)] if zero else []
    return filled.select(*[
        F.coalesce(F.col(f"_ff_{c}"), F.col(f"_bf_{c}"), *rest).alias(c) if c in cols else c
        for c in df.columns])


def impute_zero(df: DataFrame, cols: Sequence[str] | None = None, skip: Sequence[str] = ()) -> DataFrame:
    return df.na.fill(0, subset=_targets(df, cols, skip))


def impute_unknown(df: DataFrame, cols: Sequence[str] | None = None, skip: Sequence[str] = ()) -> DataFrame:
    return df.na.fill("Unknown", subset=list(cols) if cols is not None else text_columns(df, skip))
