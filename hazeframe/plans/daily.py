"""Daily medians of the three feeds side by side, and their correlation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe.functions.casts import digits_to_number
from hazeframe.operators import columns as K
from hazeframe.operators.filters import drop_all_null_rows
from hazeframe.operators.joins import outer_join
from hazeframe.operators.profile import daily_median


def digits_where_numeric(df: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    """Cast text columns in which some value holds a digit and parses after stripping.

    One aggregate decides for all columns.
    """
    texts = K.text_columns(df, skip)
    if not texts:
        return df
    probes = []
    for i, c in enumerate(texts):
        col = F.col(f"`{c}`")
        probes += [F.count_if(col.rlike("[0-9]")).alias(f"d{i}"), F.count(digits_to_number(col)).alias(f"p{i}")]
    row = df.agg(*probes).first()
    able = {c for i, c in enumerate(texts) if row[f"d{i}"] and row[f"p{i}"]}
    return df.select(*[digits_to_number(F.col(f"`{c}`")).alias(c) if c in able else F.col(f"`{c}`")
                       for c in df.columns])


def daily_table(df: DataFrame, skip: tuple[str, ...] = (), approx: bool = False) -> DataFrame:
    """Tidy a feed and take the median of each numeric column per date."""
    rows = K.tidy_columns(df, "daily")
    ts = K.time_column(rows, "daily")
    rows = digits_where_numeric(rows, (ts, *skip))
    return daily_median(rows, ts, K.numeric_columns(rows, (ts, *skip)), approx)


def combined_daily(weather: DataFrame, traffic: DataFrame, aqi: DataFrame) -> DataFrame:
    """Full outer join of daily tables on date; rows without any number are dropped."""
    both = outer_join(weather, traffic, ["date"], ("_w", "_t"))
    three = outer_join(both, aqi, ["date"], ("", "_a"))
    return drop_all_null_rows(three)
