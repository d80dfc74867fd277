"""Every registered query against its SQL on the small tables."""

import pytest

from conftest import SMALL, rows_of, rows_of_sql
from hazeframe.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    assert rows_of(QUERIES[name](spark, SMALL)) == rows_of_sql(duck, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


HOT = ["impute_ffill_median", "impute_ffill_bfill_zero", "impute_ffill_bfill", "impute_ffill_table", "impute_median",
       "rolling_mean_8", "asof_nearest", "asof_backward", "daily_median", "station_median_top10", "boxplot_stats",
       "describe_numeric", "clean_aqi", "clean_weather", "clean_traffic", "combined_daily", "training_frame",
       "asof_nearest_null_times", "asof_backward_null_times", "spike_detect"]


@pytest.mark.parametrize("name", HOT)
def test_same_rows_when_keys_are_split(split, duck, name):
    assert rows_of(QUERIES[name](split, SMALL)) == rows_of_sql(duck, ORACLES[name])


def test_entry_points(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
