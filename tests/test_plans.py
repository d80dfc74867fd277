"""Physical plans: what must and must not appear in them."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from hazeframe.catalog import QUERIES
from hazeframe.catalog import views as V
from hazeframe.functions.aqi import score_aqi

PYTHON = {"forecast_24h", "forecast_110", "arima_grid_best", "arima_wide_search", "ar_order_search", "insample_fit",
          "insample_fixed_order", "model_metadata", "arima_stepwise", "ar_stepwise", "forecast_refresh",  # model fits
          "corr_matrix", "top_corr_pairs"}  # matrix products
EAGER = {k for k in QUERIES if k.startswith("stream_")} | {"linreg_two_features", "linreg_metrics", "gbt_metrics", "feature_importance", "what_if_fitted"}


def plan(df, capsys, mode=None):
    capsys.readouterr()
    df.explain(mode) if mode else df.explain()
    return capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_pair_joins_and_no_python(spark, capsys, name):
    text = plan(QUERIES[name](spark, SMALL), capsys)
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    if name not in PYTHON:
        assert not re.search(r"Python|InPandas|InArrow", text)


def test_scoring_has_no_shuffle_and_prunes(spark, capsys):
    df = score_aqi(V.air_wide(spark, SMALL), "in_strict").where("aqi > 100").select("ord", "aqi")
    text = plan(df, capsys)
    assert "Exchange" not in text
    assert "event_type IN" in text or "In(event_type" in text


def test_scoring_method_stays_compilable(spark, capsys):
    """HotSpot never compiles a method of more than 8000 bytes."""
    for scheme in ("in_strict", "in_report", "us"):
        df = score_aqi(V.air_wide(spark, SMALL), scheme)
        for out in (df.select("ord", "aqi", "dominant"), df.where("aqi > 100").select("ord", "dominant")):
            sizes = [int(s) for s in re.findall(r"maxMethodCodeSize:(\d+)", plan(out, capsys, "codegen"))]
            assert sizes and max(sizes) < 8000


def test_newest_rows_are_limited_before_the_shuffle(spark, capsys):
    text = plan(QUERIES["o3_8hr_value"](spark, SMALL), capsys)
    assert "WindowGroupLimit" in text and "Partial" in text


def test_hourly_mean_combines_before_the_shuffle(spark, capsys):
    text = plan(QUERIES["hourly_mean"](spark, SMALL), capsys)
    assert "partial_avg" in text and text.count("Exchange") == 1


def test_pushdown_reaches_the_scan(spark, capsys):
    text = plan(V.wx(spark, SMALL).select("ord", F.col("temperature")), capsys)
    assert "EqualTo(event_type,purchase)" in text
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in text
