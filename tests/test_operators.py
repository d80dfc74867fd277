"""Tie rules, edge cases and properties on small hand-made tables."""

import datetime as dt

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hazeframe import scale
from hazeframe.functions import casts as C
from hazeframe.functions.places import match_places
from hazeframe.operators import columns as K
from hazeframe.operators import grid as G
from hazeframe.operators import impute as I
from hazeframe.operators import joins as J
from hazeframe.operators import upsert as U


def at(h, m=0, day=1):
    return dt.datetime(2024, 1, day, h, m)


def test_nearest_ties_and_tolerance(spark):
    left = spark.createDataFrame([(1, at(1), 1), (1, at(3), 2), (1, at(3, 1), 3)], "k int, ts timestamp_ntz, ord int")
    right = spark.createDataFrame([(1, at(0), 1, "a"), (1, at(2), 2, None), (1, at(2), 3, "b")],
                                  "k int, ts timestamp_ntz, ord int, v string")
    got = {r.ord: (r.w_v, r.w_ts) for r in J.asof(left, right, ["k"], "ts", ["ord"], ["ord"], "nearest", "1 hour", "w_").collect()}
    assert got == {1: ("b", at(2)), 2: ("b", at(2)), 3: (None, None)}


def test_nearest_takes_the_whole_row(spark):
    left = spark.createDataFrame([(1, at(1), 1)], "k int, ts timestamp_ntz, ord int")
    right = spark.createDataFrame([(1, at(1, 1), 1, None, 5.0), (1, at(1, 2), 2, "x", 6.0)],
                                  "k int, ts timestamp_ntz, ord int, v string, n double")
    r = J.asof(left, right, ["k"], "ts", ["ord"], ["ord"], "nearest", "1 hour", "w_").first()
    assert (r.w_v, r.w_n) == (None, 5.0)


def test_outer_join_matches_null_keys(spark):
    a = spark.createDataFrame([(None, 1), (1, 2)], "k int, v int")
    b = spark.createDataFrame([(None, 3), (2, 4)], "k int, v int")
    got = sorted(((r.k or 0), r.v_x, r.v_y) for r in J.outer_join(a, b, ["k"]).collect())
    assert [(k, x, y) for k, x, y in got] == [(0, 1, 3), (1, 2, None), (2, None, 4)]


@pytest.mark.parametrize("limit", ["4000000", "8"])
def test_masters_keep_all_rows_of_a_time(spark, limit):
    """Several stations an hour, null times and copies, against two pandas merges; with the
    lower limit the hot times are cut into cells."""
    times = [at(1)] * 9 + [at(2)] * 2 + [None, None, at(4)]
    aqi = [(t, f"a{i}", float(i)) for i, t in enumerate(times)] + [(at(6), "same", 1.0)] * 12
    weather = [(t, f"w{i}", -i) for i, t in enumerate([at(1)] * 5 + [None, at(3), at(4), at(4)])]
    traffic = [(f"t{i}", t, i) for i, t in enumerate([at(1), at(1), at(3), None, None, at(5)])]
    feeds = [("reading_time", "station", "o3"), ("obs_date", "station", "temperature"), ("station", "timestamp", "vehicles")]
    kinds = ["{} timestamp_ntz, {} string, {} double", "{} timestamp_ntz, {} string, {} int", "{} string, {} timestamp_ntz, {} int"]
    frames = [pd.DataFrame(rows, columns=names) for rows, names in zip((aqi, weather, traffic), feeds)]
    frames = [f.rename(columns={"reading_time": "timestamp", "obs_date": "timestamp"}) for f in frames]
    want = frames[0].merge(frames[1], on="timestamp", how="outer", suffixes=("_aqi", "_weather"))
    want = want.merge(frames[2], on="timestamp", how="outer")
    spark.conf.set("spark.hazeframe.groupRowLimit", limit)
    try:
        got = J.merge_masters(*[spark.createDataFrame(rows, kind.format(*names)) for rows, kind, names in
                                zip((aqi, weather, traffic), kinds, feeds)])
        rows = got.collect()
    finally:
        spark.conf.unset("spark.hazeframe.groupRowLimit")
    assert got.columns == list(want.columns)

    def cells(row):
        return tuple("" if pd.isna(v) else str(float(v)) if isinstance(v, (int, float)) else str(v) for v in row)

    assert sorted(cells(r) for r in rows) == sorted(cells(r) for r in want.itertuples(index=False))
    known = [r["timestamp"] for r in rows if r["timestamp"]]
    assert known == sorted(known) and len(rows) > len(set(known)) + 1


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 40), st.one_of(st.none(), st.integers(0, 9))), min_size=1, max_size=160))
def test_fills_equal_pandas_also_when_split(split, rows):
    data = [(k, at(0) + dt.timedelta(minutes=m), i, None if v is None else float(v)) for i, (k, m, v) in enumerate(rows)]
    df = split.createDataFrame(data, "k string, ts timestamp_ntz, ord int, v double")
    split.conf.set("spark.hazeframe.groupRowLimit", "20")
    got = {r.ord: r.v for r in I.impute_neighbours(df, ["k"], ["ts", "ord"]).collect()}
    pdf = pd.DataFrame(data, columns=["k", "ts", "ord", "v"]).sort_values(["ts", "ord"])
    pdf["v"] = pdf.groupby("k")["v"].transform(lambda s: s.astype(float).ffill().bfill())
    want = {o: None if pd.isna(v) else v for o, v in zip(pdf["ord"], pdf["v"])}
    assert got == want


def test_one_hot_timestamp_is_split(split):
    """Most rows share one key and one time; the tie-break column still splits them."""
    rows = split.range(3000).select(
        F.lit("hot").alias("k"), F.lit(at(5)).cast("timestamp_ntz").alias("ts"), F.col("id").alias("ord"),
        F.when(F.col("id") % 700 == 0, F.col("id").cast("double")).alias("v"))
    got = [r.v for r in scale.carry(rows, ["k"], ["ts", "ord"], {"f": "v"}).orderBy("ord").select(F.col("f").alias("v")).collect()]
    assert got == [float(i // 700 * 700) for i in range(3000)]
    sizes = scale.ordered_chunks(rows, ["k"], ["ts", "ord"], 3000).groupBy(scale.CHUNK).count()
    assert sizes.agg(F.max("count")).first()[0] < 400


def test_quantiles_split_equal_numpy(split):
    rows = split.range(1000).select((F.col("id") % 3).alias("k"), ((F.col("id") * 37) % 101).cast("double").alias("v"))
    got = {r.k: r.v for r in scale.quantiles(rows, ["k"], ["v"], [0.1, 0.5, 0.9]).collect()}
    pdf = rows.toPandas()
    for k, part in pdf.groupby("k"):
        want = part["v"].quantile([0.1, 0.5, 0.9]).tolist()
        assert got[k] == pytest.approx(want, abs=1e-9)


def test_trailing_split_equals_window(split):
    from hazeframe.operators.windows import spikes
    rows = split.range(900).select(F.lit(1).alias("k"), F.col("id").alias("ord"), ((F.col("id") * 7919) % 97).cast("double").alias("v"))
    cut = {r.ord: r.prev_mean for r in spikes(rows, ["k"], ["ord"], "v").collect()}
    split.conf.unset("spark.hazeframe.groupRowLimit")
    whole = {r.ord: r.prev_mean for r in spikes(rows, ["k"], ["ord"], "v").collect()}
    assert cut.keys() == whole.keys()
    assert all((a is None) == (whole[k] is None) and (a is None or abs(a - whole[k]) < 1e-9) for k, a in cut.items())


def test_resample_keeps_empty_hours_and_sums(spark):
    rows = spark.createDataFrame([("a", at(0, 10), 1.0), ("a", at(0, 50), 3.0), ("a", at(3, 5), 5.0), ("b", at(7), None)],
                                 "k string, ts timestamp_ntz, v double")
    got = [(r.k, r.ts, r.v) for r in G.resample_hourly(rows, ["k"], "ts", ["v"]).orderBy("k", "ts").collect()]
    assert got == [("a", at(0), 2.0), ("a", at(1), None), ("a", at(2), None), ("a", at(3), 5.0), ("b", at(7), None)]


def test_far_off_time_is_listed_and_the_rest_goes_on(spark):
    rows = spark.createDataFrame([("a", at(0), 1.0), ("a", at(2), 2.0), ("a", dt.datetime(9990, 1, 1), 1.0)],
                                 "k string, ts timestamp_ntz, v double")
    assert G.resample_hourly(rows, ["k"], "ts", ["v"]).count() == 4
    stray = G.long_gaps(rows, ["k"], "ts").collect()
    assert [(r.k, r.gap_start, r.gap_end.year) for r in stray] == [("a", at(2), 9990)]


def test_reindex_first_keeps_the_minute(spark):
    rows = spark.createDataFrame([("a", at(0, 7), 1, 1.0), ("a", at(1, 8), 2, 2.0), ("a", at(2, 7), 3, 3.0), ("a", at(4, 30), 4, 4.0)],
                                 "k string, ts timestamp_ntz, ord int, v double")
    got = [(r.ts, r.v) for r in G.reindex_hourly(rows, ["k"], "ts", ["ord"], align="first").orderBy("ts").collect()]
    assert got == [(at(0, 7), 1.0), (at(1, 7), None), (at(2, 7), 3.0), (at(3, 7), None), (at(4, 7), None)]


def test_merge_measures(spark):
    cols = "k int, city string, aqi int, ord int"
    old = spark.createDataFrame([(1, "old", 10, 1), (2, "old", 20, 1)], cols)
    new = spark.createDataFrame([(1, "new", None, 1), (3, "new", 30, 1), (3, "new", 31, 2)], cols)
    merged = U.merge_measures(old, new, ["k"], ["city"], ["aqi"], ["ord"])
    assert sorted((r.k, r.city, r.aqi) for r in merged.collect()) == [(1, "old", None), (2, "old", 20), (3, "new", 31)]
    again = U.merge_measures(merged.withColumn("ord", F.lit(0)), new, ["k"], ["city"], ["aqi"], ["ord"])
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, merged.collect()), key=str)
    assert U.inserted_count(old, new, ["k"]).first().inserted == 1


TIMES = [
    ("clean", ["v", "my_date", "timestamp"], "my_date"), ("train", ["my_date", "Timestamp"], "Timestamp"),
    ("train", ["v", "run_date"], "run_date"), ("live", ["counts", "Time"], "counts"), ("merge", ["Time", "date"], "date"),
    ("daily", ["recorded_at", "timestamp"], "timestamp"), ("daily", ["recorded_at"], "recorded_at"),
    ("report", ["mytime"], None), ("report", ["DateTime", "time"], "time"),
]


@pytest.mark.parametrize("rules,cols,want", TIMES)
def test_time_rules(spark, rules, cols, want):
    df = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in cols))
    assert K.time_column(df, rules) == want


def test_numbers_are_no_times(spark):
    df = spark.createDataFrame([], "currentTravelTime bigint, at_time string")
    assert K.time_column(df, "clean") == "at_time"


def test_other_finders(spark):
    df = spark.createDataFrame([], "PM25_AQI int, FINAL_AQI int, O3_8hr double, o3 double, windspeed double, dew double")
    assert K.aqi_column(df) == "FINAL_AQI"
    assert K.o3_column(df) == "O3_8hr"
    assert K.exog_columns(df) == ["windspeed"]
    assert K.resolve(["a_pm2", "pm25"], contains=["pm25", "pm2"], keyword_major=True) == "pm25"
    with pytest.raises(ValueError):
        K.require_columns(df, ["timestamp"])
    with pytest.raises(ValueError):
        K.tidy_columns(spark.createDataFrame([], "`A b` int, `a-b` int"))


def test_rename_collisions():
    assert K.canonical_names(["freeFlowSpeed", "avg_speed", "vehicles"], "traffic") == {"vehicles": "vehicle_count", "avg_speed": "avg_speed"}
    got = K.canonical_names(["NO2_AQI", "NO2", "PM25_AQI", "FINAL_AQI"], "aqi")
    assert got == {"NO2": "NO2", "FINAL_AQI": "AQI"}
    assert K.canonical_names(["dew_temp", "temp"], "weather") == {"temp": "temperature"}


def test_casts(spark):
    text = [("1,234.5", 1234.5), (" 7 ", 7.0), ("1e3", 1000.0), ("1e999", None), ("0x1p3", None), ("1f", None), ("nan", None),
            ("Infinity", None), ("", None), (None, None), ("-.5", -0.5), ("+3.", 3.0)]
    df = spark.createDataFrame(text, "t string, want double")
    assert df.where(~C.to_number("t").eqNullSafe(F.col("want"))).count() == 0
    times = [("2024-01-02 03:04:05", dt.datetime(2024, 1, 2, 3, 4, 5)), ("2024-01-02T03:04:05Z", dt.datetime(2024, 1, 2, 3, 4, 5)),
             ("2024-01-02 03:04:05.25+0530", dt.datetime(2024, 1, 2, 3, 4, 5, 250000)), ("2024-01-02", dt.datetime(2024, 1, 2)),
             ("soon", None), (None, None)]
    df = spark.createDataFrame(times, "t string, want timestamp_ntz")
    assert df.where(~C.to_timestamp("t").eqNullSafe(F.col("want"))).count() == 0


def test_places(spark):
    places = {"Upper Town": 0, "Upper Town - East Side": 0, "Lake": 0, "lake view": 0}
    asked = [("Lake", "Lake"), ("LAKE VIEW", "lake view"), ("east-upper", "Upper Town - East Side"), ("upper", "Upper Town - East Side"),
             ("nowhere", None), ("-", None), (None, None)]
    gazetteer = spark.createDataFrame([(n,) for n in [*places, None, "Lake"]], "n string")
    df = match_places(spark.createDataFrame(asked, "q string, want string"), "q", gazetteer, "n", "got")
    assert df.count() == len(asked) and [r for r in df.collect() if r.got != r.want] == []


def test_asof_without_right_time(spark):
    left = spark.createDataFrame([("a", 1, at(1)), ("a", 2, None)], "k string, o int, ts timestamp_ntz")
    right = spark.createDataFrame([("a", 1, at(1, 30)), ("a", 2, None)], "k string, o int, ts timestamp_ntz")
    for direction, want in (("nearest", 1), ("backward", None)):
        got = J.asof(left, right, ["k"], "ts", ["o"], ["o"], direction, prefix="r_")
        assert {r.o: r.r_o for r in got.collect()} == {1: want, 2: None}


def test_text_that_is_no_number(spark):
    rows = spark.createDataFrame([("1d",), ("NaN",), ("Infinity",), ("2,000.5",), (" 7 ",)], "a string")
    got = [r.a for r in K.with_schema(rows, [("a", "double")]).collect()]
    assert got == [None, None, None, 2000.5, 7.0]


def test_rename_rules(spark):
    assert K.canonical_names(["dew_temp", "air_temp", "spd of wind", "rainfall"], "weather") == {
        "air_temp": "temperature", "spd of wind": "windspeed", "rainfall": "precipitation"}
    assert K.canonical_names(["aqi_category", "us_aqi", "pm_10"], "aqi") == {"us_aqi": "AQI", "pm_10": "PM10"}
    assert K.canonical_names(["the_aqi_category_x"], "aqi") == {"the_aqi_category_x": "AQI"}
