import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from hazeframe.catalog import streams
from hazeframe.catalog import views as V
from hazeframe.plans import report as R
from hazeframe.sources import files, payloads
from hazeframe.streaming import ingest as S


def test_candidate_sources(spark, tmp_path):
    spark.range(0).write.parquet(f"{tmp_path}/empty")
    spark.range(3).write.parquet(f"{tmp_path}/a")
    spark.range(2).withColumn("x", F.lit(1)).write.parquet(f"{tmp_path}/b")
    paths = [f"{tmp_path}/{n}" for n in ("none", "empty", "a", "b")]
    assert files.first_source(spark, paths).count() == 3
    both = files.all_sources(spark, paths)
    assert both.count() == 5 and "x" in both.columns
    assert files.first_source(spark, paths[:2]) is None
    with pytest.raises(FileNotFoundError):
        files.all_sources(spark, paths[:2])


def test_csv_append_and_lenient_types(spark, tmp_path):
    part = spark.createDataFrame([("1", "2,000", "soon"), ("x", "", "2024-01-01 05:00:00")], "a string, b string, c string")
    files.write_csv(part, f"{tmp_path}/t")
    files.write_csv(part, f"{tmp_path}/t", "append")
    text = files.read_text_table(spark, f"{tmp_path}/t", ["a", "b", "c"])
    rows = files.typed(text, {"a": "bigint", "b": "double", "c": "timestamp"}).distinct().collect()
    assert sorted(rows, key=str) == sorted([(1, 2000.0, None), (None, None, dt.datetime(2024, 1, 1, 5))], key=str)


def test_append_adds_missing_columns(spark, tmp_path):
    files.append_table(spark.range(2), [("id", "bigint"), ("note", "string")], path=f"{tmp_path}/t")
    files.append_table(spark.range(1), [("id", "bigint"), ("note", "string")], path=f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").agg(F.count("*"), F.count("note")).first()[:] == (3, 0)


def test_report_without_weather_and_traffic(spark, tmp_path):
    air = V.air_wide(spark, SMALL)
    rep = R.report(R.scored(R.snapshot(air, None, None, ["station"], "ts", "ord")), ["station"])
    files.write_report(rep, f"{tmp_path}/json", f"{tmp_path}/csv")
    back = spark.read.json(f"{tmp_path}/json")
    assert back.count() == 3
    texts = back.select(F.explode("reasons").alias("r")).where("r like '%not available%'").count()
    assert texts == 6
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == 3


def test_published_reasons(spark):
    row = [(1, 120.95, 127.39, 1.95, 14.2, 0.0, 141.77, 141.77, "8hr_rolling", 2.49, 49.0, None, 10000.0, True, None, None, False)]
    cols = ("station int, pm25 double, pm10 double, no2 double, so2 double, nh3 double, o3_raw double, o3_used double, o3_method string, "
            "windspeed double, humidity double, precipitation double, visibility double, has_weather boolean, vehicle_count double, "
            "avg_speed double, has_traffic boolean")
    out = R.scored(spark.createDataFrame(row, cols))
    got = out.select("aqi", "category", R.reason_codes().alias("r"), R.suggestion_codes().alias("s")).first()
    assert got[:] == (161, "Moderate", ["DOMINANT", "O3_DIAGNOSTIC", "LIGHT_WIND", "NO_TRAFFIC"], ["MONITOR"])
    doc = R.report(out, ["station"]).first()
    assert doc.dominant == "O3"
    assert doc.reasons == [
        "Dominant pollutant: O3 (subindex 161.24).",
        "O3 diagnostic: raw_last=141.77 µg/m3  used_for_aqi=141.77 µg/m3  method=8hr_rolling  col=o3",
        "Light wind (2.49 m/s) — limited dispersion.", "Traffic data not available in live feed."]
    assert doc.suggestions == ["Monitor updates; reduce exposure if sensitive."]
    assert doc.pollutant_values_last["O3_used_µg/m3"] == 141.77


def test_payload_edges(spark):
    df = spark.createDataFrame([(1, '{"list": []}'), (2, "broken"), (3, "{}"), (4, '{"list": [{"dt": 0, "components": {"co": 1.5}}]}')], "id int, body string")
    rows = payloads.pollution_history(df, ["id"]).collect()
    assert [(r.id, r.ts, r.co, r.no2) for r in rows] == [(4, dt.datetime(1970, 1, 1), 1.5, None)]
    feed = spark.createDataFrame([('{"status": "error"}',), ('{"status": "ok", "data": {"aqi": 7}}',)], "body string")
    assert [(r.aqi, r.city, r.pm25) for r in payloads.station_feed(feed, []).collect()] == [(7.0, None, None)]


def test_stream_restart_changes_nothing(spark, tmp_path):
    out, check = f"{tmp_path}/out", f"{tmp_path}/check"

    def run():
        rows = streams._air(spark, SMALL).select("station", "ord", "o3", F.col("ord").alias("first"))
        S.upsert_stream(rows, out, check, ["station"], ["first"], ["o3"], ["ord"])
        return sorted(map(tuple, S.read_upserts(spark, out, ["station"]).collect()))

    assert run() == run()


def test_upserts_follow_event_order_not_landing_order(spark, tmp_path):
    schema = "k int, ord long, city string, v int, ts timestamp_ntz"
    when = dt.datetime(2024, 1, 1)
    for n, rows in enumerate([[(1, 5, "five", 50, when), (2, 1, "one", 10, when)], [(1, 3, "three", 30, when), (2, 2, "two", None, when)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    stream = S.landed(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema, files_per_trigger=1, nested=True)
    S.upsert_stream(stream, f"{tmp_path}/out", f"{tmp_path}/check", ["k"], ["city"], ["v"], ["ord"])
    got = {r.k: (r.city, r.v) for r in S.read_upserts(spark, f"{tmp_path}/out", ["k"]).collect()}
    assert got == {1: ("three", 50), 2: ("one", None)}


def test_weather_that_lands_later_is_matched(spark, tmp_path):
    def hour(h, m=0):
        return dt.datetime(2024, 1, 1, h, m)

    readings = [[("a", 1, hour(1)), ("a", 2, hour(2))], [("a", 3, hour(3))]]
    weather = [[("a", 10, hour(5))], [("a", 11, hour(1, 20)), ("a", 12, hour(2, 50))]]
    schema = "k string, id int, ts timestamp_ntz"
    for name, parts in (("r", readings), ("w", weather)):
        for n, rows in enumerate(parts):
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}/{n}")

    def stream(name):
        kind = spark.createDataFrame([], schema).schema
        return S.landed(spark, f"{tmp_path}/{name}", kind, files_per_trigger=1, nested=True)

    S.nearest_weather_stream(stream("r"), stream("w"), ["k"], "ts", ["id"], f"{tmp_path}/out", f"{tmp_path}/check", delay="6 hours")
    landed = spark.createDataFrame([r for p in readings for r in p], schema)
    got = {r.id: r.wx_id for r in S.read_nearest(landed.select("k", "id"), f"{tmp_path}/out", ["id"]).collect()}
    assert got == {1: 11, 2: 11 if abs(hour(2) - hour(1, 20)) < abs(hour(2, 50) - hour(2)) else 12, 3: 12}


def test_compacted_log_reads_the_same(spark, tmp_path):
    for n in range(3):
        spark.createDataFrame([(1, n), (n + 5, n)], "k int, v int").write.parquet(f"{tmp_path}/log/{S.BATCH}={n}")
    S.compact_log(spark, f"{tmp_path}/log", f"{tmp_path}/new", lambda log: S.fold_latest(log, ["k"]))
    spark.createDataFrame([(1, 9)], "k int, v int").write.parquet(f"{tmp_path}/new/{S.BATCH}=3")
    got = {r.k: r.v for r in S.read_log(spark, f"{tmp_path}/new", ["k"]).collect()}
    assert got == {1: 9, 5: 0, 6: 1, 7: 2}


def test_unknown_header_and_default_columns(spark, tmp_path):
    spark.createDataFrame([("1", "2024-01-01")], "`my aqi` string, day string").write.option("header", True).csv(f"{tmp_path}/a")
    got = files.first_source(spark, [f"{tmp_path}/none", f"{tmp_path}/a"], "csv")
    assert got.columns == ["my aqi", "day"] and got.first()[:] == ("1", "2024-01-01")


def test_report_on_loose_names(spark):
    when = dt.datetime(2024, 1, 1)
    air = spark.createDataFrame([(1, when, 1, "40,5", 80.0)], "s int, ts timestamp_ntz, o int, `PM2.5 (µg)` string, my_no2 double")
    wx = spark.createDataFrame([(1, when, 1, 1.5, 80)], "s int, ts timestamp_ntz, o int, Wind double, rel_hum int")
    keep = ["s", "ts", "o"]
    snap = R.snapshot(R.named(air, "air", keep), R.named(wx, "weather", keep), None, ["s"], "ts", "o")
    row = snap.first()
    assert (row.pm25, row.no2, row.pm10, row.o3_method, row.windspeed, row.humidity) == (405.0, 80.0, None, "no_o3_column", 1.5, 80.0)
    out = R.report(R.scored(snap), ["s"], now=F.lit(when)).first()
    assert out.aqi is not None and out.o3_diag.method == "no_o3_column" and out.timestamp == when


def test_late_rows_are_counted(spark):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1, h),) for h in range(6)], "ts timestamp_ntz")
    newest = F.lit(dt.datetime(2024, 1, 1, 5)).cast("timestamp_ntz")
    assert S.late_rows(rows, "ts", newest, 2).first().late == 3


def test_workers_import_the_package_from_any_folder(tmp_path):
    """A driver started elsewhere, with the package only on its own path."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {repo!r})
from hazeframe.catalog import QUERIES
from hazeframe.session import local_session
spark = local_session("2", partitions=2, memory="2g")
print("rows", QUERIES["insample_fixed_order"](spark, {SMALL!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 2133" in done.stdout, done.stderr[-2000:]
