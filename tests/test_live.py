"""Live tables, counted appends, sketches, band joins, place lookups, expiring state."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows_of
from hazeframe.catalog import views as V
from hazeframe.functions import places
from hazeframe.operators import joins as J
from hazeframe.operators import profile as P
from hazeframe.operators import sketches as K
from hazeframe.scale import quantiles, refined_quantiles
from hazeframe.session import scratch_path, stored
from hazeframe.sources import live
from hazeframe.streaming import ingest as S
from hazeframe.streaming.silence import BUCKETS, NEVER, SPELL, joined_spells, merge_spells, rocksdb, silent_stations, spells_of


def test_readers_stay_on_their_version(spark):
    root = scratch_path(spark, "live")
    assert live.read_live(spark, root) is None
    live.publish(spark.range(3), root)
    old = live.read_live(spark, root)
    live.publish(spark.range(10, 15), root)
    assert old.count() == 3 and live.read_live(spark, root).count() == 5


def test_an_aborted_write_leaves_the_table(spark):
    root = scratch_path(spark, "live")
    live.publish(spark.range(3), root, token=4)
    before = live.pointer(spark, root)
    broken = spark.range(1000).select(F.when(F.col("id") == 999, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        live.publish(broken, root, token=5)
    assert live.pointer(spark, root) == before and live.read_live(spark, root).count() == 3


def test_a_repeated_batch_commits_once(spark):
    root = scratch_path(spark, "live")
    rows = spark.createDataFrame([(1, 10, 0), (2, 20, 0)], "k long, v long, o long")
    assert live.upsert_live(rows, root, ["k"], [], ["v"], ["o"], token=0) == {"inserted": 2, "updated": 0}
    more = spark.createDataFrame([(2, 21, 1), (3, 30, 1)], "k long, v long, o long")
    assert live.upsert_live(more, root, ["k"], [], ["v"], ["o"], token=1) == {"inserted": 1, "updated": 1}
    version = live.pointer(spark, root)
    assert live.upsert_live(more, root, ["k"], [], ["v"], ["o"], token=1) == {"inserted": 0, "updated": 0}
    assert live.pointer(spark, root) == version
    assert sorted(map(tuple, live.read_live(spark, root).select("k", "v").collect())) == [(1, 10), (2, 21), (3, 30)]


def test_a_restarted_stream_repeats_no_batch(spark):
    out, check = S.folders(spark, "live")
    inbox = f"{out}-inbox"
    schema = "k long, o long, v long"
    for drain, rows in enumerate(([(1, 1, 5), (2, 1, 6)], [(2, 2, 7), (3, 2, 8)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
        S.live_upserts(spark.readStream.schema(schema).parquet(inbox), out, check, ["k"], [], ["v"], ["o"])
        assert live.pointer(spark, out)["token"] == drain
    assert sorted(map(tuple, live.read_live(spark, out).select("k", "v").collect())) == [(1, 5), (2, 7), (3, 8)]


@pytest.mark.parametrize("kind", ["upserts", "nearest"])
def test_folds_keep_what_the_log_says(spark, kind):
    """A log folded between two drains reads as one that never was."""
    out, check = S.folders(spark, f"fold-{kind}")
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    folds = {"upserts": lambda log: S.fold_upserts(log, ["k"]), "nearest": lambda log: S.fold_nearest(log, ["k"])}
    rows = [(rng.randrange(9), rng.randrange(1000), rng.randrange(1000)) for _ in range(120)]
    log = []
    for batch in range(4):
        part = rows[batch::4]
        frame = spark.createDataFrame(part, "k long, o long, v long")
        if kind == "upserts":
            rank = F.struct("o")
            made = frame.groupBy("k").agg(F.min(rank).alias("_first"), F.min_by(F.struct("v"), rank).alias("_id"),
                                          F.max(rank).alias("_last"), F.max_by(F.struct(F.col("v").alias("w")), rank).alias("_m"))
        else:
            rank = F.struct((-F.col("o")).alias("d"), F.col("v").alias("t"))
            made = frame.groupBy("k").agg(F.max(rank).alias("_rank"), F.max_by(F.struct("v"), rank).alias("_hit"))
        made.write.parquet(f"{out}/{S.BATCH}={batch}")
    S.compact_log(spark, out, f"{out}-folded", folds[kind])
    late = spark.read.parquet(f"{out}/{S.BATCH}=2")
    late.write.parquet(f"{out}/{S.BATCH}=9")
    late.write.parquet(f"{out}-folded/{S.BATCH}=9")
    cols = ["k", "_id", "_m"] if kind == "upserts" else ["k", "_hit"]
    plain = folds[kind](spark.read.parquet(out)).select(*cols)
    assert sorted(map(str, plain.collect())) == sorted(map(str, folds[kind](spark.read.parquet(f"{out}-folded")).select(*cols).collect()))


def test_sketches_of_days_merge(spark):
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.normal(size=30_000), rng.exponential(50, 30_000)])
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=int(h)), float(v)) for h, v in zip(rng.integers(0, 24 * 20, len(values)), values)]
    rows += [(None, 1e9), (dt.datetime(2024, 1, 1), None), (dt.datetime(2024, 1, 1), float("nan"))]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, v double")
    early, late = df.where("ts < '2024-01-11'"), df.where("ts >= '2024-01-11'")
    kept = scratch_path(spark, "sketches")
    K.daily_sketches(early, "ts", ["v"]).write.parquet(kept)
    K.daily_sketches(late, "ts", ["v"]).write.mode("append").parquet(kept)  # touches no earlier day
    probs = [0.0, 0.01, 0.5, 0.95, 1.0]
    ordered = np.sort(values)
    for parts in (spark.read.parquet(kept), K.daily_sketches(df, "ts", ["v"])):
        got = K.sketch_quantiles(K.merged(parts, ["column_name"]), probs).collect()
        assert {r.n for r in got} == {len(values)}
        for r in got:
            rank = np.searchsorted(ordered, r.value) / len(ordered)
            assert abs(rank - r.prob) <= K.rank_error() + 2 / len(ordered)


@pytest.mark.parametrize("way", [quantiles, refined_quantiles])
def test_quantiles_of_odd_groups(spark, way):
    rng = random.Random(5)
    rows = [("hot", rng.choice([1.0, 2.0, 1e300, -5.5])) for _ in range(5000)] + [("one", 4.25), ("none", None), (None, 3.0), (None, 8.0)]
    rows += [("wide", rng.uniform(-1, 1) * 10 ** rng.randrange(-9, 9)) for _ in range(30_000)] + [("nan", float("nan")), ("nan", 2.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = [0.0, 0.1, 0.5, 0.77, 1.0]
    got = {r.k: r.v for r in way(df, ["k"], ["v"], probs).collect()}
    for k in {r[0] for r in rows}:
        own = np.array([v for name, v in rows if name == k and v is not None and v == v])
        if len(own):
            assert got[k] == pytest.approx(list(np.quantile(own, probs)), rel=1e-12)
        else:
            assert got[k] in (None, [None] * 5)
    assert len(got) == 6
    assert way(df.where("k = 'none'"), [], ["v"], [0.5]).first()[0] in (None, [None])
    approx = {r.k: r.v for r in quantiles(df, ["k"], ["v"], probs, approx=True).collect()}
    own = np.sort([v for name, v in rows if name == "wide"])
    assert all(abs(np.searchsorted(own, v) / len(own) - p) < 0.02 for v, p in zip(approx["wide"], probs)) and approx["none"] is None


def test_quantiles_widen_a_bracket_that_misses(spark, monkeypatch):
    import hazeframe.scale as scale
    monkeypatch.setattr(scale, "BRACKET", 1e-9)
    monkeypatch.setattr(scale, "SKETCH", 20)
    values = [float(v) for v in np.random.default_rng(1).normal(size=20_000)]
    got = refined_quantiles(spark.createDataFrame([(v,) for v in values], "v double"), [], ["v"], [0.3, 0.5]).first()[0]
    assert got == pytest.approx(list(np.quantile(values, [0.3, 0.5])), rel=1e-12)


def test_correlation_of_many_columns_in_one_scan(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 100)) + 1e6
    x[:, 7] = 3.0
    rows = [[None if rng.random() < 0.1 else float(v) for v in r] for r in x]
    cols = [f"c{i}" for i in range(100)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(5)
    got = {(r.a, r.b): r["corr"] for r in P.corr_matrix(df, cols).collect()}
    assert len(got) == 10_000
    y = np.array([[np.nan if v is None else v for v in r] for r in rows])
    for i, j in ((0, 1), (5, 99), (42, 42), (3, 8)):
        both = ~np.isnan(y[:, i]) & ~np.isnan(y[:, j])
        want = np.corrcoef(y[both, i], y[both, j])[0, 1]
        assert got[f"c{i}", f"c{j}"] == pytest.approx(want, abs=1e-9) == got[f"c{j}", f"c{i}"]
    assert np.isnan(got["c7", "c1"])
    none = {(r.a, r.b): r["corr"] for r in P.corr_matrix(df.limit(0), ["c0", "c1"]).collect()}
    assert set(none.values()) <= {None}


def test_bands_of_any_width(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice(["x", "y", None]), rng.choice([rng.uniform(-100, 100), 7.0, None])) for i in range(600)] + [(700, "x", float("nan"))]
    bands = []
    for b in range(400):
        lo = rng.choice([rng.uniform(-120, 100), 7.0])
        bands.append((b, rng.choice(["x", "y", None]), lo, lo + rng.choice([0.0, 0.001, 3.0, 50.0, 5000.0, -1.0])))
    bands += [(900, "x", None, 0.0), (901, "y", 50.0, None), (902, "x", None, None)]
    got = J.join_ranges(spark.createDataFrame(rows, "i long, g string, v double"), spark.createDataFrame(bands, "b long, g string, lo double, hi double"), ["g"], "v")
    want = []
    for i, g, v in rows:
        hits = [b for b, h, lo, hi in bands if h == g and v is not None and v == v and (lo is None or lo <= v) and (hi is None or v <= hi)]
        want += [(i, b) for b in hits] or [(i, None)]
    assert sorted(((r.i, r.b) for r in got.collect()), key=str) == sorted(want, key=str)


def test_many_bands_need_no_pair_loop(split, capsys):
    bands = split.range(100_000).selectExpr("id", "id / 10.0D as lo", "id / 10.0D + 0.05D as hi")
    rows = split.range(20_000).selectExpr("id as i", "cast(if(id % 10 < 9, 77, id) as double) / 2.0D as v")  # one value holds 90 %
    out = J.join_ranges(rows, bands, [], "v")
    capsys.readouterr()
    out.explain()
    text = capsys.readouterr().out
    assert "NestedLoop" not in text and "Cartesian" not in text
    found = out.agg(F.count("*").alias("n"), F.count("id").alias("met")).first()
    assert found["n"] == 20_000 and found["met"] == 20_000
    assert out.where("v = 38.5").select("id").distinct().first()[0] == 385


def test_bands_in_many_cells_and_slots(split):
    rng = random.Random(9)
    odd = [float("inf"), float("-inf"), 0.0, -0.0, float("nan"), None]
    rows = [(i, rng.choice(["x", "y", "only rows", None]), rng.choice([rng.uniform(-50, 50), 7.0, rng.choice(odd)])) for i in range(700)]
    bands = []
    for b in range(300):
        lo = rng.choice([rng.uniform(-60, 50), 7.0, 0.0, -0.0, float("-inf"), None])
        bands.append((b, rng.choice(["x", "y", "only bands", None]), lo, rng.choice([None, float("inf"), -0.0, (lo or 0.0) + rng.choice([-1.0, 0.0, 0.5, 30.0])])))
    n = "lo double, hi double"
    got = J.join_ranges(split.createDataFrame(rows, "i long, g string, v double"), split.createDataFrame(bands, f"b long, g string, {n}"), ["g"], "v")
    assert got.columns == ["i", "g", "v", "b", "lo", "hi"]
    want = []
    for i, g, v in rows:
        hits = [b for b, h, lo, hi in bands if h == g and v is not None and v == v and (lo is None or lo <= v) and (hi is None or v <= hi)]
        want += [(i, b) for b in hits] or [(i, None)]
    assert sorted(((r.i, r.b) for r in got.collect()), key=str) == sorted(want, key=str)
    none = J.join_ranges(split.createDataFrame(rows, "i long, g string, v double"), split.createDataFrame([], f"b long, g string, {n}"), ["g"], "v")
    assert sorted((r.i, r.b, r.lo) for r in none.collect()) == [(i, None, None) for i in range(700)]


def test_hits_of_bands_are_not_stored(spark, monkeypatch):
    kept = []

    def counted(df, name):
        kept.append(stored(df, name))
        return kept[-1]

    monkeypatch.setattr(J, "stored", counted)
    rows = spark.range(2001).selectExpr("id as i", "cast(id as double) as v")
    bands = spark.range(500).selectExpr("id as b", "id / 1000 as lo", "1999.5D as hi")
    found = J.join_ranges(rows, bands, [], "v").agg(F.count("*").alias("n"), F.count("b").alias("met")).first()
    assert found["met"] == 1 + 1999 * 500 and found["n"] == found["met"] + 1
    assert max(k.count() for k in kept) <= 2001 + 2 * 500


def test_words_of_a_hot_run_are_cut(spark, monkeypatch):
    names = [f"sand {i} town" for i in range(300)] + ["Sandy Bay", "XA", "b"]
    words = ["sand", "and", "s", "town", "nd 2", "q", "xa", "ab", "sandy"] + [f"{i} t" for i in range(150)]
    n = spark.createDataFrame([(x,) for x in names], "_name string").withColumn("_low", F.lower("_name"))
    w = spark.createDataFrame([(x,) for x in words], "_w string")
    got = sorted(map(tuple, places.word_hits(w, n, cell=20).collect()))
    assert got == sorted((a, b) for a in words for b in names if a in b.lower())


def test_spells():
    rng = random.Random(2)
    times = sorted(rng.randrange(5000) for _ in range(200))
    values = [rng.choice([float("nan"), rng.random()]) for _ in times]
    whole = spells_of(np.array(times), np.array(values), 30)
    parts = []
    order = list(range(200))
    rng.shuffle(order)
    for k in range(0, 200, 17):
        own = order[k:k + 17]
        parts = merge_spells(parts + spells_of(np.array([times[i] for i in own]), np.array([values[i] for i in own]), 30), 30)
    assert str(parts) == str(whole) and sum(s[2] for s in whole) == 200


def test_state_of_silent_stations_is_dropped(spark):
    out, check = S.folders(spark, "silence")
    inbox = f"{out}-inbox"
    base = dt.datetime(2024, 1, 1)
    schema = "station long, ts timestamp_ntz, v double"
    batches = [[(1, 0, 1.0), (1, 30, None), (2, 0, 5.0)], [(2, 100, 6.0), (3, 300, 7.0)], [(1, 290, 8.0), (1, 10, 99.0), (3, 301, None)], [(3, 1000, 1.0)]]
    for rows in batches:
        frame = spark.createDataFrame([(s, base + dt.timedelta(minutes=m), v) for s, m, v in rows], schema)
        frame.coalesce(1).write.mode("append").parquet(inbox)
        with rocksdb(spark):
            stream = spark.readStream.schema(schema).parquet(inbox).withColumn("ts", F.col("ts").cast("timestamp"))
            S.append_rows(silent_stations(stream, ["station"], "ts", "v", "60 minutes", "30 minutes"), out, check)
    got = sorted((r.station, int((r.first_ts - base).total_seconds() // 60), int((r.last_ts - base).total_seconds() // 60), r.readings, r.value)
                 for r in spark.read.parquet(out).collect())
    # the row of minute 10 is behind the watermark; station 1 speaks again at 290
    assert got == [(1, 0, 30, 2, 1.0), (1, 290, 290, 1, 8.0), (2, 0, 0, 1, 5.0), (2, 100, 100, 1, 6.0), (3, 300, 301, 2, 7.0)]


def test_spells_of_many_stations_at_once():
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, "1"]), t, rng.choice([float("nan"), float(rng.randrange(9))]))
            for t in (rng.randrange(4000) for _ in range(600))]
    whole = None
    for k in range(0, 600, 70):
        own = pd.DataFrame(rows[k:k + 70], columns=["x", "y", "first", "value"])
        own = own.assign(last=own["first"], readings=1, valid_at=own["first"].where(own["value"].notna(), NEVER))
        whole = joined_spells(own if whole is None else pd.concat([whole, own], ignore_index=True), ["x", "y"], 40)
    want = []
    for x, y in {r[:2] for r in rows}:
        times, values = zip(*[r[2:] for r in rows if r[:2] == (x, y)])
        want += [(x, y, *s) for s in spells_of(np.array(times), np.array(values), 40)]
    got = whole[["x", "y", *SPELL]].itertuples(index=False, name=None)
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_stations_share_buckets_of_state(spark):
    out, check = S.folders(spark, "silence")
    base, big = dt.datetime(2024, 1, 1), 1 << 60
    schema = "first long, _city string, ts timestamp_ntz, v double"
    batches = [[(None if i == 7 else big + i, "x" if i % 2 else None, 0, float(i)) for i in range(2000)], [(big, None, 90, None)], [(big, None, 300, 1.0)]]
    for rows in batches:
        frame = spark.createDataFrame([(s, c, base + dt.timedelta(minutes=m), v) for s, c, m, v in rows], schema)
        frame.coalesce(1).write.mode("append").parquet(f"{out}-inbox")
        with rocksdb(spark):
            stream = spark.readStream.schema(schema).parquet(f"{out}-inbox").withColumn("ts", F.col("ts").cast("timestamp"))
            query = (silent_stations(stream, ["first", "_city"], "ts", "v", "60 minutes", "30 minutes").writeStream.format("parquet")
                     .option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start())
            query.awaitTermination()
        if len(rows) > 1:  # state, a timer and its index per bucket at most, for 2,000 stations
            assert 0 < max(op.numRowsTotal for p in query.recentProgress for op in p.stateOperators) <= 3 * BUCKETS
    got = [(str(r["first"]), r._city, int((r.last_ts - base).total_seconds() // 60), r.readings, r.value) for r in spark.read.parquet(out).collect()]
    want = [(str(None if i == 7 else big + i), "x" if i % 2 else None, 0, 1, float(i)) for i in range(2000)]
    assert sorted(map(str, got)) == sorted(map(str, [*want, (str(big), None, 90, 1, None)]))
