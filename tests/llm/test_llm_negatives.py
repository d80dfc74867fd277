"""Hard negatives: plain search over all pairs, bounds, odd rows."""

import math

import numpy as np
import pytest
from conftest import SMALL, rows_of, rows_of_sql
from pyspark.sql import functions as F

from hazeframe.llm import negatives
from hazeframe.llm.oracles import NEGATIVES
from hazeframe.llm.queries import op13_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    """(anchor, positive, rank, negative, scores) by all pairs; rows: (id, vector, label)."""
    able = []
    for i, v, label in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            able.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    for a, (aid, av, al) in enumerate(able):
        if aid is None or aid % 100:
            continue
        scored = [(sum(x * y for x, y in zip(av, v)), i, label) for b, (i, v, label) in enumerate(able) if b != a]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        for score, pid, _ in [s for s in scored if s[2] == al][:5]:
            near = [s for s in scored if s[2] != al and 30 * score <= 100 * s[0] <= 90 * score][:10]
            out += [(aid, pid, k + 1, n, score, s) for k, (s, n, _) in enumerate(near)]
    return sorted(out, key=str)


def mined(frame, **more):
    rows, _ = negatives.mine(frame, F.col("vec_id") % 100 == 0, **more)
    return sorted((tuple(r)[:6] for r in rows.collect()), key=str)


def clustered(n, seed, dims=20, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dims))
    out = []
    for i in range(n):
        c = int(rng.integers(4))
        v = centres[c] + spread * rng.normal(size=dims)
        out.append((i, [float(np.float32(x)) for x in v], c if rng.random() < 0.8 else int(rng.integers(4))))
    return out


def test_query_and_sql(spark, duck):
    assert rows_of(op13_negatives(spark, SMALL)) == rows_of_sql(duck, NEGATIVES)


@pytest.mark.parametrize("per_block", [4096, 2])
def test_same_as_all_pairs(spark, monkeypatch, per_block):
    monkeypatch.setattr(negatives, "TILE", 300)
    rows = clustered(700, 3)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert mined(frame, anchors_per_block=per_block) == plain(rows)


def test_odd_rows(spark):
    rows = clustered(250, 4, dims=9)
    rows += [rows[0]] * 3 + [rows[100], (None, rows[5][1], rows[0][2]), (None, rows[7][1], 9), (300, None, 1), (300, rows[3][1], None),
             (301, [1.0, None] + [0.0] * 7, 1), (302, [float("nan")] * 9, 2), (303, [float("inf")] * 9, 2), (304, [], 0), (400, [], 1),
             (305, rows[0][1][:4], rows[0][2]), (500, rows[0][1] + [7.0] * 30, rows[0][2]), (306, rows[0][1], 8), (307, rows[0][1], 8)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as query", "1 as score", "2 as q", "3 as anchor_row")
    assert mined(frame) == plain(rows)
    assert mined(frame.limit(0)) == [] == mined(frame.where("vec_id = 1"))


def test_equal_vectors_everywhere(spark):
    rows = [(i, [0.5, -0.25, 1.0], i % 2) for i in range(1200)] + [(2000, [1.0, 0.0, 1.0], 0), (1300, [0.5, 0.0, 0.75], 1)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(1)
    for dims in (3, 8, 20, 64, 72):
        a, b = rng.integers(-300, 300, (30, dims)).astype(float), rng.integers(-300, 300, (40, dims)).astype(float)
        scores, widths = a @ b.T, []
        for (ma, da), (mb, db) in zip(negatives._levels(*negatives._summaries(a)), negatives._levels(*negatives._summaries(b))):
            middle, off = ma @ mb.T, da @ db.T
            assert (np.abs(scores - middle) <= off + 1e-6).all()
            widths.append(off.mean())
        assert widths == sorted(widths, reverse=True)


def test_pairs_are_dropped_by_their_bounds(spark):
    rows = clustered(3000, 8, dims=64, spread=0.1)
    _, counts = negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0)
    by = {(r["step"], r["level"]): r["pairs"] for r in counts.collect()}
    for step in ("positives", "negatives"):
        levels = sorted((k[1] for k in by if k[0] == step), reverse=True)
        pairs = [by[step, k] for k in levels]
        assert pairs == sorted(pairs, reverse=True) and pairs[-1] < pairs[0]


def test_large_components_are_exact(spark):
    rows = [(i, [2.0 ** 17 - 1, float(i % 50), -(2.0 ** 16)] * 6, i % 3) for i in range(300)] + [(700, [2.0 ** 30] * 3, 0)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == plain(rows[:-1])
