"""Stepwise order search: the range of the wide grid without fitting all of it.

A state table holds, per series, the best order so far, the candidates already fitted and
those to fit next. A round fits the waiting candidates of all series in parallel; a series
that improved waits for the unseen neighbours of its new best order, and the others are
done. Rounds end when no series waits.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe.plans import forecast as M
from hazeframe.scale import null_safe
from hazeframe.session import ship, stored

#: Candidates a task fits for one series, one after another.
PER_TASK = 6
#: Shapes the search begins with, each plain and once differenced.
SHAPES = [((2, 2), (1, 1)), ((0, 0), (0, 0)), ((1, 0), (1, 0)), ((0, 1), (0, 1))]
STARTS = [((p, d, q), (P, 0, Q)) for (p, q), (P, Q) in SHAPES for d in (0, 1)]


def neighbours(grid: Sequence[tuple]) -> list[list[int]]:
    """Candidates one step away from each: one order up or down by one, or both orders of
    the plain or of the seasonal part together."""
    place = {c: i for i, c in enumerate(grid)}
    one = np.eye(6, dtype=int)
    steps = [sign * s for s in (*one, one[0] + one[2], one[3] + one[5]) for sign in (1, -1)]
    out = []
    for order, seasonal in grid:
        near = (tuple(map(int, np.array((*order, *seasonal)) + s)) for s in steps)
        out.append(sorted(place[n[:3], n[3:]] for n in near if (n[:3], n[3:]) in place))
    return out


def stepwise_orders(df: DataFrame, keys: Sequence[str], ts: str, y: str, exog: Sequence[str] = (),
                    grid: list[tuple] | None = None, starts: Sequence[tuple] = STARTS) -> DataFrame:
    """(keys, order, seasonal, aic, fits): the order each series' search ends with and the
    number of candidates fitted on the way.

    A round moves to the least AIC among all candidates it fitted, the first of equals, if
    it is less than the best so far. All AICs of a series start from one common point of
    the grid, as in ``forecast.search_orders``. A series no candidate fits gets (1, 0, 0)
    and a null AIC; series longer than ``forecast.MAX_HOURS`` are left out.
    """
    keys, exog, grid = list(keys), list(exog), grid or M.wide_grid()
    spark = df.sparkSession
    ship(spark)
    place = {c: i for i, c in enumerate(grid)}
    first = [place[c] for c in starts if c in place]
    if not first:
        raise ValueError("none of the starts is in the grid")
    packed = stored(M._pack(M.within_length(df.where(F.col(y).isNotNull()), keys), keys, ts, [y, *exog]).drop(f"_a_{ts}"), "series")
    near = F.broadcast(spark.createDataFrame(list(enumerate(neighbours(grid))), "_c int, _near array<int>"))  # one row per candidate
    state = packed.select(*keys, F.lit(None).cast("int").alias("best"), F.lit(None).cast("double").alias("aic"),
                          F.array().cast("array<int>").alias("tried"), F.array(*map(F.lit, first)).alias("todo"))
    state = stored(state, "order-state")
    widest = M.widest_lag(grid)
    types = dict(df.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", candidate int, aic double"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        values, x, _ = M._unpack(row, y, exog)
        numbers = [int(c) for c in row["_some"]]
        aics = [M.candidate_aic(values, x, grid[c], widest) for c in numbers]
        return M._rows({k: row[k] for k in keys}, len(numbers), candidate=np.array(numbers, "int32"), aic=np.array(aics, float))

    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    while not (waiting := state.where(F.size("todo") > 0)).isEmpty():
        parts = F.explode(F.sequence(F.lit(0), F.floor((F.size("todo") - 1) / PER_TASK).cast("int")))
        some = waiting.select(*keys, "todo", parts.alias("_block")).select(
            *keys, "_block", F.slice("todo", F.col("_block") * PER_TASK + 1, F.lit(PER_TASK)).alias("_some"))
        fan = null_safe(packed, some, keys).repartition(n, *keys, "_block")
        tried = fan.groupBy(*keys, "_block").applyInPandas(run, schema).withColumn("aic", F.nanvl("aic", F.lit(None).cast("double")))
        known = F.when(F.col("aic").isNotNull(), F.struct("aic", "candidate"))
        found = tried.groupBy(*keys).agg(F.min(known).alias("_b"))
        moved = F.col("_b").isNotNull() & (F.col("aic").isNull() | (F.col("_b.aic") < F.col("aic")))
        joined = null_safe(state, found, keys, "left").withColumn("_moved", F.coalesce(moved, F.lit(False)))
        joined = joined.withColumns({"best": F.when(F.col("_moved"), F.col("_b.candidate")).otherwise(F.col("best")),
                                     "aic": F.when(F.col("_moved"), F.col("_b.aic")).otherwise(F.col("aic")),
                                     "tried": F.concat("tried", "todo")})
        ahead = F.array_except(F.coalesce("_near", F.array().cast("array<int>")), "tried")
        state = stored(joined.join(near, F.col("best") == F.col("_c"), "left").select(
            *keys, "best", "aic", "tried", F.when(F.col("_moved"), ahead).otherwise(F.array().cast("array<int>")).alias("todo")), "order-state")
    chosen = F.coalesce(F.get(M.spelled(grid), F.col("best")), M.spelled([M.DEFAULT_ORDER])[0])
    return state.withColumn("_p", chosen).select(
        *keys, F.col("_p.o").alias("order"), F.col("_p.s").alias("seasonal"), "aic", F.size("tried").alias("fits"))
