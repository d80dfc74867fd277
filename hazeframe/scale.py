"""Ordered and ranked work that stays bounded when one key holds much of the data.

Window functions and exact percentiles put a whole key into one task. The helpers
here first count rows per key. While the largest key is below ``group_row_limit``
they use the plain Spark operator. Above it they cut the data into ranges of
(key, order), work inside the ranges, and pass the little state that crosses a range
border through a table with one row per (key, range).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazeframe.session import stored

LIMIT_KEY = "spark.hazeframe.groupRowLimit"
DEFAULT_LIMIT = 4_000_000
BROADCAST_ROWS = 100_000
CHUNK = "_chunk"
POSITION = "_position"


def group_row_limit(spark: SparkSession) -> int:
    """Rows one task may hold of a single key before the key is split."""
    return int(spark.conf.get(LIMIT_KEY, str(DEFAULT_LIMIT)))


def group_sizes(df: DataFrame, by: Sequence[str]) -> tuple[int, int]:
    """(all rows, rows of the largest key); one aggregate, one row to the driver."""
    if not by:
        total = df.count()
        return total, total
    row = df.groupBy(*by).count().agg(F.sum("count"), F.max("count")).first()
    return int(row[0] or 0), int(row[1] or 0)


def chunk_count(spark: SparkSession, total: int) -> int:
    """Ranges to cut ``total`` rows into."""
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(shuffle, math.ceil(total / max(1, group_row_limit(spark))))


def ordered_chunks(df: DataFrame, by: Sequence[str], order: Sequence[str], total: int) -> DataFrame:
    """Add ``_chunk``: the number of the (key, order) range a row lies in.

    Spark samples the range borders, so ranges are even whatever the keys look like.
    The result is stored because borders differ from one evaluation to the next.
    """
    ranged = df.repartitionByRange(chunk_count(df.sparkSession, total), *by, *order)
    return stored(ranged.withColumn(CHUNK, F.spark_partition_id()), "chunks")


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null meets null; the result has one copy of them."""
    named = right.select(*[F.col(c).alias(f"_k_{c}") if c in keys else F.col(c) for c in right.columns])
    match = F.lit(True)
    for c in keys:
        match = match & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return left.join(named, match, how).drop(*[f"_k_{c}" for c in keys])


def ranking(order: Sequence[str]) -> Column:
    """Sort key for max_by and min_by. A single column keeps the buffer fixed-width, so
    that Spark can aggregate by hash instead of by sort."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def _attach(rows: DataFrame, state: DataFrame, keys: Sequence[str], chunks: int) -> DataFrame:
    """Left join the border state. It has at most one row per range, so its size is known."""
    right = state.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                         *[c for c in state.columns if c not in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    if chunks <= BROADCAST_ROWS:
        right = F.broadcast(right)
    return rows.join(right, cond, "left").drop(*[f"_k_{k}" for k in keys])


def carry(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    forward: dict[str, str] | None = None,
    backward: dict[str, str] | None = None,
    bounded: bool = False,
    sizes: tuple[int, int] | None = None,
) -> DataFrame:
    """Last non-null value at or before each row, and first one at or after it.

    ``forward`` and ``backward`` map a new column name to the column that is carried.
    ``order`` must end in a column that breaks ties. ``bounded`` says that the groups
    are known to be small (for example one row per hour), which skips the count.
    ``sizes`` hands in the result of ``group_sizes`` where it is known.
    """
    forward, backward = forward or {}, backward or {}
    by, order = list(by), list(order)
    total, largest = (0, 0) if bounded else sizes or group_sizes(df, by)
    if largest <= group_row_limit(df.sparkSession):
        return _carry_in(df, by, order, forward, backward)

    rows = ordered_chunks(df, by, order, total)
    rank = ranking(order)
    carried = {**forward, **backward}
    state = rows.groupBy(*by, CHUNK).agg(
        *[F.max_by(src, F.when(F.col(src).isNotNull(), rank)).alias(f"_f_{new}")
          for new, src in forward.items()],
        *[F.min_by(src, F.when(F.col(src).isNotNull(), rank)).alias(f"_b_{new}")
          for new, src in backward.items()],
    )
    before = Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*by).orderBy(F.desc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    state = state.select(
        *by, CHUNK,
        *[F.last(f"_f_{new}", True).over(before).alias(f"_s_{new}") for new in forward],
        *[F.last(f"_b_{new}", True).over(after).alias(f"_s_{new}") for new in backward],
    )
    crossing = F.lit(False)
    for new in carried:
        crossing = crossing | F.col(f"_s_{new}").isNotNull()
    inside = _carry_in(rows, by + [CHUNK], order, forward, backward)
    chunks = chunk_count(df.sparkSession, total)
    joined = _attach(inside, state.where(crossing), by + [CHUNK], chunks)
    return joined.select(
        *df.columns,
        *[F.coalesce(F.col(new), F.col(f"_s_{new}")).alias(new) for new in carried],
    )


def _carry_in(df, by, order, forward, backward) -> DataFrame:
    # The backward pass sorts in descending order: a frame that ends at
    # unboundedFollowing would rescan the rest of the group for every row.
    up = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    down = (Window.partitionBy(*by).orderBy(*[F.desc(c) for c in order])
            .rowsBetween(Window.unboundedPreceding, 0))
    return df.select(
        "*",
        *[F.last(src, True).over(up).alias(new) for new, src in forward.items()],
        *[F.last(src, True).over(down).alias(new) for new, src in backward.items()],
    )


def positions(
    df: DataFrame, by: Sequence[str], order: Sequence[str], weight: str | None = None
) -> DataFrame:
    """Add ``_position``: the running sum of ``weight`` (1 per row if none) along ``order``."""
    by, order = list(by), list(order)
    total, largest = group_sizes(df, by)
    step = F.col(weight) if weight else F.lit(1).cast("long")
    inner = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    if largest <= group_row_limit(df.sparkSession):
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(POSITION, F.sum(step).over(w if by else inner))
    rows = ordered_chunks(df, by, order, total)
    return chunk_sums(rows, by, order, {POSITION: step}, chunk_count(df.sparkSession, total)).select(*df.columns, POSITION)


def chunk_sums(rows: DataFrame, by: Sequence[str], order: Sequence[str], sums: dict[str, Column], chunks: int) -> DataFrame:
    """Running sums along ``order`` over the ``chunks`` ranges of ``ordered_chunks``; ``sums``
    maps a new column to what it adds up."""
    by = list(by)
    w = Window.partitionBy(*by, CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    state = rows.groupBy(*by, CHUNK).agg(*[F.sum(step).alias(f"_s_{new}") for new, step in sums.items()]).select(
        *by, CHUNK, *[F.sum(f"_s_{new}").over(before).alias(f"_s_{new}") for new in sums])
    state = state.where(F.coalesce(*[f"_s_{new}" for new in sums]).isNotNull())
    joined = _attach(rows.withColumns({new: F.sum(step).over(w) for new, step in sums.items()}), state, by + [CHUNK], chunks)
    return joined.select(*rows.columns, *[(F.col(new) + F.coalesce(f"_s_{new}", F.lit(0))).alias(new) for new in sums])


def trailing(
    df: DataFrame, by: Sequence[str], order: Sequence[str], width: int, exprs: dict[str, tuple],
) -> DataFrame:
    """Aggregates over each row and up to ``width`` rows before it.

    ``exprs`` maps a new column to (aggregate column, first offset, last offset) with
    offsets in [-width, 0]. Large keys are cut into blocks by position; the last
    ``width`` rows of a block are repeated at the head of the next one.
    """
    by, order = list(by), list(order)
    total, largest = group_sizes(df, by)
    if largest <= group_row_limit(df.sparkSession):
        w = Window.partitionBy(*by).orderBy(*order)
        return df.select("*", *[agg.over(w.rowsBetween(lo, hi)).alias(n)
                                for n, (agg, lo, hi) in exprs.items()])
    size = max(width + 1, group_row_limit(df.sparkSession))
    ranked = positions(df, by, order)
    index = F.col(POSITION) - 1
    block = F.floor(index / size)
    homes = F.when(index % size >= size - width, F.array(block, block + 1)).otherwise(F.array(block))
    copies = ranked.select("*", block.alias("_home"), F.explode(homes).alias("_block"))
    w = Window.partitionBy(*by, "_block").orderBy(POSITION)
    return (
        copies.select("*", *[agg.over(w.rowsBetween(lo, hi)).alias(n)
                             for n, (agg, lo, hi) in exprs.items()])
        .where("_home = _block")
        .select(*df.columns, *exprs)
    )


#: Rank error that the brackets of ``quantiles`` allow for, as a share of a group's values,
#: and the size of the sketches they come from. A bracket that misses is widened.
BRACKET, SKETCH = 0.004, 2048


def _value(c: str) -> Column:
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def quantiles(
    df: DataFrame, by: Sequence[str], cols: Sequence[str], probs: Sequence[float],
    approx: bool = False, sizes: tuple[int, int] | None = None,
) -> DataFrame:
    """Exact interpolated percentiles: one row per key, one array per column. NaN counts as
    null.

    Spark's exact percentile keeps every distinct value of a group in one buffer. For
    large groups ``refined_quantiles`` narrows the ranks down instead. ``approx`` takes the
    quantiles of a mergeable sketch.
    """
    by, cols, probs = list(by), list(cols), [float(p) for p in probs]
    if approx:
        grid = F.array(*[F.lit(p) for p in probs])
        sketched = df.groupBy(*by).agg(*[x for i, c in enumerate(cols) for x in (
            F.count(_value(c)).alias(f"_n{i}"), F.kll_sketch_agg_double(_value(c), F.lit(SKETCH)).alias(f"_s{i}"))])
        return sketched.select(*by, *[F.when(F.col(f"_n{i}") > 0, F.kll_sketch_get_quantile_double(f"_s{i}", grid)).alias(c)
                                      for i, c in enumerate(cols)])
    _, largest = sizes or group_sizes(df, by)
    # One buffer per column holds the distinct values of a group.
    if largest <= group_row_limit(df.sparkSession) // max(1, len(cols)):
        grid = F.array(*[F.lit(p) for p in probs])
        return df.groupBy(*by).agg(*[F.percentile(_value(c), grid).alias(c) for c in cols])
    return refined_quantiles(df, by, cols, probs)


def refined_quantiles(df: DataFrame, by: Sequence[str], cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``quantiles`` for groups of any size.

    A mergeable sketch of every group and column gives a bracket of values around each
    wanted rank. The next passes count the values below the brackets, and those inside value
    by value; no buffer holds the values of a group, and only a small share of the rows is
    shuffled. Brackets that miss their rank, which the counts show, are widened.
    """
    pairs = [(i, p) for i in range(len(cols)) for p in probs]

    def at(i: int, p: float) -> Column:
        return F.when(F.col(f"_n{i}") > 0, F.kll_sketch_get_quantile_double(f"_s{i}", F.lit(p)))

    # stored, as a sketch drawn anew would differ
    sketched = stored(df.groupBy(*by).agg(*[x for i, c in enumerate(cols) for x in (
        F.count(_value(c)).alias(f"_n{i}"), F.kll_sketch_agg_double(_value(c), F.lit(SKETCH)).alias(f"_s{i}"))]), "sketches")
    wide = BRACKET
    while True:
        ends = {}
        for k, (i, p) in enumerate(pairs):
            ends[f"_lo{k}"] = at(i, p - wide) if p - wide > 0 else F.lit(float("-inf"))
            ends[f"_hi{k}"] = at(i, p + wide) if p + wide < 1 else F.lit(float("inf"))
        targets = stored(sketched.select(*by, *[f"_n{i}" for i in range(len(cols))], *[c.alias(n) for n, c in ends.items()]), "brackets")
        values = df.select(*by, *[_value(c).alias(f"_v{i}") for i, c in enumerate(cols)])
        if by:
            rows, end = null_safe(values, targets, by), {n: F.col(n) for n in ends}
        else:  # one row of numbers: as literals they reach the scan
            one = targets.first()
            rows, end = values, {n: F.lit(one[n]).cast("double") for n in ends}
        below = rows.groupBy(*by).agg(*[F.count_if(F.col(f"_v{i}") < end[f"_lo{k}"]).alias(f"_b{k}") for k, (i, _) in enumerate(pairs)])
        inside = [(F.col(f"_v{i}") >= end[f"_lo{k}"]) & (F.col(f"_v{i}") <= end[f"_hi{k}"]) for k, (i, _) in enumerate(pairs)]
        near = rows.where(reduce(lambda a, b: a | b, inside)).select(*by, F.explode(F.array(*[
            F.when(hit, F.struct(F.lit(k).alias("_k"), F.col(f"_v{i}").alias("_v"))) for (k, (i, _)), hit in zip(enumerate(pairs), inside)])).alias("_e"))
        counts = stored(near.where("_e is not null").select(*by, "_e.*").groupBy(*by, "_k", "_v").agg(F.count("*").alias("_n")), "counts")
        facts = F.explode(F.array(*[F.struct(F.lit(k).alias("_k"), F.lit(p).alias("_p"), F.col(f"_n{i}").alias("_all"), F.col(f"_b{k}").alias("_below"))
                                    for k, (i, p) in enumerate(pairs)])).alias("_e")
        totals = targets.select(*by, *[f"_n{i}" for i in range(len(cols))])
        if by:
            known = null_safe(totals, below, by)
        else:  # two single rows
            below = stored(below, "below")
            known = totals.withColumn("_b", one_row(below)).select(*totals.columns, "_b.*")
        known = known.select(*by, facts).select(*by, "_e.*")
        ranked = null_safe(positions(counts, [*by, "_k"], ["_v"], "_n"), known, [*by, "_k"])
        rank = F.col("_p") * (F.col("_all") - 1) - F.col("_below")
        hits = {name: (r >= F.col(POSITION) - F.col("_n")) & (r < F.col(POSITION)) for name, r in (("lo", F.floor(rank)), ("hi", F.ceil(rank)))}
        found = ranked.groupBy(*by, "_k").agg(*[F.max(F.when(hit, F.col("_v"))).alias(f"_{name}") for name, hit in hits.items()])
        picked = stored(null_safe(known, found, [*by, "_k"], "left"), "picks")
        if wide >= 1 or picked.where("_all > 0 and (_lo is null or _hi is null)").isEmpty():
            break
        wide *= 8
    part = F.col("_p") * (F.col("_all") - 1) - F.floor(F.col("_p") * (F.col("_all") - 1))
    exact = F.when(part == 0, F.col("_lo")).otherwise((1 - part) * F.col("_lo") + part * F.col("_hi"))
    return picked.groupBy(*by).agg(*[
        F.array(*[F.max(F.when(F.col("_k") == pairs.index((i, p)), exact)) for p in probs]).alias(c) for i, c in enumerate(cols)])


def medians(df: DataFrame, by: Sequence[str], cols: Sequence[str], approx: bool = False,
            sizes: tuple[int, int] | None = None) -> DataFrame:
    """Exact medians (mean of the middle two), one row per key."""
    q = quantiles(df, by, cols, [0.5], approx, sizes)
    return q.select(*by, *[F.col(c)[0].alias(c) for c in cols])


def one_row(df: DataFrame) -> Column:
    """The only row of ``df`` as a struct column, read through a scalar subquery."""
    return df.select(F.struct(*df.columns).alias("_row")).scalar()
