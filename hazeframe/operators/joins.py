"""Joins by time and by band."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import isqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe.functions.aqi import breakpoint_table
from hazeframe.operators.columns import as_time, time_column
from hazeframe.operators.filters import keep_last
from hazeframe.scale import BROADCAST_ROWS, carry, chunk_count, chunk_sums, group_row_limit, group_sizes, ordered_chunks
from hazeframe.session import stored


def suffix_shared(left: DataFrame, right: DataFrame, keys: Sequence[str], suffixes: tuple[str, str]):
    """Rename non-key columns that both sides have."""
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    return (left.withColumnsRenamed({c: c + suffixes[0] for c in shared}),
            right.withColumnsRenamed({c: c + suffixes[1] for c in shared}))


def outer_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
               suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Full outer join; null keys match null keys, so rows that repeat a key are paired.
    Spark never splits a hot key of a full outer join; ``join_feeds`` needs none, and
    ``merge_outer`` cuts it."""
    left, right = suffix_shared(left, right, keys, suffixes)
    return _paired(left, right, keys, [], "full_outer")


def _paired(left: DataFrame, right: DataFrame, keys: Sequence[str], cells: Sequence[str], how: str) -> DataFrame:
    mine = right.withColumnsRenamed({k: f"_r_{k}" for k in (*keys, *cells)})
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in (*keys, *cells)])
    return left.join(mine, cond, how).select(
        *[F.coalesce(F.col(k), F.col(f"_r_{k}")).alias(k) for k in keys],
        *[c for c in left.columns if c not in (*keys, *cells)],
        *[c for c in right.columns if c not in (*keys, *cells)])


def key_counts(feeds: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The keys of all feeds with the rows that each feed has of them, ``_n0``, ``_n1`` and so on."""
    flags = union_feeds(*[f.select(*keys, F.lit(k).alias("_feed")) for k, f in enumerate(feeds)])
    return flags.groupBy(*keys).agg(*[F.count(F.when(F.col("_feed") == k, 1)).alias(f"_n{k}") for k in range(len(feeds))])


def merge_outer(left: DataFrame, right: DataFrame, keys: Sequence[str], suffixes: tuple[str, str] = ("_x", "_y"),
                counts: DataFrame | None = None) -> DataFrame:
    """``outer_join`` for keys of any size.

    ``counts`` holds every key with its rows on both sides (``_n0``, ``_n1``). A key with
    more rows or pairs than one task may hold is cut: rows of a side are dealt into slots
    and repeated for every slot of the other side, so each pair meets in one cell. Such a
    key on one side only needs no join.
    """
    left, right = suffix_shared(left, right, keys, suffixes)
    limit = group_row_limit(left.sparkSession)
    counts = key_counts([left, right], keys) if counts is None else counts
    n0, n1 = F.col("_n0").cast("double"), F.col("_n1").cast("double")
    hot = stored(counts.where(F.greatest(n0, n1, n0 * n1) > limit), "hot")
    kinds = hot.count()
    if not kinds:
        return _paired(left, right, keys, [], "full_outer")
    step = max(1, isqrt(limit))
    hot = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys],
                     *[F.greatest(F.lit(1), F.ceil(n / step)).cast("int").alias(s) for n, s in ((n0, "_s0"), (n1, "_s1"))],
                     ((n0 > 0) & (n1 > 0)).alias("_meet"))
    hot = F.broadcast(hot) if kinds <= BROADCAST_ROWS else hot
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys])
    drop = [f"_h_{k}" for k in keys]
    cold = _paired(left.join(hot, cond, "left_anti"), right.join(hot, cond, "left_anti"), keys, [], "full_outer")
    sides, alone = [], []
    for feed, mine, other, slots in ((left, "_i", "_j", ("_s0", "_s1")), (right, "_j", "_i", ("_s1", "_s0"))):
        rows = feed.join(hot, cond).drop(*drop)
        alone.append(rows.where(~F.col("_meet")).select(*feed.columns))
        # stored, since a slot drawn anew would lose pairs
        slot = F.floor(F.rand(7) * F.col(slots[0])).cast("int")
        dealt = stored(rows.where("_meet").withColumn(mine, slot), "slots")
        dealt = dealt.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(slots[1]) - 1)))
        sides.append(dealt.select(*feed.columns, "_i", "_j"))
    met = _paired(*sides, keys, ["_i", "_j"], "inner")
    return union_feeds(cold, met, *alone).select(*cold.columns)


def join_feeds(aqi: DataFrame, weather: DataFrame, traffic: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The three feeds side by side on their keys, named as two outer joins would.

    Every feed has one row per key (of rows that repeat a key the largest value of a
    column counts). They are stacked and grouped once, so null keys meet, and a hot key
    is summed up before the shuffle.
    """
    aqi, weather = suffix_shared(aqi, weather, keys, ("_aqi", "_weather"))
    both = [c for c in (*aqi.columns, *weather.columns) if c not in keys]
    shared = {c for c in both if c in traffic.columns}
    aqi, weather = (f.withColumnsRenamed({c: f"{c}_x" for c in shared}) for f in (aqi, weather))
    traffic = traffic.withColumnsRenamed({c: f"{c}_y" for c in shared})
    values = [c for f in (aqi, weather, traffic) for c in f.columns if c not in keys]
    return union_feeds(aqi, weather, traffic).groupBy(*keys).agg(*[F.max(c).alias(c) for c in values])


def merge_masters(aqi: DataFrame, weather: DataFrame, traffic: DataFrame) -> DataFrame:
    """The merged table of three raw feeds: the time column of each is found by name, taken
    as the common key, and the result is in time order. Rows of one time are ordered by a
    hash, so that a time that holds much of the result is cut into several ranges of the sort.

    Rows are never summed up: those of one time (several stations, null times) are all
    paired with each other, as two outer merges do.
    """
    feeds, keys = [], ["timestamp"]
    for feed in (aqi, weather, traffic):
        found = time_column(feed, "merge")
        if found is None:
            raise ValueError(f"no time column among {feed.columns}")
        feeds.append(feed.withColumn(found, as_time(feed, found)).withColumnRenamed(found, "timestamp"))
    counts = stored(key_counts(feeds, keys), "counts")
    one, two = F.col("_n0").cast("double"), F.col("_n1").cast("double")
    pairs = F.when(one + two > 0, F.greatest(one, F.lit(1)) * F.greatest(two, F.lit(1))).otherwise(0.0)
    both = merge_outer(*feeds[:2], keys, ("_aqi", "_weather"), counts)
    merged = merge_outer(both, feeds[2], keys, counts=counts.select(*keys, pairs.alias("_n0"), F.col("_n2").alias("_n1")))
    return merged.orderBy(*keys, F.xxhash64(*merged.columns))


def asof(
    left: DataFrame, right: DataFrame, by: Sequence[str], ts: str, order: Sequence[str],
    right_order: Sequence[str], direction: str = "nearest", tolerance: str | None = None,
    prefix: str = "", time_name: str | None = None, hourly_left: bool = False,
) -> DataFrame:
    """Attach to every left row one right row of the same key, chosen by time.

    ``backward`` takes the last right row at or before the left time. ``nearest`` takes
    the closer of that row and the first one after it; equal distances go to the later
    row. ``tolerance`` (such as "1 hour") is inclusive. Both sides are stacked and
    scanned once in time order, so the work grows with the rows, not with pairs.
    ``hourly_left`` says that the left side has one row per key and hour, so that only
    the right side needs counting. Right rows without a time are left out, and a left
    row without a time gets nulls.
    """
    right = right.where(F.col(ts).isNotNull())
    taken = [c for c in right.columns if c not in by]
    unique = keep_last(right, [*by, ts], right_order) if right_order else right
    hit = F.struct(*[F.col(c) for c in taken])
    lefts = left.select("*", F.lit(1).alias("_side"), F.lit(None).cast(unique.select(hit).schema[0].dataType).alias("_hit"))
    rights = unique.select(*by, ts, F.lit(0).alias("_side"), hit.alias("_hit"))
    both = lefts.unionByName(rights, allowMissingColumns=True)
    nearest = direction == "nearest"
    # Counting the inputs spares the count from running the dedup as well.
    counted = right.select(*by) if hourly_left else left.select(*by).unionByName(right.select(*by))
    scanned = carry(both, by, [ts, "_side", *order], {"_prev": "_hit"}, {"_next": "_hit"} if nearest else {},
                    sizes=group_sizes(counted, by))
    rows = scanned.where("_side = 1")
    pick = F.when(F.col(ts).isNotNull(), F.col("_prev"))
    if nearest:
        back = F.col(ts) - F.col("_prev")[ts]
        ahead = F.col("_next")[ts] - F.col(ts)
        later = F.when(F.col("_prev").isNull() | (ahead <= back), F.col("_next")).otherwise(F.col("_prev"))
        pick = F.when(F.col(ts).isNotNull(), later)
    rows = rows.withColumn("_pick", pick)
    if tolerance:
        limit = F.expr(f"interval {tolerance}")
        gap = F.col(ts) - F.col("_pick")[ts]
        rows = rows.withColumn("_pick", F.when((gap <= limit) & (gap >= -limit), F.col("_pick")))
    names = {c: (time_name or f"{prefix or 'right_'}{c}") if c == ts else f"{prefix}{c}" for c in taken}
    return rows.select(*left.columns, *[F.col("_pick")[c].alias(n) for c, n in names.items()])


def join_bands(df: DataFrame, scheme: str, pollutant: str = "pollutant", conc: str = "conc") -> DataFrame:
    """Long readings with the breakpoint row that holds their concentration.

    The band table is a constant of at most 36 rows, so it is broadcast.
    """
    bands = F.broadcast(breakpoint_table(df.sparkSession, scheme)).withColumnRenamed("pollutant", "_p")
    cond = (F.col(pollutant) == F.col("_p")) & F.col(conc).between(F.col("lo"), F.col("hi"))
    return df.join(bands, cond, "left").drop("_p")


#: A cell of rows that bands are looked up in has at least so many rows.
CELL_ROWS = 64


def join_ranges(df: DataFrame, bands: DataFrame, by: Sequence[str], value: str, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Left join of every row with each band of its ``by`` group that holds ``value``, both
    ends included; for tables of any size on either side. A null end is open, a band with lo
    above hi holds nothing, and a null value matches none.

    Rows and band ends stand in one order, by group and value, so that a band holds the rows
    of one span of ranks, and the bands open at a row are its hits. Ranks are cut into cells,
    and a band goes to those it meets; a cell has a fourth of the mean span, but 64 rows at
    least and 2,000 at most (the root of the row limit). Hits are never stored or shuffled:
    disk grows with the tables and with one copy of a band per cell of its span.
    """
    by = list(by)
    spark = df.sparkSession
    step = max(1, isqrt(group_row_limit(spark)))
    v = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    more = [c for c in bands.columns if c not in by]
    low, high = (F.coalesce(F.col(c).cast("double"), F.lit(open_end)) for c, open_end in ((lo, float("-inf")), (hi, float("inf"))))
    # stored, since a number drawn anew would pair other ends
    held = stored(bands.select(*by, F.monotonically_increasing_id().alias("_id"), low.alias("_lo"), high.alias("_hi"),
                               *[F.col(c).alias(f"_b_{c}") for c in more]), "bands")
    ends = held.where("_lo <= _hi").select(*by, "_id", F.explode(F.array(
        F.struct(F.col("_lo").alias("_x"), F.lit(0).alias("_side")), F.struct(F.col("_hi").alias("_x"), F.lit(2).alias("_side")))).alias("_end")).select(*by, "_id", "_end.*")
    rows = df.select(*by, v.alias("_x"), F.lit(1).alias("_side"), F.struct(*df.columns).alias("_row"))
    # + 0.0: both zeros are one value; a random tie-break cuts a value of many rows
    points = union_feeds(rows, ends).withColumns({"_x": F.col("_x") + 0.0, "_tie": F.rand(7)})
    total = points.count()
    order = [*by, "_x", "_side", "_tie"]
    is_row = (F.col("_side") == 1) & F.col("_x").isNotNull()
    ranked = stored(chunk_sums(ordered_chunks(points, [], order, total), [], order, {
        "_rank": is_row.cast("long"), "_open": F.when(F.col("_side") == 0, 1).when(F.col("_side") == 2, -1).otherwise(0).cast("long"),
    }, chunk_count(spark, total)).select("_side", "_id", "_row", "_rank", "_open"), "ranked")
    spans = ranked.where("_side <> 1").groupBy("_id").agg(F.min("_rank").alias("_from"), F.max("_rank").alias("_to")).where("_from < _to")
    spans = stored(held.join(spans, "_id").drop(*by, "_lo", "_hi"), "spans")
    count, hits = spans.agg(F.count("*"), F.sum(F.col("_to") - F.col("_from"))).first()
    rows_in = min(step, max(CELL_ROWS, (hits or 0) // (4 * max(1, count))))
    asked = ranked.where("_side = 1 and _open > 0").select("_row", (F.col("_rank") - 1).alias("_at"))
    asked = asked.withColumn("_cell", F.floor(F.col("_at") / rows_in))
    spread = spans.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("_from") / rows_in), F.floor((F.col("_to") - 1) / rows_in))))
    # a cell of many bands is cut into slots of bands, each with all its rows
    full = stored(spread.groupBy("_cell").count().where(F.col("count") > step).select("_cell", F.ceil(F.col("count") / step).cast("int").alias("_slots")), "full-cells")
    full = F.broadcast(full) if full.count() <= BROADCAST_ROWS else full
    slots = F.coalesce("_slots", F.lit(1))
    asked = asked.join(full, "_cell", "left").withColumn("_slot", F.explode(F.sequence(F.lit(0), slots - 1))).drop("_slots")
    spread = spread.join(full, "_cell", "left").withColumn("_slot", F.pmod(F.xxhash64("_id"), slots.cast("long")).cast("int")).drop("_slots")
    # by sort: what is known of the size of the bands was known before their copies
    met = asked.join(spread.hint("merge"), ["_cell", "_slot"]).where("_at >= _from and _at < _to")
    alone = ranked.where("_side = 1 and _open = 0")
    return met.select("_row.*", *[F.col(f"_b_{c}").alias(c) for c in more]).union(
        alone.select("_row.*", *[F.lit(None).cast(bands.schema[c].dataType).alias(c) for c in more]))


def attach(df: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join a dimension; Spark broadcasts it when its measured size allows."""
    return df.join(dim, list(on), "left")


def union_feeds(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, columns by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
