"""Mixing sources to target weights by a low-discrepancy schedule (operator 11).

Slot n of the mix belongs to the point n * phi (modulo 1), mapped through the cumulative
targets of the sources; any stretch of slots is close to the targets. The slots of a
source are ranked, and slot k of a source takes block k of its documents, which stand in
the order of a hash and are cut into blocks of equal numbers of words. A document may lie
in several blocks, and a source that is taken more than once goes round.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeframe.llm.common import stored
from hazeframe.scale import POSITION, positions

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
#: A target is at most so many times its source's size.
TIMES = 2
BLOCK = 4096
#: Points are integers below 2**POINT_BITS; the step is the golden ratio's fraction of that, made odd.
POINT_BITS = 40
HALF = POINT_BITS // 2
STEP = int((5 ** 0.5 - 1) / 2 * (1 << POINT_BITS)) | 1
#: Slots are ranked, and items numbered, in groups of about this many rows.
GROUP_ROWS = 50_000
COPIES = 10_000


def point(n: Column) -> Column:
    """n * STEP modulo 2**POINT_BITS, in two halves, so that no product overflows."""
    low = (1 << HALF) - 1
    high = F.shiftrightunsigned(n, HALF).bitwiseAND(F.lit(low)) * F.lit(STEP)
    return (F.shiftleft(high.bitwiseAND(F.lit(low)), HALF) + n.bitwiseAND(F.lit(low)) * F.lit(STEP)).bitwiseAND(
        F.lit((1 << POINT_BITS) - 1))


def _exact(n: int) -> Column:
    return F.lit(Decimal(n)).cast("decimal(38,0)")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE, times: int = TIMES) -> DataFrame:
    """(source, source_size, idx, target) from (source, source_size).

    Weights are given out by the code points of the source, null last, again and again.
    The excess over ``times`` the size is reshared by weight until no source is above;
    each round is an aggregate over the sources, and sums of them are all the driver sees.
    """
    ordered = positions(sizes.withColumn("_null", F.col("source").isNull()), [], ["_null", "source"])
    given = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col(POSITION) - 1) % len(weights) + 1).cast("int"))
    ranked = stored(ordered.select("source", "source_size", F.col(POSITION).alias("idx"), given.cast("long").alias("_w")), "sources")
    size, weight = F.col("source_size").cast("decimal(38,0)"), F.col("_w").cast("decimal(38,0)")
    total = int(ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    full, state = F.lit(False), None
    while True:
        row = ranked.agg(F.coalesce(F.sum(F.when(full, F.col("source_size"))), F.lit(0)),
                         F.coalesce(F.sum(F.when(~full, F.col("_w"))), F.lit(0))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
        # weight one gets (share * total - times * filled) / open words
        num = share.numerator * total - times * share.denominator * int(row[0])
        den = share.denominator * int(row[1])
        full = size * _exact(times * den) <= weight * _exact(num)
    target = F.when(full, (F.col("source_size") * times).cast("double")).otherwise(
        F.col("_w").cast("double") * F.lit(float(num)) / F.lit(float(den or 1)))
    return ranked.select("source", "source_size", "idx", target.alias("target"))


def _spread(df: DataFrame, by: str, group: Column, order: Sequence[str], weight: Column | None) -> tuple[DataFrame, DataFrame]:
    """(rows with their place inside the group, start of each (by, group)).

    Groups follow one another in their own order. Only sums of groups are summed in order,
    so no task holds all rows of a ``by`` value.
    """
    step = F.lit(1).cast("long") if weight is None else weight
    dealt = df.withColumn("_g", group)
    inside = Window.partitionBy(by, "_g").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(by).orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(by, "_g").agg(F.sum(step).alias("_n")).select(
        F.col(by).alias("_by"), F.col("_g").alias("_gg"), F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long").alias("_start"))
    return dealt.withColumn("_in", F.coalesce(F.sum(step).over(inside), F.lit(0)).cast("long")), starts


def schedule(plan: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, idx, k): the source of every slot and the slot's rank within its source.

    ``plan`` has idx and tokens. The points are looked up by an equi-join on cells of the
    unit interval; a cell holds the same share of points whatever the sources look like.
    A source that no point meets gets one slot behind the others.
    """
    plan = plan.where("tokens > 0").select("idx", "tokens")
    cum = stored(positions(plan, [], ["idx"], "tokens"), "cumulated")
    count, total = cum.agg(F.count("*"), F.coalesce(F.max(POSITION), F.lit(0))).first()
    slots = math.ceil(int(total) / block)
    ones, scale = 1 << POINT_BITS, float(1 << POINT_BITS) / max(1, int(total))
    bounds = cum.select("idx", F.floor((F.col(POSITION) - F.col("tokens")) * F.lit(scale)).alias("_lo"),
                        F.when(F.col(POSITION) == int(total), ones).otherwise(F.floor(F.col(POSITION) * F.lit(scale))).alias("_hi"))
    bits = max(12, math.ceil(math.log2(4 * max(1, count))))
    cells = bounds.where("_lo < _hi").withColumn("_cell", F.explode(F.sequence(
        F.shiftrightunsigned("_lo", POINT_BITS - bits), F.shiftrightunsigned(F.col("_hi") - 1, POINT_BITS - bits))))
    points = plan.sparkSession.range(slots).select(F.col("id").alias("slot"), point(F.col("id")).alias("_u"))
    points = points.withColumn("_c", F.shiftrightunsigned("_u", POINT_BITS - bits))
    met = points.join(cells, (F.col("_c") == F.col("_cell")) & (F.col("_u") >= F.col("_lo")) & (F.col("_u") < F.col("_hi"))).select("slot", "idx")
    ranked, starts = _spread(met, "idx", F.floor(F.col("slot") / GROUP_ROWS), ["slot"], None)
    ranked = ranked.join(starts, (F.col("idx") == F.col("_by")) & (F.col("_g") == F.col("_gg"))).select(
        "slot", "idx", (F.col("_start") + F.col("_in")).alias("k"))
    ranked = stored(ranked, "slots")
    unmet = plan.join(ranked.select("idx").distinct(), "idx", "left_anti")
    late = positions(unmet.select("idx"), [], ["idx"]).select((F.col(POSITION) + (slots - 1)).alias("slot"), "idx", F.lit(0).cast("long").alias("k"))
    return ranked.unionByName(late)


def _block_of(at: Column) -> Column:
    """The block that word ``at`` of a source's round falls into; the first ``_more`` blocks
    hold a word more than the others."""
    cut = F.col("_more") * (F.col("_words") + 1)
    return F.when(at < cut, _div(at, F.col("_words") + 1)).otherwise(
        F.col("_more") + _div(at - cut, F.greatest("_words", F.lit(1).cast("long"))))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _block_start(k: Column) -> Column:
    return k * F.col("_words") + F.least(k, F.col("_more"))


KEY = ["idx", "doc_id", "_hash", "_copy"]


class Mix:
    """The mix of ``docs`` (doc_id, source, text).

    ``rows``: source, doc_id, size, source_size and target of every row of docs.
    ``slots``: slot, idx (number of the source), k (rank within the source).
    ``spans()``: the mix itself, as spans of words of documents.

    A null text has no words, a null source is a source, null ids are kept. Rows that agree
    in source, id and text are rows of their own and lie one behind the other; ties cannot
    matter else. Documents without words are in rows only. An empty table gives no rows.
    Other columns are ignored. All is a function of the rows, so reruns agree.
    """

    def __init__(self, docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE,
                 times: int = TIMES, block: int = BLOCK) -> None:
        if not 0 <= share <= times:
            raise ValueError("no source may be taken more than `times` times, so the share cannot be larger")
        self.times = times
        text = F.coalesce("text", F.lit(""))
        named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit("/"), text)
        items = docs.select("source", F.col("doc_id").cast("long").alias("doc_id"),
                            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.md5(named).alias("_hash"))
        items = stored(items.groupBy("source", "doc_id", "size", "_hash").agg(F.count("*").alias("copies")), "sizes")
        sizes = items.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
        plan = targets(sizes, weights, share, times).withColumn("tokens", F.floor("target").cast("long"))
        self.slots = stored(schedule(plan, block), "schedule")
        counts = self.slots.groupBy("idx").agg(F.count("*").alias("_m"))
        plan = stored(plan.join(counts, "idx", "left").withColumn("_m", F.greatest(F.coalesce("_m", F.lit(1)), F.lit(1)).cast("long")), "plan")

        total = items.count()
        digits = max(1, math.ceil(math.log(max(1, total / GROUP_ROWS), 16)))
        placed, starts = _spread(items, "source", F.substring("_hash", 1, digits), ["_hash", "doc_id"], F.col("size") * F.col("copies"))
        starts = starts.join(plan, F.col("_by").eqNullSafe(F.col("source"))).drop("source")
        placed = placed.join(starts, F.col("source").eqNullSafe(F.col("_by")) & (F.col("_g") == F.col("_gg")))
        placed = stored(placed.select(
            "source", "idx", "doc_id", "_hash", "size", "copies", "source_size", "target", "tokens", (F.col("_start") + F.col("_in")).alias("_at"),
            _div(F.col("tokens"), F.col("_m")).alias("_words"), (F.col("tokens") % F.col("_m")).alias("_more")), "placed")
        # rows that repeat very often are dealt out before they are written one by one
        first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long")))
        often = placed.where(F.col("copies") > COPIES).withColumn("_from", first).repartition("_hash", "_from")
        parts = placed.where(F.col("copies") <= COPIES).withColumn("_from", F.lit(0).cast("long")).unionByName(often)
        copy = F.explode(F.sequence("_from", F.least(F.col("_from") + COPIES, F.col("copies")) - 1))
        self.rows = parts.withColumn("_copy", copy).withColumn("_at", F.col("_at") + F.col("_copy") * F.col("size")).drop("_from", "copies")

    def spans(self) -> DataFrame:
        """(slot, offset, source, doc_id, start, length, size, ...): ``length`` words of a
        document from word ``start`` on stand at ``offset`` of ``slot``."""
        rounds = self.rows.withColumn("_round", F.explode(F.array(*[F.lit(r).cast("long") for r in range(self.times)])))
        rounds = rounds.withColumn("_from", F.col("_at") + F.col("_round") * F.col("source_size"))
        rounds = rounds.withColumn("_to", F.least(F.col("_from") + F.col("size"), F.col("tokens"))).where("_from < _to")
        parts = rounds.withColumn("_k", F.explode(F.sequence(_block_of(F.col("_from")), _block_of(F.col("_to") - 1))))
        begin = F.greatest(_block_start(F.col("_k")), F.col("_from"))
        end = F.least(_block_start(F.col("_k") + 1), F.col("_to"))
        parts = parts.select(*KEY, "source", "size", "source_size", "target", "_k", (begin - F.col("_from")).alias("start"),
                             (end - begin).alias("length"), (begin - _block_start(F.col("_k"))).alias("offset"))
        slots = self.slots.select("slot", F.col("idx").alias("_idx"), "k")
        return parts.join(slots, (F.col("idx") == F.col("_idx")) & (F.col("_k") == F.col("k"))).drop("_idx", "_k", "k")

    def taken(self) -> DataFrame:
        """(doc_id, size, source_size, target, taken): the words that the spans of each row hold."""
        cols = [*KEY, "size", "source_size", "target"]
        both = self.rows.select(*cols, F.lit(0).cast("long").alias("length")).unionByName(self.spans().select(*cols, "length"))
        return both.groupBy(*KEY).agg(*[F.max(c).alias(c) for c in cols[len(KEY):]], F.sum("length").alias("taken")).select(
            "doc_id", *cols[len(KEY):], "taken")
