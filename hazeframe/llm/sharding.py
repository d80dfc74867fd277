"""Sharding by balanced label propagation (operator 10), DataFrame operations only.

Documents with equal texts are linked. Shards are labels that spread over the links: every
document starts with a label of its own, and its group then asks, as a whole, for the
shard that holds most of it. Requests are granted while the shard stays within its quota of
bytes, the large ones first; what is refused asks for shards with room, round after round,
until nothing moves. A group above the quota cannot stay whole and fills shard after shard.
Documents without links cost no cut wherever they go, so they are dealt last and level the
shards, the large ones first.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeframe.llm.common import number_slots, running_total, stored

SHARDS = 8
#: Tasks over which the rows of one group are dealt when they meet a fact about it.
SALTS = 16
#: Upper sizes of the classes in which documents level the shards, from large to small.
LEVELS = [1 << k for k in (40, 17, 15, 13, 11, 10, 9, 8, 7)]


def _pick(values: list[int], index: Column) -> Column:
    """values[index] for a shard number."""
    return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), index + 1)


def _totals(rows: DataFrame, shards: int) -> list[int]:
    out = [0] * shards
    for shard, n in rows.groupBy("shard").agg(F.sum("size")).collect():
        out[shard] = int(n)
    return out


def _line(units: DataFrame, by: list[str], rows: int) -> DataFrame:
    """Add ``_at``: the bytes of the units before each in its ``by`` group, large units first
    (by powers of two, of equals in the order of running_total)."""
    ranked = units.withColumn("_rank", (64 - F.floor(F.log2("size"))).cast("int"))
    weights = ranked.groupBy(*by, "_rank").agg(F.sum("size").alias("_w"))
    before = Window.partitionBy(*by).orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    weights = weights.select(*[F.col(c).alias(f"_b_{c}") for c in (*by, "_rank")], F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_before"))
    match = F.lit(True)
    for c in (*by, "_rank"):
        match = match & (F.col(c) == F.col(f"_b_{c}"))
    # at most 64 rows for each shard
    queued = running_total(ranked, [*by, "_rank"], ["unit"], "size", "_queue", rows).join(F.broadcast(weights), match)
    return queued.select(*units.columns, (F.col("_before") + F.col("_queue")).alias("_at"))


def _dealt(line: Column, size: Column, room: list[int]) -> Column:
    """The shard whose stretch of the rooms, one after another, holds a unit's middle."""
    ends = list(accumulate(max(0, r) for r in room))
    return F.size(F.filter(F.array(*[F.lit(float(e)) for e in ends[:-1]]), lambda e: e <= line + size / 2)).cast("int")


def _salted(rows: DataFrame, groups: DataFrame, on: str, to: str, how: str) -> DataFrame:
    """Join of documents with a table of one row per group or unit. The rows of a large group
    are dealt over SALTS tasks, where the other side is repeated."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salt = F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")
    right = groups.withColumn("_salt", salts)
    joined = rows.withColumn("_own", salt).join(right, (F.col(on) == F.col(to)) & (F.col("_own") == F.col("_salt")), how)
    return joined.drop("_own", "_salt", to)


def _propagate(linked: DataFrame, quota: int, shards: int) -> tuple[DataFrame, DataFrame]:
    """(linked documents with their shards, those that no shard has room for).

    A unit is a group, or a document of a group above the quota.
    """
    start = linked.withColumn("shard", F.pmod(F.xxhash64("key", F.lit("start")), F.lit(shards)).cast("int"))
    votes = start.groupBy("group", "shard").agg(F.sum("size").alias("here"))
    groups = stored(votes.groupBy("group").agg(  # at most one row per group and shard
        F.sum("here").alias("size"), F.max(F.struct("here", (-F.col("shard")).alias("shard"))).alias("best")).select(
        "group", "size", (-F.col("best.shard")).alias("to")), "groups")
    above = groups.where(F.col("size") > quota).select(F.col("group").alias("_g"))
    large = stored(_salted(linked, above, "group", "_g", "left_semi"), "large")
    small = groups.where(F.col("size") <= quota).select(F.col("group").alias("unit"), "size", "to")
    n_large = large.count()
    room = [quota] * shards
    placed = None

    def grant(asks: DataFrame, rows: int) -> DataFrame:
        """Place what fits, the large units first; gives what does not."""
        nonlocal placed
        granted = stored(_line(asks, ["to"], rows).withColumn("_in", F.col("_at") + F.col("size") <= _pick(room, F.col("to"))), "granted")
        inside = granted.where("_in").select("unit", "size", F.col("to").alias("shard"))
        for shard, taken in enumerate(_totals(inside, shards)):
            room[shard] -= taken
        placed = inside if placed is None else placed.unionByName(inside)
        return granted.where("not _in").select("unit", "size")

    asks = small
    if n_large:  # one after another and before all others, so that each is cut as seldom as can be
        queue = running_total(large, [], ["group", "key"], "size", "_at", n_large)
        filled = F.least(F.floor((F.col("_at") + F.col("size") / 2) / quota), F.lit(shards - 1)).cast("int")
        refused = grant(stored(queue.select(F.col("key").alias("unit"), "size", filled.alias("to")), "asks"), n_large)
        left = refused.count()
        if left:
            asks = asks.unionByName(_line(refused, [], left).select("unit", "size", _dealt(F.col("_at"), F.col("size"), room).alias("to")))
    asks = stored(asks, "asks")
    waiting = asks.count()
    while waiting:
        before = sum(room)
        refused = grant(asks, waiting)
        waiting = refused.count()
        if sum(room) == before:  # nothing moved
            break
        if waiting:
            asks = stored(_line(refused, [], waiting).select("unit", "size", _dealt(F.col("_at"), F.col("size"), room).alias("to")), "asks")
    if placed is None:
        nothing = linked.withColumn("shard", F.lit(0)).limit(0)
        return nothing, linked
    unit = F.coalesce(F.col("_u"), F.col("group"))
    named = linked.join(large.select(F.col("key").alias("_u")), F.col("key") == F.col("_u"), "left").withColumn("unit", unit).drop("_u")
    home = placed.select(F.col("unit").alias("_unit"), "shard")
    done = stored(_salted(named, home, "unit", "_unit", "left").select("key", "group", "size", "shard"), "labels")
    return done.where("shard is not null"), done.where("shard is null").drop("shard")


def cut_pairs(placed: DataFrame) -> DataFrame:
    """(pairs, cut): pairs of linked documents, and those whose shards differ; from rows
    with group and shard."""
    parts = placed.groupBy("group", "shard").agg(F.count("*").alias("n"))
    groups = parts.groupBy("group").agg(F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("same"))
    pairs = F.col("n") * (F.col("n") - 1) / 2
    return groups.agg(F.coalesce(F.sum(pairs), F.lit(0)).cast("long").alias("pairs"),
                      F.coalesce(F.sum(pairs - F.col("same")), F.lit(0)).cast("long").alias("cut"))


def _height(used: list[int], weight: int) -> float:
    """The level that the emptiest shards reach together when ``weight`` is poured in."""
    filled = sorted(used)
    for k in range(1, len(filled) + 1):
        height = (weight + sum(filled[:k])) / k
        if k == len(filled) or height <= filled[k]:
            return height
    return 0.0


def _level(rest: DataFrame, used: list[int], shards: int) -> DataFrame:
    """Deal documents into the room that shards have left, class by class of size.

    Documents of a class stand in a line, group by group; the line is cut where the next
    shard is full. Each cut is off by less than one document, and the next class, of
    smaller ones, makes up for it.
    """
    rest = stored(rest.withColumn("level", F.expr(
        "case " + " ".join(f"when size > {low} then {k}" for k, low in enumerate(LEVELS[1:])) + f" else {len(LEVELS) - 1} end")),
        "rest")
    classes = {r[0]: (int(r[1]), int(r[2])) for r in rest.groupBy("level").agg(F.count("*"), F.sum("size")).collect()}
    used, done = list(used), None
    for level in sorted(classes):
        n, weight = classes[level]
        height = _height(used, weight)
        ends = list(accumulate(max(0.0, height - u) for u in used))
        line = running_total(rest.where(F.col("level") == level), [], ["group", "key"], "size", "_at", n)
        middle = F.col("_at") + F.col("size") / 2
        shard = F.size(F.filter(F.array(*[F.lit(float(e)) for e in ends[:-1]]), lambda e: e <= middle))
        # a shard without room has an interval of no length, which no middle falls into
        placed = stored(line.withColumn("shard", shard.cast("int")).select("key", "group", "size", "shard"), "level")
        for k, w in enumerate(_totals(placed, shards)):
            used[k] += w
        done = placed if done is None else done.unionByName(placed)
    return done


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, group): equal texts together where quotas
    allow, sizes near equal. Rows of one group have equal texts; ``cut_pairs`` counts the
    links between shards.

    size is the UTF-8 bytes of the text plus 1 (a null text has no bytes), slot numbers
    the rows of a shard without gaps. Null texts are equal to each other. Rows that
    repeat, id included, are linked and dealt as separate rows; a null doc_id is kept. An
    empty table gives no rows. Other columns are ignored. The driver sees the byte sums
    of the shards and of the size classes.
    """
    raw = F.col("text").cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(raw, F.lit(b""))).alias("text_crc32"), F.coalesce(F.md5(raw), F.lit("")).alias("_hash"))
    # rows that repeat get one key, and count with all their bytes
    rows = stored(rows.withColumn("key", F.md5(F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "_hash"))), "sizes")
    items = rows.groupBy("key", F.col("_hash").alias("group")).agg(
        F.sum("size").alias("size"), F.count("*").alias("rows"))
    items = stored(items, "items")
    copies = items.groupBy("group").agg(F.count("*").alias("_n")).where("_n > 1").select(F.col("group").alias("_g"))
    linked = _salted(items, copies, "group", "_g", "left_semi").select("key", "group", "size")
    single = _salted(items, copies, "group", "_g", "left_anti").select("key", "group", "size")
    total = int(items.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0])
    quota = -(-total // shards)
    labels, beyond = _propagate(linked, quota, shards)
    loose = _level(single.unionByName(beyond), _totals(labels, shards), shards)
    placed = labels if loose is None else labels.unionByName(loose)
    named = rows.join(placed.select(F.col("key").alias("_key"), "shard"), F.col("key") == F.col("_key"))
    n = rows.count()
    return number_slots(stored(named.select("doc_id", "size", "text_crc32", "key", "shard", F.col("_hash").alias("group")), "placed"),
                        "shard", ["key", "doc_id"], "slot", n).select("doc_id", "size", "text_crc32", "shard", "slot", "group")
