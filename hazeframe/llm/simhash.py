"""SimHash near-duplicates by a grid join on per-segment bit counts (operator 2).

A 64-bit fingerprint is embedded as 32 bit counts, one per segment of two bits. The
Manhattan distance of two count vectors never exceeds the Hamming distance of the
fingerprints. Within distance 3, one half of the 16 + 16 counts therefore differs by at
most 1: the two points lie in the same unit cell of that half's grid or in two cells
that touch in one coordinate. The range join probes exactly these cells, cuts the
candidates by the Manhattan distance over all counts, then by the Hamming distance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeframe.llm.common import add_columns, fresh, stored
from hazeframe.llm.components import components

SHINGLE, SEED, MAX_BITS = 3, 42, 3
_BITS = np.array([[v >> b & 1 for b in range(8)] for v in range(256)], np.int64)
HALVES = {0: "(fp & 4294967295L)", 1: "shiftrightunsigned(fp, 32)"}
PAIRS = 0x55555555


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit SimHash over XXH64 (seed 42) of the 3-word shingles, repeats
    included. A-Z is lower-cased; words are runs without ASCII white space."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(words, words[1:], words[2:])) if len(words) >= SHINGLE else [b" ".join(words)]
    one = xxhash.xxh64_intdigest
    hashes = np.array([one(s, SEED) for s in shingles], np.uint64)
    columns = hashes.view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(columns[:, i], minlength=256) @ _BITS for i in range(8)])
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(texts: pa.Array) -> list[pa.Array]:
    made = np.array([fingerprint(t) for t in texts.to_pylist()], np.uint64)
    return [pa.array(made.view(np.int64), pa.int64())]


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp); fp holds the fingerprint's bits as a signed long. Null and empty
    texts get 0."""
    return add_columns(docs, ["text"], [T.StructField("fp", T.LongType())], _fingerprints, keep=["doc_id"])


def links(points: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) with a < b: all pairs of distinct fingerprints at most ``max_bits`` apart.

    ``points`` has one row per distinct fingerprint, column fp. Exact for up to 3 bits.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the two half grids are exact for at most 3 differing bits")
    whole = points.select("fp")
    for name, half in (("lo", HALVES[0]), ("hi", HALVES[1])):
        whole = whole.withColumn(name, F.expr(half))
        # SWAR: the count of every 2-bit segment, side by side
        whole = whole.withColumn(name, F.expr(f"{name} - (shiftright({name}, 1) & {PAIRS}L)"))
    # Unary form of the counts: Manhattan distance becomes a popcount.
    unary = "({c} | (shiftright({c}, 1) & 1431655765L))"
    whole = whole.withColumn("u", F.expr(
        f"shiftleft({unary.format(c='hi')}, 32) | {unary.format(c='lo')}"))
    step = "transform(filter(sequence(0, 15), i -> (shiftright({c}, 2 * i) & 3) < 2), i -> {c} + shiftleft(1L, 2 * i))"

    def rows(cells):
        both = ", ".join(f"transform({cells.format(c=c)}, x -> struct({k} as half, x as cell))"
                         for k, c in enumerate(("lo", "hi")))
        return whole.select("fp", "u", F.expr(f"explode(concat({both})) as at")).select("fp", "u", "at.*")

    home = rows("array({c})").alias("h")
    # A pair one step apart is met once, from its lower end; a pair in one cell from both ends.
    probe = rows(f"concat(array({{c}}), {step})").alias("p")
    met = (F.col("h.half") == F.col("p.half")) & (F.col("h.cell") == F.col("p.cell")) & (
        F.col("h.fp") != F.col("p.fp")) & (F.expr("bit_count(h.u ^ p.u)") <= max_bits) & (
        F.expr("bit_count(h.fp ^ p.fp)") <= max_bits)
    return (home.join(probe, met)
            .select(F.least("h.fp", "p.fp").alias("a"), F.greatest("h.fp", "p.fp").alias("b")).distinct())


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id): the smallest doc_id reachable over links.

    Documents are first reduced to distinct fingerprints, so copies cost nothing more.
    Null texts count as empty (fingerprint 0). A row without doc_id has a component like
    any other, but can't name one: component_id is null if no row in reach has an id.
    Repeated rows stay repeated; empty tables give no rows; other columns are ignored.
    """
    fps = stored(fingerprints(docs), "fingerprints")
    points = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "points")
    roots = components(links(points, max_bits))
    rooted = points.join(roots, points["fp"] == roots["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    members = rooted.join(named, "root").select("fp", "component_id")
    return fps.join(members, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id.

    Of rows that repeat a doc_id one stays. Rows without doc_id can't be told apart by
    it and stay as they are. Columns and their order are kept.
    """
    from pyspark.sql import Window

    own = fresh(docs, "_kept")
    kept = (near_duplicates(docs.select("doc_id", "text")).where("doc_id = component_id")
            .select(F.col("doc_id").alias(own)).distinct())
    same = Window.partitionBy("doc_id").orderBy("doc_id")
    chosen = (docs.join(kept, F.col("doc_id") == F.col(own))
              .withColumn(own, F.row_number().over(same)).where(F.col(own) == 1).select(*docs.columns))
    return chosen.unionByName(docs.where("doc_id is null"))
