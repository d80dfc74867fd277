"""Hard-negative mining with segment summaries (operator 13).

Every vector is stored with the mean and the deviation of its segments of two
components. For a segment of n components, n * mean_a * mean_b is off the segment's part of
the inner product by at most the product of the deviations, so two inner products of the
summaries bound the score. Segments are refined from the whole vector to two components;
pairs whose bounds leave the wanted range of scores go at the first level that shows it,
and the rest are scored exactly, in integers.

Anchors are the stated query set: they are taken in blocks of bounded size against all
vectors, which stay where they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeframe.llm.common import in_tasks, number_slots, stored
from hazeframe.session import scratch_path, ship

SEGMENT = 2
#: Components beyond this have no part: their products would not fit a long.
LARGEST = 1 << 26
#: An anchor block holds at most so many anchors and so many components.
BLOCK_ANCHORS, BLOCK_CELLS = 4096, 4_000_000
#: Pairs that are compared at once in a task. The first rows come in smaller tiles, which set
#: scores to beat for the rest.
TILE, FIRST_ROWS = 2_000_000, 128
NO_ID = np.iinfo(np.int64).max  # a null id comes last among ties
NEVER = np.iinfo(np.int64).min


def _summaries(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, squared deviations) of the segments of each row."""
    n, d = q.shape
    wide = np.zeros((n, -(-d // SEGMENT) * SEGMENT))
    wide[:, :d] = q
    parts = wide.reshape(n, -1, SEGMENT)
    sums = parts.sum(axis=2)
    return sums, np.maximum((parts * parts).sum(axis=2) - sums * sums / SEGMENT, 0.0)


def _levels(sums: np.ndarray, squares: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(scaled means, deviations) from one segment down to the stored ones. Inner products of
    the first are the middle of the score's bounds, those of the second how far it can be off."""
    width, out = SEGMENT, []
    while True:
        out.append((sums / np.sqrt(width), np.sqrt(squares)))
        if sums.shape[1] <= 1:
            return out[::-1]
        if sums.shape[1] % 2:
            sums, squares = (np.pad(x, ((0, 0), (0, 1))) for x in (sums, squares))
        a, b = sums[:, ::2], sums[:, 1::2]
        # two halves of one width: their deviations add up, plus what their means differ
        squares = squares[:, ::2] + squares[:, 1::2] + (a - b) ** 2 / (2 * width)
        sums, width = a + b, 2 * width


def quantized(df: DataFrame) -> DataFrame:
    """(vec_id, label, q, sums, squares) of the rows that take part; arrays as bytes."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, lists = (batch.column(i) for i in range(3))
            flat = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
            good = np.isfinite(flat)  # a null component arrives as NaN
            scaled = np.floor(256 * np.where(good, flat, 0.0))
            good &= np.abs(scaled) <= LARGEST
            lengths = np.where(lists.is_null(), 0, lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int64)
            ends = np.cumsum(lengths)
            bad = np.concatenate([[0], np.cumsum(~good)])
            whole = (bad[ends] == bad[ends - lengths]) & lists.is_valid().to_numpy(zero_copy_only=False)
            whole &= labels.is_valid().to_numpy(zero_copy_only=False)
            rows, q, sums, squares = np.flatnonzero(whole), [], [], []
            for i in rows:
                v = scaled[ends[i] - lengths[i]:ends[i]]
                s, sq = _summaries(v[None])
                q.append(v.astype(np.int32).tobytes())
                sums.append(s[0].tobytes())
                squares.append(sq[0].tobytes())
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [ids.take(take), labels.take(take), *(pa.array(x, pa.binary()) for x in (q, sums, squares))],
                names=["vec_id", "label", "q", "sums", "squares"])

    return in_tasks(df.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding"), run,
                    "vec_id long, label long, q binary, sums binary, squares binary")


def _matrix(column: list[bytes], dtype: type, width: int) -> np.ndarray:
    """Rows of at most ``width`` numbers; shorter vectors end in zeros."""
    out = np.zeros((len(column), width))
    lengths = {len(x) for x in column}
    if len(lengths) == 1 and column:
        flat = np.frombuffer(b"".join(column), dtype).reshape(len(column), -1)[:, :width]
        out[:, :flat.shape[1]] = flat
    else:
        for i, x in enumerate(column):
            v = np.frombuffer(x, dtype)[:width]
            out[i, :len(v)] = v
    return out


@dataclass
class Anchors:
    """A block of anchors, as tasks get it. Query i looks for scores in [low, high] of its
    anchor ``of``; ``same`` says whether labels have to agree or to differ."""

    label: np.ndarray
    q: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]
    of: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool
    first: int

    @property
    def width(self) -> int:
        return self.q.shape[1]


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integers; in doubles only where those are exact."""
    most = (np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0)) * max(1, a.shape[1])
    if most < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.T.astype(np.int64)


class Best:
    """The best ``first`` (score, id) of each query so far: higher scores, then smaller ids."""

    def __init__(self, queries: int, first: int, low: np.ndarray) -> None:
        self.first, self.least = first, low.copy()
        self.query = np.empty(0, np.int64)
        self.score, self.id = self.query.copy(), self.query.copy()

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(query):
            return
        query, score, ids = (np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
        rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
        keep = rank < self.first
        full = rank == self.first - 1
        self.least[query[full]] = np.maximum(self.least[query[full]], score[full])
        self.query, self.score, self.id = query[keep], score[keep], ids[keep]


def _compare(rows: np.ndarray, anchors: np.ndarray, block: Anchors, tile: dict, best: Best, count: np.ndarray) -> None:
    """Search ``rows`` of a tile for the queries of ``anchors`` (indices into the block).

    ``count`` counts pairs: all, those alive behind each level, exact ones.
    """
    if not len(rows) or not len(anchors):
        return
    mine = np.flatnonzero(np.isin(block.of, anchors))
    place = np.searchsorted(anchors, block.of[mine])
    least = np.full(len(anchors), np.inf)
    most = np.full(len(anchors), -np.inf)
    np.minimum.at(least, place, best.least[mine].astype(np.float64))
    np.maximum.at(most, place, block.high[mine].astype(np.float64))
    pairs = np.equal.outer(block.label[anchors], tile["label"][rows]) == block.same
    count[0] += pairs.sum()
    for level, ((ma, da), (mb, db)) in enumerate(zip(block.levels, tile["levels"])):
        middle, off = ma[anchors] @ mb[rows].T, da[anchors] @ db[rows].T
        off = off + 1.0 + 1e-9 * (np.abs(middle) + off)  # rounding
        pairs &= (middle + off >= least[:, None]) & (middle - off <= most[:, None])
        count[1 + level] += pairs.sum()
        some, any_anchor = pairs.any(axis=0), pairs.any(axis=1)
        if not some.any():
            return
        if some.mean() < 0.9 or any_anchor.mean() < 0.9:  # refine what is left
            rows, anchors, least, most = rows[some], anchors[any_anchor], least[any_anchor], most[any_anchor]
            pairs = pairs[np.ix_(any_anchor, some)]
    scores = _exact(block.q[anchors], tile["q"][rows])
    count[-1] += pairs.sum()
    ids = tile["id"][rows]
    at = np.searchsorted(anchors, block.of)
    for k in range(int(np.bincount(block.of).max(initial=0))):
        # the k-th query of every anchor
        nth = _nth(block.of, k)
        nth = nth[np.isin(block.of[nth], anchors)]
        part = scores[at[nth]]
        hit = pairs[at[nth]] & (part >= best.least[nth][:, None]) & (part <= block.high[nth][:, None])
        if hit.sum() > 8 * best.first * len(nth) and hit.shape[1] > best.first:
            masked = np.where(hit, part, NEVER)
            kth = np.partition(masked, hit.shape[1] - best.first, axis=1)[:, hit.shape[1] - best.first]
            hit &= part >= kth[:, None]
        i, j = np.nonzero(hit)
        best.add(nth[i], part[i, j], ids[j])


def _nth(of: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k-th query of every anchor; queries of an anchor stand together."""
    starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.empty(0, np.int64)
    counts = np.diff(np.r_[starts, len(of)])
    return starts[counts > k] + k


def _search(block: Anchors):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(block.of), block.first, block.low)
        count = np.zeros(len(block.levels) + 2, np.int64)
        by_label = {x: np.flatnonzero(block.label == x) for x in np.unique(block.label)} if block.same else None
        most = max(1, TILE // max(1, len(block.label)))
        step = min(most, FIRST_ROWS)
        segments = block.levels[-1][0].shape[1]
        every = np.arange(len(block.label))
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, step)
                at, step = at + step, min(most, 2 * step)
                ids, label, q, sums, squares = (part.column(i) for i in range(5))
                tile = dict(
                    id=ids.fill_null(NO_ID).to_numpy(zero_copy_only=False), label=label.to_numpy(zero_copy_only=False),
                    q=_matrix(q.to_pylist(), np.int32, block.width),
                    levels=_levels(_matrix(sums.to_pylist(), np.float64, segments), _matrix(squares.to_pylist(), np.float64, segments)))
                if by_label is None:
                    _compare(np.arange(part.num_rows), every, block, tile, best, count)
                else:
                    for x in np.unique(tile["label"]):
                        if x in by_label:
                            _compare(np.flatnonzero(tile["label"] == x), by_label[x], block, tile, best, count)
        if len(best.query):
            yield pa.RecordBatch.from_arrays(
                [pa.array(best.query), pa.array(best.score), pa.array(best.id, mask=best.id == NO_ID)], names=["query", "score", "vec_id"])
        yield pa.RecordBatch.from_arrays(  # the counts come as queries below zero
            [pa.array(-1 - np.arange(len(count))), pa.array(count), pa.nulls(len(count), pa.int64())], names=["query", "score", "vec_id"])

    return run


def _found(vectors: DataFrame, block: Anchors) -> DataFrame:
    """(query, score, vec_id): the best of every query over all tasks, and the pair counts."""
    rows = in_tasks(vectors.select("vec_id", "label", "q", "sums", "squares"), _search(block), "query long, score long, vec_id long")
    return stored(rows, "block-hits")


def _ranked(rows: DataFrame, by: list[str], first: int, out: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return rows.withColumn(out, F.row_number().over(order)).where(F.col(out) <= first)


RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, "
          "anchor_row long, positive_rank int")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10,
         low: int = 30, high: int = 90, anchors_per_block: int = BLOCK_ANCHORS) -> tuple[DataFrame, DataFrame]:
    """(hard negatives, pair counts) of the rows of ``vectors`` (vec_id, label, embedding)
    for which ``is_anchor`` holds.

    Rows with a null label, a null vector, or a component that is null, not finite or
    beyond 2**18 have no part. Components become floor(256 * x). A vector that is shorter
    than another ends in zeros, and an empty one scores 0. A null id is last among ties.
    Rows that repeat are rows of their own: each may be an anchor, a positive and a
    negative. An empty table, or one without anchors, gives no rows. Other columns are
    ignored.

    An anchor's positives are the ``positives`` best other rows of its label. For each, the
    best ``negatives`` rows of other labels with ``low`` * positive score <= 100 * score
    <= ``high`` * positive score. anchor_row tells anchors of one id apart, positive_rank
    the positives of an anchor. The second table counts pairs by block and step: all (-1),
    left after each level (-2, ...), scored exactly (the last). The driver sees blocks of
    bounded size, their positives and counts.
    """
    spark = vectors.sparkSession
    ready = stored(quantized(vectors), "segments")
    found = ready.where(is_anchor)
    size = found.agg(F.count("*"), F.coalesce(F.max(F.octet_length("q")), F.lit(0))).first()
    widest = max(SEGMENT, size[1] // 4)
    per_block = max(1, min(anchors_per_block, BLOCK_CELLS // widest))
    numbered = stored(number_slots(found.withColumn("_all", F.lit(0)), "_all", ["vec_id", "label", "q"], "anchor_row", size[0]), "anchors")
    paths, counts = [], []
    for start in range(0, size[0], per_block):
        rows = numbered.where(F.col("anchor_row").between(start, start + per_block - 1)).orderBy("anchor_row").collect()
        levels = -(-widest // SEGMENT)
        q = _matrix([r["q"] for r in rows], np.int32, widest)
        summed = _levels(_matrix([r["sums"] for r in rows], np.float64, levels), _matrix([r["squares"] for r in rows], np.float64, levels))
        label = np.array([r["label"] for r in rows], np.int64)
        every = np.arange(len(rows))
        # one more than asked for, as an anchor finds itself
        block = Anchors(label, q, summed, every, np.full(len(rows), NEVER + 1), np.full(len(rows), NO_ID), True, positives + 1)
        hits = _found(ready, block)
        counts.append(hits.where("query < 0").select(F.lit(start).alias("block"), F.lit("positives").alias("step"), "query", "score"))
        near = _ranked(hits.where("query >= 0"), ["query"], positives + 1, "_rank").orderBy("query", "_rank").collect()
        own = (q.astype(np.int64) ** 2).sum(axis=1)
        chosen: dict[int, list[tuple[int, int | None]]] = {}
        itself: set[int] = set()
        for r in near:
            a = r["query"]
            if a not in itself and r["score"] == own[a] and r["vec_id"] == rows[a]["vec_id"]:
                itself.add(a)
            elif len(chosen.setdefault(a, [])) < positives:
                chosen[a].append((r["score"], r["vec_id"]))
        queries = [(a, k, s, p) for a in sorted(chosen) for k, (s, p) in enumerate(chosen[a])]
        if not queries:
            continue
        scores = [s for _, _, s, _ in queries]
        block = Anchors(label, q, summed, np.array([a for a, *_ in queries]), np.array([-(-low * s // 100) for s in scores], np.int64),
                        np.array([high * s // 100 for s in scores], np.int64), False, negatives)
        hits = _found(ready, block)
        counts.append(hits.where("query < 0").select(F.lit(start).alias("block"), F.lit("negatives").alias("step"), "query", "score"))
        named = spark.createDataFrame([(i, rows[a]["vec_id"], rows[a]["anchor_row"], p, s, k + 1) for i, (a, k, s, p) in enumerate(queries)],
                                      "_q long, anchor_id long, anchor_row long, positive_id long, positive_score long, positive_rank int")
        best = _ranked(hits.where("query >= 0"), ["query"], negatives, "rank").join(F.broadcast(named), F.col("query") == F.col("_q"))
        path = scratch_path(spark, "negatives")
        best.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score"), "anchor_row", "positive_rank").write.parquet(path)
        paths.append(path)
    out = spark.read.schema(RESULT).parquet(*paths) if paths else spark.createDataFrame([], RESULT)
    total = spark.createDataFrame([], "block int, step string, query long, score long")
    for c in counts:
        total = total.union(c)
    return out, total.groupBy("block", "step", F.col("query").alias("level")).agg(F.sum("score").alias("pairs"))
