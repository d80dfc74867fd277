"""Best-fit packing with certified bin counts (operator 3).

Pieces are dealt evenly over partitions and packed best-fit decreasing, one partition a
task. Lower bounds from dual feasible functions are sums over pieces, so they add up:
each partition knows its bound, and the sums over all partitions bound the whole. A
partition whose count meets its bound is certified. Bins that are not full can only be
bettered by documents of other partitions, so their documents go to the next round,
where partitions that left gaps exchange them and are packed again, until the whole
count meets its bound or one small partition is left.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeframe.llm.common import in_tasks, stored
from hazeframe.llm.tokens import by_bytes, encoder

CAPACITY = 4096
END_ID = 1
#: Pieces a task packs. With about 1 KB per piece in pandas this is some 50 MB.
PER_TASK = 50_000

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids", T.BinaryType())])


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, digest: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids): ids of whole texts plus the end id, cut into
    pieces of ``capacity`` where longer. ``ids`` is little-endian unsigned 32-bit; with
    ``digest`` their crc32, as ``ids_crc32``, takes their place and the ids stay in the task.

    A null or empty text is the end id alone.
    """
    last = T.StructField("ids_crc32", T.LongType()) if digest else PIECES["ids"]
    schema = T.StructType([*PIECES.fields[:-1], last])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in (part for whole in batches for part in by_bytes(whole, 1)):
            ids, offsets = enc.encode(batch.column(1))
            ids = np.insert(ids, offsets[1:], end_id).astype("<u4", copy=False)
            begins = offsets + np.arange(len(offsets))  # an end id per text
            parts = -(-np.diff(begins) // capacity)
            doc = np.repeat(np.arange(len(parts)), parts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
            at = begins[doc] + piece * capacity
            length = np.minimum(capacity, begins[doc + 1] - at)
            raw = memoryview(ids.tobytes())
            cuts = [raw[4 * a:4 * (a + n)] for a, n in zip(at.tolist(), length.tolist())]
            made = pa.array([zlib.crc32(c) for c in cuts], pa.int64()) if digest else pa.array(cuts, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(piece * capacity),
                 pa.array(length), made], names=schema.names)

    return in_tasks(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)


def dual_feasible(capacity: int) -> list[tuple[int, np.ndarray]]:
    """(weight a bin can hold, weight per length 0 to capacity) of each function.

    The identity; for a threshold t the function that counts a piece above capacity - t
    as a whole bin, drops pieces below t and keeps the rest; and for k = 1 to 8 the
    function that rounds (k + 1) * length down to whole capacities.
    """
    x = np.arange(capacity + 1, dtype=np.int64)
    out = [(capacity, x)]
    for t in range(max(1, capacity // 16), capacity // 2 + 1, max(1, capacity // 32)):
        out.append((capacity, np.where(x > capacity - t, capacity, np.where(x >= t, x, 0))))
    for k in range(1, 9):
        steps = (k + 1) * x
        out.append((capacity * k, np.where(steps % capacity == 0, k * x, capacity * (steps // capacity))))
    return out


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs; ``counts`` has the pieces per length 0 to capacity."""
    return max(-(-int(counts @ weights) // holds) for holds, weights in dual_feasible(capacity))


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) per piece and the free room per bin, best-fit decreasing.

    Ties between equal pieces keep their order. Rooms are kept as a sorted list of the
    distinct sizes, so a piece costs one bisection.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rooms: list[int] = []
    open_bins: dict[int, list[int]] = {}
    free: list[int] = []
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        at = bisect_left(rooms, size)
        if at == len(rooms):
            b, room = len(free), capacity
            free.append(capacity)
        else:
            room = rooms[at]
            b = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room], rooms[at]
        bins[i], offsets[i] = b, capacity - room
        left = free[b] = room - size
        if left:
            if left not in open_bins:
                insort(rooms, left)
                open_bins[left] = []
            open_bins[left].append(b)
    return bins, offsets, np.array(free, np.int64)


_STATE = [T.StructField("_part", T.LongType()), T.StructField("_seq", T.LongType()),
          T.StructField("offset", T.LongType()), T.StructField("_open", T.BooleanType())]


def length_counts(items: DataFrame, capacity: int = CAPACITY) -> np.ndarray:
    """Pieces per length; at most ``capacity`` rows reach the driver."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in items.groupBy("length").count().collect():
        if length is None or not 1 <= length <= capacity:
            raise ValueError(f"length {length} is not between 1 and {capacity}")
        counts[length] = n
    return counts


def pack(items: DataFrame, capacity: int = CAPACITY, per_task: int = PER_TASK, merge: int = 16) -> DataFrame:
    """Add sequence_id and offset to rows with a ``length`` of 1 to ``capacity``.

    Every row is one piece, repeated rows included; other columns are carried along
    (keep them narrow), but for clashing ones, which are replaced. No rows give no rows;
    a null length or one out of range is an error. Later rounds take the documents of
    the emptiest bins into ``merge`` times fewer partitions: one bin of a certified
    partition, up to one in ``merge`` of another. The driver sees the length counts and
    one row of sums per round.
    """
    cols = [c for c in items.columns if c not in ("sequence_id", "offset", *[f.name for f in _STATE])]
    rows = stored(items.select(*cols), "pieces")
    counts = length_counts(rows, capacity)
    total = int(counts.sum())
    least = lower_bound(counts, capacity)
    schema = T.StructType([rows.schema[c] for c in cols] + _STATE)
    # by place in the stored table: rows that repeat are dealt out like any others
    key = F.xxhash64(F.monotonically_increasing_id())

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lengths = pdf["length"].to_numpy(np.int64)
        bins, offsets, free = best_fit(lengths, capacity)
        certified = len(free) == lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        give = 1 if certified else max(2, len(free) // merge)
        emptiest = np.argsort(-free, kind="stable")[:give]
        is_open = np.zeros(len(free), bool)
        is_open[emptiest[free[emptiest] > 0]] = True
        return pdf[cols].assign(_part=pdf["_part"].to_numpy(), _seq=bins, offset=offsets, _open=is_open[bins])

    parts, closed, k, done = max(1, math.ceil(total / per_task)), 0, 0, None
    while True:
        dealt = rows.withColumn("_part", F.pmod(key, F.lit(parts)))
        packed = stored(dealt.groupBy("_part").applyInPandas(run, schema), "packed")
        # 20 bits for the bin, 4 for the round, the rest for the partition
        named = packed.withColumn("sequence_id", (F.col("_part") * 16 + k) * 2**20 + F.col("_seq"))
        shut, loose, left = packed.agg(
            F.count_if(~F.col("_open") & (F.col("offset") == 0)),
            F.count_if(F.col("_open") & (F.col("offset") == 0)), F.count_if("_open")).first()
        closed += shut
        last = parts == 1 or loose <= 1 or closed + loose <= least
        out = named if last else named.where("not _open")
        out = out.select(*cols, "sequence_id", "offset")
        done = out if done is None else done.unionByName(out)
        if last:
            return done
        rows, parts, k = named.where("_open").select(*cols), max(1, min(parts // merge, left // 1000)), k + 1


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of
    every document. Null texts count as empty, repeated rows are packed each for itself,
    rows without doc_id keep a null one, and other columns are ignored."""
    return pack(pieces(docs, tokenizer, capacity, end_id, digest=True), capacity)
