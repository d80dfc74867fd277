"""Token-id files compressed by a Re-Pair grammar (operator 8).

A file holds blocks of documents in doc_id order. In each block frequent pairs of
neighbouring ids are replaced by nonterminals, again and again; a pair never reaches
over the end of a document, so every document is a run of symbols of its own. Rules and
expansion lengths are stored with the block: a document, or any id inside it, is decoded
without the rest.

Block layout, little-endian: magic ``IDBLOCK1``; five unsigned 64-bit numbers (documents,
rules, symbols, ids, first nonterminal); doc ids (signed 64-bit) and one byte each that
says whether the doc id is null; symbols before each document, ids before each document
(unsigned 64-bit, one more than documents); rules (left, right: unsigned 32-bit); their
expansion lengths (unsigned 32-bit); symbols (unsigned 16-bit if all fit, else 32).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeframe.llm.common import in_tasks, stored
from hazeframe.llm.files import NewFile, open_input, reading_tasks
from hazeframe.llm.tokens import by_bytes, encoder, gather
from hazeframe.session import scratch_path

MAGIC = b"IDBLOCK1"
END_ID = 0
#: Ids of a block: the grammar works on some ten arrays of this length.
BLOCK_IDS = 2_000_000
#: Rounds of replacement (None: until no pair is left), new rules per round at most, and
#: times a pair must occur.
ROUNDS, RULES_PER_ROUND, LEAST_PAIRS = None, 5000, 16


def _buckets(pairs: np.ndarray, factor: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    return ((pairs.view(np.uint64) * np.uint64(factor)) >> np.uint64(44)).astype(np.int32)


def repair(ids: np.ndarray, last: np.ndarray, first_new: int, rounds: int | None = ROUNDS,
           per_round: int = RULES_PER_ROUND, least: int = LEAST_PAIRS):
    """(symbols, last flags, rules) of one block. ``last`` marks the last id of a document.

    Each round takes the most frequent pairs as rules and replaces them from left to right,
    of overlapping pairs every other one, until no pair occurs ``least`` times. Pairs that
    would come after ``per_round`` others, or share a hash bucket with a more frequent one,
    wait for the next round. A pair of old symbols only gets rarer, so a round counts the
    pairs that were frequent before and those beside a new symbol.
    """
    seq, last = ids.astype(np.int64), last.copy()
    open_ = np.ones(len(seq), bool)  # a pair that begins here may be frequent
    rules: list[np.ndarray] = []
    new = first_new
    done, ease = 0, 2
    while len(seq) > 1 and (rounds is None or done < rounds):
        done += 1
        inner = np.flatnonzero(open_[:-1] & ~last[:-1])
        pair = (seq[inner] << 32) | seq[inner + 1]
        # Buckets that are too rare as a whole hold no frequent pair: no need to sort them.
        bucket = _buckets(pair)
        weight = np.bincount(bucket, minlength=1 << 20)
        enough = weight[weight >= least]
        last_weight = np.partition(enough, len(enough) - per_round)[len(enough) - per_round] if len(enough) > per_round else 0
        open_[inner[(weight < least)[bucket]]] = False
        limit = max(least, int(last_weight) // ease)
        heavy = (weight >= limit)[bucket]
        inner, pair, bucket = inner[heavy], pair[heavy], bucket[heavy]
        ranked = np.sort(pair)
        begin = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, np.int64)
        counts = np.diff(np.append(begin, len(ranked)))
        kinds = ranked[begin]
        # a rare pair is closed unless it looks like a frequent one, which costs time only
        frequent = np.zeros(1 << 20, bool)
        frequent[_buckets(kinds[counts >= least], 0xC2B2AE3D27D4EB4F)] = True
        open_[inner[~frequent[_buckets(pair, 0xC2B2AE3D27D4EB4F)]]] = False
        kinds, counts = kinds[counts >= limit], counts[counts >= limit]
        order = np.lexsort((kinds, -counts))[:per_round]
        if not len(order):
            if limit == least:
                break
            # many pairs share the heavy buckets, none is that frequent itself
            ease *= 2
            continue
        chosen = kinds[order]
        place = _buckets(chosen)
        _, first = np.unique(place, return_index=True)
        chosen = chosen[np.sort(first)]
        # each bucket holds one chosen pair at most
        name = np.full(1 << 20, -1, np.int32)
        name[_buckets(chosen)] = np.arange(len(chosen))
        mark = name[bucket]
        hit = np.flatnonzero(mark >= 0)
        hit = hit[chosen[mark[hit]] == pair[hit]]
        at, mark = inner[hit], mark[hit] + new
        # in a run of touching pairs every other one is taken
        begins = np.append(True, np.diff(at) != 1)
        run = np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
        taken = (np.arange(len(at)) - run) % 2 == 0
        at, mark = at[taken], mark[taken]
        seq[at] = mark
        last[at] |= last[at + 1]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        open_[at] = True
        open_[np.maximum(at - 1, 0)] = True
        open_[np.maximum(at - 2, 0)] = True  # if the symbol before was replaced as well
        seq, last, open_ = seq[keep], last[keep], open_[keep]
        rules.append(np.stack([chosen >> 32, chosen & 0xFFFFFFFF], axis=1))
        new += len(chosen)
    return seq, last, np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)


def expansions(rules: np.ndarray, first_new: int) -> list[np.ndarray]:
    """The ids every rule stands for; a rule only uses symbols made before it."""
    out: list[np.ndarray] = []
    for left, right in rules.tolist():
        out.append(np.concatenate([
            out[s - first_new] if s >= first_new else np.array([s], np.uint32) for s in (left, right)]))
    return out


def block_bytes(doc_ids: list, ids: np.ndarray, ends: np.ndarray) -> bytes:
    """Encode documents; ``ends`` holds the ids up to the end of each, at least one each."""
    last = np.zeros(len(ids), bool)
    last[ends - 1] = True
    first_new = int(ids.max()) + 1
    seq, flags, rules = repair(ids, last, first_new)
    lengths = np.array([len(e) for e in expansions(rules, first_new)], "<u4")
    symbol_ends = np.flatnonzero(flags) + 1
    small = first_new + len(rules) <= 1 << 16
    numbers = np.array([len(doc_ids), len(rules), len(seq), len(ids), first_new], "<u8")
    return b"".join([
        MAGIC, numbers.tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        bytes(d is None for d in doc_ids),
        np.append(0, symbol_ends).astype("<u8").tobytes(), np.append(0, ends).astype("<u8").tobytes(),
        rules.astype("<u4").tobytes(), lengths.tobytes(), seq.astype("<u2" if small else "<u4").tobytes()])


class Block:
    """A block read back; sections are checked against the length of the data."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a block of token ids")
        docs, rules, symbols, self.n_ids, self.first_new = np.frombuffer(data, "<u8", 5, 8).tolist()
        width = 2 if self.first_new + rules <= 1 << 16 else 4
        want = 48 + docs * 9 + (docs + 1) * 16 + rules * 12 + symbols * width
        if len(data) != want:
            raise ValueError(f"a block of {want} bytes has {len(data)}")
        at = 48

        def section(kind, n):
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        ids, null = section("<i8", docs), section("u1", docs)
        self.doc_ids = [None if z else d for d, z in zip(ids.tolist(), null.tolist())]
        self.symbol_ends, self.id_ends = section("<u8", docs + 1), section("<u8", docs + 1)
        self.rules = section("<u4", rules * 2).reshape(-1, 2).astype(np.int64)
        self.lengths = section("<u4", rules)
        self.symbols = section("<u2" if width == 2 else "<u4", symbols)
        grown = expansions(self.rules, self.first_new)
        if [len(e) for e in grown] != self.lengths.tolist():
            raise ValueError("expansion lengths do not fit the rules")
        # all expansions in one array; a plain id expands to itself
        self._flat = np.concatenate([np.arange(self.first_new, dtype=np.uint32), *grown])
        sizes = np.concatenate([np.ones(self.first_new, np.int64), self.lengths.astype(np.int64)])
        self._sizes, self._firsts = sizes, np.concatenate([[0], np.cumsum(sizes)[:-1]])

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """The ids of documents lo to hi - 1 of the block."""
        run = self.symbols[int(self.symbol_ends[lo]):int(self.symbol_ends[hi])].astype(np.int64)
        return gather(self._flat, self._firsts[run], self._sizes[run])[0]

    def ids_at(self, doc: int, start: int, n: int) -> np.ndarray:
        """``n`` ids of one document from ``start``; decodes only the symbols that hold them."""
        run = self.symbols[int(self.symbol_ends[doc]):int(self.symbol_ends[doc + 1])].astype(np.int64)
        ends = np.cumsum(self._sizes[run])
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, start + n, "left") + 1
        part = gather(self._flat, self._firsts[run[a:b]], self._sizes[run[a:b]])[0]
        skip = start - (int(ends[a - 1]) if a else 0)
        return part[skip:skip + n]


def write_ids(docs: DataFrame, tokenizer: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Write all documents in ascending doc_id order; returns the stored manifest
    (part, block, path, at, size, n_docs, n_ids), one row per block.

    Null texts count as empty, null doc_ids come first, rows that repeat a doc_id follow
    each other in any order. No rows give no blocks.
    """
    folder = scratch_path(docs.sparkSession, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, out, part, number = encoder(tokenizer), None, 0, 0
        held, held_docs, held_ends, n = [], [], [], 0

        def flush():
            nonlocal out, number, held, held_docs, held_ends, n
            out = out or NewFile(folder, f"part-{part:05d}.ids")
            data = block_bytes(held_docs, np.concatenate(held), np.array(held_ends, np.int64))
            row = [part, number, out.uri, out.write(data), len(data), len(held_docs), n]
            number += 1
            held, held_docs, held_ends, n = [], [], [], 0
            return row

        tail = np.array([end_id], np.uint32)
        rows = []
        for batch in batches:
            if batch.num_rows:
                part = batch.column(2)[0].as_py()
            for some in by_bytes(batch, 1):
                ids, offsets = enc.encode(some.column(1))
                for d, a, b in zip(some.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                    held += [ids[a:b], tail]
                    n += b - a + 1
                    held_docs.append(d), held_ends.append(n)
                    if n >= block_ids:
                        rows.append(flush())
        if held_docs:
            rows.append(flush())
        if out:
            out.close()
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
            names=["part", "block", "path", "at", "size", "n_docs", "n_ids"])

    # the row's place cuts a doc_id, or null, that many rows share
    placed = docs.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("_row"))
    ordered = (placed.repartitionByRange("doc_id", "_row").sortWithinPartitions("doc_id")
               .select("doc_id", "text", F.spark_partition_id().cast("long").alias("_part")))
    return stored(in_tasks(
        ordered, run, "part long, block long, path string, at long, size long, n_docs long, n_ids long"), "manifest")


def read_ids(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, from the files; ids is
    little-endian unsigned 32-bit, start counts the ids of all documents before it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at, size, base in zip(*[c.to_pylist() for c in batch.columns]):
                with open_input(path) as source:
                    source.seek(at)
                    block = Block(source.read(size))
                docs = len(block.doc_ids)
                for lo in range(0, docs, 2000):
                    hi = min(docs, lo + 2000)
                    ids = block.ids(lo, hi).astype("<u4", copy=False)
                    ends = block.id_ends[lo:hi + 1].astype(np.int64)
                    if len(ids) != ends[-1] - ends[0]:
                        raise ValueError(f"{path} at {at}: documents do not decode to their lengths")
                    values = pa.Array.from_buffers(pa.large_binary(), hi - lo, [
                        None, pa.py_buffer(4 * (ends - ends[0])), pa.py_buffer(ids.tobytes())])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(block.doc_ids[lo:hi], pa.int64()), pa.array(base + ends[:-1]),
                         pa.array(np.diff(ends)), values.cast(pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"])

    # One row per task of the writer, then one per block of a task.
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))
    bases = parts.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    inside = F.coalesce(F.sum("n_ids").over(
        Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = (manifest.withColumn("_in", inside).join(bases, "part")
              .select("path", "at", "size", (F.col("_base") + F.col("_in")).alias("base")))
    # an explicit number, as these few small rows stand for much work
    spread = blocks.repartition(reading_tasks(manifest.sparkSession), F.xxhash64("path", "at"))
    return in_tasks(spread, run, "doc_id long, start long, n_tokens long, ids binary")


def crc32_of(ids: bytes) -> int:
    return zlib.crc32(ids)
