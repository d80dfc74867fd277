"""Benchmark decontamination by edit distance over item-sized windows (operator 1).

Texts are sequences of lower-cased words. For every benchmark item of n words, a passage is
a leak if its word edit distance k to the item is at most ``share`` * n, rounded down; it
may have n - k to n + k words. Windows of n words find the candidates (fewer at the end of
a text). Steps, all inside the task that holds the text:

1. q-gram lemma, loses nothing: the window at the start of a passage within k edits keeps at least n - 1 - 2k of the
   item's n - 1 word pairs, so windows with fewer pairs of items of n words are out; pairs
   that repeat count once more only as far as they repeat in an item.
2. CGK random walks embed windows and items so that edits become differing positions.
   A walk steps from a word to the next one when a random bit of (step, word) says so.
3. Bit-sampling LSH: a few sampled positions of a walk make a signature; equal
   signatures of equal n are candidates. For each size n, walks are added until simulated
   edits at the largest allowed distance are found with the target recall; where MAX_WALKS
   do not reach it, all windows of step 1 are compared with the items whose pairs they hold.
4. The exact edit distance to the nearest beginning of the window, extended by k words, decides.

Items are a stated query set: they are taken in blocks of bounded size, each against all
documents, and no document is shuffled or paired with another.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeframe.llm.common import add_columns, fresh, stored
from hazeframe.llm.tokens import by_bytes, gather

SHARE = 0.2
#: Items of one word are no evidence of a leak and are left out.
MIN_WORDS = 2
#: Simulated passages per item size.
TRIALS = 400
TARGET_RECALL = 0.99
#: Words of the items that one pass over the documents carries to every task.
BLOCK_WORDS = 500_000
WORD = re.compile(r"\w+")
BITS, SAMPLES, MAX_WALKS = 3, 4, 40
LEAK = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("start", T.IntegerType()),
    T.StructField("n_words", T.IntegerType()), T.StructField("distance", T.IntegerType()),
    T.StructField("span", T.IntegerType())])


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def edit_distance(a: list, b: list, most: int) -> int | None:
    """Edit distance if it is at most ``most``; only the diagonal band is computed."""
    if abs(len(a) - len(b)) > most:
        return None
    far = most + 1
    row = [j if j <= most else far for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        lo, hi = max(1, i - most), min(len(b), i + most)
        new = [far] * (len(b) + 1)
        if i <= most:
            new[0] = i
        for j in range(lo, hi + 1):
            new[j] = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != b[j - 1]))
        row = new
        if min(row[lo - 1:hi + 1]) > most:
            return None
    return row[-1] if row[-1] <= most else None


def closest_span(a: list, b: list, most: int) -> tuple[int, int] | None:
    """(distance, length) of the beginning of ``b`` nearest to ``a`` within ``most``; of
    equals the one whose length is nearest to that of ``a``, then the shorter one."""
    far = most + 1
    row = [j if j <= most else far for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        lo, hi = max(1, i - most), min(len(b), i + most)
        if lo > len(b) + 1:
            return None
        new = [far] * (len(b) + 1)
        if i <= most:
            new[0] = i
        for j in range(lo, hi + 1):
            new[j] = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != b[j - 1]))
        row = new
        if min(row[lo - 1:hi + 1]) > most:
            return None
    distance, _, length = min((d, abs(j - len(a)), j) for j, d in enumerate(row))
    return (distance, length) if distance <= most else None


class Items:
    """The search structure of one block of items. Unknown words are 0, the end is -1."""

    def __init__(self, items: list[tuple[int, list[str]]], share: float = SHARE,
                 target: float = TARGET_RECALL, seed: int = 7):
        self.share = share
        vocabulary: dict[str, int] = {}
        by_size: dict[int, list[tuple[int, np.ndarray]]] = defaultdict(list)
        for item_id, words in sorted(items):
            ids = np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words], np.int64)
            by_size[len(ids)].append((item_id, ids))
        self.vocabulary, self.base = vocabulary, len(vocabulary) + 1
        self.sizes = {n: (np.array([i for i, _ in v]), np.stack([w for _, w in v])) for n, v in sorted(by_size.items())}
        pairs = {n: w[:, :-1] * self.base + w[:, 1:] for n, (_, w) in self.sizes.items()}
        self.own_pairs = {n: np.unique(p) for n, p in pairs.items()}
        self.repeats = {n: max(p.shape[1] - len(np.unique(row)) for row in p) for n, p in pairs.items()}
        self.pairs = np.unique(np.concatenate([*self.own_pairs.values(), np.zeros(0, np.int64)]))
        # for every pair the sizes of the items that hold it, one after another
        held = [(np.searchsorted(self.pairs, p), np.full(len(p), n)) for n, p in self.own_pairs.items()]
        which = np.concatenate([np.zeros(0, np.int64), *[w for w, _ in held]])
        order = np.argsort(which, kind="stable")
        self.pair_sizes = np.concatenate([np.zeros(0, np.int64), *[n for _, n in held]])[order]
        self.pair_ends = np.searchsorted(which[order], np.arange(len(self.pairs) + 1))
        self.filter = np.zeros(1 << 20, bool)
        self.filter[self._bucket(self.pairs)] = True
        rng = np.random.default_rng(seed)
        longest = 3 * max(self.sizes, default=1)
        self.odd = rng.integers(1, 1 << 62, (MAX_WALKS, longest)) | 1
        self.shift = rng.integers(0, 1 << 62, (MAX_WALKS, longest))
        self.draws = rng.random((MAX_WALKS, SAMPLES, BITS))
        #: Walks and recall for each item size; a size without walks is compared exactly.
        self.walks, self.recall = {}, {}
        for n in self.sizes:
            self.walks[n], self.recall[n] = self._enough_walks(n, target, rng)
        self.index = {n: [self.signatures(w, walk) for walk in range(self.walks[n])]
                      for n, (_, w) in self.sizes.items()}
        # for the exact sizes: the items that hold each pair
        self.holders = {}
        for n, walks in self.walks.items():
            if not walks:
                row = np.repeat(np.arange(len(pairs[n])), n - 1)
                own, item = np.unique(np.stack([pairs[n].ravel(), row]), axis=1)
                self.holders[n] = own, item

    @staticmethod
    def _bucket(pairs: np.ndarray) -> np.ndarray:
        return ((pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def known_pairs(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, numbers) of the word pairs that some item holds."""
        pair = ids[:-1] * self.base + ids[1:]
        at = np.flatnonzero(self.filter[self._bucket(pair)] & (ids[:-1] > 0) & (ids[1:] > 0))
        number = np.minimum(np.searchsorted(self.pairs, pair[at]), len(self.pairs) - 1)
        known = self.pairs[number] == pair[at]
        return at[known], number[known]

    def starts(self, ids: np.ndarray, doc: np.ndarray, ends: np.ndarray) -> dict[int, np.ndarray]:
        """Window starts per item size that the pair count leaves."""
        at, number = self.known_pairs(ids)
        inside = doc[at] == doc[at + 1]
        at, number = at[inside], number[inside]
        times = self.pair_ends[number + 1] - self.pair_ends[number]
        size, _ = gather(self.pair_sizes, self.pair_ends[number], times)
        place = np.repeat(at, times)
        order = np.argsort(size, kind="stable")
        size, place = size[order], place[order]
        out = {}
        for n in self.sizes:
            need = n - 1 - 2 * int(self.share * n)
            if need <= 0:
                out[n] = np.arange(len(ids))
                continue
            own = place[np.searchsorted(size, n):np.searchsorted(size, n, "right")]
            first, last = own[:len(own) - need + 1], own[need - 1:]
            fits = np.flatnonzero((last - first <= n - 2) & (doc[first] == doc[last])) if len(own) >= need else []
            if not len(fits):
                continue
            # all starts from which a window holds these pairs
            first, last = first[fits], last[fits]
            begin = np.concatenate([[0], ends[:-1]])[doc[first]]
            low = np.maximum(last - (n - 2), begin)
            cover = np.zeros(len(ids) + 1, np.int32)
            np.add.at(cover, low, 1)
            np.add.at(cover, first + 1, -1)
            out[n] = np.flatnonzero(np.cumsum(cover) > 0)
        return out

    def signatures(self, rows: np.ndarray, walk: int) -> np.ndarray:
        """(rows, SAMPLES) signatures of word rows of equal length, padded with -1."""
        n = rows.shape[1]
        padded = np.concatenate([rows, np.full((len(rows), 1), -1, rows.dtype)], axis=1)
        steps = np.minimum((self.draws[walk] * 3 * n).astype(int), 3 * n - 1)
        made = np.zeros((SAMPLES, len(rows)), np.uint64)
        wanted = defaultdict(list)
        for s in range(SAMPLES):
            for t in steps[s]:
                wanted[int(t)].append(s)
        at, line = np.zeros(len(rows), np.int64), np.arange(len(rows))
        for t in range(max(wanted) + 1):
            symbol = padded[line, at]
            for s in wanted.get(t, ()):
                made[s] = made[s] * np.uint64(0x100000001B3) + (symbol + 2).view(np.uint64)
            with np.errstate(over="ignore"):
                mixed = symbol * self.odd[walk, t] + self.shift[walk, t]
            at = np.minimum(at + ((mixed >> 37) & 1), n)
        return made.T

    def _enough_walks(self, n: int, target: float, rng) -> tuple[int, float]:
        """(walks, recall): as many walks as find items of ``n`` words with random edits at
        the largest distance often enough; (0, 1.0) where MAX_WALKS do not."""
        items, most = self.sizes[n][1], int(self.share * n)
        if not most:  # one walk finds what is equal
            return 1, 1.0
        picks = items[rng.integers(len(items), size=TRIALS)]
        changed = np.full((TRIALS, n), -1, np.int64)
        for t, words in enumerate(picks.tolist()):
            for _ in range(most):
                kind, at = rng.integers(3), int(rng.integers(max(1, len(words))))
                if kind == 0 and len(words) > 1:
                    del words[at]
                elif kind == 1:
                    words.insert(at, 0)
                else:
                    words[at] = 0
            changed[t, :min(n, len(words))] = words[:n]
        found = np.zeros(TRIALS, bool)
        for walk in range(MAX_WALKS):
            found |= (self.signatures(picks, walk) == self.signatures(changed, walk)).any(axis=1)
            if found.mean() >= (3 + target) / 4:  # room for the luck of the trials
                return walk + 1, float(found.mean())
        return 0, 1.0

    def leaks(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        """(item_id, start word, item words, distance) per text: the closest window of
        each item, the first of equals; items in ascending order."""
        return [[x[:4] for x in found] for found in self.spans(texts, False)]

    def spans(self, texts: list[str | None], longer: bool = True) -> list[list[tuple[int, int, int, int, int]]]:
        """(item_id, start word, item words, distance, span words) per text: the closest
        passage of each item, of any length within the allowed edits; the first of equals.
        Without ``longer`` only windows of the item's length are compared."""
        get = self.vocabulary.get
        coded = [np.array([get(w, 0) for w in words_of(t)], np.int64) for t in texts]
        sizes = np.array([len(c) for c in coded])
        best: list[dict[int, tuple[int, int, int, int]]] = [{} for _ in texts]
        if not self.sizes or not sizes.sum():
            return [[] for _ in texts]
        ids = np.concatenate(coded)
        ends = np.cumsum(sizes)
        doc = np.repeat(np.arange(len(texts)), sizes)
        for n, starts in self.starts(ids, doc, ends).items():
            most = int(self.share * n)
            starts = starts[np.minimum(starts + n, ends[doc[starts]]) - starts >= n - most]
            for lo in range(0, len(starts), 50_000):
                self._search(starts[lo:lo + 50_000], n, most, ids, doc, ends, *self.sizes[n], best, longer)
        return [[(i, s, n, d, m) for i, (d, s, n, m) in sorted(b.items())] for b in best]

    def _distinct_pairs(self, windows: np.ndarray, n: int) -> np.ndarray:
        """Different word pairs of each window that items of n words hold."""
        pair = windows[:, :-1] * self.base + windows[:, 1:]
        own = self.own_pairs[n]
        known = (own[np.minimum(np.searchsorted(own, pair), len(own) - 1)] == pair) & (windows[:, :-1] > 0) & (windows[:, 1:] > 0)
        ranked = np.sort(np.where(known, pair, -1), axis=1)
        return (ranked[:, 0] >= 0) + ((ranked[:, 1:] != ranked[:, :-1]) & (ranked[:, 1:] >= 0)).sum(axis=1)

    def _sharing(self, windows: np.ndarray, n: int, need: int) -> set[tuple[int, int]]:
        """(window, item) of all items that share at least ``need`` different pairs."""
        own, item = self.holders[n]
        if need <= 0:
            return {(w, i) for w in range(len(windows)) for i in range(len(self.sizes[n][1]))}
        out: set[tuple[int, int]] = set()
        for lo in range(0, len(windows), 2000):
            part = windows[lo:lo + 2000]
            pair = np.where((part[:, :-1] > 0) & (part[:, 1:] > 0), part[:, :-1] * self.base + part[:, 1:], -1)
            flat, window = np.unique(np.stack([pair.ravel(), np.repeat(np.arange(len(part)), n - 1)]), axis=1)
            first, last = np.searchsorted(own, flat), np.searchsorted(own, flat, "right")
            met, _ = gather(item, first, last - first)
            met_window = np.repeat(window, last - first)
            both, times = np.unique(np.stack([met_window, met]), axis=1, return_counts=True)
            out.update((lo + int(w), int(i)) for w, i in both[:, times >= need].T)
        return out

    def _search(self, starts, n, most, ids, doc, ends, item_ids, rows, best, longer) -> None:
        at = starts[:, None] + np.arange(n)
        inside = at < ends[doc[starts]][:, None]
        windows = np.where(inside, ids[np.minimum(at, len(ids) - 1)], -1)
        enough = self._distinct_pairs(windows, n) >= n - 1 - 2 * most - self.repeats[n]
        starts, windows, inside = starts[enough], windows[enough], inside[enough]
        if not len(starts):
            return
        seen: set[tuple[int, int]] = set() if self.walks[n] else self._sharing(windows, n, n - 1 - 2 * most - self.repeats[n])
        for walk in range(self.walks[n]):
            made, have = self.signatures(windows, walk), self.index[n][walk]
            for s in range(SAMPLES):
                order = np.argsort(have[:, s], kind="stable")
                ranked = have[order, s]
                lo, hi = np.searchsorted(ranked, made[:, s]), np.searchsorted(ranked, made[:, s], "right")
                for w in np.flatnonzero(hi > lo).tolist():
                    seen.update((w, int(i)) for i in order[lo[w]:hi[w]])
        if not seen:
            return
        pairs = np.array(sorted(seen))
        # windows that differ in fewest places first: they settle most pairs at once
        apart = (windows[pairs[:, 0]] != rows[pairs[:, 1]]).sum(axis=1)
        for k in np.argsort(apart, kind="stable").tolist():
            w, i = pairs[k].tolist()
            p = int(starts[w])
            d, item = int(doc[p]), int(item_ids[i])
            first = int(ends[d - 1]) if d else 0
            had = best[d].get(item)
            limit = most if had is None else min(most, had[0])
            if not limit and apart[k]:
                continue
            if not apart[k]:
                hit = (0, n)
            elif longer:
                # words inserted in the middle push the end of the passage out of the window
                hit = closest_span(rows[i].tolist(), ids[p:min(p + n + most, int(ends[d]))].tolist(), limit)
            else:
                window = windows[w][inside[w]].tolist()
                distance = edit_distance(rows[i].tolist(), window, limit)
                hit = None if distance is None else (distance, len(window))
            if hit is not None and (had is None or (hit[0], p - first) < had[:2]):
                best[d][item] = (hit[0], p - first, n, hit[1])


def item_blocks(benchmark: DataFrame, min_words: int = MIN_WORDS, block_words: int = BLOCK_WORDS,
                share: float = SHARE, target: float = TARGET_RECALL) -> Iterator[Items]:
    """Search structures of bounded size. Items without text, without id or with fewer
    than ``min_words`` words are left out."""
    held: list[tuple[int, list[str]]] = []
    size = 0
    rows = benchmark.where("item_id is not null and text is not null")
    for row in rows.select(F.col("item_id").cast("long"), "text").distinct().toLocalIterator():
        words = words_of(row[1])
        if len(words) < min_words:
            continue
        held.append((row[0], words))
        size += len(words)
        if size >= block_words:
            yield Items(held, share, target)
            held, size = [], 0
    if held:
        yield Items(held, share, target)


_KIND = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("n_words", pa.int32()),
                            ("distance", pa.int32()), ("span", pa.int32())]))


def _with_block(docs: DataFrame, block: Items, into: str, keep: list[str]) -> DataFrame:
    """``keep`` columns plus what the texts leak of one block of items."""
    def run(texts: pa.Array) -> list[pa.Array]:
        found: list = []
        for part in by_bytes(pa.RecordBatch.from_arrays([texts], names=["text"]), 0, 8 << 20):
            found += [x or None for x in block.spans(part.column(0).to_pylist())]
        return [pa.array([None if x is None else [dict(zip(LEAK.names, y)) for y in x] for x in found], _KIND)]

    return add_columns(docs, ["text"], [T.StructField(into, T.ArrayType(LEAK))], run, keep)


def with_leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, target: float = TARGET_RECALL,
               min_words: int = MIN_WORDS, into: str = "leaks", block_words: int = BLOCK_WORDS) -> DataFrame:
    """All rows and columns of ``docs`` plus ``into``: one (item_id, start, n_words,
    distance, span) per benchmark item found, null for none; the passage has ``span`` words.

    Null and empty texts have no leaks; rows that repeat are judged alike; an empty
    benchmark leaves every row without leaks; a clashing column is replaced; an empty table
    stays empty. Of passages of one item the nearest counts, then the first.

    A benchmark of one block is searched in the plan that is returned. Of a larger one each
    block is searched and what it finds is stored before the next one is read, so that no
    plan, and no task, carries more than a block.
    """
    out = docs.drop(into)
    blocks = item_blocks(benchmark, min_words, block_words, share, target)
    block, after = next(blocks, None), next(blocks, None)
    if block is None:
        return out.withColumn(into, F.lit(None).cast(T.ArrayType(LEAK)))
    if after is None:
        return _with_block(out, block, into, out.columns)
    row, other = fresh(out, "_row"), fresh(out, "_other")
    rows = stored(out.withColumn(row, F.monotonically_increasing_id()), "rows")
    hits = None
    for block in chain([block, after], blocks):
        part = stored(_with_block(rows, block, into, [row]).where(F.col(into).isNotNull()), "leaks")
        hits = part if hits is None else hits.unionByName(part)
    found = hits.groupBy(F.col(row).alias(other)).agg(F.array_sort(F.flatten(F.collect_list(into))).alias(into))
    return rows.join(found, F.col(row) == F.col(other), "left").select(*out.columns, into)


def leaks(docs: DataFrame, benchmark: DataFrame, **kwargs) -> DataFrame:
    """(doc_id, item_id, start, n_words, distance, span, similarity), one row per document and
    benchmark item that it holds."""
    found = with_leaks(docs.select("doc_id", "text"), benchmark, **kwargs).where("leaks is not null")
    return found.select("doc_id", F.explode("leaks").alias("l")).select(
        "doc_id", "l.*", (1 - F.col("l.distance") / F.col("l.n_words")).alias("similarity"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, **kwargs) -> DataFrame:
    """The documents that hold no benchmark item, with their columns."""
    found = fresh(docs, "leaks")
    return with_leaks(docs, benchmark, into=found, **kwargs).where(F.col(found).isNull()).select(*docs.columns)
