"""Toxicity by the nearest labelled examples (operator 5).

Texts are TF-IDF vectors over all their words; the cosine to labelled examples is searched
exactly through an inverted index with block maxima, so that a text's terms bound its
cosine to every block of examples. Blocks are visited from the highest bound on, until no
block left can hold a nearer one.
Neighbours vote with their cosines, and the vote is calibrated on the examples
themselves, each scored without its own text.

A term's IDF is multiplied by what it tells about the label: fully where a likelihood
ratio test finds it to depend on the label beyond chance, else by ``WEAK``. Beside words,
stems of four to seven letters count if they pass that test, so inflected forms meet.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeframe.llm.common import add_columns, bounded_rows, in_tasks, remainder, stored
from hazeframe.llm.tokens import by_bytes

HELD_OUT, FOLDS = 0, 5
#: Labelled rows the model is fitted on: those with the smallest hashes of doc_id.
MAX_EXAMPLES = 8_000
NEIGHBOURS, BLOCK = 15, 32
#: Share of its IDF that a term keeps if it does not tell the labels apart.
WEAK = 0.1
#: Share of the examples from which on a term is kept as a row of weights.
MANY = 0.05
#: Share of these rows from which on a block keeps all, zeros included: then none are picked out.
MOST = 0.7
#: Blocks that each text has visited when thresholds are raised, before the rest, and texts searched at once.
VISITS, TEXTS = (4, 16), 256
#: Texts whose postings are summed up at once: they take most of the memory of a search.
POSTED = 32
#: Tasks that read the examples, and parts in which tasks hand over document frequencies.
EXAMPLE_TASKS, SLICES = 16, 8
#: Bytes of text that a task cuts into words at once.
PART = 4 << 20
#: Cosines are compared to this many digits; blocks are left out if their bound is lower by more than that.
DIGITS, EQUAL = 9, 1e-8
GAP = r"[^\p{L}]+"
PREFIXES = (4, 5, 6, 7)


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """(row, word, frequency) of every distinct word of every text, in order of row and
    word, and the words that the numbers stand for: lower-case runs of letters."""
    lists = pc.split_pattern_regex(pc.utf8_lower(texts.fill_null("")), GAP)
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    if "" in words:  # what stands before and behind the outer gaps
        kept = code != words.index("")
        code, row = code[kept], row[kept]
    pair, n = np.unique(row * len(words) + code, return_counts=True)
    return pair // max(1, len(words)), pair % max(1, len(words)), n, words


def stems_of(word: str) -> list[str]:
    return [word[:k] + "*" for k in PREFIXES if len(word) > k]


def terms_of(text: str | None) -> Counter:
    """Terms of a whole text with their frequencies.

    Words; their first letters, marked ``*``; and first letters that begin at least two or
    three different words, marked ``*2`` and ``*3``: a stem that a text keeps inflecting
    says more than one that it happens to contain.
    """
    out: Counter = Counter()
    forms: Counter = Counter()
    _, code, n, words = words_of(pa.array([text], pa.string()))
    for c, k in zip(code.tolist(), n.tolist()):
        out[words[c]] += k
        for stem in stems_of(words[c]):
            out[stem] += k
            forms[stem] += 1
    for stem, k in forms.items():
        for least in (2, 3):
            if k >= least:
                out[f"{stem}{least}"] = 1
    return out


def training_labels(labels: DataFrame, most: int = MAX_EXAMPLES) -> DataFrame:
    """(doc_id, toxic) of at most ``most`` labelled rows outside the held-out fold; a
    doc_id labelled both ways counts as toxic."""
    rows = labels.where("doc_id is not null and toxic is not null")
    rows = rows.where(remainder("doc_id", FOLDS) != HELD_OUT)
    return bounded_rows(rows.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")),
                        F.col("doc_id"), most)


def distinct_examples(docs: DataFrame, train: DataFrame) -> DataFrame:
    """(doc_id, text, toxic): one example per text, so that copies are one piece of evidence.
    It has the smallest doc_id of its copies and the share of them that are toxic."""
    small = F.broadcast(train)  # at most MAX_EXAMPLES rows of two numbers
    rows = docs.join(small, "doc_id").groupBy(F.coalesce("text", F.lit("")).alias("text"))
    return rows.agg(F.min("doc_id").alias("doc_id"), F.avg("toxic").alias("toxic")).repartition(EXAMPLE_TASKS)


def _sides(texts: pa.Array, side: np.ndarray) -> Iterator[tuple[list[str], np.ndarray]]:
    """(terms, texts of either side that hold each) for the words and each kind of stem."""
    row, code, _, words = words_of(texts)

    def counted(held: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(held * 2 + side[of], minlength=2 * n).reshape(n, 2)

    yield words, counted(code, row, len(words))
    place: dict[str, int] = {}
    own = [[place.setdefault(w, len(place)) for w in stems_of(word)] for word in words]
    n = np.fromiter(map(len, own), np.int64, len(own))
    flat = np.fromiter((i for x in own for i in x), np.int64, int(n.sum()))
    stems = flat[_ranges((np.cumsum(n) - n)[code], n[code])]
    pair, forms = np.unique(np.repeat(row, n[code]) * max(1, len(place)) + stems, return_counts=True)
    of, stem = pair // max(1, len(place)), pair % max(1, len(place))
    for ending in (1, 2, 3):
        held = forms >= ending
        if held.any():
            yield [w + (str(ending) if ending > 1 else "") for w in place], counted(stem[held], of[held], len(place))


def example_terms(examples: DataFrame) -> list[tuple[str, bool]]:
    """(term, whether it tells the labels apart) of all words and all telling stems of the
    examples, which bound what is collected.

    The bound of the test is that of a false term among all of them with probability 1/20.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in (part for whole in batches for part in by_bytes(whole, 0, PART)):
            side = (batch.column(1).to_numpy(zero_copy_only=False) >= 0.5).astype(np.int64)
            for names, n in _sides(batch.column(0), side):
                for i in np.flatnonzero(n.any(axis=1)).tolist():
                    name, counts = names[i], n[i]
                    held = seen.get(name)
                    seen[name] = counts if held is None else held + counts
        names = list(seen)
        for lo in range(0, len(names), 50_000):
            n = np.array([seen[w] for w in names[lo:lo + 50_000]], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[lo:lo + 50_000], pa.string()), *(pa.array(np.ascontiguousarray(c)) for c in n.T)], names=["term", "n0", "n1"])

    totals = {r[0]: r[1] for r in examples.groupBy(F.col("toxic") >= 0.5).count().collect()}
    neg, pos = totals.get(False, 0), totals.get(True, 0)
    every = pos + neg
    counts = in_tasks(examples.select("text", "toxic"), run, "term string, n0 long, n1 long").groupBy("term").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    counts = stored(counts, "terms")
    # a term of fewer examples can never pass
    kinds = counts.where("n0 + n1 >= 3").count()
    n = F.col("n0") + F.col("n1")

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    ratio = 2 * (part(F.col("n1"), n * pos / every) + part(F.col("n0"), n * neg / every)
                 + part(pos - F.col("n1"), (every - n) * pos / every)
                 + part(neg - F.col("n0"), (every - n) * neg / every)) if pos and neg else F.lit(0.0)
    tells = (n >= 3) & (ratio >= 2 * math.log(max(1, kinds) / 0.05))
    rows = counts.select("term", tells.alias("tells")).where(F.col("tells") | ~F.contains("term", F.lit("*")))
    return sorted((r[0], bool(r[1])) for r in rows.collect())


class Vectors:
    """Term vectors of several texts, one after another: numbers and frequencies of the
    numbered terms, in order, and per text the sum of (1 + log frequency) squared of its
    other words."""

    def __init__(self, rows: int, row: np.ndarray, term: np.ndarray, count: np.ndarray, rest: np.ndarray):
        self.ends = np.searchsorted(row, np.arange(rows + 1))
        self.term, self.count, self.rest = term, count, rest

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray, float]:
        own = slice(self.ends[i], self.ends[i + 1])
        return self.term[own], self.count[own], float(self.rest[i])

    def __len__(self) -> int:
        return len(self.ends) - 1


class Reader:
    """Finds the numbered terms of texts."""

    def __init__(self, terms: list[str]):
        self.terms = len(terms)
        self.number = {w: i for i, w in enumerate(terms)}
        self.stems = {w.rstrip("23") for w in terms if "*" in w}
        #: What every word with such a stem begins with; few words do.
        self.heads = {w[:min(PREFIXES)] for w in self.stems}

    def read(self, texts: pa.Array) -> Vectors:
        """Vectors of whole texts, as ``terms_of`` counts them."""
        row, code, n, words = words_of(texts)
        number = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))[code]
        other = number < 0
        rest = np.bincount(row[other], (1 + np.log(n[other])) ** 2, minlength=len(texts)) if other.any() else np.zeros(len(texts))
        parts = [(row[~other], number[~other], n[~other])]
        heads, head = self.heads, min(PREFIXES)
        stemmed = {c: [w for w in stems_of(words[c]) if w in self.stems] for c, word in enumerate(words) if word[:head] in heads}
        stemmed = {c: own for c, own in stemmed.items() if own}
        if stemmed:
            names = sorted({w for own in stemmed.values() for w in own})
            place = {w: i for i, w in enumerate(names)}
            at = np.flatnonzero(np.isin(code, np.fromiter(stemmed, np.int64, len(stemmed))))
            pairs = np.array([(i, place[w]) for i in at.tolist() for w in stemmed[int(code[i])]], np.int64).reshape(-1, 2)
            key, back, forms = np.unique(row[pairs[:, 0]] * len(names) + pairs[:, 1], return_inverse=True, return_counts=True)
            of_row, stem = key // len(names), key % len(names)
            total = np.bincount(back, n[pairs[:, 0]]).astype(np.int64)
            for ending, most in (("", total), ("2", None), ("3", None)):
                named = np.array([self.number.get(w + ending, -1) for w in names], np.int64)[stem]
                held = (named >= 0) & (forms >= int(ending or 1))
                parts.append((of_row[held], named[held], most[held] if most is not None else np.ones(int(held.sum()), np.int64)))
        row, term, count = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((term, row))
        return Vectors(len(texts), row[order], term[order], count[order], rest)


def _distinct(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(distinct texts, number of each row's text)."""
    coded = texts.fill_null("").dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)


def document_frequencies(docs: DataFrame, terms: list[str]) -> np.ndarray:
    """Documents that hold each term. A task counts a text once per batch, with its copies,
    and hands over its counts as a few arrays, which are summed by their number."""
    reader = Reader(terms)
    cuts = np.linspace(0, len(terms), SLICES + 1).astype(int)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(terms), np.int64)
        for batch in (part for whole in batches for part in by_bytes(whole, 0, PART)):
            texts, copies = _distinct(batch.column(0))
            found = reader.read(texts)
            times = np.bincount(copies, minlength=len(texts))
            seen += np.bincount(found.term, np.repeat(times, np.diff(found.ends)), minlength=len(terms)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SLICES), pa.int32()), pa.array([seen[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())],
            names=["slice", "seen"])

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        made = sum(np.frombuffer(x, np.int64) for x in pdf["seen"])
        return pd.DataFrame({"slice": pdf["slice"].iloc[:1], "seen": [np.asarray(made, np.int64).tobytes()]})

    parts = in_tasks(docs.select("text"), run, "slice int, seen binary").groupBy("slice").applyInPandas(total, "slice int, seen binary")
    got = {r[0]: np.frombuffer(r[1], np.int64) for r in parts.collect()}
    return np.concatenate([got[i] if i in got else np.zeros(b - a, np.int64) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))])


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All of start, start + 1, ... start + count - 1, one range after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def _alike(rows: list[tuple[np.ndarray, np.ndarray]], groups: int) -> np.ndarray:
    """An order in which like vectors stand together, so that bounds of blocks are tight:
    k-means over random projections."""
    rng = np.random.default_rng(7)
    flat = np.zeros((len(rows), 48))
    width = max((int(t[-1]) + 1 for t, _ in rows if len(t)), default=1)
    signs = rng.choice([-1.0, 1.0], size=(width, flat.shape[1])).astype(np.float32)
    for i, (t, w) in enumerate(rows):
        flat[i] = w @ signs[t]
    centres = flat[rng.choice(len(rows), groups, replace=False)]
    for _ in range(6):
        near = (flat @ centres.T - 0.5 * (centres * centres).sum(axis=1)).argmax(axis=1)
        for g in range(groups):
            if (near == g).any():
                centres[g] = flat[near == g].mean(axis=0)
    return np.lexsort((flat[:, 0], near))


Steps = tuple[np.ndarray, np.ndarray]


def calibrated(raw: np.ndarray, toxic: np.ndarray, prior: float) -> Steps:
    """Isotonic steps from raw votes to observed shares, each drawn to the prior by one row."""
    order = np.argsort(raw, kind="stable")
    pools: list[list[float]] = []  # sum, number, least and largest raw vote
    for x, y in zip(raw[order], toxic[order]):
        pools.append([y, 1, x, x])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    xs, ys = [0.0], [0.0]
    for total, n, low, high in pools:
        for x in (low, high):
            if x > xs[-1]:
                xs.append(x)
                ys.append(max(ys[-1], (total + prior) / (n + 1)))
    if xs[-1] < 1:
        xs.append(1.0)
        ys.append(ys[-1] if pools else 1.0)
    return np.array(xs), np.array(ys)


class Index:
    """Block-max inverted index over labelled examples with a calibrated vote.

    Like examples stand in blocks together. A term in many examples is a matrix row in
    every block that holds it, with its largest weight there; a term in few is a list of
    postings. ``value`` is the weight of each term (IDF times what it tells), ``unknown``
    that of a word no example holds. ``toxic`` may be a share.
    """

    def __init__(self, ids: list, rows: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray,
                 value: np.ndarray, unknown: float = 0.0, neighbours: int = NEIGHBOURS, block: int = BLOCK, many: float = MANY):
        self.value, self.unknown, self.k, self.block = value, unknown, neighbours, block
        toxic = np.asarray(toxic, float)
        weighted = [self.weigh(t, c) for t, c in rows]
        held = np.array([i for i, (t, _) in enumerate(weighted) if len(t)], int)
        if len(held):
            held = held[_alike([weighted[i] for i in held], max(1, len(held) // (4 * block)))]
        self.ids = np.array([ids[i] for i in held], np.int64)
        self.toxic = toxic[held]
        empty = np.ones(len(rows), bool)
        empty[held] = False
        self.prior = float(toxic.mean()) if len(toxic) else 0.0
        self.no_terms = (float(toxic[empty].sum()) + self.prior) / (float(empty.sum()) + 1)
        self.blocks = -(-len(held) // block)
        term = np.concatenate([np.zeros(0, np.int64), *[weighted[i][0] for i in held]])
        holder = np.repeat(np.arange(len(held)), [len(weighted[i][0]) for i in held]).astype(np.int64)
        weight = np.concatenate([np.zeros(0), *[weighted[i][1] for i in held]])
        often = np.bincount(term, minlength=len(value)) >= max(1.0, many * len(held))
        self.row_of = np.where(often, np.cumsum(often) - 1, -1)
        dense = often[term]
        self.largest = np.zeros((int(often.sum()), self.blocks))
        # per block: the matrix rows that it holds (None: all, as it holds most of them), their weights
        self.parts: list[tuple[np.ndarray | None, np.ndarray]] = []
        cuts = np.searchsorted(holder, np.arange(self.blocks + 1) * block)
        for b, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
            mine = np.flatnonzero(dense[lo:hi]) + lo
            part = np.zeros((len(self.largest), block))
            part[self.row_of[term[mine]], holder[mine] - b * block] = weight[mine]
            self.largest[:, b] = part.max(axis=1, initial=0.0)
            rows_held = np.flatnonzero(self.largest[:, b])
            whole = len(rows_held) > MOST * len(part)
            self.parts.append((None, part) if whole else (rows_held, part[rows_held]))
        order = np.lexsort((holder[~dense], term[~dense]))
        self.holder, self.weight = holder[~dense][order].astype(np.int32), weight[~dense][order]
        self.lists = np.searchsorted(term[~dense][order], np.arange(len(value) + 1))
        self.place = {int(i): n for n, i in enumerate(held)}

    def weigh(self, terms, counts, rest: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """(terms, weights): (1 + log tf) * value over the length of the whole text."""
        terms = np.asarray(terms, np.int64)
        weights = (1 + np.log(np.asarray(counts, float))) * self.value[terms] if len(terms) else np.zeros(0)
        norm = math.sqrt(float(weights @ weights) + rest * self.unknown ** 2)
        return (terms, weights / norm) if norm else (terms[:0], weights[:0])

    def nearest(self, texts: list[tuple[np.ndarray, np.ndarray]], k: int, skip: list[int] | None = None) -> list[list[tuple[float, int]]]:
        """For each (terms, weights) the k examples of largest positive cosine, of equal ones
        (to DIGITS digits) those with the smallest doc_id. ``skip`` names one to leave out."""
        n, wide = len(texts), self.blocks * self.block
        if not n or not wide:
            return [[] for _ in texts]
        row = np.repeat(np.arange(n), [len(t) for t, _ in texts])
        term, weight = (np.concatenate([x[i] for x in texts]) for i in (0, 1))
        often = self.row_of[term] >= 0
        heavy = np.zeros((n, len(self.largest)))
        heavy[row[often], self.row_of[term[often]]] = weight[often]
        of, few, by = row[~often], term[~often], weight[~often]
        cosine = np.empty((n, self.blocks, self.block))
        for lo in range(0, n, POSTED):
            hi = min(n, lo + POSTED)
            own = slice(*np.searchsorted(of, (lo, hi)))
            start = self.lists[few[own]]
            count = self.lists[few[own] + 1] - start
            postings = _ranges(start, count)
            at = np.repeat((of[own] - lo) * wide, count) + self.holder[postings]
            worth = self.weight[postings] * np.repeat(by[own], count)
            cosine[lo:hi] = np.bincount(at, worth, minlength=(hi - lo) * wide).reshape(hi - lo, self.blocks, self.block)
        bounds = cosine.max(axis=2) + heavy @ self.largest
        order = np.argsort(-bounds, axis=1, kind="stable")
        least, skipped = np.zeros(n), np.full(n, -1) if skip is None else np.asarray(skip)
        best = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))  # text, cosine, example
        for lo, hi in zip((0, *VISITS), (*VISITS, self.blocks)):
            wanted = np.zeros((n, self.blocks), bool)
            np.put_along_axis(wanted, order[:, lo:hi], True, axis=1)
            wanted &= (bounds >= least[:, None]) & (bounds > 0)
            found = [best]
            for b in np.flatnonzero(wanted.any(axis=0)).tolist():
                mine = np.flatnonzero(wanted[:, b])
                rows, part = self.parts[b]
                own = heavy if len(mine) == n else heavy[mine]
                own = cosine[mine, b] + (own if rows is None else own[:, rows]) @ part
                i, j = np.nonzero(own > np.maximum(least[mine], 0.0)[:, None])
                found.append((mine[i], np.round(own[i, j], DIGITS), b * self.block + j))
            text, value, example = (np.concatenate(x) for x in zip(*found))
            kept = (example != skipped[text]) & (value > 0)
            text, value, example = text[kept], value[kept], example[kept]
            at = np.lexsort((self.ids[example], -value, text))
            text, value, example = text[at], value[at], example[at]
            first = np.searchsorted(text, np.arange(n + 1))
            rank = np.arange(len(text)) - first[text]
            full = np.flatnonzero(rank == k - 1)
            least[text[full]] = value[full] - EQUAL
            best = (text[rank < k], value[rank < k], example[rank < k])
        first = np.searchsorted(best[0], np.arange(n + 1))
        pairs = list(zip(best[1].tolist(), best[2].tolist()))
        return [pairs[a:b] for a, b in zip(first, first[1:])]

    def vote(self, near: list[tuple[float, int]]) -> float:
        """Cosine-weighted share of toxic neighbours, drawn to the prior by half a vote."""
        weights = np.array([c for c, _ in near])
        return float((weights @ self.toxic[[i for _, i in near]] + 0.5 * self.prior) / (weights.sum() + 0.5))

    def left_out(self, rows: list[int], texts: list[tuple]) -> list[float]:
        """The raw votes on examples (their numbers when the index was made) without the
        examples themselves; the prior for one that meets no other."""
        near = self.nearest([self.weigh(t, c) for t, c in texts], self.k, [self.place.get(i, -1) for i in rows])
        return [self.vote(x) if x else self.prior for x in near]

    def scores(self, texts: list[tuple[np.ndarray, np.ndarray, float]], steps: Steps) -> list[tuple[float, list[int]]]:
        """(calibrated score, ids of the neighbours, nearest first) of each text. One that
        shares no term with an example gets the share of toxic examples without terms."""
        out = []
        for lo in range(0, len(texts), TEXTS):
            near = self.nearest([self.weigh(*t) for t in texts[lo:lo + TEXTS]], self.k)
            out += [(float(np.interp(self.vote(x), *steps)), self.ids[[i for _, i in x]].tolist()) if x else (self.no_terms, []) for x in near]
        return out


_SCORES = [T.StructField("score", T.DoubleType()), T.StructField("neighbours", T.ArrayType(T.LongType()))]


class Model:
    """What tasks need to score texts. The structures are built where they are used, once per
    worker, so that only the example vectors travel."""

    def __init__(self, terms: list[str], ids: np.ndarray, ends: np.ndarray, term: np.ndarray, count: np.ndarray,
                 toxic: np.ndarray, value: np.ndarray, unknown: float):
        self.terms, self.ids, self.ends, self.toxic = "\n".join(terms), ids, ends, toxic
        self.term, self.count, self.value, self.unknown = term.astype(np.int32), count.astype(np.int32), value, unknown
        self.built: tuple[Reader, Index] | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "built": None}

    def parts(self) -> tuple[Reader, Index]:
        if self.built is None:
            rows = [(self.term[a:b].astype(np.int64), self.count[a:b]) for a, b in zip(self.ends, self.ends[1:])]
            terms = self.terms.split("\n") if self.terms else []
            self.built = Reader(terms), Index(self.ids.tolist(), rows, self.toxic, self.value, self.unknown)
        return self.built


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, weak: float = WEAK):
    """(broadcast model, calibration steps) of the labelled examples; document frequencies
    count all ``docs``."""
    train = stored(training_labels(labels, max_examples), "labels")
    examples = stored(distinct_examples(docs, train), "examples")
    known = example_terms(examples)
    terms, tells = [t for t, _ in known], np.array([s for _, s in known], bool)
    del known
    every = docs.count()
    idf = np.log((every + 1) / (document_frequencies(docs, terms) + 1)) + 1
    value = idf * np.where(tells, 1.0, weak)
    reader = Reader(terms)

    def run(texts: pa.Array) -> list[pa.Array]:
        found = reader.read(texts)
        ends = pa.array(found.ends.astype(np.int32))
        return [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (found.term, found.count)]

    vector = [T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType()))]
    rows = stored(add_columns(examples, ["text"], vector, run, keep=["doc_id", "toxic"]), "vectors")
    held = rows.toArrow().sort_by("doc_id").combine_chunks()  # at most max_examples rows
    lists = held.column("terms").combine_chunks()
    model = Model(terms, held.column("doc_id").to_numpy(), lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy(),
                  held.column("counts").combine_chunks().values.to_numpy(), held.column("toxic").to_numpy(), value,
                  weak * (math.log((every + 1) / 2) + 1))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    number = {d: i for i, d in enumerate(model.ids.tolist())}

    def vote(ids: pa.Array, terms: pa.Array, counts: pa.Array) -> list[pa.Array]:
        made, index = [], shared.value.parts()[1]
        rows = list(zip(ids.to_pylist(), terms.to_pylist(), counts.to_pylist()))
        for lo in range(0, len(rows), TEXTS):
            part = rows[lo:lo + TEXTS]
            made += index.left_out([number[d] for d, _, _ in part], [(np.array(t, np.int64), c) for _, t, c in part])
        return [pa.array(made, pa.float64())]

    voted = add_columns(rows.where(F.size("terms") > 0).repartition(EXAMPLE_TASKS), ["doc_id", "terms", "counts"],
                        [T.StructField("vote", T.DoubleType())], vote, keep=["doc_id", "toxic"]).collect()
    voted.sort(key=lambda r: r["doc_id"])
    prior = float(model.toxic.mean()) if len(model.toxic) else 0.0
    return shared, calibrated(np.array([r["vote"] for r in voted]), np.array([r["toxic"] for r in voted]), prior)


def scores(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, weak: float = WEAK) -> DataFrame:
    """(doc_id, held_out, score, predicted, neighbours) for every document.

    Labels outside the held-out fold (crc32(doc_id as text) mod 5 = 0) are learned; only
    the text of a document is scored, whole. IDF counts all documents; a word that no
    example holds cannot meet one and counts in the length of its text, as a word of one
    document. Of examples with one text the smallest doc_id stands for all, and ties
    between neighbours go to smaller ids. Null and empty texts have no terms; repeated rows
    are scored alike; held_out is null for a null doc_id; without labels of both kinds every
    score is the share of toxic labels. An empty table gives no rows. Columns other than
    doc_id and text are ignored, whatever their names.
    """
    docs = docs.select("doc_id", "text")
    shared, steps = fit(docs, labels, max_examples, weak)

    def run(texts: pa.Array) -> list[pa.Array]:
        reader, index = shared.value.parts()
        made = []
        for part in by_bytes(pa.RecordBatch.from_arrays([texts], names=["text"]), 0, PART):
            own, at = _distinct(part.column(0))
            found = reader.read(own)
            scored = index.scores([found[i] for i in range(len(found))], steps)
            made += [scored[i] for i in at.tolist()]
        return [pa.array([m[0] for m in made], pa.float64()), pa.array([m[1] for m in made], pa.list_(pa.int64()))]

    scored = add_columns(docs, ["text"], _SCORES, run, keep=["doc_id"])
    return scored.select("doc_id", (remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "neighbours")
