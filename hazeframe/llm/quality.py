"""Quality rules: isolation forest on rule statistics (operator 9).

Each text is reduced to statistics of simple rules. Trees of random splits over a sample
of them isolate unusual rows on short paths; the threshold on the resulting anomaly
score is set on labelled rows so that nearly all good ones stay.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeframe.llm.common import add_columns, bounded_rows, fresh, stored

#: Trees, rows each one is grown on, and rows of the sample they are drawn from. Fewer trees
#: leave the score of a row, and with it the threshold, to the luck of the splits.
TREES, TREE_ROWS, SAMPLE_ROWS = 1000, 256, 51_200
#: Share of the good labelled rows that the threshold keeps at least.
KEEP_GOOD = 0.99
BINS = 2000
SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_letters", "n_upper", "n_marks", "n_digits", "n_lines", "n_top_word"]
FEATURES = ["symbols_per_char", "dup_lines", "repeats", "upper", "marks", "digits", "word_length", "top_word"]


def statistics(text: str | None) -> tuple[int, ...]:
    """The counts named in COUNTS and MORE for a whole text; null counts as empty.

    Words are runs without ASCII white space. n_dup_lines counts lines with a word that
    equal an earlier line; n_repeat_words the words inside 3-word windows that occur
    twice or more, the first occurrence included. n_marks counts ``!?``.
    """
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    lines = [s for s in text.split("\n") if s.strip(" \t\n\v\f\r")]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = {w for w, c in Counter(windows).items() if c > 1}
        covered = 0  # words below this position are counted
        for i, w in enumerate(windows):
            if w in often:
                repeated += i + 3 - max(i, covered)
                covered = i + 3
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4") if text else np.zeros(0, "<u4")
    letter, upper = _classes()
    capped = np.minimum(points, len(letter) - 1)
    return (n, chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated,
            int(letter[capped].sum()), int(upper[capped].sum()), text.count("!") + text.count("?"),
            int(((points >= 48) & (points <= 57)).sum()), len(lines),
            Counter(words).most_common(1)[0][1] if words else 0)


_tables: tuple[np.ndarray, np.ndarray] | None = None


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Letter and upper-case flags of the code points below 0x20000."""
    global _tables
    if _tables is None:
        every = [chr(i) for i in range(0x20000)]
        _tables = np.array([c.isalpha() for c in every]), np.array([c.isupper() for c in every])
    return _tables


def with_statistics(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rows plus one long column per count; clashing columns are replaced."""
    def run(texts: pa.Array) -> list[pa.Array]:
        made = np.array([statistics(t.as_py()) for t in texts], np.int64).reshape(-1, len(COUNTS + MORE))
        return [pa.array(np.ascontiguousarray(c)) for c in made.T]

    return add_columns(docs, ["text"], [T.StructField(c, T.LongType()) for c in COUNTS + MORE], run, keep)


def features(rows: dict[str, np.ndarray]) -> np.ndarray:
    """(rows, FEATURES) rates; an empty text has zeros.

    Repetition is damped by a few lines or words, since a short text with one repeated
    line is not unusual.
    """
    c = {k: np.asarray(rows[k], float) for k in COUNTS + MORE}

    def rate(a, b, damp=0):
        return c[a] / np.maximum(c[b] + damp, 1)

    return np.stack([
        rate("n_symbols", "word_chars"), rate("n_dup_lines", "n_lines", 20), rate("n_repeat_words", "n_words", 200),
        rate("n_upper", "n_letters"), rate("n_marks", "n_words"), rate("n_digits", "word_chars"),
        np.minimum(rate("word_chars", "n_words"), 50) / 50, rate("n_top_word", "n_words", 20)], axis=1)


def base_failed(n_words, n_repeat_words):
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


class Forest:
    """Isolation trees as flat arrays: per node the feature, the split value, the left
    child (the right one follows it) and the path length where a path ends."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.size = min(rows, len(sample))
        self.height = max(1, math.ceil(math.log2(max(2, self.size))))
        self.trees = []
        for _ in range(trees if len(sample) else 0):
            own = sample[rng.choice(len(sample), self.size, replace=False)]
            self.trees.append(self._grow(own, rng))

    @staticmethod
    def average_path(n: float) -> float:
        """Mean path length of an unsuccessful search among n rows."""
        return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n

    def _grow(self, rows: np.ndarray, rng) -> tuple[np.ndarray, ...]:
        feature, split, child, path = [0], [0.0], [0], [0.0]
        queue = [(0, rows, 0)]
        while queue:
            node, own, depth = queue.pop()
            low, high = own.min(axis=0), own.max(axis=0)
            able = np.flatnonzero(high > low)
            if depth >= self.height or len(own) <= 1 or not len(able):
                path[node] = depth + self.average_path(len(own))
                continue
            f = int(rng.choice(able))
            at = float(rng.uniform(low[f], high[f]))
            left = own[:, f] <= at
            feature[node], split[node], child[node] = f, at, len(feature)
            for part in (own[left], own[~left]):
                queue.append((len(feature), part, depth + 1))
                feature.append(0), split.append(0.0), child.append(0), path.append(0.0)
        return np.array(feature), np.array(split), np.array(child), np.array(path)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly score: 2 to the power of minus the mean path length over the usual one;
        near 1 for rows that are isolated at once, 0 without trees."""
        if not self.trees or not len(rows):
            return np.zeros(len(rows))
        total, line = np.zeros(len(rows)), np.arange(len(rows))
        for feature, split, child, path in self.trees:
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.height):
                inner = child[node] > 0
                node = np.where(inner, child[node] + (rows[line, feature[node]] > split[node]), node)
            total += path[node]
        return 2.0 ** (-total / len(self.trees) / max(self.average_path(self.size), 1e-9))


def _score_column(rows: DataFrame, forest: Forest, keep: list[str]) -> DataFrame:
    def run(*arrays: pa.Array) -> list[pa.Array]:
        table = {c: a.to_numpy(zero_copy_only=False) for c, a in zip(COUNTS + MORE, arrays)}
        return [pa.array(forest.score(features(table)))]

    return add_columns(rows, COUNTS + MORE, [T.StructField("anomaly", T.DoubleType())], run, keep)


class Model:
    """A forest and the anomaly score above which a document is dropped."""

    def __init__(self, forest: Forest, threshold: float):
        self.forest, self.threshold = forest, threshold


def learn(stats: DataFrame, labels: DataFrame, trees: int = TREES, rows: int = TREE_ROWS,
          keep_good: float = KEEP_GOOD, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Grow the forest on at most ``sample_rows`` rows (those with the smallest hashes of
    doc_id) and set the threshold on all labelled rows.

    Rows that fail the base rules play no part in the threshold. Of BINS steps that keep
    ``keep_good`` of the rows labelled 1, the one that best tells both labels apart is
    taken (share of good rows kept less share of bad rows kept), of equals the highest.
    Without good rows nothing is dropped. A doc_id labelled both ways counts as good.
    """
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.max("quality").cast("int").alias("_good"))
    sample = bounded_rows(stats.where("n_words > 0"), F.col("doc_id"), sample_rows).select(*COUNTS, *MORE).toPandas()
    forest = Forest(features({c: sample[c].to_numpy() for c in COUNTS + MORE}), trees, rows)
    passing = stats.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    scored = _score_column(passing.join(marks, "doc_id"), forest, ["_good"])
    counts = np.zeros((2, BINS + 1))
    for good, step, n in scored.groupBy("_good", F.floor(F.col("anomaly") * BINS).alias("_bin")).count().collect():
        counts[int(good > 0), int(step)] += n
    bad, good = counts[0].cumsum(), counts[1].cumsum()
    if not good[-1]:
        return Model(forest, math.inf)
    apart = good / good[-1] - bad / max(1, bad[-1])
    able = np.flatnonzero(good >= keep_good * good[-1])
    step = able[::-1][np.argmax(apart[able][::-1])]
    return Model(forest, (int(step) + 1) / BINS)


def judge(stats: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns plus anomaly, base_failed and kept."""
    scored = _score_column(stats, model.forest, keep=list(dict.fromkeys([*keep, "n_words", "n_repeat_words"])))
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return scored.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("anomaly") <= model.threshold))


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, the base counts, base_failed, anomaly, kept) for every document.

    Null and empty texts have no words and fail the base rules; repeated rows are judged
    alike; a null doc_id is kept as null and has no label; an empty table gives no rows.
    """
    stats = stored(with_statistics(docs, keep=["doc_id"]), "statistics")
    return judge(stats, learn(stats, labels), ["doc_id", *COUNTS]).select(
        "doc_id", *COUNTS, "base_failed", "anomaly", "kept")


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with their columns."""
    stats = stored(with_statistics(docs, keep=["doc_id"]), "statistics")
    model = learn(stats, labels)
    verdict = fresh(docs, "_kept")

    def run(texts: pa.Array) -> list[pa.Array]:
        made = np.array([statistics(t.as_py()) for t in texts], np.int64).reshape(-1, len(COUNTS + MORE))
        counts = dict(zip(COUNTS + MORE, made.T))
        bad = base_failed(counts["n_words"], counts["n_repeat_words"])
        return [pa.array(~bad & (model.forest.score(features(counts)) <= model.threshold), pa.bool_())]

    judged = add_columns(docs, ["text"], [T.StructField(verdict, T.BooleanType())], run)
    return judged.where(F.col(verdict)).select(*docs.columns)


__all__ = ["Forest", "Model", "good_documents", "judge", "learn", "statistics", "verdicts", "with_statistics"]
