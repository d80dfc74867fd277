"""Language identification by rank-order n-gram profiles (operator 7).

A profile lists the most frequent letter n-grams (one to three letters, ``_`` for a word
border) by rank. A document is ranked the same way; the language whose profile has the
smallest out-of-place distance to it wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeframe.llm.common import add_columns, fresh, in_tasks, remainder, stored

#: n-grams of a profile, and of a document that are compared with it.
PROFILE_GRAMS = 300
#: Expected training documents per language: those with the smallest hashes of doc_id.
SAMPLE_PER_LANGUAGE = 3000
HELD_OUT, FOLDS = 2, 4
#: Languages up to which their counts are broadcast; beyond, texts are shuffled by language.
BROADCAST_LANGUAGES = 10_000
UNKNOWN = "und"
_BORDER = 0x5F
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether a code point is a letter; made once per worker."""
    global _letters
    if _letters is None:
        _letters = np.array([chr(i).isalpha() for i in range(0x33480)])
    return _letters


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, counts) of a whole text. An n-gram of code points a, b, c is the number
    a << 42 | b << 21 | c, missing leading ones being 0. No letter gives none."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    known = letters()
    letter = known[np.minimum(points, len(known) - 1)] & (points < len(known))
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # runs of other characters become one border; one border at either end
    line = np.concatenate([[_BORDER], np.where(letter, points, _BORDER), [_BORDER]])
    border = line == _BORDER
    keep = ~border | np.append(True, ~border[:-1])
    line, border = line[keep], border[keep]
    pair = line[:-1] << 21 | line[1:]
    triple = pair[:-1] << 21 | line[2:]
    grams = np.concatenate([line[~border], pair, triple[~border[1:-1]]])
    return np.unique(grams, return_counts=True)


def top_grams(text: str | None, most: int = PROFILE_GRAMS) -> np.ndarray:
    """The most frequent n-grams in order of rank; ties by the n-gram's number."""
    grams, counts = gram_counts(text)
    if len(counts) > most:
        # only counts that reach the last place need sorting
        least = np.partition(counts, len(counts) - most)[len(counts) - most]
        some = counts >= least
        grams, counts = grams[some], counts[some]
    return grams[np.lexsort((grams, -counts))[:most]]


class Profiles:
    """Ranks of all profiles side by side, small enough for every task:
    languages x PROFILE_GRAMS numbers."""

    def __init__(self, ranked: dict[str, list[int]], size: int = PROFILE_GRAMS):
        self.names, self.size = sorted(ranked), size
        self.grams = np.unique(np.array([g for v in ranked.values() for g in v], np.int64))
        self.ranks = np.full((len(self.names), len(self.grams) + 1), -1, np.int64)
        for k, name in enumerate(self.names):
            at = np.searchsorted(self.grams, ranked[name])
            self.ranks[k, at] = np.arange(len(at))

    def distances(self, top: np.ndarray) -> np.ndarray:
        """Out-of-place distance to each language: an n-gram that a profile lacks counts
        ``size`` places, any other the places it is off."""
        at = np.searchsorted(self.grams, top)
        at[at < len(self.grams)] = np.where(
            self.grams[at[at < len(self.grams)]] == top[at < len(self.grams)], at[at < len(self.grams)], len(self.grams))
        ranks = self.ranks[:, at]
        off = np.abs(ranks - np.arange(len(top)))
        return np.where(ranks < 0, self.size, np.minimum(off, self.size)).sum(axis=1)

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score). The score is the lead of the best language over the next,
        as a share of the next one's distance; over none with a single language. Ties go
        to the first name."""
        top = top_grams(text, self.size)
        if not len(top) or not self.names:
            return UNKNOWN, 0.0
        distances = self.distances(top)
        order = np.argsort(distances, kind="stable")
        best = float(distances[order[0]])
        other = float(distances[order[1]]) if len(order) > 1 else float(self.size * len(top))
        return self.names[order[0]], (other - best) / other if other else 0.0


def learn(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, size: int = PROFILE_GRAMS,
          held_out: bool = True) -> Profiles:
    """Profiles from the documents with a language and a text, leaving out those whose
    crc32(doc_id as text) mod 4 is 2 (``held_out``) and those without doc_id.

    Languages are counted over all rows; of each, an expected ``per_language`` documents
    are used, chosen by a hash of doc_id (all, where there are fewer). Only the profiles
    reach the driver.
    """
    rows = docs.where("lang is not null and text is not null and doc_id is not null").select(
        "doc_id", F.col("lang").cast("string").alias("lang"), "text")
    if held_out:
        rows = rows.where(remainder("doc_id", FOLDS) != HELD_OUT)
    sizes = stored(rows.groupBy("lang").agg(F.count("*").alias("_n")), "languages")
    if sizes.count() <= BROADCAST_LANGUAGES:
        sizes = F.broadcast(sizes)
    spread = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 30))
    chosen = rows.join(sizes, "lang").where(spread * F.col("_n") < F.lit(per_language * (1 << 30))).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1)
            parts = []
            for i, lang in enumerate(langs):
                grams, counts = gram_counts(texts[i].as_py())
                parts.append(pd.DataFrame({"lang": lang, "gram": grams, "n": counts}))
                if len(parts) >= 200 or i == len(langs) - 1:
                    summed = pd.concat(parts).groupby(["lang", "gram"], as_index=False)["n"].sum()
                    yield pa.RecordBatch.from_pandas(summed.astype({"gram": "int64", "n": "int64"}), preserve_index=False)
                    parts = []

    counts = in_tasks(chosen, run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= size)
    ranked: dict[str, list[int]] = {}
    for lang, gram, _ in sorted(top.select("lang", "gram", "rank").collect(), key=lambda r: (r[0], r[2])):
        ranked.setdefault(lang, []).append(gram)
    return Profiles(ranked, size)


def identify(docs: DataFrame, profiles: Profiles, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All rows and columns plus lang_pred and score (0 to 1), under ``names``; clashing
    columns are replaced.

    Only the text is read: ``und`` with score 0 if it is null, has no letter, or nothing
    was learned. Repeated rows are judged alike.
    """
    def run(texts: pa.Array) -> list[pa.Array]:
        made = [profiles.predict(t.as_py()) for t in texts]
        return [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())]

    fields = [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    return add_columns(docs, ["text"], fields, run)


def predictions(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every document; held_out is null for a
    null doc_id."""
    profiles = learn(docs)
    return identify(docs.select("doc_id", "text"), profiles).select(
        "doc_id", (remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")


def in_known_language(docs: DataFrame) -> DataFrame:
    """The documents in a language that could be told, with their columns: those whose
    prediction is not ``und``. If no row has a language to learn from, all that have a
    letter stay."""
    profiles = learn(docs)
    if not profiles.names:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    names = fresh(docs, "lang_pred"), fresh(docs, "score")
    return identify(docs, profiles, names).where(F.col(names[0]) != UNKNOWN).select(*docs.columns)


