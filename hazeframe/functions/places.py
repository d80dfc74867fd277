"""Match free-text place names to a gazetteer of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeframe.session import stored

#: Longest run of characters by which names are looked up.
GRAM = 3
#: Names, and words, of one run that meet in one task.
CELL = 2000


def _words(c: Column) -> Column:
    """Lower-case words; hyphens separate words."""
    return F.filter(F.split(F.lower(F.regexp_replace(c, "-", " ")), r"\s+"), lambda w: w != "")


def _runs(name: Column, n: int) -> Column:
    """Every run of ``n`` characters; one run for a shorter text."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(name) - (n - 1), F.lit(1)))
    return F.transform(starts, lambda i: F.substring(name, i, F.lit(n)))


def _grams(name: Column) -> Column:
    """Every run of 1 to GRAM characters of a name, each once."""
    return F.array_distinct(F.concat(*[_runs(name, n) for n in range(1, GRAM + 1)]))


def _probes(word: Column) -> Column:
    """The runs that a name has to hold to contain the word."""
    return F.array_distinct(F.when(F.length(word) > GRAM, _runs(word, GRAM)).otherwise(F.array(word)))


def word_hits(words: DataFrame, names: DataFrame, cell: int = CELL) -> DataFrame:
    """Every pair of a word (``_w``) and a name (``_name``, ``_low``) that contains it.

    A word is looked up by its rarest run of characters alone. Names that share a run,
    and words that probe it, are cut into cells of about ``cell``, so the pairs of a run
    spread over tasks: a cell of names meets every cell of words of its run once.
    """
    held = stored(names.select("_name", "_low", F.explode(_grams(F.col("_low"))).alias("_g")), "grams")
    counts = held.groupBy("_g").agg(F.count("*").alias("_names"))
    probes = words.select("_w", F.explode(_probes(F.col("_w"))).alias("_g"))
    rarest = (probes.join(counts, "_g", "left").groupBy("_w")  # a run no name holds rules the word out
              .agg(F.min(F.struct(F.coalesce("_names", F.lit(0)).alias("_names"), "_g")).alias("_r")).where("_r._names > 0")
              .select("_w", F.col("_r._g").alias("_g")))
    rarest = stored(rarest, "probes")
    cells = rarest.groupBy("_g").agg(F.count("*").alias("_words")).join(counts, "_g").select(
        F.col("_g").alias("_k"), F.ceil(F.col("_names") / cell).cast("int").alias("_i"), F.ceil(F.col("_words") / cell).cast("int").alias("_j"))

    def dealt(rows: DataFrame, by: str, mine: str, other: str) -> DataFrame:
        own = F.pmod(F.xxhash64(by), F.col(mine).cast("long")).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        met = rows.join(cells, F.col("_g") == F.col("_k")).drop("_k")
        return met.withColumn(f"{mine}c", own).withColumn(f"{other}c", every).drop("_i", "_j")

    left = dealt(rarest, "_w", "_j", "_i")
    right = dealt(held, "_name", "_i", "_j").withColumnsRenamed({"_g": "_k", "_ic": "_ik", "_jc": "_jk"})
    same = (F.col("_g") == F.col("_k")) & (F.col("_ic") == F.col("_ik")) & (F.col("_jc") == F.col("_jk"))
    return left.join(right, same & F.col("_low").contains(F.col("_w"))).select("_w", "_name")


def match_places(df: DataFrame, query: str, places: DataFrame, name: str, out: str = "place") -> DataFrame:
    """Add the best place name for each query, or null.

    An exact name wins, then the same name in another case, then the name that contains
    most words of the query. Ties go to the greatest name. Each distinct query, word and
    name is looked up once, words by ``word_hits``.
    """
    asked = df.select(F.col(query).alias("_q")).where("_q is not null").distinct()
    names = places.select(F.col(name).alias("_name")).where("_name is not null").distinct()
    folded = names.withColumn("_low", F.lower("_name"))
    words = stored(asked.select("_q", F.explode(_words(F.col("_q"))).alias("_w")).groupBy("_q", "_w").agg(F.count("*").alias("_n")), "words")
    hits = word_hits(words.select("_w").distinct(), folded).select(F.col("_w").alias("_v"), "_name")
    contained = words.join(hits, F.col("_w") == F.col("_v")).groupBy("_q", "_name").agg(F.sum("_n").alias("_score"))
    same = asked.join(folded, F.lower("_q") == F.col("_low")).select(
        "_q", "_name", F.when(F.col("_q") == F.col("_name"), 2).otherwise(1).alias("_level"), F.lit(0).cast("long").alias("_score"))
    every = contained.select("_q", "_name", F.lit(0).alias("_level"), "_score").unionByName(same)
    best = every.groupBy("_q").agg(F.max(F.struct("_level", "_score", "_name")).alias("_b"))
    # an exact or folded hit also counts the words it contains, which only breaks ties
    found = best.select(F.col("_q"), F.col("_b._name").alias(out))
    return df.join(found, F.col(query) == F.col("_q"), "left").drop("_q")
