"""Rows that every corpus operator has to cope with."""

from pyspark.sql import types as T

SENTENCE = "the quick brown fox jumps over the lazy dog while seven small birds watch from an old stone wall"
LONG = " ".join(f"word{i % 977} other{i % 13}" for i in range(40_000))
ROWS = [
    (1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (None, SENTENCE, "en"), (4, SENTENCE, "en"),
    (5, LONG, "en"), (6, SENTENCE, "fr"), (6, SENTENCE, "fr"), (7, "12 34 !!", "de"), (8, "Été à la plage\nÉté à la plage", "fr"),
    (9, "single", "en"), (10, "日本語 の 文章", None), (11, SENTENCE.upper(), "en"), (None, None, None),
]
#: Columns whose names clash with those the operators use inside or return.
CLASH = ("fp", "size", "key", "group", "shard", "slot", "terms", "score", "leaks", "length", "offset", "_part", "kept",
         "lang_pred", "component_id", "n_words", "_kept", "anomaly")
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in CLASH])


def odd_docs(spark, rows=ROWS):
    return spark.createDataFrame([(d, t, lang, None, len(t or ""), *["x"] * len(CLASH)) for d, t, lang in rows], SCHEMA)


def no_docs(spark):
    return odd_docs(spark, [])


def ids(df):
    return sorted((r["doc_id"] for r in df.collect()), key=lambda d: (d is not None, d))


ALL_IDS = sorted((r[0] for r in ROWS), key=lambda d: (d is not None, d))
