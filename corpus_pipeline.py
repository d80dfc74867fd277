"""A training-corpus pipeline: five stages, each written as Parquet and read again.

Every stage works on all its predecessor kept. The first four return the columns of
documents; the last packs what is left into sequences.

Stages take any rows: nulls in any column, empty and very long texts, rows that repeat,
columns with names the operators use inside, and empty tables, which stay empty. Repeated
rows are judged alike, each for itself, but for near-dedup, where one of them stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hazeframe.llm import decontam, langid, packing, quality, simhash
from hazeframe.llm.common import stored, table
from hazeframe.llm.queries import tokenizer_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told stay; those without text or letters go. Without
    any labelled language, every document with a letter stays."""
    return langid.in_known_language(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are not anomalous stay; null and empty texts fail
    the rules. Without labels only the rules decide."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest doc_id,
    once; rows without doc_id stay unchanged."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item stay, null and empty texts among them. An empty
    benchmark lets all stay."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, each with its sequence and offset; a null or empty text is one
    piece, its end id. Equal pieces are packed each for itself."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language", language),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: Tokenizers and learned models can't be stated in SQL; the tests use a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
