"""The corpus queries: each applies its operator to a whole table and derives the columns
of its result contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe.llm import (decontam, idfiles, langid, licenses, mixing, negatives, oracles, packing, quality, repair, sharding,
                           simhash, toxicity, warc)
from hazeframe.llm.common import table


def tokenizer_path(name: str) -> str:
    """Path of a public tokenizer file; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item it leaks, at 80 % word edit similarity."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages")), with_payload=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(table(spark, sf_dir, "documents"))


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = idfiles.read_ids(idfiles.write_ids(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(table(spark, sf_dir, "documents")).taken()


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair.all_conversations(rows, repair.repair(repair.damage(rows))[0])


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found, _ = negatives.mine(rows.select("vec_id", moved.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_decontamination, op2_simhash, op3_packing, op4_warc, op5_toxicity, op6_licenses, op7_language,
        op8_token_ids, op9_quality, op10_sharding, op11_mixing, op12_repair, op13_negatives)}
ORACLES: dict[str, str] = {
    "op4_warc": oracles.WARC, "op6_licenses": oracles.licenses_sql(), "op11_mixing": oracles.MIXING, "op12_repair": oracles.repair_sql(),
    "op13_negatives": oracles.NEGATIVES}
