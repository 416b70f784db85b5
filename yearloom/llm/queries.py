"""Registered queries of the package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.llm import (
    decontaminate, jaccard, language, negatives, packing, pages, quality, quotes, repair, sharding, token_files, vectors, word_model,
)
from yearloom.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

#: Tokenizer files lie in the folder this setting names, if it is set.
TOKENIZERS = "spark.yearloom.tokenizers"

#: Ids, segments and loss-bearing ids of a sequence.  The first id of a segment bears no loss, so the
#: third limit binds in sequences of fewer than eight segments.
PACK_LIMITS = (2048, 128, 2040)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar(table(spark, folder, "documents"))


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.interleave(table(spark, folder, "documents"), shards=16)


def tokenizer(spark: SparkSession, name: str) -> str:
    """A tokenizer file's path: in the folder the session names, else the installed package's."""
    folder = spark.conf.get(TOKENIZERS, None)
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_quotes(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.unquoted(table(spark, folder, "conversations"), unfound=True)


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer(spark, "byte_bpe_50k.json"), end=1,
                        limits=PACK_LIMITS)


def op6_word_model(spark: SparkSession, folder: str) -> DataFrame:
    return word_model.fit_and_score(table(spark, folder, "documents"))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.fit_and_label(table(spark, folder, "documents"))


def op9_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, folder, "embeddings"), threshold=0.95)


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(table(spark, folder, "documents"), tokenizer(spark, "word_bpe_49k.json"), end=2)


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    label = F.col("label").cast("long")
    return negatives.mine(rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.damage_and_repair(table(spark, folder, "conversations"))


def op13_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_sharding": op2_sharding,
    "op3_quotes": op3_quotes,
    "op4_decontamination": op4_decontamination,
    "op5_packing": op5_packing,
    "op6_word_model": op6_word_model,
    "op7_quality": op7_quality,
    "op8_language": op8_language,
    "op9_vectors": op9_vectors,
    "op10_token_files": op10_token_files,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_page_text": op13_page_text,
}
