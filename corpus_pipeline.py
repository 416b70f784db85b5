"""From raw documents to packed sequences: the stages and how they are run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from yearloom.llm import decontaminate, jaccard, language, packing, quality
from yearloom.llm.queries import PACK_LIMITS, table, tokenizer
from yearloom.session import scratch_path


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID (operator 8): documents without letters or without a main language go."""
    model = language.fit(docs.where(~language.learning_fold()))
    return language.keep_identified(docs, model)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier (operator 7): documents unlike trusted text go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (operator 1): the smallest doc_id of each class stays."""
    return jaccard.one_per_class(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (operator 4): benchmark passages are cut out."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing (operator 5): token sequences of at most 2048 ids."""
    return packing.pack(docs, tokenizer(spark, "byte_bpe_50k.json"), end=1, limits=PACK_LIMITS)


STAGES = [
    ("language", identified),
    ("quality", good),
    ("jaccard", distinct),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: No SQL: the language model and the Viterbi labels have no counterpart there.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
