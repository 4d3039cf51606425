"""From raw documents to packed training sequences: the stages in order.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents that the one before kept.  All but the last return
the columns of ``documents``; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weighted_insights.llm import fertility, hyperminhash, linecrf, packing, pii
from weighted_insights.storage import new_path, remove, scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule on words, symbols, repetition or tokeniser fertility rejects."""
    return fertility.keep_documents(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines look good.  The model learns from the raw documents, as the rules leave hardly any bad ones."""
    raw = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return linecrf.keep_documents(docs, linecrf.train(raw, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles: that of smallest id."""
    return hyperminhash.keep_one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; ``n_chars`` follows."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their ids and a checksum of them."""
    return packing.pack_documents(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("pack", pack),
]

#: Models and tokenizers cannot be told in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a Parquet table that the next stage reads.

    What a stage wrote for itself, and the table that it read, are removed when its result is written; the input of the
    last stage stays, as the result is read from it.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        with scratch():
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.schema(made.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
