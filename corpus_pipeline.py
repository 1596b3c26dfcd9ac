"""The corpus pipeline: quality rules, language, exact and near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet in the shared folder and hands the table to the next.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthscore.llm import exact_dedup, langid, line_quality, packing, simhash
from hearthscore.llm.common import fresh
from hearthscore.session import stage_table

MIN_LANGUAGE_SHARE = 0.5  # of a text's letters, in its main language


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects short, repetitive and depleted documents; frequent lines go from the others.

    Null texts are rejected as short; null sources form one host.
    """
    return line_quality.filter_documents(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language or without one that holds half of the letters.

    Null texts and texts without a letter have none; null labels teach nothing.
    """
    model = langid.fit(docs.where(~langid.is_held_out(F.col("doc_id"))), "text", "lang")
    (found,) = fresh(docs, "_found")
    labelled = docs.withColumn(found, langid.language_of(model, F.col("text")))
    wanted = (F.col(found)["lang"] != "und") & (F.col(found)["score"] >= MIN_LANGUAGE_SHARE)
    return labelled.where(wanted).drop(found)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays; a null text counts as empty."""
    return exact_dedup.drop_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts whose SimHash fingerprints are linked, the smallest id stays.

    Shingles of four words and at most four differing bits, as the operator's
    query; null and empty texts are one group.
    """
    return simhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in length buckets and token-budget batches; null texts are empty."""
    sized = docs.select("doc_id", packing.word_count("text").alias("n_tokens"))
    return packing.pack(sized, "doc_id", "n_tokens")


STAGES = [
    ("quality", quality),
    ("language", language),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("packing", pack),
]

# The stages learn models and follow links, which SQL cannot express; the tests
# hold the operators behind the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
