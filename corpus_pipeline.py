"""The training-data pipeline: every stage is one operator of ``ledgerloom.llm`` over all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import decontaminate, line_dedup, mixing, ngram_join, quality
from ledgerloom.llm.common import WORD


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of documents still here."""
    return quality.keep_good(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that occurred before; a document that was nothing else goes."""
    found = line_dedup.drop_repeated_lines(docs)
    found = found.filter((F.col("n_removed") == 0) | F.col("text").rlike(WORD))
    # the count of characters follows the text where lines went
    count = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.withColumn("n_chars", count).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: runs of five words, similarity 0.8."""
    return ngram_join.drop_near_duplicates(docs, words=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: which documents are taken, how often, and the words that makes."""
    found = mixing.mix(docs, F.regexp_count("text", F.lit(WORD)), mixing.quality_weight("text"))
    return found.filter("copies > 0")


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
]

# a trained classifier and hashed draws are no SQL; the tests check every stage against plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, in order."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
