"""Corpus pipeline over ``documents``: quality classifier, language id, n-gram
Jaccard join, benchmark decontamination, best-fit packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. Every stage's result is written as Parquet and reread as
the next stage's ``docs``. All stages but the last keep the documents' columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martlake.llm import decontam, jaccard, langid, packing, quality
from martlake.llm.queries import tokenizer_path
from martlake.llm.text import scratch, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language."""
    return langid.keep_language(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five-word shingles, similarity 0.8."""
    return jaccard.keep_one(docs, n=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents, packed into sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("quality", good_quality), ("language", known_language), ("near-duplicates", one_of_each),
          ("decontamination", decontaminated), ("packing", packed)]

#: no stage can be expressed in SQL as a whole; each is tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
