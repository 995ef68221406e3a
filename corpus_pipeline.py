"""The training-data pipeline: each stage works on the documents that its predecessor kept.

``STAGES`` lists (name, function) pairs; each function takes (spark, docs, sf_dir) and
returns a DataFrame: the documents that stay, with all their columns, and from the last
stage the packing. ``run`` applies them in turn, each on the written result of the one
before, so that a lost executor costs at most a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.lineage import materialise
from millrace.llm import decontam, exactdedup, jaccard, langid, packing
from millrace.llm.queries import remainder


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with words in a language of the corpus, and enough of them in one."""
    return langid.keep_known(docs, langid.fit(docs, remainder(F.col("doc_id"), 3) != 1))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of those with equal texts."""
    return exactdedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of those that links of similar shingles join."""
    return jaccard.drop_near(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten words in a row of the benchmark."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of the documents goes."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

# Language labels and packing can't be expressed in SQL; the tests have a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
