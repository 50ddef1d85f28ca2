"""From raw documents to packed token rows: the stages of the corpus pipeline.

Every stage takes all rows its predecessor kept and returns the columns of
``documents``, the last one packed rows.

1. ``language``: rows without a language (no letter), where the predicted one is
   less likely than not, or whose text is far less likely per byte than the labelled
   texts of that language, go.
2. ``near_duplicates``: of documents that word 5-shingles link at a Jaccard
   similarity of 0.8 or more, directly or through others, the smallest id stays.
3. ``decontaminate``: documents that hold a benchmark passage go.
4. ``mix``: sources are taken to their target weights; a row taken twice is
   there twice.
5. ``pack``: token ids in rows of 2048.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, langid, mixing, nearjoin, packing
from tidemark.session import materialize

#: A prediction that is less likely than this is a rejection.
MIN_LANGUAGE_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs)
    # written once: the usual scores are of all labelled rows, and every text is scored once
    scored = materialize(langid.predict(docs, model, out="__language", measured=True), "lang-scores")
    sure = langid.in_language(F.col("__language"), langid.usual_scores(scored), MIN_LANGUAGE_SCORE)
    return scored.where(sure).drop("__language")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nearjoin.one_of_each(docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("mix", mix), ("pack", pack)]

#: Language scoring and tokenization have no SQL form; tests/llm checks the
#: pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
