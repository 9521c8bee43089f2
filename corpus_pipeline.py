"""Corpus pipeline: five stages over ``documents``, each written as Parquet and
read again as the next one's input.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame.  All but the last return the columns of ``documents``.
``n_chars`` follows the text where a stage changes it.

Defined cases: null, empty and white texts fail the quality rules, so the first
stage drops them; rows without an id take part by their texts and end with a null
id; of equal rows and of copies one row stays; very long texts are one row
throughout; an empty table gives an empty result; further columns, whatever their
names, come through all stages but the last unread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portrait.llm import decontaminate, ngram_join, quality_rules, sentencepiece_codec, suffix_dedup
from portrait.llm.queries import VOCABULARY
from portrait.llm.ship import ship
from portrait.session import scratch_path

# Length of a repeated passage: fifty words of four letters and a blank.
PASSAGE_BYTES = 250


def _counted(before: DataFrame, after: DataFrame) -> DataFrame:
    """``after`` with n_chars (where there is such a column) of its text."""
    if "n_chars" not in before.columns:
        return after
    return after.withColumn("n_chars", F.length("text").cast(before.schema["n_chars"].dataType)).select(before.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without boilerplate lines."""
    return _counted(docs, quality_rules.clean(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts."""
    ship(spark)
    return ngram_join.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of PASSAGE_BYTES that also stand elsewhere."""
    ship(spark)
    return _counted(docs, suffix_dedup.remove(docs, length=PASSAGE_BYTES))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    ship(spark)
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents."""
    ship(spark)
    return sentencepiece_codec.encode(docs, sentencepiece_codec.Vocabulary.load(VOCABULARY))


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates),
          ("suffix-array dedup", repeated_passages), ("benchmark decontamination", decontaminated),
          ("SentencePiece encoding", encoded)]

ORACLE_SQL = None          # SentencePiece and the removal of byte strings have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
