"""Queries of the operators over the test tables, by registered name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portrait.llm import (
    chat_format,
    decontaminate,
    license_scan,
    lm_score,
    ngram_join,
    periodic_runs,
    quality_classifier,
    quality_rules,
    sentencepiece_codec,
    simhash,
    suffix_dedup,
    url_filter,
    whitening,
)
from portrait.llm.ship import ship

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# URL rules of the query (fixed values): verdict, host, path
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_decontaminate(spark, sf):
    found = decontaminate.scan(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query
def op2_sentencepiece(spark, sf):
    return sentencepiece_codec.encode(table(spark, sf, "documents"), sentencepiece_codec.Vocabulary.load(VOCABULARY))


@query
def op3_quality_rules(spark, sf):
    return quality_rules.judge(table(spark, sf, "documents")).select(
        "doc_id", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_words",
        "n_line_words")


@query
def op4_ngram_join(spark, sf):
    return ngram_join.join(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op5_license_scan(spark, sf):
    return license_scan.scan(table(spark, sf, "documents"))


@query
def op6_chat_format(spark, sf):
    text = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                F.lit(text).alias("text"))
    rows = table(spark, sf, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                                                    "role", "text")
    return chat_format.digest(chat_format.conversations(rows.unionByName(own)))


@query
def op7_url_filter(spark, sf):
    """A page's outcome is the label of the document with its number: bad when
    it is toxic or of low quality."""
    outcomes = table(spark, sf, "labels").select(F.col("doc_id").alias("page_id"),
                                                 ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return url_filter.judge(table(spark, sf, "pages"), outcomes, RULES).select(
        "page_id", "host", "path", "rule", "verdict")


@query
def op8_suffix_dedup(spark, sf):
    return suffix_dedup.report(table(spark, sf, "documents"))


@query
def op9_quality_classifier(spark, sf):
    docs = table(spark, sf, "documents")
    return quality_classifier.score(docs, quality_classifier.train(docs, table(spark, sf, "labels")))


@query
def op10_lm_score(spark, sf):
    return lm_score.score(table(spark, sf, "documents"))


@query
def op11_periodic_runs(spark, sf):
    """A tenth of the texts get a planted repetition first."""
    return periodic_runs.report(table(spark, sf, "documents"), plant=True).drop("n_words")


@query
def op12_simhash(spark, sf):
    return simhash.join(table(spark, sf, "documents"))


@query
def op13_whitening(spark, sf):
    return whitening.whiten(table(spark, sf, "embeddings"))


@query
def pipeline(spark, sf):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf)
