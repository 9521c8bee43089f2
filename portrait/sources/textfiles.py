"""Delimited text sources: ``k##v`` alias files, TSV label dictionaries,
``a|b|c`` scored lines.  All are read with ``spark.read.text`` / ``csv`` and
parsed with built-in expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines_in_order(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with a total order equal to file order: (file path, block
    start, position inside the block).  Positions come from the scan itself,
    so the order survives any later shuffle."""
    return spark.read.text(path).select(
        "value",
        F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                 F.monotonically_increasing_id()).alias("line_order"))


def load_alias_map(spark: SparkSession, path: str, sep: str = "##") -> DataFrame:
    """``alias##canonical`` lines, lower-cased; when an alias repeats, the
    last line wins.  Lines without the separator are skipped."""
    lines = read_lines_in_order(spark, path)
    parts = F.split(F.col("value"), sep, 3)
    kv = lines.where(F.size(parts) >= 2).select(
        F.lower(parts[0]).alias("alias"), F.lower(parts[1]).alias("canonical"), "line_order")
    return kv.groupBy("alias").agg(F.max_by("canonical", "line_order").alias("canonical"))


def load_label_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """TSV ``name<TAB>count<TAB>id``; only well-formed 3-field lines kept."""
    raw = spark.read.text(path)
    parts = F.split(F.col("value"), "\t")
    return raw.where(F.size(parts) == 3).select(
        parts[0].alias("name"), (parts[1]).try_cast("bigint").alias("count"),
        (parts[2]).try_cast("bigint").alias("id")).where(F.col("count").isNotNull() & F.col("id").isNotNull())


def parse_scored_lines(spark: SparkSession, path: str, prefix: str = "__label__") -> DataFrame:
    """``id|__label__l1,p1|__label__l2,p2`` lines -> (id, label_1, prob_1,
    label_2, prob_2).  Lines without exactly three fields, empty labels or
    unparsable probabilities are dropped; duplicates removed."""
    raw = spark.read.text(path)
    f = F.split(F.col("value"), r"\|")
    ok = raw.where(F.size(f) == 3).select(f[0].alias("id"), f[1].alias("a"), f[2].alias("b"))

    def part(c, i):
        s = F.split(c, ",")
        return F.when((F.length(c) > 1) & (F.size(s) == 2), s[i])

    def label(c):
        v = part(c, 0)
        return F.when(F.startswith(v, F.lit(prefix)), F.substring(v, len(prefix) + 1, 1 << 30)).otherwise(v)

    out = ok.select("id", label(F.col("a")).alias("label_1"),
                    (part(F.col("a"), 1)).try_cast("double").alias("prob_1"),
                    label(F.col("b")).alias("label_2"),
                    (part(F.col("b"), 1)).try_cast("double").alias("prob_2"))
    valid = ((F.length("id") > 1) & (F.length("label_1") > 1) & F.col("prob_1").isNotNull() &
             (F.col("prob_1") != -1.0) & (F.length("label_2") > 1) & F.col("prob_2").isNotNull() &
             (F.col("prob_2") != -1.0))
    return out.where(valid).distinct()
