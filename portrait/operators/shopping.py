"""Shopping interest: label dictionaries of a three-level taxonomy, labelled
goods, training lines and the result sets of scored files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portrait.operators.ordering import segmented_index

LEVELS = (1, 2, 3)
PREFIX = "__label__"


def level_dictionary(goods: DataFrame) -> DataFrame:
    """(level, name, count, id): how many goods each category of each level has,
    numbered within its level (count desc, name asc).  One GROUPING SETS pass
    counts all levels, one sort numbers them."""
    cols = [f"category_{k}" for k in LEVELS]
    counts = (goods.groupingSets([[c] for c in cols], *cols)
              .agg(F.count(F.lit(1)).alias("count"), F.grouping_id().alias("_gid")))
    # a column that is grouped by has bit 0; the others are null
    level = F.lit(len(cols)) - F.log2(F.lit((1 << len(cols)) - 1) - F.col("_gid")).cast("int")
    named = counts.select(level.cast("bigint").alias("level"), F.coalesce(*cols).alias("name"), "count")
    return segmented_index(named, "level", [F.col("count").desc(), F.col("name").asc()], "id")


def attach_labels(goods: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``label_k = count-id`` for each level (null when unknown)."""
    out = goods
    for k in LEVELS:
        out = out.join(dictionary.where(F.col("level") == k).select(
            F.col("name").alias(f"category_{k}"),
            F.concat_ws("-", F.col("count").cast("string"), F.col("id").cast("string")).alias(f"label_{k}")),
            f"category_{k}", "left")
    return out


def _levels(labelled: DataFrame, *cols: str) -> DataFrame:
    """A labelled table with one row for each level: level, name, label."""
    rows = F.inline(F.array(*[F.struct(F.lit(k).cast("bigint").alias("level"), F.col(f"category_{k}").alias("name"),
                                       F.col(f"label_{k}").alias("label")) for k in LEVELS]))
    return labelled.select(*cols, rows)


def _count_and_id(label: Column) -> tuple[Column, Column]:
    parts = F.split(label, "-")
    two = F.size(parts) == 2
    return F.when(two, F.get(parts, F.lit(0)).try_cast("bigint")), F.when(two, F.get(parts, F.lit(1)).try_cast("bigint"))


def dictionary_of(labelled: DataFrame) -> DataFrame:
    """(level, name, count, id) read back from a labelled table: the parts of its
    ``count-id`` labels, distinct per level; labels of another form are left out."""
    count, number = _count_and_id(F.col("label"))
    return (_levels(labelled).select("level", "name", count.alias("count"), number.alias("id"))
            .where(F.col("name").isNotNull() & F.col("count").isNotNull() & F.col("id").isNotNull()).distinct())


def train_lines(labelled: DataFrame, title: str, min_support: int) -> DataFrame:
    """(level, line): ``__label__<id>, <title>`` at each level for categories with
    at least ``min_support`` goods."""
    count, number = _count_and_id(F.col("label"))
    return (_levels(labelled, title).where((count >= min_support) & number.isNotNull() & F.col(title).isNotNull())
            .select("level", F.concat(F.lit(PREFIX), number.cast("string"), F.lit(", "), F.col(title)).alias("line")))


def result_lines(lines: DataFrame) -> DataFrame:
    """Lines ``id|text|__label__<n>`` (columns level, value) of scored files ->
    level, id, text, pred, number, kept.  A line is kept with exactly three
    fields, each of two characters or more."""
    f = F.split("value", r"\|")
    field = lambda i: F.get(f, F.lit(i))
    kept = (F.size(f) == 3) & (F.length(field(0)) > 1) & (F.length(field(1)) > 1) & (F.length(field(2)) > 1)
    parts = F.split(field(2), "__")
    return lines.select(F.col("level").cast("bigint").alias("level"), field(0).alias("id"), field(1).alias("text"),
                        field(2).alias("pred"), F.when(F.size(parts) == 3, F.get(parts, F.lit(2)).try_cast("bigint")).alias("number"),
                        F.coalesce(kept, F.lit(False)).alias("kept"))


def line_counts(parsed: DataFrame) -> DataFrame:
    """(level, lines, rejected) of parsed result lines."""
    return parsed.groupBy("level").agg(F.count(F.lit(1)).alias("lines"), F.count_if(~F.col("kept")).alias("rejected"))


def result_sets(parsed: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Rows found in the result sets of all levels: id, text, and pred_k, label_k of
    each level.  All levels go through one lookup of the predicted numbers (no
    name: an empty label) and one grouping by (id, text); texts with several
    predictions at a level give every combination, as joins would."""
    names = dictionary.select("level", F.col("id").alias("number"), "name")
    named = (parsed.where("kept").join(names, ["level", "number"], "left")
             .select("level", "id", "text", F.struct("pred", F.coalesce("name", F.lit("")).alias("label")).alias("r")))
    per = named.groupBy("id", "text").agg(*[F.collect_set(F.when(F.col("level") == k, F.col("r"))).alias(f"r{k}") for k in LEVELS])
    for k in LEVELS:
        per = per.withColumn(f"r{k}", F.explode(f"r{k}"))
    return per.select("id", "text", *[F.col(f"r{k}.{c}").alias(f"{c}_{k}") for k in LEVELS for c in ("pred", "label")])
