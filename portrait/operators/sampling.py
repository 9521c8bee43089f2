"""Deterministic sampling and splitting by id hash (stable under
re-partitioning and task retries, unlike row-order based sampling)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def hash_unit(id_col: Column) -> Column:
    """md5 of the id mapped to [0, 1)."""
    h = F.substring(F.md5(id_col.cast("string")), 1, 8)
    return F.conv(h, 16, 10).cast("double") / F.lit(4294967296.0)


def hash_split(id_col: Column, threshold_hex: str = "cccccccc", left: str = "train", right: str = "valid") -> Column:
    """``md5(id)[0:8] < threshold`` -> left (0.8 for 'cccccccc')."""
    return F.when(F.substring(F.md5(id_col.cast("string")), 1, 8) < F.lit(threshold_hex), F.lit(left)) \
        .otherwise(F.lit(right))


def per_group_sample(df: DataFrame, group: str, order: Column, n: int) -> DataFrame:
    """At most ``n`` rows per group, the first by ``order``.  The rank filter
    is planned with a per-partition group limit before the shuffle, so a huge
    group sends only ``n`` rows per map task."""
    w = Window.partitionBy(group).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def balance_classes(df: DataFrame, id_col: str, label: str) -> DataFrame:
    """Downsample every class to the minority size (in expectation): keep a
    row when hash(id) < min_count / class_count.  Class counts are one
    aggregate over a handful of rows, joined back by broadcast."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    frac = counts.select(label, (F.min("_n").over(Window.partitionBy()) / F.col("_n")).alias("_f"))
    j = df.join(frac, label)
    return j.where(hash_unit(F.col(id_col)) < F.col("_f")).drop("_f")


def downsample(df: DataFrame, id_col: str, label: str, fractions: dict) -> DataFrame:
    """Keep a class-dependent fraction by id hash (e.g. {0: 0.1, 1: 1.0})."""
    f = F.lit(1.0)
    for k, v in fractions.items():
        f = F.when(F.col(label) == k, F.lit(float(v))).otherwise(f)
    return df.where(hash_unit(F.col(id_col)) < f)


def min_support(df: DataFrame, cls: str, threshold: int) -> DataFrame:
    """Classes with at least ``threshold`` rows."""
    return df.groupBy(cls).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= threshold)
