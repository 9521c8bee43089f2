"""The distributed index / running totals must equal a single-window result
also when the data really spans many partitions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from portrait.operators.ordering import global_index, running_totals


def test_global_index_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 5000, numPartitions=7).select(((F.col("id") * 7919) % 1000).alias("v"), "id")
        got = global_index(df, [F.col("v").desc(), F.col("id").asc()])
        ref = df.withColumn("ref", F.row_number().over(Window.orderBy(F.col("v").desc(), F.col("id").asc())) - 1)
        j = got.join(ref, "id")
        assert j.where(F.col("idx") != F.col("ref")).count() == 0
        assert got.select(F.countDistinct("idx")).first()[0] == 5000
        assert got.rdd.getNumPartitions() >= 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_running_totals_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 3000, numPartitions=5).select("id", (F.col("id") % 3).cast("double").alias("x"))
        got = running_totals(df, [F.col("id").asc()], ["x"])
        ref = df.withColumn("ref", F.sum("x").over(Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)))
        assert got.join(ref, "id").where(F.col("cum_x") != F.col("ref")).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
