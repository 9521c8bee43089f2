"""Daily re-runs driven by the streaming file source."""

from pyspark.sql import functions as F

from tables import SF_SMALL
from portrait.functions import dates as D
from portrait.session import scratch_path
from portrait.sources.tables import table
from portrait.streaming.daily import run_new_partitions


def daily_counts(df):
    return df.groupBy("stat_date", "event_type").agg(F.count(F.lit(1)).alias("n"))


def test_new_partitions_are_recomputed_whole(spark):
    ev = table(spark, SF_SMALL, "events").withColumn("stat_date", D.stat_date(F.col("ts")))
    src, out, ck = (scratch_path(spark, x) for x in ("landing", "daily", "stream-ckpt"))
    days = sorted(r[0] for r in ev.select("stat_date").distinct().collect())
    first, second = days[:3], days[3:5]
    ev.where(F.col("stat_date").isin(first)).write.partitionBy("stat_date").parquet(src)
    schema = spark.read.parquet(src).schema
    run_new_partitions(spark, src, schema, daily_counts, out, ck)
    got = spark.read.parquet(out)
    assert sorted(r[0] for r in got.select("stat_date").distinct().collect()) == first
    # a new day lands in two pieces; only that day is (re)computed, over all its files
    new = ev.where(F.col("stat_date").isin(second))
    new.where(F.col("event_type") == "click").write.mode("append").partitionBy("stat_date").parquet(src)
    new.where(F.col("event_type") != "click").write.mode("append").partitionBy("stat_date").parquet(src)
    run_new_partitions(spark, src, schema, daily_counts, out, ck)
    got = spark.read.parquet(out)
    expect = daily_counts(ev.where(F.col("stat_date").isin(first + second)))
    assert got.select("stat_date", "event_type", "n").exceptAll(expect).count() == 0
    assert expect.exceptAll(got.select("stat_date", "event_type", "n")).count() == 0
