"""Table access and partition scans.

Real deployments store each table as Parquet partitioned by ``stat_date``
(``yyyyMMdd`` bigint) or by an hourly string ``yyyyMMddHH``; the scans below
filter on the partition column so Spark prunes partitions.  For tables that
carry an event timestamp instead (the test tables), the same scans are
expressed as a timestamp range so the predicate reaches the Parquet reader as
a pushed filter.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portrait.functions import dates

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _as_date(day) -> _dt.date:
    if isinstance(day, _dt.date):
        return day
    s = str(day)
    return _dt.date(int(s[0:4]), int(s[4:6]), int(s[6:8]))


def scan_partition(df: DataFrame, day, partition_col: str = "stat_date") -> DataFrame:
    """One daily partition: ``stat_date = d`` (partition pruning)."""
    return df.where(F.col(partition_col) == F.lit(int(_as_date(day).strftime("%Y%m%d"))))


def scan_hour_prefix(df: DataFrame, day, partition_col: str = "stat_hour") -> DataFrame:
    """Hourly string partitions of one day; ``like 'd%'`` written as a range so
    both pruning and min/max statistics apply."""
    d = _as_date(day)
    lo = d.strftime("%Y%m%d") + "00"
    hi = (d + _dt.timedelta(days=1)).strftime("%Y%m%d") + "00"
    c = F.col(partition_col)
    return df.where((c >= lo) & (c < hi))


def ts_day_slice(df: DataFrame, ts_col: str, day) -> DataFrame:
    """Daily scan for tables keyed by a timestamp: ``[d, d+1)`` on the raw
    column (pushed to Parquet) plus the derived ``stat_date`` column."""
    d = _as_date(day)
    return ts_range_slice(df, ts_col, d, d + _dt.timedelta(days=1))


def ts_range_slice(df: DataFrame, ts_col: str, start, end) -> DataFrame:
    # string literals: independent of the session and driver time zones
    lo = F.lit(_as_date(start).isoformat() + " 00:00:00").cast("timestamp_ntz")
    hi = F.lit(_as_date(end).isoformat() + " 00:00:00").cast("timestamp_ntz")
    c = F.col(ts_col)
    return (df.where((c >= lo) & (c < hi))
            .withColumn("stat_date", dates.stat_date(c)))


def latest_partition(df: DataFrame, partition_col: str = "stat_date") -> DataFrame:
    """Rows of the newest partition.  The max is a scalar subquery planned by
    Spark (no driver round trip in user code)."""
    return df.where(F.col(partition_col) == df.select(F.max(partition_col)).scalar())


def with_partition_cols(df: DataFrame, ts: Column) -> DataFrame:
    """Derive ``stat_date`` (yyyyMMdd bigint) and ``stat_hour`` (yyyyMMddHH)."""
    return (df.withColumn("stat_date", dates.stat_date(ts))
              .withColumn("stat_hour", F.date_format(ts, "yyyyMMddHH")))


def latest_partition_of_table(spark: SparkSession, table_name: str, partition_col: str = "stat_date") -> DataFrame:
    """Newest partition of a catalog table from partition metadata
    (``SHOW PARTITIONS``): no data file is opened to find it, and the value is
    applied as a literal so the scan prunes to that one partition."""
    parts = spark.sql(f"SHOW PARTITIONS {table_name}")
    value = F.regexp_extract(F.col("partition"), f"(?:^|/){partition_col}=([^/]+)", 1)
    latest = parts.select(F.max(value.cast("bigint"))).first()[0]
    return spark.table(table_name).where(F.col(partition_col) == F.lit(latest))


def write_bucketed(df: DataFrame, table_name: str, key: str, buckets: int, path: str) -> DataFrame:
    """Store ``df`` as a Parquet table bucketed and sorted by ``key``.  Two
    tables bucketed on the join key with the same bucket count are joined
    without a shuffle (e.g. orders and lineitem on the order key, the join
    behind every install-list job)."""
    (df.write.mode("overwrite").option("path", path)
       .bucketBy(buckets, key).sortBy(key).saveAsTable(table_name))
    return df.sparkSession.table(table_name)
