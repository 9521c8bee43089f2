"""Sinks: dated-partition overwrite, guarded writes, ready markers, line exports.

Writes go to paths the caller passes (on a cluster: the shared warehouse or
the folder named in ``spark.checkpoint.dir``), never to machine-local temp."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portrait.session import freeze


def overwrite_partitions(df: DataFrame, path: str, partition_col: str = "stat_date") -> None:
    """Write ``df`` partitioned by its own ``partition_col``; only the
    partitions present in ``df`` are replaced (dynamic overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_col).parquet(path))


def overwrite_partition(df: DataFrame, path: str, job_date: int | None,
                        partition_col: str = "stat_date") -> None:
    """Replace one ``stat_date`` partition with ``df`` (create the table if
    missing), or the whole dataset when ``job_date`` is None.  Rows that carry
    ``stat_date`` themselves go to their own partitions, never to another day's."""
    if job_date is None:
        df.write.mode("overwrite").parquet(path)
        return
    if partition_col not in df.columns:
        df = df.withColumn(partition_col, F.lit(int(job_date)).cast("bigint"))
    overwrite_partitions(df, path, partition_col)


def guarded_write(df: DataFrame, path: str, job_date: int | None, min_rows: int,
                  partition_col: str = "stat_date") -> bool:
    """Write only when the result has more than ``min_rows`` rows.  The count
    and the write share one cached computation."""
    cached = df.persist()
    try:
        n = cached.count()
        if n > min_rows:
            overwrite_partition(cached, path, job_date, partition_col)
            return True
        return False
    finally:
        cached.unpersist()


def write_marker(spark: SparkSession, path: str, job_date: int) -> None:
    """Ready marker holding the date, written after the data it announces."""
    spark.range(1).select(F.lit(str(job_date)).alias("value")).write.mode("overwrite").text(path)


def sized(lines: DataFrame, by: Sequence[str], size: int) -> DataFrame:
    """Lines (column ``value`` and folder columns) dealt out so that each task
    writes one file of about ``size`` bytes: a first pass adds up the bytes of
    each folder (one row for each), which then gets as many files as it needs, and
    every line the number of its file.  Unlike a ``REBALANCE`` hint, which splits a
    large folder only along the map tasks that wrote to it, this holds however the
    rows lie; lines are spread by a hash of the line and of the task it comes
    from, so equal lines of many tasks do not make one large file."""
    rows = lines.withColumn("_from", F.spark_partition_id())
    # the place of a folder does not depend on how it is shown
    whole = Window.orderBy(*by) if by else Window.orderBy(F.lit(0))
    files = freeze(lines.groupBy(*by).agg(F.greatest(F.ceil(F.sum(F.octet_length("value") + 1) / size), F.lit(1)).alias("_n"))
                   .withColumn("_end", F.sum("_n").over(whole)))
    total = files.agg(F.max("_end")).first()[0]
    if total is None:
        return lines
    named = files.select(*[F.col(c).alias(f"_f{i}") for i, c in enumerate(by)], "_n", "_end")
    if by:
        on = [F.col(c).eqNullSafe(F.col(f"_f{i}")) for i, c in enumerate(by)]
        rows = rows.join(named, on)
    else:
        rows = rows.select("*", F.lit(total).alias("_n"), F.lit(total).alias("_end"))
    place = F.col("_end") - 1 - F.pmod(F.xxhash64("value", "_from"), F.col("_n"))
    return rows.repartitionById(int(total), place.cast("int")).select(lines.columns)


def export_lines(df: DataFrame, line: Column, path: str, partition_by: Sequence[str] = (),
                 target_bytes: int | None = None) -> None:
    """One text line per row (e.g. ``id##yf##text`` or ``__label__x, text``), with
    ``target_bytes`` in files of about that size however the rows lie."""
    out = df.select(*partition_by, line.alias("value"))
    if target_bytes:
        out = sized(out, partition_by, target_bytes)
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.text(path)


HIVE_FIELD_SEP = "\u0001"   # default field delimiter of Hive text tables


def write_delimited(df: DataFrame, path: str, job_date: int | None, sep: str = HIVE_FIELD_SEP,
                    partition_col: str = "stat_date", partition_by: Sequence[str] = (),
                    target_bytes: int | None = None) -> None:
    """Text-table sink: one line per row, fields joined by ``sep`` (nulls as
    ``\\N``), optionally into one dated partition (dynamic overwrite) and folders
    of further columns; with ``target_bytes`` in files of about that size."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in df.columns if c not in partition_by]
    out = df.select(*partition_by, F.concat_ws(sep, *fields).alias("value"))
    folders = list(partition_by)
    if job_date is not None:
        out = out.withColumn(partition_col, F.lit(int(job_date)).cast("bigint"))
        folders = [partition_col, *folders]
    if target_bytes:
        out = sized(out, folders, target_bytes)
    w = out.write.mode("overwrite")
    if folders:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*folders)
    w.text(path)


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str], sep: str = HIVE_FIELD_SEP) -> DataFrame:
    raw = spark.read.text(path)
    parts = F.split(F.col("value"), sep)
    cols = [F.when(parts[i] == "\\N", F.lit(None)).otherwise(parts[i]).alias(c) for i, c in enumerate(columns)]
    extra = [c for c in raw.columns if c != "value"]
    return raw.select(*cols, *extra)
