"""Global order statistics without a single-partition window.

``row_number() over (order by ...)`` with no PARTITION BY moves every row into
one task.  Here the data is range-partitioned by the sort key (``orderBy``),
each partition computes its local running totals in one Arrow pass, and the
per-partition totals (one row per partition, a proven small size) are turned
into offsets and broadcast back.  The sorted intermediate is checkpointed to
the shared checkpoint dir so both passes see the same rows and a lost
executor does not replay the sort.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portrait.session import freeze

_PID = "_part_id"


def running_totals(df: DataFrame, order: Sequence[Column], value_cols: Sequence[str],
                   prefix: str = "cum_") -> DataFrame:
    """Add inclusive running sums ``cum_<c>`` of numeric ``value_cols`` along
    the total order ``order`` (callers include a unique key to break ties)."""
    ordered = df.orderBy(*order).withColumn(_PID, F.spark_partition_id())
    out_fields = list(ordered.schema.fields) + [
        T.StructField(prefix + c, T.DoubleType(), False) for c in value_cols]
    schema = T.StructType(out_fields)
    cols = list(value_cols)

    def local_cumsum(batches):
        carry = {c: 0.0 for c in cols}
        for pdf in batches:
            for c in cols:
                s = pdf[c].astype("float64").fillna(0.0).cumsum() + carry[c]
                if len(s):
                    carry[c] = float(s.iloc[-1])
                pdf[prefix + c] = s
            yield pdf

    local = freeze(ordered.mapInPandas(local_cumsum, schema))
    totals = local.groupBy(_PID).agg(*[F.max(prefix + c).alias("_tot_" + c) for c in cols])
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(_PID, *[F.coalesce(F.sum("_tot_" + c).over(w), F.lit(0.0)).alias("_off_" + c)
                                   for c in cols])
    joined = local.join(F.broadcast(offsets), _PID, "left")
    return joined.select(*[F.col(f.name) for f in ordered.schema.fields if f.name != _PID],
                         *[(F.col(prefix + c) + F.coalesce(F.col("_off_" + c), F.lit(0.0))).alias(prefix + c)
                           for c in cols])


def global_index(df: DataFrame, order: Sequence[Column], name: str = "idx") -> DataFrame:
    """Dense 0-based position of each row in the total order ``order``.

    JVM only: after the range-partitioned sort, a row's position inside its
    partition is ``monotonically_increasing_id() - (partition_id << 33)``;
    per-partition row counts (one row per partition) become offsets."""
    ordered = df.orderBy(*order).withColumn(_PID, F.spark_partition_id())
    ordered = ordered.withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.col(_PID).cast("long"), 33))
    local = freeze(ordered)
    counts = local.groupBy(_PID).agg((F.max("_pos") + 1).alias("_n"))
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = local.join(F.broadcast(offsets), _PID, "left")
    return out.withColumn(name, (F.col("_off") + F.col("_pos")).cast("bigint")).drop(_PID, "_pos", "_off")


def segmented_index(df: DataFrame, segment: str, order: Sequence[Column], name: str = "idx") -> DataFrame:
    """Dense 0-based position of each row within its segment: one sort by
    (segment, order), positions over the whole, less the segment's first one
    (one row per segment; segments are few by meaning, such as levels)."""
    whole = global_index(df, [F.col(segment).asc(), *order], "_at")
    first = whole.groupBy(segment).agg(F.min("_at").alias("_first"))
    return whole.join(first, segment).withColumn(name, F.col("_at") - F.col("_first")).drop("_at", "_first")


def top_k_indexed(df: DataFrame, order: Sequence[Column], k: int, name: str = "idx") -> DataFrame:
    """First ``k`` rows of a total order with their 0-based index.  ``limit``
    after ``orderBy`` plans as TakeOrderedAndProject (per-partition heaps of
    size k), so the window below sees at most k rows."""
    top = df.orderBy(*order).limit(k)
    return top.withColumn(name, (F.row_number().over(Window.orderBy(*order)) - 1).cast("bigint"))
