"""Re-run a daily job for every date partition that received new files.

``readStream`` on the partitioned landing folder tracks which files are new
(in the streaming checkpoint, on shared storage).  Each micro-batch only says
*which dates* changed; the job is then re-run over the complete partitions of
those dates from the static table and the output partitions are overwritten,
so a day that arrives in several batches still ends up computed over all of
its files.  ``availableNow`` processes what is there and stops, like a
scheduled daily run."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from portrait.sources.sinks import overwrite_partitions


def run_new_partitions(spark: SparkSession, source_path: str, schema: StructType,
                       job: Callable[[DataFrame], DataFrame], sink_path: str, checkpoint_location: str,
                       partition_col: str = "stat_date", max_files_per_trigger: int | None = None) -> None:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_path)

    def each(batch: DataFrame, _epoch: int) -> None:
        # one row per touched date: bounded by the number of days in the batch
        days = [r[0] for r in batch.select(partition_col).distinct().collect()]
        if not days:
            return
        full = spark.read.schema(schema).parquet(source_path).where(F.col(partition_col).isin(days))
        overwrite_partitions(job(full), sink_path, partition_col)

    q = (stream.select(partition_col).writeStream.foreachBatch(each)
         .option("checkpointLocation", checkpoint_location)
         .trigger(availableNow=True).start())
    q.awaitTermination()
