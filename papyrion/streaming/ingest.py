"""Files as a stream: each micro-batch of new files goes through the batch plan.

A file source sees new files only.  Changed and deleted files are found by the
hash comparison of ``operators.incremental``, which stays a batch job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def new_files(spark: SparkSession, folder: str, pattern: str = "*.pdf", per_batch: int = 1000) -> DataFrame:
    schema = spark.read.format("binaryFile").load(folder).schema
    files = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", per_batch).load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file_key"), "path", F.sha2("content", 256).alias("hash"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), "content")


def ingest(files: DataFrame, process: Callable[[DataFrame], DataFrame], output: str, checkpoint: str) -> StreamingQuery:
    """Write ``process(batch)`` of each micro-batch to a folder of its own, so a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    return files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def events_by_window(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and values of events by type and time window; works on streams and tables alike."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
