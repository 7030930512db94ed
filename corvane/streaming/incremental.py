"""Incremental batch behaviours as streams: new content only, late data, idempotent sinks, counts in windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parquet_stream(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    """New Parquet files of a folder, in the folder's own schema."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def unseen(stream: DataFrame, digest: str, time: str, delay: str = "1 day") -> DataFrame:
    """Rows whose content digest has not come before, remembered until the watermark passes."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([digest])


def window_counts(stream: DataFrame, time: str, by: str, width: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Counts and sums by tumbling window; state is dropped behind the watermark."""
    w = stream.withWatermark(time, delay).groupBy(F.window(time, width), by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return w.select(F.col("window")["start"].alias("start"), by, "n", "total")


def run_once(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """All data there is, then stop. ``write`` gets each batch with its number and must overwrite by it, so a repeated batch does no harm."""
    stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
