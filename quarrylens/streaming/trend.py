"""An extension: windowed event rates as Structured Streaming, the same code in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def event_rates(events: DataFrame, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Events and their values by type and event-time window; in a stream, late rows count until the watermark."""
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks need a zoned time
    if events.isStreaming:
        events = events.withWatermark("ts", late)
    return events.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "events", "total")


def read_event_stream(spark, folder: str, schema, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def start(rates: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Closed windows as Parquet, each exactly once; restarts go on from the checkpoint."""
    return rates.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").start(path)
