"""Streams: windowed event counts with late data, and a drop folder that replaces observations by source and year."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from statlas.sources.sinks import replace_partitions


def event_windows(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums by window and type; works on a stream (rows later than the watermark are dropped) and on a table."""
    own = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if own.isStreaming:
        own = own.withWatermark("ts", late)
    grouped = own.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return grouped.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "n", "total")


def ingest_folder(spark: SparkSession, folder: str, schema: str, target: str, checkpoint: str) -> StreamingQuery:
    """Take in the parquet files that are new in a folder, replace their sources' years in target, and stop."""
    stream = spark.readStream.schema(schema).parquet(folder)
    return stream.writeStream.foreachBatch(lambda df, _: replace_partitions(df, target)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
