"""Optional extension: windows over the events stream, and incremental indexing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, folder: str, schema) -> DataFrame:
    """Parquet files of a folder as a stream; the time stamp gets the session's zone."""
    return spark.readStream.schema(schema).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Count and sum by window and type; works on a stream and on a table."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    out = rows.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return out.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """A user's runs of events with no gap of ``gap`` or more."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    out = rows.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return out.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def index_incrementally(stream: DataFrame, upsert, checkpoint: str):
    """Hand each new batch of files to upsert(batch, id) once, then stop."""
    return stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(upsert).start()
