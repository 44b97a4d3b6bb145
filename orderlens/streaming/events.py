"""Counts of events by hour as a stateful stream: event time, watermark, late rows.

The stream groups events by hour and type. The state store holds the hours that may still change: an hour is closed, and
its state dropped, once an event has been seen that is later than the hour's end by more than the allowed delay. Events that
arrive for a closed hour are late: they are not counted, and the stream's report tells how many state updates were dropped
(``numRowsDroppedByWatermark``; rows are combined by hour and type before they meet the state, so it counts those).

Every micro-batch writes the groups that it changed to a folder of its own number, replacing what an earlier attempt left
there. The newest number of a group has its count, so a reader sees open hours too, and a repeated micro-batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import storage

DELAY = "2 hours"
EVENTS = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("event_type", T.StringType())])
COUNTS = T.StructType([
    T.StructField("hour_start", T.TimestampNTZType()), T.StructField("event_type", T.StringType()), T.StructField("events", T.LongType()),
])


def hourly_counts(events: DataFrame, delay: str = DELAY) -> DataFrame:
    """Events by hour and type of a stream or a table; rows without a time are left out.

    A watermark takes a point in time, so times without a zone are read in the session's zone and given back without. Use
    UTC, where no hour is skipped or repeated.
    """
    timed = events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    if events.isStreaming:
        timed = timed.withWatermark("ts", delay)
    counted = timed.groupBy(F.window("ts", "1 hour").alias("hour"), "event_type").agg(F.count("*").alias("events"))
    return counted.select(F.col("hour.start").cast("timestamp_ntz").alias("hour_start"), "event_type", "events")


def stream_hourly_counts(
    spark: SparkSession, source: str, target: str, checkpoint: str, delay: str = DELAY, files_at_once: int | None = None,
    progress: list | None = None,
) -> DataFrame:
    """Count the event files that are new in ``source``, then stop; returns all counts so far.

    ``files_at_once`` bounds the files of a micro-batch. ``progress`` receives Spark's report of each micro-batch.
    """
    reader = spark.readStream.schema(EVENTS).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    if files_at_once:
        reader = reader.option("maxFilesPerTrigger", files_at_once)

    def write(changed: DataFrame, number: int) -> None:
        changed.write.mode("overwrite").parquet(f"{target}/batch={number}")

    query = (
        hourly_counts(reader.parquet(source), delay)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if progress is not None:
        progress += query.recentProgress
    return read_hourly_counts(spark, target)


def read_hourly_counts(spark: SparkSession, target: str) -> DataFrame:
    """The newest count of each hour and type."""
    if not storage.children(spark, target):
        return spark.createDataFrame([], COUNTS)
    written = spark.read.schema(T.StructType([*COUNTS.fields, T.StructField("batch", T.LongType())])).parquet(target)
    return written.groupBy("hour_start", "event_type").agg(F.max_by("events", "batch").alias("events"))
