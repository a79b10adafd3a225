"""Incremental runs on Structured Streaming: land new segment files, keep per-recording totals, merge gaps of turns as sessions.

Every query runs with trigger(availableNow) and a checkpoint folder: a run handles what is new and ends, and a lost run starts again
from the checkpoint. Global clustering stays a batch job, as it needs all embeddings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from voxmill.sources.sinks import write_table


def read_new(spark: SparkSession, folder: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """A stream of the Parquet files that appear in folder."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(folder)


def land(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append what is new to a Parquet table, once."""
    stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(target).awaitTermination()


def totals(stream: DataFrame) -> DataFrame:
    """Running count and time by recording and speaker (update or complete mode)."""
    return stream.groupBy("video_id", "speaker").agg(F.count("*").alias("n"), F.sum("duration_ms").alias("total_ms"))


def update_totals(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Keep the totals of all files so far in a Parquet table that each batch writes anew.

    State is one row for each recording and speaker; a batch that runs twice writes the same table, and a lost one leaves the old table.
    """

    def write(batch: DataFrame, number: int) -> None:
        write_table(batch, target)

    totals(stream).writeStream.outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start().awaitTermination()


def sessions(stream: DataFrame, gap: str = "300 milliseconds", lateness: str = "1 hour") -> DataFrame:
    """Islands of points of one speaker that are closer than gap, by session windows on the column ts, late rows within the watermark included."""
    w = stream.withWatermark("ts", lateness).groupBy("speaker", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return w.select("speaker", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def windowed(stream: DataFrame, width: str = "1 hour", slide: str | None = None, lateness: str = "1 hour") -> DataFrame:
    """Counts and time by speaker in tumbling or sliding windows on ts."""
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    w = stream.withWatermark("ts", lateness).groupBy("speaker", window.alias("w")).agg(F.count("*").alias("n"), F.sum("duration_ms").alias("total_ms"))
    return w.select("speaker", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "total_ms")
