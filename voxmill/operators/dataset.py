"""The final dataset: projection, totals, packaging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.config import Dataset


def project(seg: DataFrame, cfg: Dataset = Dataset()) -> DataFrame:
    """Dataset records of segments with a text; an asr.duration of 0 counts as missing."""
    text = F.trim(F.col("asr.text"))
    duration = F.coalesce(F.when(F.col("asr.duration") != 0, F.col("asr.duration")), F.col("duration_ms") / 1000, F.lit(0.0))
    return seg.where(F.coalesce(text, F.lit("")) != "").select(
        "segment_id", text.alias("text"), F.format_string("wavs/%s.wav", F.col("segment_id").cast("string")).alias("audio"), F.round(duration, 2).alias("duration"),
        F.lit(0.0).alias("similarity"), "video_id", F.lit(cfg.language).alias("language"), F.lit(cfg.speaker_name).alias("speaker"),
    )


def with_audio(records: DataFrame, files: DataFrame) -> DataFrame:
    """Records whose audio file is listed in files (path), by its name."""
    names = files.select(F.substring_index("path", "/", -1).alias("_name")).distinct()
    return records.withColumn("_name", F.substring_index("audio", "/", -1)).join(names, "_name", "left_semi").drop("_name")


def total(records: DataFrame, cfg: Dataset = Dataset()) -> DataFrame:
    """One row: records, seconds, minutes, and whether the set is smaller than wanted."""
    seconds = F.coalesce(F.sum(F.col("duration").cast("decimal(18,2)")), F.lit(0)).cast("double")
    return records.agg(F.count("*").alias("n"), seconds.alias("total_seconds")).select("n", "total_seconds", F.round(F.col("total_seconds") / 60, 2).alias("total_minutes"), (F.col("total_seconds") < cfg.min_total_minutes * 60).alias("below_minimum"))
