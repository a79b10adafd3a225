"""Transcript validity, failure exports and tallies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxmill.config import Asr
from voxmill.functions.text import contains_script, non_linguistic

#: Reason codes in the order in which they are tested.
REASONS = ("ok", "too_short", "empty_result", "transcribe_error", "empty_text", "text_too_short", "no_chinese", "non_linguistic", "low_confidence")


def target_without_overlap(seg: DataFrame) -> DataFrame:
    return seg.where((F.col("speaker") == "TARGET") & ~F.coalesce("is_overlap", F.lit(False)))


def validity(df: DataFrame, asr: Asr = Asr()) -> DataFrame:
    """df (duration, has_result, error, text, confidence) with reason, the first that holds in the order of REASONS, and valid."""
    text = F.trim(F.coalesce("text", F.lit("")))
    low = (F.lit(asr.confidence) > 0) & F.col("confidence").isNotNull() & (F.col("confidence") < asr.confidence)
    reason = (
        F.when(F.col("duration") < asr.min_duration, "too_short")
        .when(~F.coalesce("has_result", F.lit(False)), "empty_result")
        .when(F.col("error").isNotNull(), "transcribe_error")
        .when(text == "", "empty_text")
        .when(F.length(text) < asr.min_chars, "text_too_short")
        .when(~contains_script(text, asr.script), "no_chinese")
        .when(non_linguistic(text), "non_linguistic")
        .when(low, "low_confidence")
        .otherwise("ok")
    )
    return df.withColumn("reason", reason).withColumn("valid", F.col("reason") == "ok")


def asr_path(passed: str = "asr/passed", low: str = "asr/low_confidence") -> Column:
    """Where the sound of a judged segment (segment_id, valid, reason) belongs: valid ones, and those refused for their confidence alone; else null."""
    name = F.concat(F.lit("/"), F.col("segment_id").cast("string"), F.lit(".wav"))
    return F.when(F.col("valid"), F.concat(F.lit(passed), name)).when(F.col("reason").startswith("low_confidence"), F.concat(F.lit(low), name))


def reason_class(reason: Column) -> Column:
    """The first of REASONS that a reason text begins with, else other."""
    out = F.lit("other")
    for r in reversed(REASONS):
        out = F.when(reason.startswith(r), r).otherwise(out)
    return out


def reason_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(reason_class(F.col("reason")).alias("reason")).agg(F.count("*").alias("n"))


def failed_export(seg: DataFrame) -> DataFrame:
    """The twelve columns of failed segments (asr.valid is false)."""
    return seg.where(~F.col("asr.valid")).select(
        "segment_id", "video_id", (F.col("duration_ms") / 1000).alias("duration"), "speaker", "snr_db", "sfm", "hnr_db",
        *[F.col(f"asr.{c}").alias(c) for c in ("valid", "reason", "text", "confidence", "confidence_min")],
    )


def confidence(tokens: Column) -> tuple[Column, Column]:
    """Mean and least of the largest softmax probability of each token's scores (array of arrays), rounded to 4 places; null without tokens."""

    def largest(scores: Column) -> Column:
        top = F.array_max(scores)
        return 1.0 / F.aggregate(scores, F.lit(0.0), lambda s, x: s + F.exp(x - top))

    p = F.transform(tokens, largest)
    mean = F.when(F.size(p) > 0, F.aggregate(p, F.lit(0.0), lambda s, x: s + x) / F.size(p))
    return F.round(mean, 4), F.round(F.array_min(p), 4)
