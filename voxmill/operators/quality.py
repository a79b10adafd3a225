"""Rule-based audio quality gates with reason codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxmill.config import QualityGate


def audio_status(samples: Column, sr: Column) -> Column:
    """ok, or why a waveform is unusable: audio_empty, audio_too_short, audio_silent."""
    n = F.coalesce(F.size(samples), F.lit(0))
    power = F.aggregate(samples, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return F.when(samples.isNull() | (n < 100), "audio_empty").when(n / sr < 0.1, "audio_too_short").when(F.sqrt(power / n) < 1e-6, "audio_silent").otherwise("ok")


def speech_ratio(speech: Column, total: Column) -> Column:
    return speech / F.greatest(total, F.lit(1))


def speech_gate(df: DataFrame, gate: QualityGate = QualityGate()) -> DataFrame:
    """df (speech_samples, total_samples) with speech_ratio and filter_decision: null, or "speech_ratio=..." where it is too low."""
    r = df.withColumn("speech_ratio", speech_ratio(F.col("speech_samples"), F.col("total_samples")))
    return r.withColumn("filter_decision", F.when(F.col("speech_ratio") < gate.min_speech_ratio, F.format_string("speech_ratio=%.2f", "speech_ratio")))


def quality_gate(df: DataFrame, gate: QualityGate = QualityGate()) -> DataFrame:
    """df (snr_db, sfm, hnr_db) with filter_reason (keep, snr, sfm, hnr, multi, missing) and the readable filter_decision.

    Comparisons are strict and use the values as they are; a null metric makes the row "missing".
    """
    snr, sfm, hnr = F.col("snr_db") < gate.snr_db, F.col("sfm") > gate.sfm, F.col("hnr_db") < gate.hnr_db
    fails = snr.cast("int") + sfm.cast("int") + hnr.cast("int")
    reason = F.when(fails.isNull(), "missing").when(fails >= 2, "multi").when(snr, "snr").when(sfm, "sfm").when(hnr, "hnr").otherwise("keep")
    out = df.withColumn("filter_reason", reason)
    parts = F.concat_ws(", ", F.when(snr, F.format_string(f"snr=%.1f<{gate.snr_db}", "snr_db")), F.when(sfm, F.format_string(f"sfm=%.4f>{gate.sfm}", "sfm")), F.when(hnr, F.format_string(f"hnr=%.1f<{gate.hnr_db}", "hnr_db")))
    decision = F.when(F.col("filter_reason").isin("keep", "missing"), F.col("filter_reason")).when(F.col("filter_reason") == "multi", F.concat(F.lit("multi("), parts, F.lit(")"))).otherwise(parts)
    return out.withColumn("filter_decision", decision)


def gate_counts(gated: DataFrame) -> DataFrame:
    """Rows by filter_reason."""
    return gated.groupBy("filter_reason").agg(F.count("*").alias("n"))


def metric_summary(gated: DataFrame) -> DataFrame:
    """One row: kept and discarded rows; mean, median, least and largest of each metric."""
    aggs = [F.count_if(F.col("filter_reason") == "keep").alias("kept"), F.count_if(F.col("filter_reason") != "keep").alias("discarded")]
    for m in ("snr_db", "sfm", "hnr_db"):
        aggs += [F.round(F.avg(m), 6).alias(f"{m}_mean"), F.round(F.median(m), 6).alias(f"{m}_median"), F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max")]
    return gated.agg(*aggs)


def split_kept(seg: DataFrame, gated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) segments: kept are those that aren't TARGET, and the TARGET ones that the gate kept; the two make up seg."""
    reason = gated.select("segment_id", "filter_reason")
    marked = seg.join(reason, "segment_id", "left").withColumn("_keep", (F.col("speaker") != "TARGET") | F.coalesce(F.col("filter_reason") == "keep", F.lit(False)))
    return marked.where("_keep").drop("_keep", "filter_reason"), marked.where("NOT _keep").drop("_keep")
