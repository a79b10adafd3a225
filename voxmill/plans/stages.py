"""The stages: tracks, separation, diarization and global labels, quality gate, transcripts, dataset, report, judgement.

Models come as hook factories by name (separator, or separator_a and separator_b for an ensemble; diarizer, detector, transcriber,
evaluator); a stage without its model takes what it would make from a table made elsewhere. Recordings are rows (segment_id, video_id, sr,
samples); their segments are cut out of them where a model needs the sound, and the sound is never written twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.config import PipelineConfig
from voxmill.functions import dsp
from voxmill.functions.audio import slice_wave
from voxmill.functions.text import stem
from voxmill.operators import dataset, embeddings, intervals, quality, report, transcripts
from voxmill.plans import hooks
from voxmill.session import cut
from voxmill.sources.extract import COMMAND, extract_tracks
from voxmill.sources.files import align_stems, read_audio


@dataclass(frozen=True)
class Context:
    """What a stage works with besides its input tables."""

    folder: str
    cfg: PipelineConfig
    models: dict[str, Callable] = field(default_factory=dict)
    #: Program that makes an audio track of a video.
    command: tuple[str, ...] = COMMAND

    def has(self, *names: str) -> bool:
        return all(n in self.models for n in names)


Run = Callable[[SparkSession, dict[str, DataFrame], Context], DataFrame]


@dataclass(frozen=True)
class Stage:
    title: str
    inputs: Callable[[Context], tuple[str, ...]]
    run: Run
    enabled: Callable[[Context], bool] = lambda ctx: True


def _segment_waves(seg: DataFrame, waves: DataFrame) -> DataFrame:
    """seg with sr and its own samples, cut out of its recording."""
    sound = waves.select("video_id", "sr", F.col("samples").alias("_whole"))
    return seg.join(sound, "video_id").withColumn("samples", slice_wave(F.col("_whole"), F.col("sr"), F.col("start_ms"), F.col("end_ms"))).drop("_whole")


def extract(spark: SparkSession, inputs: dict[str, DataFrame], ctx: Context) -> DataFrame:
    """Audio tracks of the videos (path, name), in the folder tracks."""
    done = cut(extract_tracks(inputs["videos"], f"{ctx.folder}/tracks", ctx.command))
    # a track that was there already is as good as one made now
    report.require_success(done.withColumn("status", F.when(F.col("status") == "skipped", "success").otherwise(F.col("status"))))
    return done


def _mixed(waves: DataFrame, a: DataFrame, b: DataFrame, cfg) -> DataFrame:
    """vocals and kind of recordings that one model or both have separated."""
    good = {k: df.where("status = 'success'").select("segment_id", F.lit(k).alias("path"), F.col("vocals").alias(f"vocals_{k}")) for k, df in (("a", a), ("b", b))}
    kinds = align_stems(good["a"], good["b"], "segment_id").select("segment_id", "kind")
    rows = waves.join(kinds, "segment_id", "left").join(good["a"].drop("path"), "segment_id", "left").join(good["b"].drop("path"), "segment_id", "left").withColumn("kind", F.coalesce("kind", F.lit("failed")))

    def call(_, row: dict) -> dict:
        if row["kind"] == "failed":
            raise ValueError("no model separated it")
        if row["kind"] != "ensemble":
            return {"vocals": row["vocals_a"] if row["kind"] == "demucs_only" else row["vocals_b"]}
        mix, x, y = (np.asarray(row[c], dtype=np.float64) for c in ("samples", "vocals_a", "vocals_b"))
        return {"vocals": dsp.ensemble_masks(mix, x, y, cfg.n_fft, cfg.n_fft, cfg.hop, cfg.weight_a, cfg.weight_b)[0].tolist()}

    return hooks.apply_hook(rows, lambda: None, call, "vocals array<double>", ("segment_id", "video_id", "sr", "kind"))


def separate(spark: SparkSession, inputs: dict[str, DataFrame], ctx: Context) -> DataFrame:
    """(segment_id, video_id, sr, samples, kind, status, error): the vocals of each track; the track itself without a separator."""
    name = stem(F.col("path"))
    waves = read_audio(spark, f"{ctx.folder}/tracks").where("error IS NULL").select(name.alias("segment_id"), name.alias("video_id"), "sr", "samples")
    if ctx.cfg.ensemble.enabled and ctx.has("separator_a", "separator_b"):
        parts = [cut(hooks.separate(waves, ctx.models[m]).drop("no_vocals")) for m in ("separator_a", "separator_b")]
        out = _mixed(waves, *parts, ctx.cfg.ensemble).withColumnRenamed("vocals", "samples")
    elif one := next((m for m in ("separator", "separator_a", "separator_b") if ctx.has(m)), None):
        stems = hooks.separate(waves, ctx.models[one]).select("segment_id", F.col("vocals").alias("samples"), "status", "error")
        out = waves.drop("samples").join(stems, "segment_id").withColumn("kind", F.lit(one))
    else:
        out = waves.withColumns({"samples": F.col("samples").cast("array<double>"), "kind": F.lit("mix"), "status": F.lit("success"), "error": F.lit(None).cast("string")})
    out = cut(out.select("segment_id", "video_id", "sr", "samples", "kind", "status", "error"))
    report.require_success(out)
    return out


def _named(seg: DataFrame) -> DataFrame:
    return intervals.assign_ids(seg).drop("segment_id", "nth").withColumnRenamed("new_id", "segment_id")


def label_speakers(found: DataFrame, seg: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """seg with global speaker names, from rows (video_id, embeddings by speaker) of all recordings.

    Speakers are clustered by average linkage, ranked, gated, and ranked anew by the time they speak; short TARGET segments are UNCERTAIN.
    """
    d, strict = cfg.diarization, cfg.diarization.precision
    each = found.select("video_id", F.explode("embeddings").alias("e")).select("video_id", "e.speaker", "e.embedding").withColumn("vec_id", F.xxhash64("video_id", "speaker"))
    each = cut(each.dropDuplicates(["vec_id"]))
    gate = strict.embedding_max_distance if strict.enabled and strict.embedding_gate else None
    labels = embeddings.speaker_labels(each, d.threshold, d.outlier_factor if d.enable_outlier_detection else None, gate, strict.enabled and strict.iqr_outlier_detection)
    label_map = each.join(labels.withColumnRenamed("id", "vec_id"), "vec_id").select("video_id", "speaker", F.col("label").alias("global_label"))
    ranked = embeddings.rerank_by_duration(cut(embeddings.label_durations(label_map, seg)))
    named = embeddings.apply_labels(seg.withColumn("original_speaker", F.col("speaker")), ranked.select("video_id", "speaker", F.col("new_label").alias("global_label")))
    return embeddings.demote_short(named, strict.min_segment_ms) if strict.enabled else named


def diarize(spark: SparkSession, inputs: dict[str, DataFrame], ctx: Context) -> DataFrame:
    """Segments with global speakers; of the table landed where there is no diarizer, with the speakers that it has."""
    d = ctx.cfg.diarization
    if not ctx.has("diarizer"):
        seg = intervals.overlap_flags(inputs["landed"].where(F.col("duration_ms") >= d.min_segment_ms), d.overlap_ms)
        return _named(intervals.split_long(seg, d.max_segment_ms, d.min_child_ms))
    waves = inputs["03"].where("status = 'success'")
    found = cut(hooks.diarize(waves, ctx.models["diarizer"]))
    report.require_success(found)
    found = found.where("status = 'success'")
    seg = intervals.turns(found, d.min_segment_ms).withColumn("segment_id", F.concat_ws("_", "video_id", "speaker", "start_ms", "end_ms"))
    seg = cut(seg.dropDuplicates(["segment_id"]))
    # only segments that are too long are searched for pauses
    speech = hooks.detect_speech(_segment_waves(seg.where(F.col("duration_ms") > d.max_segment_ms), waves), ctx.models.get("detector", hooks.energy_detector))
    ms = F.transform("intervals", lambda i: F.struct(F.round(i["start"] * 1000).cast("long").alias("start"), F.round(i["end"] * 1000).cast("long").alias("end")))
    packed = intervals.pack_speech(seg, speech.select("segment_id", ms.alias("intervals")), d.max_segment_ms, d.min_child_ms)
    # children are numbered by what they are
    packed = packed.withColumn("segment_id", F.concat_ws("_", "video_id", "speaker", "start_ms", "end_ms"))
    return _named(intervals.overlap_flags(label_speakers(found, cut(packed), ctx.cfg), d.overlap_ms))


def gate(spark: SparkSession, inputs: dict[str, DataFrame], ctx: Context) -> DataFrame:
    """All segments with filter_reason and filter_decision; TARGET ones are measured where there is sound, others are kept as they are."""
    seg = inputs["04"]
    target = seg.where("speaker = 'TARGET'")
    if "03" in inputs:
        spans = F.lit(None).cast("array<struct<start:double,end:double>>")
        sound = _segment_waves(target, inputs["03"].where("status = 'success'")).withColumn("m", dsp.metrics_udf()("samples", spans))
        target = sound.select(*[c for c in target.columns if c not in ("snr_db", "sfm", "hnr_db")], "m.snr_db", "m.sfm", "m.hnr_db", "m.speech_samples", "m.total_samples")
        low = quality.speech_gate(target, ctx.cfg.quality).select("segment_id", F.col("filter_decision").alias("_ratio"))
        gated = quality.quality_gate(target, ctx.cfg.quality).join(low, "segment_id")
        gated = gated.withColumns({"filter_reason": F.when(F.col("_ratio").isNotNull(), "speech_ratio").otherwise(F.col("filter_reason")), "filter_decision": F.coalesce("_ratio", "filter_decision")})
    else:
        gated = quality.quality_gate(target, ctx.cfg.quality)
    return seg.join(gated.select("segment_id", "filter_reason", "filter_decision"), "segment_id", "left")


def _passed(inputs: dict[str, DataFrame]) -> DataFrame:
    """TARGET segments without overlap that the gate kept, where it ran."""
    seg = inputs["04b"].where("coalesce(filter_reason, 'keep') = 'keep'") if "04b" in inputs else inputs["04"]
    return transcripts.target_without_overlap(seg)


def transcribe(spark: SparkSession, inputs: dict[str, DataFrame], ctx: Context) -> DataFrame:
    """Passed segments with asr (text and validity) and the path that their sound belongs to."""
    seg = _passed(inputs).withColumn("duration", F.col("duration_ms") / 1000)
    if ctx.has("transcriber"):
        sound = _segment_waves(seg.select("segment_id", "video_id", "start_ms", "end_ms"), inputs["03"].where("status = 'success'"))
        results = cut(hooks.transcribe(sound, ctx.models["transcriber"]).drop("video_id"))
        report.require_success(results)
        results = results.withColumn("has_result", F.lit(True)).drop("status")
    else:
        results = inputs["results"].select("segment_id", "has_result", "error", "text", "confidence", *[F.lit(None).cast(t).alias(c) for c, t in (("language", "string"), ("confidence_min", "double"), ("sentence_count", "int"))])
    judged = transcripts.validity(seg.join(results, "segment_id", "left"), ctx.cfg.asr)
    asr = F.struct("text", "language", "duration", "valid", "reason", "confidence", "confidence_min", "sentence_count").alias("asr")
    return judged.select(*seg.drop("duration", "asr", "asr_path").columns, "valid", "reason", asr, transcripts.asr_path().alias("asr_path"))


def build(spark: SparkSession, inputs: dict[str, DataFrame], ctx: Context) -> DataFrame:
    return dataset.project(inputs["05"].where("valid"), ctx.cfg.dataset)


def describe(spark: SparkSession, inputs: dict[str, DataFrame], ctx: Context) -> DataFrame:
    return report.duration_stats(inputs["04"], "speaker")


def judge(spark: SparkSession, inputs: dict[str, DataFrame], ctx: Context) -> DataFrame:
    """The evaluator's words on each valid segment."""
    seg = inputs["05"].where("valid").select("segment_id", "video_id", "start_ms", "end_ms", "asr.text")
    out = cut(hooks.evaluate(_segment_waves(seg, inputs["03"].where("status = 'success'")), ctx.models["evaluator"], ctx.cfg.evaluation))
    report.require_success(out)
    return out


def _gated(ctx: Context) -> str:
    return "04b" if ctx.cfg.quality.enabled else "04"


#: Tables that aren't made here: listed videos, and segments or transcription results where there is no model for them.
EXTERNAL = ("videos", "landed", "results")
STAGES: dict[str, Stage] = {
    "02": Stage("audio tracks", lambda c: ("videos",), extract),
    "03": Stage("vocals", lambda c: ("02",), separate),
    "04": Stage("segments and speakers", lambda c: ("03",) if c.has("diarizer") else ("landed",), diarize),
    "04b": Stage("audio quality gate", lambda c: ("04", "03") if c.has("diarizer") else ("04",), gate, lambda c: c.cfg.quality.enabled),
    "05": Stage("transcripts", lambda c: (_gated(c), "03" if c.has("transcriber") else "results"), transcribe),
    "06": Stage("dataset records", lambda c: ("05",), build),
    "07": Stage("duration report", lambda c: ("04",), describe),
    "08": Stage("judgement", lambda c: ("05", "03"), judge, lambda c: c.cfg.evaluation.enabled and c.has("evaluator")),
}
