"""File sources: listings, WAV decoding, JSON segment tables, prioritised discovery, checkpoints of the legacy form."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxmill import schemas
from voxmill.functions.audio import decode_wav
from voxmill.functions.dsp import peak_normalise, resample_poly
from voxmill.functions.text import decode_key, stem, stem_kind

#: File types.
VIDEO = "*.{mp4,mov,mkv,webm}"
AUDIO = "*.{wav,mp3,flac,m4a}"


def listing(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """(path, name, bytes) of the files below folder, sorted by path; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    return files.select("path", stem(F.col("path")).alias("name"), F.col("length").alias("bytes")).orderBy("path")


def videos(spark: SparkSession, folder: str) -> DataFrame:
    return listing(spark, folder, VIDEO)


def audio_files(spark: SparkSession, folder: str) -> DataFrame:
    return listing(spark, folder, AUDIO)


def first_source(tiers: list[DataFrame]) -> DataFrame:
    """All rows of the first tier that has any: the choice is one for the whole set, not one for each key."""
    ranked = None
    for i, t in enumerate(tiers):
        t = t.withColumn("priority", F.lit(i))
        ranked = t if ranked is None else ranked.unionByName(t)
    best = ranked.agg(F.min("priority").alias("priority"))
    return ranked.join(F.broadcast(best), "priority")  # one row


def with_both_stems(stems: DataFrame) -> DataFrame:
    """Keys of stems (video_id, kind) that have vocals and no_vocals."""
    have = stems.groupBy("video_id").agg(F.count_if(F.col("kind") == "vocals").alias("v"), F.count_if(F.col("kind") == "no_vocals").alias("n"))
    return have.where("v > 0 AND n > 0").select("video_id")


def _waveforms(target_sr: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, path in enumerate(batch.column("path").to_pylist()):
                sr, samples, error = None, None, None
                try:
                    samples, sr = decode_wav(batch.column("content")[i].as_py())
                    if target_sr and sr != target_sr:
                        samples, sr = resample_poly(samples, sr, target_sr), target_sr
                    samples = peak_normalise(samples).astype(np.float32)
                except Exception as e:  # a bad file is a row, not the end of the run
                    error = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_pydict({"path": [path], "sr": pa.array([sr], pa.int32()), "samples": pa.array([samples], pa.list_(pa.float32())), "error": pa.array([error], pa.string())})

    return run


def read_audio(spark: SparkSession, folder: str, target_sr: int | None = 16_000) -> DataFrame:
    """(path, sr, samples, error) of WAV files: mono, resampled, peak-normalised; error instead where a file can't be decoded."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.wav").load(folder)
    return files.select("path", "content").mapInArrow(_waveforms(target_sr), "path string, sr int, samples array<float>, error string")


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of segments in the legacy form (seconds), in the canonical one (milliseconds)."""
    s = spark.read.schema(schemas.LEGACY_SEGMENTS).option("multiLine", True).json(path)
    ms = {f"{c}_ms": F.round(F.col(c) * 1000).cast("long") for c in ("start", "end", "duration")}
    return s.withColumns(ms).withColumn("speaker", F.coalesce("speaker", F.lit("UNKNOWN"))).withColumn("video_id", F.coalesce("video_id", F.lit("unknown"))).drop("start", "end", "duration")


def first_existing(spark: SparkSession, paths: list[str]) -> str:
    """The first path that exists; raises if none does."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for p in paths:
        path = hadoop(p)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return p
    raise FileNotFoundError(f"none of {paths}")


def checkpoint_durations(rows: DataFrame) -> DataFrame:
    """(video_id, speaker, value) of rows (key, value) with composite keys; keys that haven't two parts go."""
    k = rows.withColumn("_k", decode_key(F.col("key"))).where(F.col("_k").isNotNull())
    return k.select(F.col("_k")[0].alias("video_id"), F.col("_k")[1].alias("speaker"), "value")


def not_yet(df: DataFrame, done: DataFrame, key: str, at_most: int | None = None) -> DataFrame:
    """Rows whose key isn't in done; the first at_most by key if that is given."""
    rest = df.join(done.select(key).distinct(), key, "left_anti")
    return rest if at_most is None else rest.orderBy(key).limit(at_most)


def name_stems(stems: DataFrame) -> DataFrame:
    """stems (video_id, path) with kind, by their names; where a recording's names don't tell both kinds, its first two paths are rest and vocals.

    A recording has a handful of stems. With fewer than two of them, kind is null unless the name tells it.
    """
    kinds = stems.withColumn("kind", stem_kind(F.col("path")))
    own = W.partitionBy("video_id")
    told = (F.max(F.col("kind") == "vocals").over(own) & F.max(F.col("kind") == "no_vocals").over(own)).alias("told")
    nth = F.row_number().over(own.orderBy("path"))
    placed = kinds.withColumns({"_told": F.coalesce(told, F.lit(False)), "_nth": nth, "_all": F.count("*").over(own)})
    by_place = F.when(F.col("_nth") == 1, "no_vocals").when(F.col("_nth") == 2, "vocals")
    return placed.withColumn("kind", F.when(F.col("_told") | (F.col("_all") < 2), F.col("kind")).otherwise(by_place)).drop("_told", "_nth", "_all")


def align_stems(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Full outer join of two models' outputs (key, path): which of them there is."""
    j = a.select(key, F.col("path").alias("path_a")).join(b.select(key, F.col("path").alias("path_b")), key, "full_outer")
    kind = F.when(F.col("path_a").isNotNull() & F.col("path_b").isNotNull(), "ensemble").when(F.col("path_a").isNotNull(), "demucs_only").when(F.col("path_b").isNotNull(), "mdx_only").otherwise("failed")
    return j.withColumn("kind", kind)
