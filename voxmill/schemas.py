"""Canonical schemas; times are whole milliseconds."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(),
    "strings": T.ArrayType(T.StringType()), "doubles": T.ArrayType(T.DoubleType()), "floats": T.ArrayType(T.FloatType()),
}


def struct(text: str, **more: T.DataType) -> T.StructType:
    """A schema from "name type, ..." and further fields; it needs no session."""
    fields = [x.split() for x in text.split(",")]
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in fields] + [T.StructField(n, t) for n, t in more.items()])


ASR = struct("text string, language string, duration double, valid boolean, reason string, confidence double, confidence_min double, sentence_count int")
SEGMENTS = struct(
    "segment_id string, segment_path string, video_id string, speaker string, original_speaker string, start_ms long, end_ms long, duration_ms long, "
    "is_overlap boolean, overlap_speakers strings, snr_db double, sfm double, hnr_db double, filter_decision string, asr_path string, consent string", asr=ASR,
)
EMBEDDINGS = struct("video_id string, speaker string, embedding doubles")
SPEECH = struct("segment_id string", intervals=T.ArrayType(struct("start double, end double")))
WAVEFORM = struct("segment_id string, sr int, samples floats")
ASR_FAILED = struct("segment_id string, video_id string, duration double, speaker string, snr_db double, sfm double, hnr_db double, valid boolean, reason string, text string, confidence double, confidence_min double")
DATASET = struct("segment_id string, text string, audio string, duration double, similarity double, video_id string, language string, speaker string")
EVALUATION = struct("segment_id string, evaluation string, error string, text string, duration double, video_id string")
LABEL_MAP = struct("video_id string, speaker string, global_label string")
LEDGER = struct("video_id string, status string, error string, updated_at timestamp")
#: Segments as JSON files of the legacy form have them: seconds as doubles.
LEGACY_SEGMENTS = struct(
    "segment_id string, segment_path string, video_id string, speaker string, original_speaker string, start double, end double, duration double, "
    "is_overlap boolean, overlap_speakers strings, snr_db double, sfm double, hnr_db double, filter_decision string, asr_path string", asr=ASR,
)
