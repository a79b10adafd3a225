from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from voxmill.config import Asr, QualityGate, load_config
from voxmill.functions import text as fn
from voxmill.operators import dataset, quality, report, transcripts


@pytest.mark.parametrize(
    "row, reason",
    [((7.9, 0.0, 9.0), "snr"), ((9.0, 0.04, 9.0), "sfm"), ((9.0, 0.0, 3.0), "hnr"), ((1.0, 0.9, 9.0), "multi"), ((8.0, 0.03, 4.0), "keep"), ((None, 0.0, 9.0), "missing")],
)
def test_gate(spark, row, reason):
    df = spark.createDataFrame([row], "snr_db double, sfm double, hnr_db double")
    assert quality.quality_gate(df, QualityGate()).first().filter_reason == reason


def test_decision_text(spark):
    df = spark.createDataFrame([(3.14, 0.0, 9.0), (3.14, 0.5, 9.0)], "snr_db double, sfm double, hnr_db double")
    assert [r.filter_decision for r in quality.quality_gate(df).collect()] == ["snr=3.1<8.0", "multi(snr=3.1<8.0, sfm=0.5000>0.03)"]


def test_speech_ratio_of_nothing(spark):
    df = spark.createDataFrame([(0, 0), (60, 100)], "speech_samples int, total_samples int")
    assert [r.filter_decision for r in quality.speech_gate(df).collect()] == ["speech_ratio=0.00", None]


def test_split_is_a_partition(spark):
    seg = spark.createDataFrame([(1, "TARGET"), (2, "TARGET"), (3, "OTHER_00"), (4, "TARGET")], "segment_id int, speaker string")
    kept, rejected = quality.split_kept(seg, spark.createDataFrame([(1, "keep"), (2, "snr")], "segment_id int, filter_reason string"))
    assert ({r.segment_id for r in kept.collect()}, {r.segment_id for r in rejected.collect()}) == ({1, 3}, {2, 4})


@pytest.mark.parametrize(
    "row, reason",
    [
        ((0.49, True, None, "你好", 0.9), "too_short"), ((1.0, False, None, "你好", 0.9), "empty_result"), ((1.0, True, "E", "你好", 0.9), "transcribe_error"), ((1.0, True, None, "  ", 0.9), "empty_text"),
        ((1.0, True, None, "好", 0.9), "text_too_short"), ((1.0, True, None, "hello", 0.9), "no_chinese"), ((1.0, True, None, "你好", 0.849), "low_confidence"), ((1.0, True, None, "你好", None), "ok"), ((1.0, True, None, "你好", 0.85), "ok"),
    ],
)
def test_cascade(spark, row, reason):
    df = spark.createDataFrame([row], "duration double, has_result boolean, error string, text string, confidence double")
    got = transcripts.validity(df, Asr()).first()
    assert (got.reason, got.valid) == (reason, reason == "ok")


def test_non_linguistic(spark):
    texts = ["你好世界", "123,你好", "123 ,", "hello", "a好", "!?"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    assert [r.x for r in df.select(fn.non_linguistic(F.col("t")).alias("x")).collect()] == [False, False, True, False, False, True]


def test_names_and_keys(spark):
    df = spark.createDataFrame([("a/b/x.y.ckpt", "v|||s", "q")], "p string, k string, t string")
    r = df.select(fn.basename(F.col("p")), fn.stem(F.col("p")), fn.model_name(F.col("p")), fn.decode_key(F.col("k")), fn.decode_key(F.col("t")), fn.fill_prompt("<{text}>", F.col("t")), fn.safe_filename(F.lit(" a/b:é ")), fn.stem_kind(F.lit("X (Vocals)"))).first()
    assert tuple(r) == ("x.y.ckpt", "x.y", "x.y", ["v", "s"], None, "<q>", "abé", "vocals")


def test_audio_status(spark):
    df = spark.createDataFrame([([0.1] * 50, 16000), ([0.1] * 200, 16000), ([0.0] * 2000, 16000), ([0.1] * 2000, 16000), (None, 16000)], "x array<double>, sr int")
    assert [r.s for r in df.select(quality.audio_status(F.col("x"), F.col("sr")).alias("s")).collect()] == ["audio_empty", "audio_too_short", "audio_silent", "ok", "audio_empty"]


def test_histogram_and_stats(spark):
    ms = [500, 1000, 2000, 3000, 5000, 10_000, 15_000, 30_000, 490]
    seg = spark.createDataFrame([(i, m, "A", "v") for i, m in enumerate(ms)], "segment_id int, duration_ms long, speaker string, video_id string")
    assert [r.n for r in report.histogram(seg).orderBy("ordinal").collect()] == [1] * 9
    assert [r.n for r in report.histogram(seg.limit(0)).collect()] == [0] * 9
    empty = report.duration_stats(seg.limit(0)).first()
    assert (empty.n, empty.total_seconds, empty.mean, empty.p90) == (0, 0.0, 0.0, 0.0)


def test_shortest_and_funnel(spark):
    seg = spark.createDataFrame([(i, 0 if i < 3 else i * 100, "TARGET", "v") for i in range(12)], "segment_id int, duration_ms long, speaker string, video_id string")
    assert report.shortest(seg).count() == 7
    assert report.funnel(seg.limit(0), seg).count() == 0
    zero = report.funnel(seg.where("duration_ms = 0"), seg.limit(0)).first()
    assert (zero.duration_pct, zero.segments_pct) == (0.0, 0.0)


def test_dataset(spark):
    seg = spark.createDataFrame([(1, "v", 3200, ("hi ", 0.0)), (2, "v", 100, (" ", 1.0)), (3, "v", 100, (None, 1.0))], "segment_id int, video_id string, duration_ms long, asr struct<text:string,duration:double>")
    rows = dataset.project(seg).collect()
    assert [(r.segment_id, r.text, r.duration) for r in rows] == [(1, "hi", 3.2)]
    assert dataset.total(dataset.project(seg)).first().below_minimum


def test_confidence(spark):
    df = spark.createDataFrame([([[0.0, 0.0], [5.0, 5.0, 5.0, 5.0]],), ([],)], "t array<array<double>>")
    mean, least = transcripts.confidence(F.col("t"))
    assert [tuple(r) for r in df.select(mean, least).collect()] == [(0.375, 0.25), (None, None)]


def test_tally(spark):
    df = spark.createDataFrame([("success",), ("failed",), ("skipped",)], "status string")
    assert report.tally(df).first().success == 1
    report.require_success(df)
    with pytest.raises(ValueError, match="no input"):
        report.require_success(df.limit(0))


def test_config(tmp_path):
    p = tmp_path / "c.json"
    p.write_text('{"diarization": {"overlap_ms": 70, "precision": {"enabled": false}}}')
    c = load_config(str(p))
    assert (c.diarization.overlap_ms, c.diarization.threshold, load_config().diarization.threshold) == (70, 0.5, 0.55)
    p.write_text('{"nonsense": 1}')
    with pytest.raises(ValueError, match="nonsense"):
        load_config(str(p))
