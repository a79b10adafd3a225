"""Sources, sinks, hooks, the runner and streams."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxmill import schemas
from voxmill.config import Ensemble, Evaluation, PipelineConfig, QualityGate
from voxmill.functions import audio, dsp
from voxmill.plans import hooks, runner
from voxmill.plans.stages import Context
from voxmill.session import cut, shared_dir
from voxmill.sources import files, sinks
from voxmill.streaming import incremental


def test_audio_sources(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.wav").write_bytes(audio.encode_wav(0.5 * np.sin(np.arange(4800) / 7), 48_000))
    (tmp_path / "b.wav").write_bytes(b"no wav")
    (tmp_path / "c.mp4").write_bytes(b"x")
    assert [r.name for r in files.audio_files(spark, str(tmp_path)).collect()] == ["b", "a"]
    assert [r.name for r in files.videos(spark, str(tmp_path)).collect()] == ["c"]
    got = {r.path.rsplit("/", 1)[1]: r for r in files.read_audio(spark, str(tmp_path)).collect()}
    assert (got["a.wav"].sr, len(got["a.wav"].samples), max(map(abs, got["a.wav"].samples))) == (16_000, 1600, 1.0)
    assert got["b.wav"].samples is None and got["b.wav"].error


def test_segments_json(spark, tmp_path):
    p = tmp_path / "segments.json"
    p.write_text(json.dumps([{"segment_id": "s", "start": 1.2345, "end": 2.0, "duration": 0.766, "asr": {"text": "x", "valid": True}}]))
    r = files.read_segments(spark, files.first_existing(spark, [str(tmp_path / "none"), str(p)])).first()
    assert (r.start_ms, r.end_ms, r.speaker, r.video_id, r.asr.text) == (1235, 2000, "UNKNOWN", "unknown", "x")
    with pytest.raises(FileNotFoundError):
        files.first_existing(spark, [str(tmp_path / "none")])


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "keep"), (2, "snr")], "i int, decision string")
    sinks.write_split(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).where("decision = 'keep'").count() == 1
    row = sinks.report_row({"a": df, "b": df.limit(0)}).first()
    assert json.loads(row.a)[0]["decision"] in ("keep", "snr") and json.loads(row.b) == []
    first = cut(sinks.record(None, spark.createDataFrame([("v", "failed", "e")], "video_id string, status string, error string")))
    again = sinks.record(first, spark.createDataFrame([("v", "success", None)], "video_id string, status string, error string"))
    assert [r.status for r in again.collect()] == ["success"]


def test_hook_isolates_errors(spark):
    def call(model, row):
        return {"n": model(row["x"])}

    def make_divider():
        return lambda x: 1 / x

    df = spark.createDataFrame([(1, 4), (2, 0)], "i int, x int")
    got = {r.i: r for r in hooks.apply_hook(df, make_divider, call, "n double", ("i",)).collect()}
    assert (got[1].n, got[1].status) == (0.25, "success")
    assert got[2].status == "failed" and "ZeroDivisionError" in got[2].error


def test_metrics_function(spark):
    tone = [float(x) for x in np.sin(np.arange(16_000) / 10)]
    df = spark.createDataFrame([(1, tone, None), (2, None, None)], "i int, x array<double>, s array<struct<start:double,end:double>>")
    got = {r.i: r.m for r in df.select("i", dsp.metrics_udf()("x", "s").alias("m")).collect()}
    assert got[1].total_samples == 16_000 and got[2].total_samples == 0
    want = dsp.metrics(pd.Series([tone]), pd.Series([None])).iloc[0]
    assert got[1].hnr_db == pytest.approx(want.hnr_db)


def landed(spark):
    rows = [(str(i), "v", "TARGET" if i % 2 else "OTHER_00", i * 20_000, i * 20_000 + 12_000, 12_000, 9.0, 0.0, 9.0) for i in range(6)]
    return spark.createDataFrame(rows, "segment_id string, video_id string, speaker string, start_ms long, end_ms long, duration_ms long, snr_db double, sfm double, hnr_db double")


def test_runner(spark, tmp_path):
    ctx = Context(str(tmp_path), PipelineConfig())
    assert runner.stage_range("04", "05") == ["04", "04b", "05"]
    with pytest.raises(ValueError):
        runner.stage_range("99")
    with pytest.raises(FileNotFoundError):
        runner.run_stage(spark, ctx, "04")
    sinks.write_table(landed(spark), f"{ctx.folder}/landed")
    assert runner.run_missing(spark, ctx) == ["04", "07"]  # 04b is off, 05 has no results yet
    assert runner.run_missing(spark, ctx) == []
    seg = spark.read.parquet(f"{ctx.folder}/04")
    assert seg.count() == 12 and seg.select("segment_id").distinct().count() == 12
    results = seg.select("segment_id", F.lit(True).alias("has_result"), F.lit(None).cast("string").alias("error"), F.lit("你好").alias("text"), F.when(F.col("start_ms") < 30_000, 0.9).otherwise(0.1).alias("confidence"))
    sinks.write_table(results, f"{ctx.folder}/results")
    assert runner.run_missing(spark, ctx) == ["05", "06"]
    out = spark.read.parquet(f"{ctx.folder}/05")
    # six TARGET segments, of which two start in the first 30 s
    assert {(r.valid, r.asr_path.split("/")[1]) for r in out.collect()} == {(True, "passed"), (False, "low_confidence")}
    assert spark.read.parquet(f"{ctx.folder}/06").count() == 2
    assert runner.run_range(spark, ctx, "04b", "06") == ["05", "06"]


def test_all_stages(spark, tmp_path):
    """From videos to judgements over stand-ins for the models, with the ensemble and the gate switched on."""
    rate, folder = 16_000, str(tmp_path / "run")
    (tmp_path / "videos").mkdir()
    rng = np.random.default_rng(0)
    talk = np.concatenate([np.sin(np.arange(12 * rate) * 0.06) * (0.4 + 0.3 * np.sin(np.arange(12 * rate) / 900)), np.zeros(rate), 0.8 * np.sin(np.arange(5 * rate) * 0.11)]) + rng.normal(0, 1e-4, 18 * rate)
    for name in ("a", "b"):
        (tmp_path / "videos" / f"{name}.mp4").write_bytes(audio.encode_wav(talk, rate))
    (tmp_path / "videos" / "broken.mp4").write_bytes(b"no sound")

    def diarizer():
        return lambda x, sr: ([("S0", 0.0, 12.0), ("S1", 13.0, 18.0), ("S1", 11.5, 11.7)], {"S0": np.array([1.0, 0.1]), "S1": np.array([0.1, 1.0])})

    models = {
        "separator_a": lambda: lambda x, sr: {"vocals": 0.9 * x, "no_vocals": 0.1 * x}, "separator_b": lambda: lambda x, sr: {"vocals": 0.8 * x, "no_vocals": 0.2 * x},
        "diarizer": diarizer, "detector": lambda: lambda x, sr: [(0.5, 5.0), (6.0, 11.0)], "transcriber": lambda: lambda x, sr: {"text": f"长度 {len(x)}", "confidence": 0.95}, "evaluator": lambda: lambda x, sr, prompt: prompt,
    }
    cfg = PipelineConfig(quality=QualityGate(enabled=True, snr_db=0.0, sfm=1.1, hnr_db=-1.0, min_speech_ratio=0.0))
    ctx = Context(folder, cfg, models, ("cp", "{source}", "{target}"))
    sinks.write_table(files.videos(spark, str(tmp_path / "videos")).drop("bytes"), f"{folder}/videos")
    assert runner.run_missing(spark, ctx) == ["02", "03", "04", "04b", "05", "06", "07", "08"]
    read = lambda i: spark.read.parquet(f"{folder}/{i}")
    assert {(r.video_id, r.kind, r.status) for r in read("03").collect()} == {("a", "ensemble", "success"), ("b", "ensemble", "success")}
    seg = {(r.video_id, r.start_ms, r.end_ms): r for r in read("04").collect()}
    # S0's 12 s are cut at the pause; it speaks most, so it is TARGET
    assert {k[1:]: r.speaker for k, r in seg.items() if k[0] == "a"} == {(500, 5000): "TARGET", (6000, 11000): "TARGET", (13000, 18000): "OTHER_00"}
    assert all(r.segment_id.startswith(f"a_{r.speaker}_") for k, r in seg.items() if k[0] == "a") and not any(r.is_overlap for r in seg.values())
    assert {r.filter_reason for r in read("04b").where("speaker = 'TARGET'").collect()} == {"keep"}
    assert {r.text for r in read("06").collect()} == {f"长度 {n * rate // 10}" for n in (45, 50)}
    assert read("08").count() == 4 and read("08").first().evaluation.startswith("Judge")
    assert runner.run_missing(spark, ctx) == []
    # switched off, a stage is left out and its successor reads what is before it
    off = Context(folder, PipelineConfig(ensemble=Ensemble(enabled=False), evaluation=Evaluation(enabled=False)), models, ctx.command)
    assert runner.run_range(spark, off, "03", "08") == ["03", "04", "05", "06", "07"]
    assert {r.kind for r in read("03").collect()} == {"separator_a"}
    silent = Context(folder, cfg, {**models, "transcriber": lambda: lambda x, sr: 1 / 0}, ctx.command)
    with pytest.raises(ValueError, match="none of"):
        runner.run_stage(spark, silent, "05")
    assert read("05").count() == 4  # the table before is whole


def test_a_failed_overwrite_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(5), path)
    with pytest.raises(Exception, match="broken"):
        sinks.write_table(spark.range(9).select(F.when(F.col("id") == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id")), path)
    assert spark.read.parquet(path).count() == 5 and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["t"]
    sinks.write_table(spark.read.parquet(path).where("id < 3"), path)  # a table may be made from itself
    assert spark.read.parquet(path).count() == 3
    (tmp_path / "t").rename(tmp_path / "t.old")  # as if lost between two renames
    sinks.write_table(spark.range(1), path)
    assert spark.read.parquet(path).count() == 1 and not (tmp_path / "t.old").exists()


def test_shared_folder(spark):
    class Cluster:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("S", (), {"master": "spark://x", "getConf": staticmethod(dict), "getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(ValueError, match="share"):
        shared_dir(Cluster)


def test_stems_by_name_and_place(spark):
    rows = [("a", "/x/a_(Vocals).wav"), ("a", "/x/a_(Instrumental).wav"), ("b", "/x/1.wav"), ("b", "/x/2.wav"), ("c", "/x/vocals.wav"), ("d", "/x/d.wav")]
    got = {r.path: r.kind for r in files.name_stems(spark.createDataFrame(rows, "video_id string, path string")).collect()}
    assert got == {rows[0][1]: "vocals", rows[1][1]: "no_vocals", "/x/1.wav": "no_vocals", "/x/2.wav": "vocals", "/x/vocals.wav": "vocals", "/x/d.wav": None}


def test_slices_by_bytes():
    pdf = pd.DataFrame({"i": range(5), "x": [np.zeros(n) for n in (10, 10, 100, 1, 1)]})
    assert [p["i"].tolist() for p in hooks.by_bytes(pdf, 200)] == [[0, 1], [2], [3, 4]]
    assert [len(p) for p in hooks.by_bytes(pdf.iloc[:0])] == [0]


def test_streams(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    batch = landed(spark).select("video_id", "speaker", "duration_ms")
    batch.write.parquet(src)
    schema = spark.read.parquet(src).schema
    incremental.update_totals(incremental.read_new(spark, src, schema), out, check)
    batch.write.mode("append").parquet(src)
    incremental.update_totals(incremental.read_new(spark, src, schema), out, check)
    want = {tuple(r) for r in spark.read.parquet(src).groupBy("video_id", "speaker").agg(F.count("*"), F.sum("duration_ms")).collect()}
    assert {tuple(r) for r in spark.read.parquet(out).collect()} == want
    incremental.land(incremental.read_new(spark, src, schema, 1), str(tmp_path / "land"), str(tmp_path / "check2"))
    incremental.land(incremental.read_new(spark, src, schema, 1), str(tmp_path / "land"), str(tmp_path / "check2"))
    assert spark.read.parquet(str(tmp_path / "land")).count() == 12


def test_stream_windows(spark, tmp_path):
    src = str(tmp_path / "src")
    rows = [("A", "2024-01-01 00:00:00.0", 5), ("A", "2024-01-01 00:00:00.2", 5), ("A", "2024-01-01 00:00:01", 5), ("B", "2024-01-01 00:30:00", 5)]
    spark.createDataFrame(rows, "speaker string, ts string, duration_ms long").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(src)
    stream = incremental.read_new(spark, src, spark.read.parquet(src).schema)
    for name, df, n in (("s", incremental.sessions(stream), 3), ("w", incremental.windowed(stream), 2)):
        df.writeStream.format("memory").queryName(f"t_{name}").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
        assert spark.table(f"t_{name}").count() == n


def test_schemas():
    assert schemas.SEGMENTS["asr"].dataType["confidence"].dataType.typeName() == "double"


def test_extraction(spark, tmp_path):
    from voxmill.sources.extract import extract_tracks

    (tmp_path / "a.mp4").write_bytes(b"track")
    found = files.videos(spark, str(tmp_path)).drop("bytes")
    out = str(tmp_path / "out")
    copy = ("cp", "{source}", "{target}")
    assert [r.status for r in extract_tracks(found, out, copy).collect()] == ["success"]
    assert (tmp_path / "out" / "a.wav").read_bytes() == b"track"
    assert [r.status for r in extract_tracks(found, out, copy).collect()] == ["skipped"]
    assert [r.status for r in extract_tracks(found, str(tmp_path / "o2"), ("no-such-program",)).collect()] == ["failed"]


def test_written_waves(spark, tmp_path):
    df = spark.createDataFrame([("a", 16_000, [0.5, -0.5]), ("b", 16_000, None)], "segment_id string, sr int, samples array<float>")
    got = {r.segment_id: r.status for r in sinks.write_wavs(df, str(tmp_path / "w")).collect()}
    assert got["a"] == "success" and [round(x, 3) for x in audio.decode_wav((tmp_path / "w" / "a.wav").read_bytes())[0]] == [0.5, -0.5]


def test_model_hooks(spark):
    x = [0.0] * 8000 + [float(v) for v in np.sin(np.arange(16_000) / 5)] + [0.0] * 8000
    df = spark.createDataFrame([("s", "v", x, 16_000)], "segment_id string, video_id string, samples array<double>, sr int")
    speech = hooks.detect_speech(df).first()
    assert [(i.start, i.end) for i in speech.intervals] == [(0.5, 1.5)]
    r = hooks.separate(df, lambda: lambda s, sr: {"vocals": s, "no_vocals": s * 0}).first()
    assert r.status == "success" and max(r.vocals) == pytest.approx(1, abs=1e-3)
    d = hooks.diarize(df, lambda: lambda s, sr: ([("A", 0.0, 1.0)], {"A": np.ones(2)})).first()
    assert d.turns[0].speaker == "A" and d.embeddings[0].embedding == [1.0, 1.0]
    t = hooks.transcribe(df, lambda: lambda s, sr: {"text": "hi"}).first()
    assert (t.text, t.confidence) == ("hi", None)
    e = hooks.evaluate(df.selectExpr("*", "'hi' AS text"), lambda: lambda s, sr, prompt: prompt).first()
    assert e.evaluation.endswith("hi")
