"""Model hooks: what separation, diarization, speech detection, transcription and evaluation models must offer.

No model is shipped. A hook is loaded once per worker process by a factory, runs on Arrow batches, and a row that it fails on carries the error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from voxmill.config import Evaluation
from voxmill.functions.dsp import energy_vad, standardise


class Separator(Protocol):
    def __call__(self, samples: np.ndarray, sr: int) -> dict[str, np.ndarray]:
        """Stems by name: vocals and no_vocals."""


class Diarizer(Protocol):
    def __call__(self, samples: np.ndarray, sr: int) -> tuple[list[tuple[str, float, float]], dict[str, np.ndarray]]:
        """Turns (speaker, start, end) in seconds, and an embedding for each speaker."""


class SpeechDetector(Protocol):
    def __call__(self, samples: np.ndarray, sr: int) -> list[tuple[float, float]]:
        """Speech intervals in seconds."""


class Transcriber(Protocol):
    def __call__(self, samples: np.ndarray, sr: int) -> dict:
        """text, language, confidence, confidence_min, sentence_count."""


class Evaluator(Protocol):
    def __call__(self, samples: np.ndarray, sr: int, prompt: str) -> str:
        """A judgement in words."""


_loaded: dict = {}


def singleton(key: str, factory: Callable):
    """What factory() returns, made once per worker process and key."""
    if key not in _loaded:
        _loaded[key] = factory()
    return _loaded[key]


#: Bytes of input values that a hook has as Python objects, and whose results it holds, at a time.
HOOK_BYTES = 16 << 20


def by_bytes(pdf: pd.DataFrame, limit: int = HOOK_BYTES) -> Iterator[pd.DataFrame]:
    """The rows in slices of at most limit bytes of arrays; larger rows stand alone."""
    size = sum((pdf[c].map(lambda v: getattr(v, "nbytes", 0)) for c in pdf.columns), start=pd.Series(0, index=pdf.index)).tolist()
    start = total = 0
    for i, n in enumerate(size):
        if i > start and total + n > limit:
            yield pdf.iloc[start:i]
            start, total = i, 0
        total += n
    yield pdf.iloc[start:]


def apply_hook(df: DataFrame, factory: Callable, call: Callable, schema: str, keep: tuple[str, ...]) -> DataFrame:
    """keep columns of df, the columns of schema (fields of its structs are parted by semicolons) that call(model, row) returns as a dict, and status and error.

    A row that raises has status failed, its error's text and null results; the others have status success.
    """
    names = [x.strip().split()[0] for x in schema.split(",")]
    schema = schema.replace(";", ",")
    kept = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)

    key = hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = singleton(key, factory)
        for pdf in (part for batch in batches for part in by_bytes(batch)):
            rows = []
            for row in pdf.to_dict("records"):
                try:
                    rows.append({**{c: row[c] for c in keep}, **call(model, row), "status": "success", "error": None})
                except Exception as e:  # isolated: one bad record doesn't end the run
                    rows.append({**{c: row[c] for c in keep}, **dict.fromkeys(names), "status": "failed", "error": f"{type(e).__name__}: {e}"})
            yield pd.DataFrame(rows, columns=[*keep, *names, "status", "error"])

    return df.mapInPandas(run, f"{kept}, {schema}, status string, error string")


def energy_detector() -> SpeechDetector:
    """The default speech detector, without a model."""
    return energy_vad


WAVE = ("segment_id", "video_id")


def separate(df: DataFrame, factory: Callable[[], Separator]) -> DataFrame:
    """vocals and no_vocals of rows (segment_id, video_id, samples, sr), run on standardised samples; stems over full scale are scaled down."""

    def call(model: Separator, row: dict) -> dict:
        x, mean, deviation = standardise(np.asarray(row["samples"], dtype=np.float64))
        stems = model(x, int(row["sr"]))
        out = {k: stems[k] * deviation + mean for k in ("vocals", "no_vocals")}
        return {k: (v / max(1.0, float(np.abs(v).max(initial=0.0)))).tolist() for k, v in out.items()}

    return apply_hook(df, factory, call, "vocals array<double>, no_vocals array<double>", WAVE)


def diarize(df: DataFrame, factory: Callable[[], Diarizer]) -> DataFrame:
    """turns, and embeddings by speaker, of rows (segment_id, video_id, samples, sr); voxmill.operators.intervals.turns reads the turns."""

    def call(model: Diarizer, row: dict) -> dict:
        turns, embeddings = model(np.asarray(row["samples"]), int(row["sr"]))
        return {"turns": [{"speaker": s, "start": float(a), "end": float(b)} for s, a, b in turns], "embeddings": [{"speaker": s, "embedding": [float(x) for x in e]} for s, e in embeddings.items()]}

    return apply_hook(df, factory, call, "turns array<struct<speaker:string;start:double;end:double>>, embeddings array<struct<speaker:string;embedding:array<double>>>", WAVE)


def detect_speech(df: DataFrame, factory: Callable[[], SpeechDetector] = energy_detector) -> DataFrame:
    """Speech intervals of rows (segment_id, video_id, samples, sr)."""

    def call(model: SpeechDetector, row: dict) -> dict:
        return {"intervals": [{"start": a, "end": b} for a, b in model(np.asarray(row["samples"], dtype=np.float64), int(row["sr"]))]}

    return apply_hook(df, factory, call, "intervals array<struct<start:double;end:double>>", WAVE)


def transcribe(df: DataFrame, factory: Callable[[], Transcriber]) -> DataFrame:
    """text, language, confidence, confidence_min and sentence_count of rows (segment_id, video_id, samples, sr)."""

    def call(model: Transcriber, row: dict) -> dict:
        r = model(np.asarray(row["samples"]), int(row["sr"]))
        return {k: r.get(k) for k in ("text", "language", "confidence", "confidence_min", "sentence_count")}

    return apply_hook(df, factory, call, "text string, language string, confidence double, confidence_min double, sentence_count int", WAVE)


def evaluate(df: DataFrame, factory: Callable[[], Evaluator], cfg: Evaluation = Evaluation()) -> DataFrame:
    """(segment_id, video_id, text, evaluation, status, error) of rows (segment_id, video_id, text, samples, sr)."""

    def call(model: Evaluator, row: dict) -> dict:
        return {"evaluation": model(np.asarray(row["samples"]), int(row["sr"]), cfg.prompt.format(text=row["text"]))}

    return apply_hook(df, factory, call, "evaluation string", ("segment_id", "video_id", "text"))


def resource_profile(gpus: int):
    """A Spark resource profile that gives each task so many GPUs; None for none."""
    if not gpus:
        return None
    from pyspark.resource import ResourceProfileBuilder, TaskResourceRequests

    return ResourceProfileBuilder().require(TaskResourceRequests().resource("gpu", gpus)).build
