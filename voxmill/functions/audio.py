"""WAV bytes to samples and back, with the standard library and numpy."""

from __future__ import annotations

import io
import wave

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_wav(content: bytes) -> tuple[np.ndarray, int]:
    """(mono samples in [-1, 1], rate) of PCM with 1 to 4 bytes a sample; channels are averaged."""
    with wave.open(io.BytesIO(content)) as w:
        width, channels, rate = w.getsampwidth(), w.getnchannels(), w.getframerate()
        raw = w.readframes(w.getnframes())
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float64) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8) / float(1 << 23)
    else:
        x = np.frombuffer(raw, f"<i{width}").astype(np.float64) / float(1 << (8 * width - 1))
    return x.reshape(-1, channels).mean(axis=1), rate


def encode_wav(samples: np.ndarray, rate: int) -> bytes:
    """16-bit PCM bytes; samples beyond [-1, 1] are scaled down by their peak."""
    peak = float(np.abs(samples).max(initial=0.0))
    x = np.asarray(samples, dtype=np.float64) / max(peak, 1.0)
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1 if x.ndim == 1 else x.shape[1])
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.round(x * 32767).astype("<i2").tobytes())
    return out.getvalue()


def slice_wave(samples: Column, sr: Column, start_ms: Column, end_ms: Column) -> Column:
    """The samples from start_ms to before end_ms, bounds cut to the signal; null without samples."""
    first = F.floor(F.greatest(start_ms, F.lit(0)) * sr / 1000).cast("int")
    last = F.least(F.floor(end_ms * sr / 1000).cast("int"), F.size(samples))
    return F.when(samples.isNotNull(), F.slice(samples, first + 1, F.greatest(last - first, F.lit(0))))
