"""Signal metrics of one waveform in numpy, and their Arrow-batched forms as Spark functions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import functions as F

RATE = 16_000
FLOOR = 1e-12


def frames(x: np.ndarray, length: int, hop: int) -> np.ndarray:
    """Overlapping frames as rows; a shorter signal is one frame as it is."""
    return sliding_window_view(x, length)[::hop] if len(x) >= length else x[None, :]


def snr_db(x: np.ndarray, length: int = 512, hop: int = 256) -> float:
    """Decibels between the 90th and the 10th percentile of frame energies, within 0 and 60."""
    energy = (frames(np.asarray(x, dtype=np.float64), length, hop) ** 2).sum(axis=1)
    low, high = np.maximum(np.percentile(energy, [10, 90]), FLOOR)
    return float(np.clip(10 * math.log10(high / low), 0, 60))


def flatness(x: np.ndarray, mask: np.ndarray, n_fft: int = 1024, hop: int = 512, legacy_inplace_window: bool = True) -> float:
    """Median over frames of speech of the ratio of geometric to arithmetic mean power, without the constant part; 1 below one frame.

    With legacy_inplace_window the window is applied to the signal itself, so that the half a frame shares with the one before is windowed twice.
    The default thresholds were tuned on such values.
    """
    speech = np.array(x, dtype=np.float64)[np.asarray(mask, dtype=bool)]
    if len(speech) < n_fft:
        return 1.0
    window, out = np.hanning(n_fft), []
    for a in range(0, len(speech) - n_fft + 1, hop):
        frame = speech[a : a + n_fft] * window
        if legacy_inplace_window:
            speech[a : a + n_fft] = frame
        power = np.maximum(np.abs(np.fft.rfft(frame))[1:], FLOOR) ** 2
        out.append(np.exp(np.log(power).mean()) / max(power.mean(), FLOOR))
    return float(np.median(out))


def harmonicity_db(x: np.ndarray, mask: np.ndarray, sr: int = RATE, f0_min: int = 80, f0_max: int = 400, length: int = 1024, hop: int = 512) -> float:
    """Median over frames that are half speech of the harmonic-to-noise ratio from the autocorrelation's peak; 0 without such frames."""
    x = np.asarray(x, dtype=np.float64)
    if len(x) < length:
        return 0.0
    use = frames(np.asarray(mask, dtype=np.int64), length, hop).sum(axis=1) >= length * 0.5
    f = frames(x, length, hop)[use] * np.hanning(length)
    if not len(f):
        return 0.0
    size = 1 << (2 * length - 1).bit_length()
    correlation = np.fft.irfft(np.abs(np.fft.rfft(f, size)) ** 2, size)[:, :length]
    r = (correlation / np.maximum(correlation[:, :1], FLOOR))[:, sr // f0_max : sr // f0_min].max(axis=1)
    r = r[(r > 0) & (r < 1)]
    return float(np.median(np.clip(10 * np.log10(r / (1 - r + FLOOR)), 0, 40))) if len(r) else 0.0


def energy_vad(x: np.ndarray, sr: int = RATE, frame_ms: int = 20, above_db: float = 12.0, min_speech_ms: int = 250, min_silence_ms: int = 300) -> list[tuple[float, float]]:
    """Speech intervals in seconds: frames well above the quiet tenth, silences and speech shorter than the limits filled in or dropped."""
    n = sr * frame_ms // 1000
    energy = np.array([float((x[a : a + n] ** 2).mean()) for a in range(0, len(x) - n + 1, n)]) if len(x) >= n else np.zeros(0)
    if not len(energy) or energy.max() < FLOOR:
        return []
    loud = energy >= min(max(np.percentile(energy, 10), FLOOR) * 10 ** (above_db / 10), energy.max() / 4)
    edge = np.diff(np.concatenate(([0], loud.astype(np.int8), [0])))
    out: list[list[int]] = []
    for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
        if out and (a - out[-1][1]) * frame_ms < min_silence_ms:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a * frame_ms / 1000, b * frame_ms / 1000) for a, b in out if (b - a) * frame_ms >= min_speech_ms]


def interval_mask(intervals: list[tuple[float, float]], n: int, sr: int = RATE) -> np.ndarray:
    """Samples inside any of the intervals, bounds cut to the signal."""
    mask = np.zeros(n, dtype=bool)
    for a, b in intervals:
        mask[max(0, int(a * sr)) : min(n, int(b * sr))] = True
    return mask


def mask_intervals(mask: np.ndarray, sr: int = RATE) -> list[tuple[float, float]]:
    edge = np.diff(np.concatenate(([0], np.asarray(mask, dtype=np.int8), [0])))
    return [(a / sr, b / sr) for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)]


def peak_normalise(x: np.ndarray) -> np.ndarray:
    peak = float(np.abs(x).max(initial=0.0))
    return x / peak if peak > 1e-8 else x


def _k_weight(f: np.ndarray, sr: int) -> np.ndarray:
    """Frequency response of the K weighting of ITU-R BS.1770 (a high shelf and a high pass, as bilinear biquads)."""
    z = np.exp(-2j * np.pi * f / sr)
    # fixed values: centre frequency, quality and gain of the two filters
    k, q, gain = math.tan(math.pi * 1681.9744509555319 / sr), 0.7071752369554193, 10 ** (3.99984385397 / 20)
    root = gain**0.499666774155
    shelf = (gain + root * k / q + k * k + 2 * (k * k - gain) * z + (gain - root * k / q + k * k) * z * z) / (1 + k / q + k * k + 2 * (k * k - 1) * z + (1 - k / q + k * k) * z * z)
    k, q = math.tan(math.pi * 38.13547087602444 / sr), 0.5003270373238773
    passing = (1 - 2 * z + z * z) / (1 + 2 * (k * k - 1) / (1 + k / q + k * k) * z + (1 - k / q + k * k) / (1 + k / q + k * k) * z * z)
    return shelf * passing


def loudness_lufs(x: np.ndarray, sr: int = RATE) -> float | None:
    """Integrated loudness of a mono signal by ITU-R BS.1770-4: gated blocks of 400 ms; None below one block or where all blocks are gated."""
    block, hop = sr * 4 // 10, sr // 10
    if len(x) < block:
        return None
    n = len(x) + sr  # the filter's end dies away in less than a second
    weighted = np.fft.irfft(np.fft.rfft(np.asarray(x, dtype=np.float64), n) * _k_weight(np.fft.rfftfreq(n, 1 / sr), sr), n)[: len(x)]
    power = (frames(weighted, block, hop) ** 2).mean(axis=1)
    power = power[-0.691 + 10 * np.log10(np.maximum(power, FLOOR)) > -70]
    if not len(power):
        return None
    power = power[10 * np.log10(power) > 10 * math.log10(power.mean()) - 10]
    return -0.691 + 10 * math.log10(power.mean())


def rms_db(x: np.ndarray) -> float:
    """Root mean square in decibels below full scale."""
    return 20 * math.log10(max(math.sqrt(float((np.asarray(x, dtype=np.float64) ** 2).mean())) if len(x) else 0.0, FLOOR))


def loudness(x: np.ndarray, sr: int = RATE) -> float:
    """Integrated loudness, or the level of the root mean square where there is none."""
    found = loudness_lufs(x, sr)
    return rms_db(x) if found is None else found


def loudness_normalise(x: np.ndarray, target_db: float = -26.0, sr: int = RATE) -> np.ndarray:
    """Scaled to a loudness of target_db; silence stays."""
    return x * 10 ** ((target_db - loudness(x, sr)) / 20) if rms_db(x) > -200 else x


def dc_offset(x: np.ndarray) -> float:
    """The constant part of a signal."""
    return float(np.asarray(x, dtype=np.float64).mean()) if len(x) else 0.0


def clipping_ratio(x: np.ndarray, limit: float = 0.99) -> float:
    return float((np.abs(x) > limit).mean()) if len(x) else 0.0


def trim_silence(x: np.ndarray, below_db: float = -40.0, frame: int = 512, hop: int = 256) -> np.ndarray:
    """Without the quiet hops at either end, by frames centred on each hop; a signal that is quiet throughout becomes empty."""
    if not len(x):
        return x
    padded = np.pad(np.asarray(x, dtype=np.float64), frame // 2)
    level = np.sqrt((frames(padded, frame, hop) ** 2).mean(axis=1))
    loud = np.flatnonzero((level > level.max() * 10 ** (below_db / 20)) & (level > FLOOR))
    return x[loud[0] * hop : min(len(x), (loud[-1] + 1) * hop)] if len(loud) else x[:0]


def resample_poly(x: np.ndarray, rate: int, target: int, half: int = 10, beta: float = 5.0) -> np.ndarray:
    """Rational resampling by a Kaiser-windowed low-pass of half * max(up, down) taps to either side."""
    if rate == target or not len(x):
        return np.asarray(x, dtype=np.float64)
    g = math.gcd(rate, target)
    up, down = target // g, rate // g
    taps = half * max(up, down)
    t = np.arange(-taps, taps + 1)
    h = np.sinc(t / max(up, down)) * np.kaiser(2 * taps + 1, beta)
    h *= up / h.sum()
    n_out = -(-len(x) * up // down)
    at = np.arange(n_out) * down
    # output k sums x[i] h[taps + at - i up] over the inputs under the filter
    first = -((taps - at) // up)
    reach = 2 * taps // up + 1
    i = first[:, None] + np.arange(reach)
    tap = taps + at[:, None] - i * up
    ok = (i >= 0) & (i < len(x)) & (tap >= 0) & (tap <= 2 * taps)
    return (np.where(ok, np.asarray(x, dtype=np.float64)[np.clip(i, 0, len(x) - 1)] * h[np.clip(tap, 0, 2 * taps)], 0)).sum(axis=1)


def resample_fft(x: np.ndarray, rate: int, target: int) -> np.ndarray:
    """Resampling by cutting or padding the spectrum to int(n * target / rate) samples."""
    n, m = len(x), int(len(x) * target / rate)
    spectrum = np.fft.rfft(x)
    keep = np.zeros(m // 2 + 1, dtype=complex)
    k = min(len(spectrum), len(keep))
    keep[:k] = spectrum[:k]
    if min(n, m) % 2 == 0 and n != m and k == min(n, m) // 2 + 1:
        keep[k - 1] *= 0.5 if m > n else 2.0
        if m < n:
            keep[k - 1] = keep[k - 1].real
    return np.fft.irfft(keep, m) * (m / n) if m else x[:0]


def stft(x: np.ndarray, n_fft: int, hop: int) -> np.ndarray:
    """(frame, bin) spectra of centred Hann frames."""
    padded = np.pad(np.asarray(x, dtype=np.float64), n_fft // 2, mode="reflect" if len(x) > n_fft // 2 else "constant")
    return np.fft.rfft(frames(padded, n_fft, hop) * _hann(n_fft), axis=1)


def istft(spectra: np.ndarray, n_fft: int, hop: int, length: int) -> np.ndarray:
    out, weight = np.zeros(n_fft + hop * (len(spectra) - 1)), np.zeros(n_fft + hop * (len(spectra) - 1))
    w = _hann(n_fft)
    for k, f in enumerate(np.fft.irfft(spectra, n_fft, axis=1)):
        out[k * hop : k * hop + n_fft] += f * w
        weight[k * hop : k * hop + n_fft] += w * w
    return (out / np.maximum(weight, 1e-10))[n_fft // 2 : n_fft // 2 + length]


def _hann(n: int) -> np.ndarray:
    return 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)


def ensemble_masks(mix: np.ndarray, vocals_a: np.ndarray, vocals_b: np.ndarray, n_fft_a: int, n_fft_b: int, hop: int, weight_a: float = 0.5, weight_b: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """(vocals, rest) of a mixture from two models' vocals: their soft masks, a's stretched to b's bins, averaged and applied to the mixture.

    Signals are cut to the shortest and to whole hops; below a frame a's vocals are the result.
    """
    n = min(len(mix), len(vocals_a), len(vocals_b)) // hop * hop
    mix, vocals_a, vocals_b = mix[:n], vocals_a[:n], vocals_b[:n]
    if n < max(n_fft_a, n_fft_b):
        return vocals_a, mix - vocals_a

    def mask(v: np.ndarray, n_fft: int) -> np.ndarray:
        pv, pr = np.abs(stft(v, n_fft, hop)) ** 2, np.abs(stft(mix - v, n_fft, hop)) ** 2
        return pv / (pv + pr + 1e-8)

    a, b = mask(vocals_a, n_fft_a), mask(vocals_b, n_fft_b)
    if a.shape[1] != b.shape[1]:
        at = (np.arange(b.shape[1]) + 0.5) * a.shape[1] / b.shape[1] - 0.5
        a = np.stack([np.interp(at, np.arange(a.shape[1]), row) for row in a])
    spectra = stft(mix, n_fft_b, hop)
    k = min(len(a), len(b), len(spectra))
    m = (weight_a * a[:k] + weight_b * b[:k]) / (weight_a + weight_b)
    vocals = istft(spectra[:k] * m, n_fft_b, hop, n)
    return vocals, mix - vocals


def standardise(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """(z-scores, mean, deviation) with a guarded deviation, to be undone after a model has run."""
    mean, deviation = float(x.mean()), max(float(x.std()), 1e-8)
    return (x - mean) / deviation, mean, deviation


def metrics(samples: pd.Series, speech: pd.Series, sr: int = RATE) -> pd.DataFrame:
    rows = []
    for x, intervals in zip(samples, speech, strict=True):
        x = np.asarray(x if x is not None else [], dtype=np.float64)
        spans = [(i["start"], i["end"]) for i in intervals] if intervals is not None else energy_vad(x, sr)
        mask = interval_mask(spans, len(x), sr)
        rows.append((snr_db(x) if len(x) else 0.0, flatness(x, mask), harmonicity_db(x, mask, sr), int(mask.sum()), len(x)))
    return pd.DataFrame(rows, columns=["snr_db", "sfm", "hnr_db", "speech_samples", "total_samples"])


METRICS = "snr_db double, sfm double, hnr_db double, speech_samples bigint, total_samples bigint"


def metrics_udf(sr: int = RATE):
    """Spark function (samples, intervals or null) -> struct of the metrics."""

    @F.pandas_udf(METRICS)
    def run(samples: pd.Series, speech: pd.Series) -> pd.DataFrame:
        return metrics(samples, speech, sr)

    return run
