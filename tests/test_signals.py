from __future__ import annotations

import numpy as np
import pytest

from voxmill.functions import audio, dsp

RNG = np.random.default_rng(1)
SINE = np.sin(2 * np.pi * 200 * np.arange(16_000) / 16_000)
NOISE = RNG.normal(size=16_000)
ALL = np.ones(16_000, dtype=bool)


def test_snr():
    assert dsp.snr_db(np.zeros(2000)) == 0
    assert dsp.snr_db(np.ones(4096)) == pytest.approx(0)
    assert dsp.snr_db(np.concatenate([np.full(8192, 0.01), np.full(8192, 1.0)])) == pytest.approx(40, abs=0.5)
    assert dsp.snr_db(np.concatenate([np.zeros(8192), np.ones(8192)])) == 60


def test_flatness():
    assert dsp.flatness(SINE, ALL[:500].repeat(32)[:16_000] & False) == 1.0
    assert dsp.flatness(SINE, ALL, legacy_inplace_window=False) < 0.01
    assert dsp.flatness(NOISE, ALL, legacy_inplace_window=False) == pytest.approx(0.55, abs=0.05)
    assert dsp.flatness(NOISE, ALL) >= dsp.flatness(NOISE, ALL, legacy_inplace_window=False) - 0.02


def test_harmonicity():
    assert dsp.harmonicity_db(SINE[:500], ALL[:500]) == 0
    # a tone's autocorrelation at its period is the window's overlap alone
    assert dsp.harmonicity_db(SINE, ALL) > 8 > 3 > dsp.harmonicity_db(NOISE, ALL)
    x = SINE[:1024] * np.hanning(1024)
    r = np.correlate(x, x, "full")[1023:]
    r = (r / r[0])[40:200].max()
    assert dsp.harmonicity_db(SINE[:1024], ALL[:1024]) == pytest.approx(10 * np.log10(r / (1 - r)), abs=1e-6)


def test_loudness_and_peaks():
    assert dsp.loudness(dsp.loudness_normalise(NOISE)) == pytest.approx(-26)
    short = NOISE[:1000]  # below one block the level of the root mean square counts
    assert 20 * np.log10(np.sqrt((dsp.loudness_normalise(short) ** 2).mean())) == pytest.approx(-26)
    # the standard's own calibration: a full-scale tone of 997 Hz in one channel is at -3.01
    for sr in (16_000, 48_000):
        assert dsp.loudness_lufs(np.sin(2 * np.pi * 997 * np.arange(5 * sr) / sr), sr) == pytest.approx(-3.01, abs=0.05)
    assert dsp.loudness_lufs(np.zeros(16_000)) is None and dsp.dc_offset(np.full(9, 0.25)) == 0.25
    assert dsp.loudness_normalise(np.zeros(5)).tolist() == [0] * 5
    assert np.abs(dsp.peak_normalise(NOISE)).max() == pytest.approx(1)
    assert dsp.clipping_ratio(np.array([1.0, 0.5])) == 0.5
    assert len(dsp.trim_silence(np.concatenate([np.zeros(2048), np.ones(512), np.zeros(2048)]))) == 768


def test_masks():
    mask = dsp.interval_mask([(0.1, 0.2), (0.5, 9.0)], 16_000)
    assert mask.sum() == 1600 + 8000
    assert dsp.mask_intervals(mask) == [(0.1, 0.2), (0.5, 1.0)]
    x = np.concatenate([np.zeros(16_000), 0.5 * SINE, np.zeros(16_000)])
    assert dsp.energy_vad(x) == [(1.0, 2.0)]
    assert dsp.energy_vad(np.zeros(16_000)) == []


@pytest.mark.parametrize("rate, target", [(48_000, 16_000), (44_100, 16_000), (8000, 16_000)])
def test_resampling(rate, target):
    tone = np.sin(2 * np.pi * 300 * np.arange(rate) / rate)
    want = np.sin(2 * np.pi * 300 * np.arange(target) / target)
    for f in (dsp.resample_poly, dsp.resample_fft):
        got = f(tone, rate, target)
        assert len(got) == target
        assert np.abs(got - want)[500:-500].max() < 0.01


def test_wav_round_trip():
    got, sr = audio.decode_wav(audio.encode_wav(np.stack([SINE, SINE], axis=1), 16_000))
    assert sr == 16_000
    assert np.abs(got - SINE).max() < 1e-3
    assert np.abs(audio.decode_wav(audio.encode_wav(3 * SINE, 16_000))[0]).max() == pytest.approx(1, abs=1e-3)


def test_ensemble():
    voice, rest = 0.5 * SINE, 0.1 * NOISE
    v, r = dsp.ensemble_masks(voice + rest, voice, voice, 1024, 2048, 512)
    assert len(v) == 16_000 // 512 * 512
    assert np.abs(v + r - (voice + rest)[: len(v)]).max() < 1e-9
    assert ((v - voice[: len(v)])[2048:-2048] ** 2).mean() < 0.2 * (rest**2).mean()
    short = dsp.ensemble_masks(voice[:1000], voice[:1000], voice[:1000], 1024, 2048, 512)
    assert len(short[0]) == 512
    assert np.abs(dsp.istft(dsp.stft(NOISE[:8192], 1024, 256), 1024, 256, 8192) - NOISE[:8192]).max() < 1e-9
