"""Parameters of all operators. The defaults are fixed values that results depend on; JSON files override them."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Precision:
    enabled: bool = True
    clustering_threshold: float = 0.55
    embedding_gate: bool = True
    embedding_max_distance: float = 0.5
    iqr_outlier_detection: bool = True
    min_segment_ms: int = 1500


@dataclass(frozen=True)
class Diarization:
    min_segment_ms: int = 500
    max_segment_ms: int = 10_000
    min_gap_ms: int = 300
    min_child_ms: int = 300
    overlap_ms: int = 50
    max_speakers: int = 5
    clustering_threshold: float = 0.5
    enable_outlier_detection: bool = True
    outlier_factor: float = 1.5
    save_interval: int = 10
    precision: Precision = field(default_factory=Precision)

    @property
    def threshold(self) -> float:
        return self.precision.clustering_threshold if self.precision.enabled else self.clustering_threshold


@dataclass(frozen=True)
class QualityGate:
    enabled: bool = False
    snr_db: float = 8.0
    sfm: float = 0.03
    hnr_db: float = 4.0
    vad: float = 0.5
    min_speech_ratio: float = 0.5


@dataclass(frozen=True)
class Asr:
    language: str = "zh"
    min_duration: float = 0.5
    min_chars: int = 2
    confidence: float = 0.85
    #: Character class of the wanted script: CJK ideographs.
    script: str = "\\u4E00-\\u9FFF\\u3400-\\u4DBF"


@dataclass(frozen=True)
class Dataset:
    min_total_minutes: float = 30
    speaker_name: str = "target_blogger"
    language: str = "ZH"


@dataclass(frozen=True)
class Ensemble:
    enabled: bool = True
    n_fft: int = 4096
    hop: int = 1024
    weight_a: float = 0.5
    weight_b: float = 0.5


@dataclass(frozen=True)
class Evaluation:
    enabled: bool = True
    prompt: str = "Judge the quality of this recording. Its text is: {text}"


@dataclass(frozen=True)
class PipelineConfig:
    diarization: Diarization = field(default_factory=Diarization)
    quality: QualityGate = field(default_factory=QualityGate)
    asr: Asr = field(default_factory=Asr)
    dataset: Dataset = field(default_factory=Dataset)
    ensemble: Ensemble = field(default_factory=Ensemble)
    evaluation: Evaluation = field(default_factory=Evaluation)


def _merge(value, override: dict):
    known = {f.name for f in dataclasses.fields(value)}
    if unknown := set(override) - known:
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    return dataclasses.replace(value, **{k: _merge(getattr(value, k), v) if dataclasses.is_dataclass(getattr(value, k)) else v for k, v in override.items()})


def load_config(path: str | None = None) -> PipelineConfig:
    """Defaults, overridden by a JSON file of the same nesting; unknown names raise."""
    if path is None:
        return PipelineConfig()
    with open(path, encoding="utf-8") as f:
        return _merge(PipelineConfig(), json.load(f))
