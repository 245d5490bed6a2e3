"""Settings of the stages, checked when they are made.

Fixed values: the fields and their defaults are the interface of the stages, and
ids of runs are hashes over them.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class QualityGates:
    min_duration: float
    max_duration: float
    target_sample_rate: int = 16_000
    require_sample_rate_match: bool = True
    max_clipping_ratio: float = 0.005
    max_silence_ratio: float = 0.30
    min_rms_dbfs: float = -40.0
    max_rms_dbfs: float = -8.0
    min_snr_db: float = 10.0
    max_overlap_ratio: float = 0.10
    max_dc_offset: float = 0.01
    drop_music: bool = True
    require_quality: bool = True
    require_overlap: bool = True
    require_music: bool = True


# The two layers of defaults, of the library and of the command line.
SSL_GATES = QualityGates(3.0, 30.0, max_silence_ratio=0.5, min_snr_db=8.0, max_overlap_ratio=0.15)
LABELED_GATES = QualityGates(0.8, 30.0, max_silence_ratio=0.6, min_snr_db=5.0, max_overlap_ratio=0.2)
CLI_LAYER = {"max_clipping_ratio": 0.001, "min_rms_dbfs": -45.0, "max_rms_dbfs": -3.0}


@dataclass(frozen=True)
class TextGates:
    require_text: bool = True
    min_chars_per_second: float = 3.0
    max_chars_per_second: float = 25.0


@dataclass(frozen=True)
class TextNormalization:
    lowercase: bool = True
    normalize_unicode: bool = True
    remove_bracketed_text: bool = True
    remove_numbers: bool = False
    keep_word_apostrophe: bool = True


@dataclass(frozen=True)
class AudioQuality:
    silence_threshold_dbfs: float = -50.0
    clipping_threshold: float = 0.999
    frame_ms: float = 25.0
    hop_ms: float = 10.0
    noise_percentile: float = 10.0
    target_min_dbfs: float = -35.0
    target_max_dbfs: float = -8.0


@dataclass(frozen=True)
class Vad:
    target_sample_rate: int = 16_000
    threshold: float = 0.5
    min_speech_duration_ms: int = 250
    min_silence_duration_ms: int = 1000
    speech_pad_ms: int = 300
    min_segment_duration: float = 1.5
    max_segment_duration: float = 30.0
    max_threads: int | None = 1

    def __post_init__(self):
        if self.max_segment_duration <= 0:
            raise ValueError("max_segment_duration must be positive")


@dataclass(frozen=True)
class Overlap:
    model_name: str = "pyannote/overlapped-speech-detection"
    min_overlap_duration: float = 0.1
    max_threads: int | None = 1


@dataclass(frozen=True)
class Music:
    model_name: str = "MIT/ast-finetuned-audioset-10-10-0.4593"
    target_sample_rate: int = 16_000
    window_seconds: float = 10.0
    music_threshold: float = 0.5
    music_label: str = "Music"
    top_k_labels: int = 5
    batch_size: int = 8
    max_threads: int | None = 1


@dataclass(frozen=True)
class Materialize:
    output_format: str = "flac"
    subtype: str | None = None
    overwrite: bool = False

    def __post_init__(self):
        if self.output_format not in ("flac", "wav"):
            raise ValueError("output_format must be flac or wav")


@dataclass(frozen=True)
class SplitRatios:
    train: float = 0.8
    val: float = 0.1
    test: float = 0.1

    def __post_init__(self):
        if abs(self.train + self.val + self.test - 1.0) > 1e-6:
            raise ValueError("ratios must sum to 1")


@dataclass(frozen=True)
class Selection:
    gates: QualityGates = SSL_GATES
    allowed_languages: tuple[str, ...] | None = None
    max_clips_per_source: int | None = None
    target_hours: float | None = None

    def __post_init__(self):
        if self.max_clips_per_source is not None and self.max_clips_per_source < 0:
            raise ValueError("max_clips_per_source must not be negative")
        if self.target_hours is not None and self.target_hours < 0:
            raise ValueError("target_hours must not be negative")


@dataclass(frozen=True)
class LabeledSplit:
    gates: QualityGates = LABELED_GATES
    ratios: SplitRatios = SplitRatios()
    group_key: str = "audio_id"
    stratify_keys: tuple[str, ...] = ("dataset", "language")
    require_text: bool = True
    min_chars_per_second: float = 3.0
    max_chars_per_second: float = 25.0
    allowed_languages: tuple[str, ...] | None = None
    salt: str = "labeled_split_v1"

    @property
    def text_gates(self) -> TextGates:
        return TextGates(self.require_text, self.min_chars_per_second, self.max_chars_per_second)
