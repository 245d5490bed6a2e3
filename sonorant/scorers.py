"""The boundary to models: what a scorer takes and gives, and simple ones that need no model."""

from __future__ import annotations

import os
import platform
import resource
import sys
from importlib import metadata
from typing import Protocol

import numpy as np

from .config import Music, Overlap, Vad


class SpeechDetector(Protocol):
    name: str

    def detect(self, wave: np.ndarray, rate: int) -> list[tuple[int, int]]:
        """Speech as sample offsets [start, end)."""


class OverlapDetector(Protocol):
    name: str

    def overlaps(self, audio: np.ndarray, rate: int) -> list[tuple[float, float]]:
        """Overlapped speech in seconds, from (channels, samples)."""


class WindowClassifier(Protocol):
    name: str
    labels: list[str]

    def score(self, windows: np.ndarray) -> np.ndarray:
        """(windows, labels) probabilities."""


class EnergySpeech:
    """Speech where frames are loud: spans shorter than the minimum vanish, short silences close, ends are padded."""

    name = "energy"

    def __init__(self, level_dbfs: float = -40.0, frame_ms: int = 20, min_speech_ms: int = 250, min_silence_ms: int = 1000, pad_ms: int = 300):
        self.level, self.frame = 10 ** (level_dbfs / 20), frame_ms
        self.min_speech, self.min_silence, self.pad = min_speech_ms, min_silence_ms, pad_ms

    def detect(self, wave: np.ndarray, rate: int) -> list[tuple[int, int]]:
        size = max(1, rate * self.frame // 1000)
        frames = len(wave) // size
        if not frames:
            return []
        rms = np.sqrt((wave[: frames * size].astype(np.float64).reshape(frames, size) ** 2).mean(1))
        loud = np.concatenate(([False], rms > self.level, [False]))
        edges = np.flatnonzero(loud[1:] != loud[:-1])
        spans: list[list[int]] = []
        for start, end in zip(edges[::2] * size, edges[1::2] * size):
            if spans and start - spans[-1][1] < self.min_silence * rate // 1000:
                spans[-1][1] = int(end)
            else:
                spans.append([int(start), int(end)])
        pad = self.pad * rate // 1000
        spans = [s for s in spans if s[1] - s[0] >= self.min_speech * rate // 1000]
        out: list[tuple[int, int]] = []
        for start, end in spans:
            start, end = max(0, start - pad), min(len(wave), end + pad)
            out.append((max(start, out[-1][1]) if out else start, end))
        return out


class NoOverlap:
    name = "none"

    def overlaps(self, audio: np.ndarray, rate: int) -> list[tuple[float, float]]:
        return []


class FlatnessMusic:
    """A stand-in classifier: the more even the spectrum's peaks, the less music."""

    name = "flatness"
    labels = ["Speech", "Music", "Silence"]

    def score(self, windows: np.ndarray) -> np.ndarray:
        power = np.abs(np.fft.rfft(windows.astype(np.float64), axis=1)) ** 2 + 1e-12
        flat = np.exp(np.log(power).mean(1)) / power.mean(1)
        quiet = (windows.astype(np.float64) ** 2).mean(1) < 1e-8
        music = np.where(quiet, 0.0, np.clip(1 - 4 * flat, 0, 1))
        return np.stack([np.where(quiet, 0.0, 1 - music), music, quiet.astype(float)], axis=1)


class Lazy:
    """A scorer that each worker builds on first use: only its recipe travels to the tasks."""

    def __init__(self, build, name: str, **shown):
        self._build, self.name = build, name
        self.__dict__.update(shown)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_made"}

    def made(self):
        if "_made" not in self.__dict__:
            self.__dict__["_made"] = self._build()
        return self.__dict__["_made"]


def _threads(count: int | None) -> None:
    if count:
        import torch

        torch.set_num_threads(count)


class Silero(Lazy):
    """The public Silero model by its package; speech as sample offsets."""

    def __init__(self, config: Vad, on: str = "cpu"):
        def build():
            import silero_vad

            _threads(config.max_threads)
            return silero_vad.load_silero_vad().to(on)

        super().__init__(build, "silero_vad")
        self._config, self._on = config, on

    def detect(self, wave: np.ndarray, rate: int) -> list[tuple[int, int]]:
        import silero_vad
        import torch

        model, c = self.made(), self._config
        found = silero_vad.get_speech_timestamps(
            torch.from_numpy(wave).to(self._on), model, sampling_rate=rate, threshold=c.threshold, min_speech_duration_ms=c.min_speech_duration_ms,
            min_silence_duration_ms=c.min_silence_duration_ms, speech_pad_ms=c.speech_pad_ms)
        return [(int(x["start"]), int(x["end"])) for x in found]


class Pyannote(Lazy):
    """A public overlapped-speech pipeline; its token is needed to load it and may stand in HF_TOKEN."""

    def __init__(self, config: Overlap, on: str = "cpu", token: str | None = None):
        def build():
            import torch
            from pyannote.audio import Pipeline

            _threads(config.max_threads)
            pipeline = Pipeline.from_pretrained(config.model_name, use_auth_token=token or os.environ.get("HF_TOKEN"))
            return pipeline.to(torch.device(on))

        super().__init__(build, config.model_name)

    def overlaps(self, audio: np.ndarray, rate: int) -> list[tuple[float, float]]:
        import torch

        found = self.made()({"waveform": torch.from_numpy(audio), "sample_rate": rate})
        return [(float(x.start), float(x.end)) for x in found.get_timeline().support()]


class SpectrogramTransformer(Lazy):
    """A public audio classifier of the transformers package, in batches of windows; its labels are read on first use."""

    def __init__(self, config: Music, on: str = "cpu", token: str | None = None):
        def build():
            from transformers import ASTFeatureExtractor, ASTForAudioClassification

            _threads(config.max_threads)
            key = token or os.environ.get("HF_TOKEN")
            model = ASTForAudioClassification.from_pretrained(config.model_name, token=key).to(on).eval()
            return ASTFeatureExtractor.from_pretrained(config.model_name, token=key), model

        super().__init__(build, config.model_name)
        self._config, self._on = config, on

    @property
    def labels(self) -> list[str]:
        names = self.made()[1].config.id2label
        return [names[i] for i in sorted(names)]

    def score(self, windows: np.ndarray) -> np.ndarray:
        import torch

        extractor, model = self.made()
        size, out = self._config.batch_size, []
        for i in range(0, len(windows), size):
            inputs = extractor(list(windows[i : i + size]), sampling_rate=self._config.target_sample_rate, return_tensors="pt").to(self._on)
            with torch.no_grad():
                out.append(torch.sigmoid(model(**inputs).logits).cpu().numpy())
        return np.concatenate(out)


def speech_detector(kind: str, config: Vad, on: str = "cpu") -> SpeechDetector:
    if kind == "silero":
        return Silero(config, on)
    return EnergySpeech(min_speech_ms=config.min_speech_duration_ms, min_silence_ms=config.min_silence_duration_ms, pad_ms=config.speech_pad_ms)


def overlap_detector(kind: str, config: Overlap, on: str = "cpu", token: str | None = None) -> OverlapDetector:
    return Pyannote(config, on, token) if kind == "pyannote" else NoOverlap()


def music_classifier(kind: str, config: Music, on: str = "cpu", token: str | None = None) -> WindowClassifier:
    return SpectrogramTransformer(config, on, token) if kind == "ast" else FlatnessMusic()


def _cuda() -> bool:
    try:
        import torch
    except ImportError:
        return False
    return bool(torch.cuda.is_available())


def device(wanted: str = "auto") -> str:
    """cpu, or a CUDA device that is really there; an explicit one that is not fails at once."""
    if wanted == "auto":
        return "cuda" if _cuda() else "cpu"
    if wanted == "cpu":
        return wanted
    if wanted.split(":")[0] == "cuda":
        if _cuda():
            return wanted
        raise RuntimeError(f"{wanted} is not available")
    raise ValueError(f"unknown device {wanted}")


def runtime_metadata(on: str = "cpu") -> dict:
    """Where a run ran and with what: device, platform, peak memory and versions of the packages it may have used."""
    peak = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    versions = {}
    for name in ("pyspark", "numpy", "pyarrow", "soundfile", "soxr", "torch", "silero-vad", "pyannote.audio", "transformers"):
        try:
            versions[name] = metadata.version(name)
        except metadata.PackageNotFoundError:
            versions[name] = None
    return {
        "device": on, "cuda_available": _cuda(), "python": sys.version.split()[0], "platform": platform.platform(), "cpus": os.cpu_count(),
        "versions": versions, "peak_rss_mb": round(peak / (1024 * 1024 if sys.platform == "darwin" else 1024), 3),
    }
