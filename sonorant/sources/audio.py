"""Decoding, resampling and writing of audio inside tasks; paths may name any file system."""

from __future__ import annotations

import io
import math
import wave

import numpy as np

from .files import open_input, write_whole

#: Zero crossings of the resampling filter on each side, and outputs computed at once.
LOBES, OUTPUTS = 24, 1 << 16


def _optional(name: str):
    try:
        return __import__(name)
    except ImportError:
        return None


def _floats(raw: bytes, width: int, channels: int) -> np.ndarray:
    if width == 1:
        audio = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 2:
        audio = np.frombuffer(raw, "<i2").astype(np.float32) / 32768
    elif width == 3:
        parts = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        value = parts[:, 0] | (parts[:, 1] << 8) | (parts[:, 2] << 16)
        audio = (value - ((value & 0x800000) << 1)).astype(np.float32) / (1 << 23)
    elif width == 4:
        audio = np.frombuffer(raw, "<i4").astype(np.float64).__truediv__(1 << 31).astype(np.float32)
    else:
        raise ValueError(f"sample width {width}")
    return audio.reshape(-1, channels)


def read_part(file, start: float | None = None, end: float | None = None) -> tuple[np.ndarray, int]:
    """float32 samples of shape (samples, channels) and the rate, of [start, end) seconds of a seekable file.

    Only that part is decoded, so a long recording is never held whole for its
    clips. Sample indices are half to even and within the file; an inverted
    range is empty. PCM WAV needs nothing; other formats need soundfile.
    """
    head = file.read(4)
    file.seek(0)
    bounds = lambda n, rate: (
        0 if start is None else min(max(round(start * rate), 0), n), n if end is None else min(max(round(end * rate), 0), n))
    if head != b"RIFF":
        soundfile = _optional("soundfile")
        if soundfile is None:
            raise ValueError("only PCM WAV can be decoded here")
        with soundfile.SoundFile(file) as f:
            first, last = bounds(len(f), f.samplerate)
            f.seek(first)
            return f.read(max(last - first, 0), dtype="float32", always_2d=True), int(f.samplerate)
    with wave.open(file) as f:
        width, channels, rate = f.getsampwidth(), f.getnchannels(), f.getframerate()
        first, last = bounds(f.getnframes(), rate)
        f.setpos(first)
        return _floats(f.readframes(max(last - first, 0)), width, channels), rate


def decode(content: bytes) -> tuple[np.ndarray, int]:
    """Samples and rate of an encoded file's bytes, such as the `content` of Spark's binaryFile source."""
    return read_part(io.BytesIO(content))


def load(path: str, start: float | None = None, end: float | None = None) -> tuple[np.ndarray, int]:
    with open_input(path) as f:
        return read_part(f, start, end)


def mono(audio: np.ndarray) -> np.ndarray:
    return audio[:, 0] if audio.shape[1] == 1 else audio.mean(axis=1, dtype=np.float32)


def resample(samples: np.ndarray, rate: int, target: int) -> np.ndarray:
    """Band-limited resampling by soxr where it is installed, else by a windowed sinc; unchanged at equal rates."""
    if rate == target or not len(samples):
        return np.ascontiguousarray(samples, np.float32)
    soxr = _optional("soxr")
    if soxr is not None:
        return soxr.resample(samples, rate, target).astype(np.float32, copy=False)
    return _sinc(np.asarray(samples, np.float64), rate, target)


def _sinc(samples: np.ndarray, rate: int, target: int) -> np.ndarray:
    """Each output is a sum of inputs weighted by a sinc cut at the lower of the two Nyquist rates under a Blackman window.

    The rates' ratio is a fraction, so outputs fall into as many phases as its
    denominator, each with one filter; the outputs of a phase are products of
    shifted windows of the input with it.
    """
    common = math.gcd(rate, target)
    up, down = target // common, rate // common
    cutoff = min(1.0, target / rate)
    half = math.ceil(LOBES / cutoff)
    padded = np.concatenate([np.zeros(half), samples, np.zeros(half + 1)])
    count = round(len(samples) * target / rate)
    out = np.zeros(count, np.float32)
    taps = np.arange(-half + 1, half + 1)
    view = np.lib.stride_tricks.sliding_window_view(padded, 2 * half)
    for phase in range(min(up, count)):
        fraction = (phase * down % up) / up
        at = taps - fraction
        weight = cutoff * np.sinc(cutoff * at) * (0.42 + 0.5 * np.cos(np.pi * at / half) + 0.08 * np.cos(2 * np.pi * at / half))
        first = phase * down // up + 1  # the window whose tap 0 is the input at or before the output
        places = np.arange(phase, count, up)
        for i in range(0, len(places), OUTPUTS):
            part = places[i : i + OUTPUTS]
            start = first + (part[0] - phase) // up * down
            out[part] = view[start : start + (len(part) - 1) * down + 1 : down] @ weight
    return out


def load_mono(path: str, target: int) -> np.ndarray:
    audio, rate = load(path)
    return resample(mono(audio), rate, target)


def load_channels(path: str) -> tuple[np.ndarray, int]:
    """(channels, samples) at the file's own rate."""
    audio, rate = load(path)
    return np.ascontiguousarray(audio.T), rate


# WAV subtypes and their bytes a sample.
PCM = {"PCM_U8": 1, "PCM_16": 2, "PCM_24": 3, "PCM_32": 4}


def encode(audio: np.ndarray, rate: int, kind: str = "wav", subtype: str | None = None) -> bytes:
    """An encoded file: PCM WAV needs nothing, FLAC and other subtypes need soundfile."""
    if kind not in ("wav", "flac"):
        raise ValueError(f"unknown format {kind}")
    out = io.BytesIO()
    if kind == "flac" or (subtype or "PCM_16") not in PCM:
        soundfile = _optional("soundfile")
        if soundfile is None:
            raise RuntimeError(f"{kind} {subtype or ''} needs soundfile, which is not installed; wav in PCM does not")
        soundfile.write(out, audio, rate, format=kind.upper(), subtype=subtype)
        return out.getvalue()
    width = PCM[subtype or "PCM_16"]
    top = 1 << (8 * width - 1)
    whole = np.clip(np.rint(audio.astype(np.float64) * top), -top, top - 1).astype(np.int64)
    raw = (whole + 128).astype(np.uint8).tobytes() if width == 1 else np.ascontiguousarray(whole).astype("<i8").reshape(-1, 1).view(np.uint8)[:, :width].tobytes()
    with wave.open(out, "wb") as f:
        f.setnchannels(audio.shape[1])
        f.setsampwidth(width)
        f.setframerate(rate)
        f.writeframes(raw)
    return out.getvalue()


def write_audio(path: str, audio: np.ndarray, rate: int, overwrite: bool = False, kind: str = "wav", subtype: str | None = None) -> bool:
    """A clip that appears whole; False if there was one and it stays."""
    return write_whole(path, encode(audio, rate, kind, subtype), overwrite)


def write_wav(path: str, audio: np.ndarray, rate: int, overwrite: bool = False) -> bool:
    return write_audio(path, audio, rate, overwrite)
