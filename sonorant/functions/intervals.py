"""Intervals of time within a recording, as array expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def split_long(start: Column, end: Column, longest: float) -> Column:
    """array<struct<part, start, end>> of pieces of [start, end) no longer than `longest`; empty where end <= start."""
    if longest <= 0:
        raise ValueError("longest must be positive")
    pieces = F.greatest(F.ceil((end - start) / longest).cast("int"), F.lit(1))
    pieces = F.when(start + (pieces - 1) * longest >= end, F.greatest(pieces - 1, F.lit(1))).otherwise(pieces)
    parts = F.transform(
        F.sequence(F.lit(0), pieces - 1),
        lambda k: F.struct(
            k.cast("int").alias("part"),
            (start + k * longest).alias("start"),
            F.when(k == pieces - 1, end).otherwise(start + (k + 1) * longest).alias("end"),
        ),
    )
    return F.when(end > start, parts).otherwise(F.array().cast("array<struct<part:int,start:double,end:double>>"))


def rounded(segments: Column) -> Column:
    """Segments (start, end) to milliseconds with their duration, a negative one as 0."""
    return F.transform(segments, lambda s: F.struct(
        F.round(s["start"], 3).alias("start"), F.round(s["end"], 3).alias("end"),
        F.round(F.greatest(s["end"] - s["start"], F.lit(0.0)), 3).alias("duration"),
    ))


def at_least(segments: Column, shortest: float) -> Column:
    return F.filter(segments, lambda s: s["duration"] >= shortest)


def total(segments: Column) -> Column:
    return F.aggregate(segments, F.lit(0.0), lambda acc, s: acc + s["duration"])


def sample_slice(samples: Column, rate: Column, start: Column, end: Column) -> Column:
    """Samples of [start, end) seconds; indices half to even and within the clip, an inverted range is empty."""
    first = F.greatest(F.rint(start * rate).cast("int"), F.lit(0))
    last = F.least(F.rint(end * rate).cast("int"), F.size(samples))
    return F.slice(samples, first + 1, F.greatest(last - first, F.lit(0)))


def windows(samples: Column, width: int) -> Column:
    """Windows of `width` samples one after the other, the last padded with zeros; at least one."""
    if width <= 0:
        raise ValueError("width must be positive")
    count = F.greatest(F.ceil(F.size(samples) / width).cast("int"), F.lit(1))
    padded = F.concat(samples, F.array_repeat(F.lit(0.0).cast("float"), count * width - F.size(samples)))
    return F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.slice(padded, k * width + 1, width))
