"""Totals of a run, in one pass over its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.hashing import none_string


def run_totals(features: DataFrame, score: str | None = None, duration: str = "duration") -> DataFrame:
    """(num_rows, num_ok, num_errors, audio_duration[, mean_score]); the mean is over ok rows, null if there is none."""
    ok = F.col("status") == "ok"
    seconds = F.coalesce(F.nanvl(duration, F.lit(0.0)), F.lit(0.0))
    columns = [
        F.count("*").alias("num_rows"), F.count_if(ok).alias("num_ok"), F.count_if(~ok).alias("num_errors"),
        F.round(F.coalesce(F.sum(F.when(ok, seconds)), F.lit(0.0)), 3).alias("audio_duration"),
    ]
    if score:
        columns.append(F.round(F.avg(F.when(ok & ~F.isnan(score), F.col(score))), 6).alias("mean_score"))
    return features.agg(*columns)


def ratio_of_sums(features: DataFrame, part: str, whole: str, name: str) -> DataFrame:
    """sum(part) / sum(whole) over ok rows, null where the whole is nothing."""
    ok = features.where((F.col("status") == "ok") & ~F.isnan(part) & ~F.isnan(whole))
    total = F.sum(whole)
    return ok.agg(F.round(F.when(total > 0, F.sum(part) / total), 6).alias(name))


def counts_by(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(key, value, n): counts for each of several keys in one pass; a missing value is the string None."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("key"), none_string(F.col(k)).alias("value")) for k in keys]))
    return rows.select(pairs.alias("x")).groupBy("x.key", "x.value").agg(F.count("*").alias("n"))


def selected_hours(rows: DataFrame) -> DataFrame:
    seconds = F.coalesce(F.nanvl("duration", F.lit(0.0)), F.lit(0.0))
    return rows.agg(F.count("*").alias("n"), F.round(F.coalesce(F.sum(seconds), F.lit(0.0)) / 3600, 4).alias("hours"))


def real_time_factor(seconds: float, audio_seconds: float) -> float | None:
    return seconds / audio_seconds if audio_seconds > 0 else None
