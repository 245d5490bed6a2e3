"""Window scores of a classifier rolled up to clips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def sigmoid(logit: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-logit))


def clip_rollup(windows: DataFrame, clip: str, p: str, threshold: float) -> DataFrame:
    """(clip, music_probability, music_mean_probability, music_ratio, is_music, num_windows) of windows in long form."""
    value = F.col(p)
    return windows.groupBy(clip).agg(
        F.round(F.max(value), 6).alias("music_probability"), F.round(F.avg(value), 6).alias("music_mean_probability"),
        F.round(F.avg((value >= threshold).cast("double")), 6).alias("music_ratio"),
        (F.max(value) >= threshold).alias("is_music"), F.count("*").alias("num_windows"),
    )


def top_labels(scores: DataFrame, clip: str, label: str, p: str, k: int) -> DataFrame:
    """(clip, place, label, probability): the k labels of greatest mean over a clip's windows, later labels first among equals."""
    means = scores.groupBy(clip, label).agg(F.avg(p).alias("__mean"))
    order = Window.partitionBy(clip).orderBy(F.col("__mean").desc(), F.col(label).desc())
    return means.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).select(
        clip, "place", label, F.round("__mean", 6).alias("probability"))


def label_index(labels: DataFrame, name: str) -> DataFrame:
    """Index of a label whatever its case; no row where there is none."""
    return labels.where(F.lower("label") == name.lower()).select(F.min("index").alias("index")).where(F.col("index").isNotNull())
