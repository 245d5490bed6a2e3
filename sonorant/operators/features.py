"""Feature tables: the last row of each clip, joins to a manifest, selection score."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.hashing import none_string


def last_wins(features: DataFrame, order: list[str], keep: list[str]) -> DataFrame:
    """One row per audio_id, the last by `order`, whatever its status; rows without an id are skipped.

    A partial aggregation: repeated rows collapse before the shuffle.
    """
    last = F.max_by(F.struct(*keep), F.struct(*order)).alias("x")
    return features.where(F.col("audio_id").isNotNull()).groupBy(F.col("audio_id").cast("string").alias("audio_id")).agg(last).select("audio_id", "x.*")


def read_shards(shards: list[DataFrame]) -> DataFrame:
    """Shard outputs in the order given, with file_ord, so that later files win."""
    numbered = [s.withColumn("file_ord", F.lit(i)) for i, s in enumerate(shards)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)


QUALITY = ("status", "clipping_ratio", "silence_ratio", "rms_dbfs", "snr_estimate_db", "dc_offset_mean_abs", "quality_score")
OVERLAP = ("status", "overlap_ratio")
MUSIC = ("status", "is_music")


def join_features(manifest: DataFrame, quality: DataFrame | None, overlap: DataFrame | None, music: DataFrame | None = None) -> DataFrame:
    """The manifest with structs q, o and m, null where a clip has no such feature.

    Left joins on the id as text; the feature sides have one row a clip and only
    the columns that gates and score read, so no row multiplies.
    """
    out = manifest.withColumn("__id", none_string(F.col("audio_id")))
    for name, features, columns in (("q", quality, QUALITY), ("o", overlap, OVERLAP), ("m", music, MUSIC)):
        if features is None:
            kinds = ", ".join(f"{c}: {'string' if c == 'status' else 'boolean' if c == 'is_music' else 'double'}" for c in columns)
            out = out.withColumn(name, F.lit(None).cast(f"struct<{kinds}>"))
        else:
            side = features.select(F.col("audio_id").alias("__id"), F.struct(*columns).alias(name))
            out = out.join(side, "__id", "left")
    return out.drop("__id")


def no_nan(value: Column) -> Column:
    """The number, null where it is none (NaN)."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def without_nan(rows: DataFrame) -> DataFrame:
    """The rows with null for every NaN."""
    return rows.select(*[
        no_nan(F.col(f.name)).alias(f.name) if f.dataType.simpleString() in ("float", "double") else F.col(f.name) for f in rows.schema])


def selection_score(q: Column, o: Column) -> Column:
    """Quality less a fifth of the overlap ratio plus up to 0.1 for SNR, 6 decimals; what is not ok, null or NaN adds nothing.

    The score is always a number: NaN sorts above all numbers, so one such clip
    would take the first place of its source and of the budget.
    """
    q_ok = F.coalesce(q["status"] == "ok", F.lit(False))
    o_ok = F.coalesce(o["status"] == "ok", F.lit(False))
    part = lambda ok, value: F.when(ok, F.coalesce(no_nan(value), F.lit(0.0))).otherwise(0.0)
    quality = part(q_ok, q["quality_score"])
    overlap = part(o_ok, o["overlap_ratio"])
    snr = part(q_ok, q["snr_estimate_db"])
    bonus = F.least(F.greatest(snr / 30.0, F.lit(0.0)), F.lit(1.0)) * 0.1
    return F.round(quality - overlap * 0.2 + bonus, 6)
