"""Problem 5: at most so many clips for each contributor, the best ones by score."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..runtime import cut, global_row_numbers
from .ids import clip_key
from .skew import looked_up

CAP = 20
SHARE = 0.02
SALTS = 32


def latest_clips(candidates: DataFrame) -> DataFrame:
    """One row a clip: that with the greatest delivered_at (null is oldest; then the better score, then the source).

    Partial aggregation collapses repeated deliveries before the shuffle, so a
    clip delivered very often is no hot key.
    """
    number = F.when(F.isnan("selection_score"), None).otherwise(F.col("selection_score"))
    return (
        candidates.where(F.col("audio_id").isNotNull())
        .select("audio_id", "delivered_at", number.cast("double").alias("score"),
                clip_key(F.col("source_audio_id")).alias("source"))
        .groupBy("audio_id")
        .agg(F.max(F.struct("delivered_at", "score", "source")).alias("last"))
        .select("audio_id", "last.score", "last.source")
    )


def over_cap(candidates: DataFrame, cap: int = CAP, salts: int = SALTS) -> DataFrame:
    """Clips left out when each source keeps at most `cap`: (audio_id).

    Order within a source: higher score first, null and NaN after all numbers,
    equal scores by audio_id in code-point order. Clips without a source do not
    count and are never left out; an empty table gives no rows; further columns
    are ignored. A dominant source is ranked in salted parts first: a clip with
    `cap` better ones in its own part is out at once, and only the others, at
    most cap * salts a source, meet in the final ranking.
    """
    if cap < 0:
        raise ValueError("cap must not be negative")
    order = [F.col("score").desc_nulls_last(), F.col("audio_id").asc()]
    clips = latest_clips(candidates).where(F.col("source").isNotNull())
    salted = clips.withColumn("salt", F.pmod(F.xxhash64("audio_id"), F.lit(salts)))
    pre = salted.withColumn("pre", F.row_number().over(Window.partitionBy("source", "salt").orderBy(*order)))
    final = pre.where(F.col("pre") <= cap).withColumn(
        "place", F.row_number().over(Window.partitionBy("source").orderBy(*order))
    )
    return (
        pre.where(F.col("pre") > cap).select("audio_id")
        .unionByName(final.where(F.col("place") > cap).select("audio_id"))
    )


def kept(candidates: DataFrame, cap: int = CAP, salts: int = SALTS) -> DataFrame:
    """The clips kept, with their place within the source: (audio_id, source, score, place)."""
    order = [F.col("score").desc_nulls_last(), F.col("audio_id").asc()]
    clips = latest_clips(candidates).where(F.col("source").isNotNull())
    salted = clips.withColumn("salt", F.pmod(F.xxhash64("audio_id"), F.lit(salts)))
    pre = salted.withColumn("pre", F.row_number().over(Window.partitionBy("source", "salt").orderBy(*order)))
    return (
        pre.where(F.col("pre") <= cap)
        .withColumn("place", F.row_number().over(Window.partitionBy("source").orderBy(*order)))
        .where(F.col("place") <= cap)
        .select("audio_id", "source", "score", "place")
    )


def over_share(candidates: DataFrame, share: float = SHARE) -> DataFrame:
    """Clips left out when each source keeps at most this share of all clips that name a source: (audio_id).

    At least one clip is kept of every source; the order is that of `over_cap`.
    So large a cap spares no row of a dominant source the final ranking, so
    places come from one order over all sources and clips: range partitions,
    numbered on their own, part a source's clips over many tasks, and a place is
    the number less that of the source's first clip.
    """
    if not 0 < share <= 1:
        raise ValueError("share must lie in (0, 1]")
    order = [F.col("source").asc(), F.col("score").desc_nulls_last(), F.col("audio_id").asc()]
    clips = cut(global_row_numbers(latest_clips(candidates).where(F.col("source").isNotNull()), order, "row"))
    total = clips.count()
    first = clips.groupBy("source").agg(F.min("row").alias("m"))
    return looked_up(clips, "source", first, total).where(F.col("row") - F.col("m") >= max(1, int(share * total))).select("audio_id")
