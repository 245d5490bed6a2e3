"""Problem 3: one ranking from scores of unlike scale, by leximin over percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..runtime import cut, global_row_numbers
from .skew import HOT_PARTS, joined_apart

# What the feature runs write where they have no SNR, and the range of decibels that can be.
SNR_SENTINELS = (-99.0, 999.0)
SNR_RANGE = (-20.0, 100.0)
#: Share of values beyond any decibel from which a run's SNR is an amplitude ratio.
LINEAR_SHARE = 0.005


def _number(name: str) -> Column:
    return F.when(~F.isnan(name), F.col(name).cast("double"))


def _inside(value: Column, low: float, high: float) -> Column:
    return F.when((value >= low) & (value <= high), value)


def latest(features: DataFrame, columns: list[str], run: str) -> DataFrame:
    """A clip's row with the greatest computed_at (null is oldest); error rows count and have no metrics."""
    ok = F.coalesce(F.col("status") == "ok", F.lit(False))
    values = [F.when(ok, _number(c)).alias(c) for c in columns]
    last = F.struct(F.col("computed_at"), F.col(run).alias("run"), *values)
    return features.where(F.col("audio_id").isNotNull()).groupBy("audio_id").agg(F.max(last).alias("x")).select("audio_id", "x.*")


def usable_scores(quality: DataFrame, overlap: DataFrame) -> DataFrame:
    """(audio_id, quality_score, snr_estimate_db, overlap_ratio) in common units, null where unusable.

    A run that reports another unit is found from its own values: quality or
    overlap in percent (the mean of the positive values exceeds 1), SNR as an
    amplitude ratio (values beyond any decibel). Sentinels, NaN and impossible
    values are unusable.
    """
    q = latest(quality, ["quality_score", "snr_estimate_db"], "quality_run_id")
    snr = F.when(~F.col("snr_estimate_db").isin(*SNR_SENTINELS), F.col("snr_estimate_db"))
    q = q.withColumn("snr_estimate_db", snr)
    positive = F.when((F.col("quality_score") > 0) & (F.col("quality_score") <= 100), F.col("quality_score"))
    runs = q.groupBy("run").agg(
        (F.avg(positive) > 1).alias("percent"),
        (F.avg((F.col("snr_estimate_db") > SNR_RANGE[1]).cast("double")) > LINEAR_SHARE).alias("linear"),
    )
    q = q.alias("q").join(runs.alias("r"), F.col("q.run").eqNullSafe(F.col("r.run")), "left")
    score = F.when(F.col("percent"), F.col("quality_score") / 100).otherwise(F.col("quality_score"))
    decibel = F.when(
        F.col("linear"), F.when(F.col("snr_estimate_db") > 0, 20 * F.log10("snr_estimate_db"))
    ).otherwise(F.col("snr_estimate_db"))
    q = q.select("audio_id", _inside(score, 0, 1).alias("quality_score"), _inside(decibel, *SNR_RANGE).alias("snr_estimate_db"))

    o = latest(overlap, ["overlap_ratio"], "overlap_run_id")
    positive = F.when((F.col("overlap_ratio") > 0) & (F.col("overlap_ratio") <= 100), F.col("overlap_ratio"))
    runs = o.groupBy("run").agg((F.avg(positive) > 1).alias("percent"))
    o = o.alias("o").join(runs.alias("r"), F.col("o.run").eqNullSafe(F.col("r.run")), "left")
    ratio = F.when(F.col("percent"), F.col("overlap_ratio") / 100).otherwise(F.col("overlap_ratio"))
    o = o.select("audio_id", _inside(ratio, 0, 1).alias("overlap_ratio"))
    return q.join(o, "audio_id", "full")


def _long(scores: DataFrame, higher_is_better: dict[str, bool]) -> DataFrame:
    """(audio_id, score, value): a row for each score of a clip, higher values better, null where unusable."""
    each = F.explode(F.array(*[
        F.struct(F.lit(name).alias("score"), (F.col(name) if up else -F.col(name)).alias("value"))
        for name, up in higher_is_better.items()
    ])).alias("x")
    return scores.select("audio_id", each).select("audio_id", "x.score", (F.col("x.value") + 0.0).alias("value"))


def percentiles(long: DataFrame) -> DataFrame:
    """Mid-rank percentile of every distinct value: (score, value, equal, n, percentile).

    (worse + equal / 2) / n over the n clips whose score is usable. Equal values
    are counted before anything is sorted, so a value that most clips share is
    one row, and the sort is range-partitioned with offsets carried over.
    """
    distinct = long.where(F.col("value").isNotNull()).groupBy("score", "value").agg(F.count("*").alias("equal"))
    parted = cut(
        distinct.repartitionByRange("score", "value").sortWithinPartitions("score", "value")
        .withColumn("part", F.spark_partition_id())
    )
    sums = parted.groupBy("score", "part").agg(F.sum("equal").alias("rows"))
    # One row for each score and partition, so no more than the partitions the session asks for.
    order = Window.partitionBy("score").orderBy("part")
    offsets = sums.select(
        "score", "part",
        (F.sum("rows").over(order) - F.col("rows")).alias("offset"),
        F.sum("rows").over(Window.partitionBy("score")).alias("n"),
    )
    inside = Window.partitionBy("score", "part").orderBy("value")
    return (
        parted.withColumn("through", F.sum("equal").over(inside))
        .join(F.broadcast(offsets), ["score", "part"])
        .select(
            "score", "value", "equal", "n",
            ((F.col("offset") + F.col("through") - F.col("equal") + F.col("equal") / 2.0) / F.col("n")).alias("percentile"),
        )
    )


def leximin_ranking(scores: DataFrame, higher_is_better: dict[str, bool]) -> DataFrame:
    """Every clip once: (audio_id, place, worst, ..., best percentile), place 1 first.

    Each score becomes its percentile, a missing or unusable score is 0, below
    every usable one; each clip's percentiles are sorted ascending and compared
    lexicographically, higher first, equal vectors by audio_id. No score's range
    matters and a strong score cannot mask a weak one. All scores meet their
    percentiles in one join; values that very many clips share, and nulls, take
    theirs by a broadcast, so no value is a hot key.
    """
    k = len(higher_is_better)
    long = _long(scores, higher_is_better)
    table = percentiles(long)
    hot = table.where(F.col("equal") > F.col("n") / HOT_PARTS).select("score", "value", F.struct(F.col("percentile").alias("m")).alias("__hot"))
    told = joined_apart(long, ["score", "value"], hot, table.select("score", "value", F.col("percentile").alias("m")))
    vectors = told.groupBy("audio_id").agg(F.array_sort(F.collect_list(F.coalesce("m", F.lit(0.0)))).alias("v"))
    out = vectors.select("audio_id", *[F.col("v")[i].alias(f"p{i + 1}") for i in range(k)])
    order = [*[F.col(f"p{i + 1}").desc() for i in range(k)], F.col("audio_id").asc()]
    return global_row_numbers(out, order, "zero").select("audio_id", (F.col("zero") + 1).alias("place"), *[f"p{i + 1}" for i in range(k)])


DIRECTIONS = {"quality_score": True, "snr_estimate_db": True, "overlap_ratio": False}


def rank_clips(quality: DataFrame, overlap: DataFrame) -> DataFrame:
    """The clips of the two feature tables in one ranking; empty tables give none."""
    return leximin_ranking(cut(usable_scores(quality, overlap)), DIRECTIONS)
