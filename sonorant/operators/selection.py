"""Diversity cap and hours budget over scored clips."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.hashing import none_string
from ..runtime import cut, global_row_numbers
from .features import no_nan

#: Rows whose durations are summed together when the budget's end is sought.
CHUNK = 100_000
SALTS = 32


def _best_first(score: str, ties: tuple[str, ...]) -> list:
    """Higher scores first, null and NaN after all numbers; equal ones by audio_id and then `ties`."""
    return [no_nan(F.col(score)).desc_nulls_last(), F.col("audio_id").asc(), *[F.col(t).asc() for t in ties]]


def mark_source_cap(scored: DataFrame, cap: int, source: str = "source_audio_id", score: str = "selection_score", ties: tuple[str, ...] = ()) -> DataFrame:
    """Clips with `place` within their source by (score desc, audio_id, ties), null where it exceeds the cap.

    All clips without a source are one group; null and NaN scores come last.
    Repeated rows of a clip count each: give `ties` where they differ. Places within salted parts of a
    source come first; only those within the cap there are ranked together.
    """
    if cap < 0:
        raise ValueError("cap must not be negative")
    order = _best_first(score, ties)
    keyed = scored.withColumn("__s", none_string(F.col(source)))
    keyed = keyed.withColumn("__part", F.pmod(F.xxhash64("audio_id", *ties), F.lit(SALTS)))
    keyed = keyed.withColumn("__pre", F.row_number().over(Window.partitionBy("__s", "__part").orderBy(*order)))
    near = F.col("__pre") <= cap
    final = keyed.where(near).withColumn("place", F.row_number().over(Window.partitionBy("__s").orderBy(*order)))
    final = final.withColumn("place", F.when(F.col("place") <= cap, F.col("place")))
    rest = keyed.where(~near).withColumn("place", F.lit(None).cast("int"))
    return final.unionByName(rest).drop("__s", "__part", "__pre")


def mark_budget(scored: DataFrame, hours: float, score: str = "selection_score", ties: tuple[str, ...] = ()) -> DataFrame:
    """Clips with `in_budget`: greedy by (score desc, audio_id, ties), null and NaN scores last, skipping a clip that does not fit and going on.

    The first clip is always kept. Durations count in whole milliseconds, null
    and NaN as 0. Rows are numbered in a distributed order; then, in rounds, the
    longest run that fits is found from sums over chunks of rows and, inside one
    chunk, a running sum. What is left of the budget only shrinks, so clips
    longer than it are out for good, and a round is one condition on number and
    duration. After a round that at least halved what is left, the rows that may
    still fit are written apart, so later rounds read few. Clips of 3 to 30
    seconds need a few rounds.
    """
    ms = F.round(F.coalesce(F.nanvl("duration", F.lit(0.0)), F.lit(0.0)) * 1000).cast("bigint")
    order = _best_first(score, ties)
    rows = cut(global_row_numbers(scored.withColumn("__ms", ms), order, "__row"))
    left = round(hours * 3_600_000)
    start, taken = -1, []
    candidates, bound = rows.select("__row", "__ms"), left
    first = rows.where(F.col("__row") == 0).select("__ms").first()
    if first is not None:
        left -= first[0]
        taken.append((F.col("__row") == 0))
        start = 0
    while first is not None and left >= 0:
        may_fit = (F.col("__row") > start) & (F.col("__ms") <= left)
        if 2 * left < bound and len(taken) > 2:
            candidates, bound = cut(candidates.where(may_fit)), left
        open_rows = candidates.where(may_fit)
        # One row for each chunk of rows that holds a candidate.
        sums = open_rows.groupBy(F.floor(F.col("__row") / CHUNK).alias("c")).agg(F.sum("__ms").alias("s")).orderBy("c").collect()
        if not sums:
            break
        acc, over = 0, None
        for c, s in sums:
            if acc + s > left:
                over = c
                break
            acc += s
        if over is None:
            taken.append((F.col("__row") > start) & (F.col("__ms") <= left))
            break
        inside = open_rows.where(F.floor(F.col("__row") / CHUNK) == over)
        running = inside.withColumn("sum", F.sum("__ms").over(Window.orderBy("__row")) + acc)
        last = running.agg(
            F.max(F.when(F.col("sum") <= left, F.struct("__row", "sum"))).alias("fit"),
            F.min(F.when(F.col("sum") > left, F.col("__row"))).alias("beyond"),
        ).first()
        taken.append((F.col("__row") > start) & (F.col("__row") < last["beyond"]) & (F.col("__ms") <= left))
        left -= last["fit"]["sum"] if last["fit"] is not None else acc
        start = last["beyond"]
    kept = taken[0] if taken else F.lit(False)
    for t in taken[1:]:
        kept = kept | t
    return rows.withColumn("in_budget", kept).drop("__row", "__ms")
