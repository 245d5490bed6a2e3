"""Stratified, grouped, deterministic splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..config import SplitRatios
from ..functions.hashing import none_string, unit_hash


def assign_splits(records: DataFrame, ratios: SplitRatios, group: str, strata: list[str], salt: str = "") -> DataFrame:
    """Records with `split`: whole groups by the midpoint of their share, in hash order within a stratum.

    Missing keys are the string None. A group that occurs in several strata is
    placed in each on its own. Only group counts are ordered, and the running
    count first goes over 256 hash buckets a stratum, so a stratum with most
    groups is not sorted in one task.
    """
    keys = [f"__k{i}" for i in range(len(strata))]
    rows = records.select("*", *[none_string(F.col(s)).alias(k) for s, k in zip(strata, keys)], none_string(F.col(group)).alias("__g"))
    groups = rows.groupBy(*keys, "__g").agg(F.count("*").alias("n"))
    groups = groups.withColumn("h", unit_hash(F.col("__g"), salt)).withColumn("b", F.least(F.floor(F.col("h") * 256), F.lit(255)).cast("int"))
    buckets = groups.groupBy(*keys, "b").agg(F.sum("n").alias("s"))
    ordered = Window.partitionBy(*keys).orderBy("b")
    buckets = buckets.select(
        *keys, "b", (F.sum("s").over(ordered) - F.col("s")).alias("before"), F.sum("s").over(Window.partitionBy(*keys)).alias("total"))
    inner = Window.partitionBy(*keys, "b").orderBy("h", "__g")
    placed = groups.join(buckets, [*keys, "b"]).withColumn("acc", F.col("before") + F.sum("n").over(inner) - F.col("n"))
    middle = (F.col("acc") + F.col("acc") + F.col("n")) / F.lit(2.0) / F.col("total").cast("double")
    split = F.when(middle < ratios.train, "train").when(middle < ratios.train + ratios.val, "val").otherwise("test")
    chosen = placed.select(*keys, "__g", split.alias("split"))
    return rows.drop("split").join(chosen, [*keys, "__g"]).drop(*keys, "__g")


def split_counts(assigned: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(split, n, hours) for train, val and test, also where none fell; with `by`, counts of what there is."""
    hours = F.round(F.sum(F.coalesce(F.nanvl("duration", F.lit(0.0)), F.lit(0.0))) / 3600, 4).alias("hours")
    counts = assigned.groupBy("split", *[none_string(F.col(b)).alias(b) for b in by or []]).agg(F.count("*").alias("n"), hours)
    if by:
        return counts
    domain = assigned.sparkSession.createDataFrame([("train",), ("val",), ("test",)], "split string")
    return domain.join(counts, "split", "left").select("split", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("hours", F.lit(0.0)).alias("hours"))
