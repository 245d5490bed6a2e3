"""Joins whose left keys may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: A key with more than this part of all rows is hot. There are fewer such keys than parts, which bounds what is broadcast.
HOT_PARTS = 1_000


def looked_up(rows: DataFrame, key: str, values: DataFrame, total: int) -> DataFrame:
    """`rows`, `total` in number, with the value m of their key, null without one. `values` (key, m) has unique keys.

    Hot keys, of which there are less than HOT_PARTS, and nulls meet their value
    where they lie, by a broadcast; the rows of all others are shuffled, at most
    one part in HOT_PARTS of them to one key.
    """
    hot = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") > total // HOT_PARTS)
    known = hot.join(values, key, "left").select(key, F.struct("m").alias("__hot"))
    return joined_apart(rows, [key], known, values)


def joined_apart(rows: DataFrame, keys: list[str], hot: DataFrame, values: DataFrame) -> DataFrame:
    """`rows` with the value m of their keys; those in `hot` (keys, __hot struct<m>), less than HOT_PARTS a kind, by a broadcast."""
    told = rows.join(F.broadcast(hot), keys, "left")
    here = F.col("__hot").isNotNull() | F.col(keys[-1]).isNull()
    warm = told.where(here).select(*rows.columns, F.col("__hot.m").alias("m"))
    cold = told.where(~here).drop("__hot").join(values, keys, "left").select(*rows.columns, "m")
    return warm.unionByName(cold)
