"""Shards and limits by line number, paths, ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def shard(manifest: DataFrame, index: int, count: int, limit: int | None = None) -> DataFrame:
    """Rows with (line_number - 1) % count == index, the first `limit` of them in line order."""
    if count <= 0 or not 0 <= index < count:
        raise ValueError("need 0 <= index < count")
    if limit is not None and limit <= 0:
        raise ValueError("limit must be positive")
    rows = manifest.where((F.col("line_number") - 1) % count == index)
    return rows if limit is None else rows.orderBy("line_number").limit(limit)


def shard_totals(manifest: DataFrame, index: int, count: int, limit: int | None = None) -> DataFrame:
    """(num_input_rows, num_processed_rows, num_skipped_shard_rows) of a scan that stops at the first row of its shard beyond the limit."""
    mine = (F.col("line_number") - 1) % count == index
    rows = manifest.select("line_number", mine.alias("mine"))
    if limit is not None:
        # The row that stops the scan: at most limit + 1 rows are looked at.
        beyond = rows.where("mine").orderBy("line_number").limit(limit + 1).agg(
            F.when(F.count("*") > limit, F.max("line_number")).alias("stop"))
        rows = rows.crossJoin(F.broadcast(beyond)).where(F.col("stop").isNull() | (F.col("line_number") < F.col("stop")))
    return rows.agg(
        F.count("*").alias("num_input_rows"), F.count_if("mine").alias("num_processed_rows"), F.count_if(~F.col("mine")).alias("num_skipped_shard_rows"))


def resolve_path(path: Column, folder: str) -> Column:
    """An absolute path or URI as it is, a relative one under the manifest's folder."""
    return F.when(path.startswith("/") | path.contains("://"), path).otherwise(F.concat(F.lit(folder.rstrip("/") + "/"), path))


def clip_path(segment_id: Column, ending: str) -> Column:
    return F.concat(F.lit("audio/"), segment_id, F.lit(f".{ending}"))


def segment_id(audio_id: Column, vad_index: Column, part: Column) -> Column:
    return F.format_string("%s_vad_%05d_%02d", audio_id, vad_index, part)
