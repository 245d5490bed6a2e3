"""The queries of the engine's own operators and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import LABELED_GATES, LabeledSplit, Selection, SplitRatios, SSL_GATES, TextNormalization, Vad
from ..functions import hashing, intervals, signal, text
from ..operators import features, gates, music, report, selection, sharding, split
from ..runtime import cut, ensure_checkpoint_dir, spread, table
from ..schemas import RAW_UNLABELED
from ..scorers import EnergySpeech
from ..sources import manifest as manifests
from . import pipelines
from .oracle import SQL

#: Labeled clips mostly have no features here; those they have are gated.
OPEN_LABELED = replace(LABELED_GATES, require_quality=False, require_overlap=False, require_music=False)
LABEL = "nAtIoN_7"
PLAIN = TextNormalization(normalize_unicode=False)
MANIFEST = "/data/manifests/train.jsonl"


def quality(spark: SparkSession, d: str) -> DataFrame:
    return features.last_wins(table(spark, d, "quality_features"), ["computed_at"], [*features.QUALITY, "computed_at"])


def overlap(spark: SparkSession, d: str) -> DataFrame:
    return features.last_wins(table(spark, d, "overlap_features"), ["computed_at"], [*features.OVERLAP, "computed_at"])


def clips(spark: SparkSession, d: str) -> DataFrame:
    """Scored clips with unique ids, from the orders table."""
    return table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("audio_id"), F.col("o_custkey").cast("string").alias("source_audio_id"),
        F.round("o_totalprice", 2).alias("selection_score"), (3 + (F.col("o_orderkey") % 271) / 10.0).alias("duration"))


def waves(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings as short mono signals at 1000 Hz, some of them clipping."""
    loud = (1 + F.col("vec_id") % 4).cast("float")
    return table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: (x * loud).cast("float")).alias("samples"))


def music_windows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("clip"), (F.col("l_discount") * 10 + 0.0).alias("p"))


def clip_music(spark: SparkSession, d: str) -> DataFrame:
    """Music features: a clip's windows are the lines of the order with its line number; each 20th run failed, clips without an order have none."""
    numbered = features.last_wins(table(spark, d, "quality_features"), ["computed_at"], ["source_line_number"])
    rolled = music.clip_rollup(music_windows(spark, d), "clip", "p", 0.95)
    status = F.when(F.col("clip") % 20 == 0, "error").otherwise("ok")
    return numbered.join(rolled, F.col("source_line_number") == F.col("clip")).select("audio_id", status.alias("status"), "is_music")


def joined_ssl(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "ssl_candidates").drop("selection_score")
    return features.join_features(rows, quality(spark, d), overlap(spark, d), clip_music(spark, d))


def ssl_reasons() -> Column:
    return gates.all_reasons(
        gates.quality_reasons(F.col("duration"), F.col("sample_rate"), F.col("q"), F.col("o"), F.col("m"), SSL_GATES),
        gates.language_reason(F.col("language"), ("uz", "ru")))


def gate_reasons(spark: SparkSession, d: str) -> DataFrame:
    return joined_ssl(spark, d).select("audio_id", "delivered_at", F.array_join(ssl_reasons(), ",").alias("reasons"))


def reject_histogram(spark: SparkSession, d: str) -> DataFrame:
    return gates.histogram(joined_ssl(spark, d).select(ssl_reasons().alias("reject_reasons")))


def selection_score(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "ssl_candidates").select("audio_id", "delivered_at")
    return features.join_features(rows, quality(spark, d), overlap(spark, d)).select("audio_id", "delivered_at", features.selection_score(F.col("q"), F.col("o")).alias("score"))


def feature_last_wins(spark: SparkSession, d: str) -> DataFrame:
    """Every clip's last row; what is no number (NaN) comes out null, as from any gate or score that reads it."""
    return features.without_nan(quality(spark, d))


def shard_union(spark: SparkSession, d: str) -> DataFrame:
    """The clips' last rows over two shards of a feature table, the second read later."""
    rows = table(spark, d, "overlap_features").select("audio_id", "status", "overlap_ratio", "computed_at")
    even = F.pmod(F.dayofmonth("computed_at"), F.lit(2)) == 0
    both = features.read_shards([rows.where(even), rows.where(~even)])
    return features.last_wins(both, ["file_ord", "computed_at"], ["file_ord", "status", "overlap_ratio"])


def anti_missing(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "ssl_candidates").select("audio_id", "delivered_at")
    return rows.join(quality(spark, d), "audio_id", "left_anti")


def normalized_text(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "labeled_manifest")).select("line_number", text.normalize_text(F.col("text"), PLAIN).alias("normalized"))


def normalized_text_unicode(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "labeled_manifest")).select("line_number", text.normalize_text(F.col("text")).alias("normalized"))


def normalized_text_options(spark: SparkSession, d: str) -> DataFrame:
    bare = TextNormalization(normalize_unicode=False, lowercase=False, remove_bracketed_text=False, remove_numbers=True, keep_word_apostrophe=False)
    return spread(table(spark, d, "documents")).select("doc_id", text.normalize_text(F.col("text"), bare).alias("normalized"))


def text_gate_reasons(spark: SparkSession, d: str) -> DataFrame:
    rows = spread(table(spark, d, "labeled_manifest")).withColumn("clean", text.normalize_text(F.col("text")))
    reasons = gates.all_reasons(gates.text_reasons(F.col("text"), F.col("clean"), F.col("duration")))
    return rows.select("line_number", F.array_join(reasons, ",").alias("reasons"))


def labeled_assignment(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "labeled_manifest").drop("split")
    return split.assign_splits(rows, SplitRatios(), "speaker_id", ["language", "dataset"], "s1")


def labeled_split_assignment(spark: SparkSession, d: str) -> DataFrame:
    return labeled_assignment(spark, d).select("line_number", "split")


def labeled_split_counts(spark: SparkSession, d: str) -> DataFrame:
    """Last features, joins, gates, normalised text gates, split and counts: the labeled branch end to end."""
    rows = spread(table(spark, d, "labeled_manifest"))
    config = LabeledSplit(OPEN_LABELED, group_key="speaker_id", stratify_keys=("language", "dataset"), salt="s1")
    assigned, _ = pipelines.run_labeled_split(rows, quality(spark, d), overlap(spark, d), clip_music(spark, d), config)
    return split.split_counts(assigned, ["language"])


def labeled_gate_reasons(spark: SparkSession, d: str) -> DataFrame:
    """All reasons of every labeled row with all feature tables required."""
    rows = spread(table(spark, d, "labeled_manifest"))
    config = LabeledSplit(allowed_languages=("uz", "ru", "kk"))
    judged = pipelines.labeled_reasons(rows, quality(spark, d), overlap(spark, d), clip_music(spark, d), config)
    return judged.select("line_number", F.array_join("reject_reasons", ",").alias("reasons"))


def split_totals(spark: SparkSession, d: str) -> DataFrame:
    return split.split_counts(labeled_assignment(spark, d))


def stable_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "labeled_manifest").select("line_number", hashing.unit_hash(F.col("speaker_id"), "salt").alias("h"))


def source_cap(spark: SparkSession, d: str) -> DataFrame:
    return selection.mark_source_cap(clips(spark, d), 3).select("audio_id", F.col("place").isNull().alias("over"))


def hours_budget(spark: SparkSession, d: str) -> DataFrame:
    return selection.mark_budget(clips(spark, d), 2.0).select("audio_id", "in_budget")


def ssl_selection(spark: SparkSession, d: str) -> DataFrame:
    """Gates, score, cap and budget over every row of the candidates, repeated ones too: the stage each one reached."""
    rows = table(spark, d, "ssl_candidates").select("audio_id", "delivered_at", "duration", "sample_rate", "language", "dataset", "source_audio_id")
    config = Selection(SSL_GATES, ("uz", "ru"), 3, 0.5)
    out = pipelines.run_ssl_selection(rows, quality(spark, d), overlap(spark, d), clip_music(spark, d), config, ties=("delivered_at",))
    return out.select("audio_id", "delivered_at", "stage")


def selected_by_language_dataset(spark: SparkSession, d: str) -> DataFrame:
    rows = joined_ssl(spark, d).where(F.size(ssl_reasons()) == 0)
    return report.counts_by(rows, ["language", "dataset"])


def selected_hours(spark: SparkSession, d: str) -> DataFrame:
    return report.selected_hours(joined_ssl(spark, d).where(F.size(ssl_reasons()) == 0))


def spans(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "ssl_candidates")
    one = F.array(F.struct(F.col("source_start").alias("start"), F.col("source_end").alias("end")))
    return rows.select(F.col("audio_id").alias("source"), "delivered_at", one.alias("spans"))


SHORT = Vad(max_segment_duration=5.0, min_segment_duration=1.5)


def split_long_segments(spark: SparkSession, d: str) -> DataFrame:
    pieces = pipelines.pieces_of(spans(spark, d), ["source", "delivered_at"], SHORT).where("kept")
    return pieces.select(
        sharding.segment_id(F.col("source"), F.col("vad_index"), F.col("part")).alias("segment_id"), "delivered_at",
        F.round("start", 3).alias("vad_start"), F.round("end", 3).alias("vad_end"), F.round(F.col("end") - F.col("start"), 3).alias("vad_duration"))


def vad_source_summary(spark: SparkSession, d: str) -> DataFrame:
    pieces = pipelines.pieces_of(spans(spark, d), ["source", "delivered_at"], SHORT)
    kept = F.round(F.sum(F.when(F.col("kept"), F.col("end") - F.col("start"))), 3)
    return pieces.groupBy("source", "delivered_at").agg(
        F.count_if("kept").alias("num_segments"), F.coalesce(kept, F.lit(0.0)).alias("kept_duration"),
        F.count_if(~F.col("kept")).alias("dropped_short"), F.count_if(F.col("part") > 0).alias("extra_parts"))


def clip_manifest(spark: SparkSession, d: str) -> DataFrame:
    run = pipelines.Run(MANIFEST, "vad_x")
    raw = table(spark, d, "raw_unlabeled").withColumn("line_number", F.xxhash64("audio_id", "recorded_at"))
    found = raw.select("line_number", F.array(F.struct(F.lit(0.5).alias("start"), F.lit(12.75).alias("end"))).alias("spans")).distinct()
    segments = pipelines.segments_of(raw.distinct(), found, run, "none", SHORT)
    return pipelines.clip_rows(segments).select("audio_id", "audio_path", "source_audio_path", "source_start", "source_end", "duration", "dataset")


def materialized_slices(spark: SparkSession, d: str) -> DataFrame:
    start, end = (F.col("vec_id") % 50) / 1000.0, (F.col("vec_id") % 70) / 1000.0
    cut = intervals.sample_slice(F.col("samples"), F.lit(1000), start, end)
    return waves(spark, d).select("vec_id", F.size(cut).alias("n"), F.round(F.aggregate(cut, F.lit(0.0), lambda a, x: a + x), 5).alias("total"))


def overlap_features(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "overlap_features").where(F.col("status") == "ok")
    segments = F.transform("overlap_segments", lambda s: F.struct(s["start_sec"].alias("start"), s["end_sec"].alias("end")))
    rows = rows.withColumn("s", intervals.at_least(intervals.rounded(segments), 0.3)).withColumn("total", intervals.total(F.col("s")))
    return rows.select(
        "audio_id", "computed_at", F.size("s").alias("num_overlap_segments"), F.round("total", 3).alias("overlap_duration"),
        F.when(F.col("duration") > 0, F.round(F.col("total") / F.col("duration"), 6)).otherwise(0.0).alias("overlap_ratio"))


def overlap_corpus_ratio(spark: SparkSession, d: str) -> DataFrame:
    return report.ratio_of_sums(table(spark, d, "overlap_features"), "overlap_duration", "duration", "corpus_overlap_ratio")


def music_clip_rollup(spark: SparkSession, d: str) -> DataFrame:
    return music.clip_rollup(music_windows(spark, d), "clip", "p", 0.5)


def music_totals(spark: SparkSession, d: str) -> DataFrame:
    rolled = music_clip_rollup(spark, d)
    return rolled.agg(F.count("*").alias("num_rows"), F.count_if("is_music").alias("num_music"), F.round(F.count_if("is_music") / F.count("*"), 6).alias("music_share"))


def music_top_labels(spark: SparkSession, d: str) -> DataFrame:
    scores = table(spark, d, "embeddings").select(F.col("label").alias("clip"), F.posexplode("embedding").alias("label_idx", "x"))
    return music.top_labels(scores.withColumn("p", music.sigmoid(F.col("x").cast("double"))), "clip", "label_idx", "p", 3)


def music_windows_padded(spark: SparkSession, d: str) -> DataFrame:
    framed = waves(spark, d).select("vec_id", F.posexplode(intervals.windows(F.col("samples"), 10)).alias("k", "w"))
    return framed.select("vec_id", "k", F.size("w").alias("n"), F.round(F.aggregate("w", F.lit(0.0), lambda a, x: a + x), 5).alias("total"))


def label_index(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "nation").select(F.col("n_name").alias("label"), F.col("n_nationkey").alias("index"))
    return music.label_index(labels, LABEL)


def quality_metrics_mono(spark: SparkSession, d: str) -> DataFrame:
    return waves(spark, d).select("vec_id", signal.metrics_of(F.col("samples"), F.lit(1000)).alias("x")).select("vec_id", "x.*")


def quality_metrics_stereo(spark: SparkSession, d: str) -> DataFrame:
    """The same samples taken as two interleaved channels."""
    return waves(spark, d).select("vec_id", signal.metrics_of(F.col("samples"), F.lit(1000), F.lit(2)).alias("x")).select("vec_id", "x.*")


def quality_score(spark: SparkSession, d: str) -> DataFrame:
    score = signal.quality_score(F.col("rms_dbfs"), F.col("clipping_ratio"), F.col("silence_ratio"), F.nanvl("snr_estimate_db", F.lit(None).cast("double")))
    rows = table(spark, d, "quality_features").where(F.col("status") == "ok")
    return rows.select("audio_id", "computed_at", score.alias("estimate"))


def level_round_trip(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "quality_features").where(F.col("status") == "ok")
    return rows.select("audio_id", "computed_at", F.round(signal.dbfs(signal.amplitude(F.col("peak_dbfs"))), 6).alias("level"))


def shard_and_limit(spark: SparkSession, d: str) -> DataFrame:
    return sharding.shard(table(spark, d, "labeled_manifest"), 1, 3, 100).select("line_number", "audio_id")


def shard_totals(spark: SparkSession, d: str) -> DataFrame:
    return sharding.shard_totals(table(spark, d, "labeled_manifest"), 1, 3, 100)


def run_totals(spark: SparkSession, d: str) -> DataFrame:
    return report.run_totals(table(spark, d, "quality_features"), "quality_score")


def path_resolution(spark: SparkSession, d: str) -> DataFrame:
    path = F.when(F.col("line_number") % 3 == 0, F.concat(F.lit("/"), "audio_path")).otherwise(F.col("audio_path"))
    return table(spark, d, "labeled_manifest").select("line_number", sharding.resolve_path(path, "/data/manifests").alias("path"))


def error_rows(spark: SparkSession, d: str) -> DataFrame:
    """Every recording fails to open, each seventh because it has no path: one error row each, none lost."""
    path = F.when(F.col("line_number") % 7 > 0, F.col("audio_path")).alias("audio_path")
    rows = table(spark, d, "labeled_manifest").select("line_number", "audio_id", path, "duration")
    out = pipelines.run_audio_quality(rows, pipelines.Run("/nowhere/manifest.jsonl", "quality_x"))
    return out.select("source_line_number", "status", "error_type")


def jsonl_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """The recordings written as JSON lines and read again, and what their line numbers are: as many as lines, from 1 in each file."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/jsonl-{uuid.uuid4().hex}"
    manifests.write_jsonl(table(spark, d, "raw_unlabeled").withColumn("recorded_at", F.col("recorded_at").cast("string")), folder)
    rows = cut(manifests.read_manifest(spark, folder, RAW_UNLABELED + ", recorded_at string"))
    manifests.remove(spark, folder)
    files = rows.groupBy("file").agg(F.count_distinct("line_number").alias("n"), F.min("line_number").alias("low"), F.max("line_number").alias("high"))
    lines = files.agg(F.sum("n").alias("num_lines"), F.min("low").alias("first_line"), F.sum("high").alias("last_lines"))
    return rows.drop("file_ord", "file", "line_number", "raw").crossJoin(F.broadcast(lines))


def energy_vad_segments(spark: SparkSession, d: str) -> DataFrame:
    """Spans of a simple detector on short signals."""

    def run(frames):
        detector = EnergySpeech(-22.0, 5, 10, 10, 2)
        for frame in frames:
            rows = [(i, s, e) for i, w in frame.itertuples(index=False) for s, e in detector.detect(w, 1000)]
            yield pd.DataFrame(rows, columns=["vec_id", "first", "last"])

    return waves(spark, d).mapInPandas(run, "vec_id bigint, first int, last int")


QUERIES = (
    labeled_split_counts, labeled_gate_reasons, labeled_split_assignment, split_totals, gate_reasons, reject_histogram, text_gate_reasons, normalized_text,
    normalized_text_unicode, normalized_text_options, feature_last_wins, shard_union, anti_missing, selection_score, source_cap, hours_budget, ssl_selection,
    selected_by_language_dataset, selected_hours, stable_hash, split_long_segments, vad_source_summary, clip_manifest, materialized_slices,
    overlap_features, overlap_corpus_ratio, music_clip_rollup, music_totals, music_top_labels, music_windows_padded, label_index,
    quality_metrics_mono, quality_metrics_stereo, quality_score, level_round_trip, shard_and_limit, shard_totals, run_totals, path_resolution, error_rows, jsonl_roundtrip, energy_vad_segments,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
