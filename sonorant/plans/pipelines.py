"""The stages end to end: manifests in, feature tables, selections and splits out."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..config import AudioQuality, LabeledSplit, Materialize, Music, Overlap, Selection, TextNormalization, Vad
from ..functions import signal
from ..functions.hashing import none_string
from ..functions.text import normalize_text
from ..operators import features, gates, selection, sharding, split
from ..runtime import cut
from ..schemas import ERROR_TAIL, FEATURE_HEAD, SEGMENTS
from ..scorers import OverlapDetector, SpeechDetector, WindowClassifier
from ..sources import audio


@dataclass(frozen=True)
class Run:
    """What every feature stage needs besides its own settings."""

    manifest: str
    run_id: str
    shard: int = 0
    shards: int = 1
    limit: int | None = None
    fail_fast: bool = False

    @property
    def folder(self) -> str:
        return os.path.dirname(self.manifest) or "."


def _stage(rows: DataFrame, run: Run, kind: str, tail: str, one: Callable[[str, object], dict]) -> DataFrame:
    """A row of `kind` for each manifest row of the shard; errors become rows, unless fail_fast."""
    schema = f"{FEATURE_HEAD}, {tail}, {kind_id(kind)} string, {ERROR_TAIL}"
    optional = [c for c in ("dataset", "language", "split", "duration") if c in rows.columns]
    chosen = sharding.shard(rows, run.shard, run.shards, run.limit).select("line_number", "audio_id", "audio_path", *optional)

    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def work(batches):
        for batch in batches:
            out = []
            for r in map(lambda x: SimpleNamespace(**x), batch.to_pylist()):
                row = {k: getattr(r, k, None) for k in optional if k != "duration"}
                row |= {"audio_id": r.audio_id, "feature_type": kind, "feature_version": "1.0", "source_manifest": run.manifest,
                        "source_line_number": r.line_number, kind_id(kind): run.run_id}
                name = str(r.audio_path)
                path = name if name.startswith("/") or "://" in name else f"{run.folder}/{name}"
                try:
                    out.append(row | {"status": "ok", "audio_path": path} | one(path, r))
                except Exception as e:  # noqa: BLE001
                    if run.fail_fast:
                        raise
                    out.append(row | {"status": "error", "audio_path": r.audio_path, "error_type": type(e).__name__, "error": str(e)})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return chosen.mapInArrow(work, schema)


def kind_id(kind: str) -> str:
    return {"audio_quality": "quality_run_id", "music_detection": "music_run_id"}.get(kind, f"{kind}_run_id")


def _split_schema(schema: str) -> list[str]:
    """Column declarations of a DDL string; commas inside <> do not separate."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(schema):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            out.append(schema[start:i].strip())
            start = i + 1
    return [*out, schema[start:].strip()]


def _duration(row) -> float:
    """A clip's duration in its manifest, which a feature row needs."""
    value = getattr(row, "duration", None)
    if value is None or value != value:
        raise ValueError("the manifest row has no duration")
    return float(value)


def run_audio_quality(rows: DataFrame, run: Run, config: AudioQuality = AudioQuality()) -> DataFrame:
    def one(path, r):
        samples, rate = audio.load(path)
        found = signal.metrics(samples, rate, config)
        return found | {"manifest_duration": round(_duration(r), 3), "duration_delta": round(found["duration"] - _duration(r), 3)}

    out = _stage(rows, run, "audio_quality", f"manifest_duration double, duration_delta double, {signal.MEASURED}", one)
    score = signal.score_of(F.col("exact"), config).alias("quality_score")
    return out.select(*[score if c == "exact" else F.col(c) for c in out.columns])


def run_overlap(rows: DataFrame, run: Run, detector: OverlapDetector, config: Overlap = Overlap()) -> DataFrame:
    def one(path, r):
        whole = _duration(r)
        samples, rate = audio.load_channels(path)
        found = [{"start": round(s, 3), "end": round(e, 3), "duration": round(max(e - s, 0.0), 3)} for s, e in detector.overlaps(samples, rate)]
        found = [x for x in found if x["duration"] >= config.min_overlap_duration]
        length = sum(x["duration"] for x in found)
        return {"duration": round(whole, 3), "overlap_duration": round(length, 3), "overlap_ratio": round(length / whole, 6) if whole > 0 else 0.0,
                "num_overlap_segments": len(found), "overlap_segments": found, "overlap_model": detector.name}

    tail = ("duration double, overlap_duration double, overlap_ratio double, num_overlap_segments int, "
            "overlap_segments array<struct<start:double,end:double,duration:double>>, overlap_model string")
    return _stage(rows, run, "overlap", tail, one)


def windows_of(samples: np.ndarray, width: int) -> np.ndarray:
    if width <= 0:
        raise ValueError("width must be positive")
    count = max(1, -(-len(samples) // width))
    out = np.zeros(count * width, np.float32)
    out[: len(samples)] = samples
    return out.reshape(count, width)


def run_music(rows: DataFrame, run: Run, classifier: WindowClassifier, config: Music = Music()) -> DataFrame:
    def one(path, r):
        samples = audio.load_mono(path, config.target_sample_rate)
        p = classifier.score(windows_of(samples, round(config.window_seconds * config.target_sample_rate)))
        at = [x.lower() for x in classifier.labels].index(config.music_label.lower())
        own, mean = p[:, at], p.mean(axis=0)
        best = np.argsort(mean)[::-1][: max(0, config.top_k_labels)]
        return {"duration": round(_duration(r), 3), "music_model": classifier.name, "music_label": config.music_label, "music_threshold": config.music_threshold,
                "music_probability": round(float(own.max()), 6), "music_mean_probability": round(float(own.mean()), 6),
                "music_ratio": round(float(np.mean(own >= np.asarray(config.music_threshold, p.dtype))), 6),
                "is_music": bool(float(own.max()) >= config.music_threshold), "num_windows": len(p),
                "top_labels": [{"label": classifier.labels[i], "probability": round(float(mean[i]), 6)} for i in best]}

    tail = ("duration double, music_model string, music_label string, music_threshold double, music_probability double, "
            "music_mean_probability double, music_ratio double, is_music boolean, num_windows int, "
            "top_labels array<struct<label:string,probability:double>>")
    return _stage(rows, run, "music_detection", tail, one)


def run_vad(rows: DataFrame, run: Run, detector: SpeechDetector, config: Vad = Vad()) -> tuple[DataFrame, DataFrame]:
    """(segments, summaries). Decoding and detection run once; both tables come from one checkpointed table of spans."""
    spans = "line_number bigint, duration double, sample_rate int, spans array<struct<start:double,end:double>>, error_type string, error string"
    chosen = sharding.shard(rows, run.shard, run.shards, run.limit)
    paths = chosen.select("line_number", sharding.resolve_path(F.col("audio_path"), run.folder).alias("path"))

    def work(frames):
        for frame in frames:
            out = []
            for line, path in frame.itertuples(index=False):
                try:
                    samples = audio.load_mono(path, config.target_sample_rate)
                    rate = config.target_sample_rate
                    found = [{"start": s / rate, "end": e / rate} for s, e in detector.detect(samples, rate)]
                    out.append((line, len(samples) / rate, rate, found, None, None))
                except Exception as e:  # noqa: BLE001
                    if run.fail_fast:
                        raise
                    out.append((line, None, None, None, type(e).__name__, str(e)))
            yield pd.DataFrame(out, columns=["line_number", "duration", "sample_rate", "spans", "error_type", "error"], dtype=object)

    found = cut(paths.mapInPandas(work, spans))
    return segments_of(chosen, found, run, detector.name, config), vad_summary(chosen, found, run, detector.name, config)


def pieces_of(spans: DataFrame, keys: list[str], config: Vad) -> DataFrame:
    """(keys, vad_index, part, start, end, kept) of every piece of (keys, spans); a piece too short is not kept."""
    from ..functions.intervals import split_long

    opened = spans.select(*keys, F.posexplode("spans").alias("vad_index", "s"))
    parts = opened.select(*keys, "vad_index", F.explode(split_long(F.col("s.start"), F.col("s.end"), config.max_segment_duration)).alias("p"))
    return parts.select(*keys, "vad_index", "p.part", "p.start", "p.end", (F.col("p.end") - F.col("p.start") >= config.min_segment_duration).alias("kept"))


def segments_of(rows: DataFrame, spans: DataFrame, run: Run, model: str, config: Vad) -> DataFrame:
    pieces = pieces_of(spans.where(F.col("spans").isNotNull()), ["line_number"], config).where("kept")
    have = set(rows.columns)
    source = lambda c, kind: (F.col(c) if c in have else F.lit(None)).cast(kind)
    joined = rows.join(pieces, "line_number").select(
        sharding.segment_id(F.col("audio_id"), F.col("vad_index"), F.col("part")).alias("segment_id"), F.col("audio_id").alias("source_audio_id"),
        F.lit(run.manifest).alias("source_manifest"), F.col("line_number").alias("source_line_number"),
        sharding.resolve_path(F.col("audio_path"), run.folder).alias("source_audio_path"), F.col("audio_path").alias("source_audio_relpath"),
        source("dataset", "string").alias("dataset"), source("language", "string").alias("language"), source("split", "string").alias("source_split"),
        source("duration", "double").alias("source_duration"), source("sample_rate", "int").alias("source_sample_rate"),
        source("channels", "int").alias("source_channels"), source("source_clips", "string").alias("source_clips"),
        F.round("start", 3).alias("vad_start"), F.round("end", 3).alias("vad_end"), F.round(F.col("end") - F.col("start"), 3).alias("vad_duration"),
        F.lit(run.run_id).alias("vad_run_id"), F.lit(model).alias("vad_model"), F.lit(config.threshold).alias("vad_threshold"),
    )
    return joined.select(*[c.split()[0] for c in _split_schema(SEGMENTS)])


def vad_summary(rows: DataFrame, spans: DataFrame, run: Run, model: str, config: Vad) -> DataFrame:
    kept = F.sum(F.when(F.col("kept"), F.col("end") - F.col("start")))
    pieces = pieces_of(spans.where(F.col("spans").isNotNull()), ["line_number"], config).groupBy("line_number").agg(
        F.count_if("kept").alias("num_vad_segments"), F.coalesce(kept, F.lit(0.0)).alias("kept"),
        F.count_if(~F.col("kept")).alias("dropped_short_segments"), F.count_if(F.col("part") > 0).alias("fallback_split_long_segments"))
    d, k = F.col("s.duration"), F.coalesce(F.col("kept"), F.lit(0.0))
    ok = F.col("s.error_type").isNull()
    when_ok = lambda c: F.when(ok, c)
    have = set(rows.columns)
    source = lambda c, kind: when_ok((F.col(f"r.{c}") if c in have else F.lit(None)).cast(kind))
    return (
        rows.alias("r").join(spans.alias("s"), "line_number").join(pieces.alias("p"), "line_number", "left").select(
            F.col("r.audio_id").alias("audio_id"), F.when(ok, "ok").otherwise("error").alias("status"), F.lit(run.manifest).alias("source_manifest"),
            F.col("line_number").alias("source_line_number"),
            F.when(ok, sharding.resolve_path(F.col("r.audio_path"), run.folder)).otherwise(F.col("r.audio_path")).alias("audio_path"),
            source("dataset", "string").alias("dataset"), source("language", "string").alias("language"),
            when_ok(F.round(d, 3)).alias("duration"), source("duration", "double").alias("metadata_duration"), when_ok(F.col("s.sample_rate")).alias("sample_rate"),
            when_ok(F.coalesce("num_vad_segments", F.lit(0))).alias("num_vad_segments"), when_ok(F.round(k, 3)).alias("vad_kept_duration"),
            when_ok(F.when(d > 0, F.round(k / d, 6)).otherwise(0.0)).alias("vad_kept_ratio"),
            when_ok(F.round(F.greatest(d - k, F.lit(0.0)), 3)).alias("vad_dropped_duration"),
            when_ok(F.coalesce("dropped_short_segments", F.lit(0))).alias("dropped_short_segments"),
            when_ok(F.coalesce("fallback_split_long_segments", F.lit(0))).alias("fallback_split_long_segments"),
            F.lit(run.run_id).alias("vad_run_id"), F.lit(model).alias("vad_model"), F.col("s.error_type"), F.col("s.error"),
        )
    )


def clip_rows(segments: DataFrame, ending: str = "wav") -> DataFrame:
    """Manifest rows of materialised clips; duration, rate and channels come from the cut audio."""
    return segments.select(
        F.col("segment_id").alias("audio_id"), sharding.clip_path(F.col("segment_id"), ending).alias("audio_path"),
        F.col("vad_duration").alias("duration"), F.col("source_sample_rate").alias("sample_rate"), F.col("source_channels").alias("channels"),
        "language", "dataset", "source_audio_id", "source_audio_path", "source_audio_relpath", "source_manifest", "source_line_number",
        F.col("vad_start").alias("source_start"), F.col("vad_end").alias("source_end"), "source_duration", "vad_duration", "vad_run_id", "vad_model", "vad_threshold",
    )


#: Seconds of a recording whose clips one task cuts.
STRETCH = 600.0


def materialize(segments: DataFrame, folder: str, config: Materialize = Materialize("wav"), fail_fast: bool = False) -> DataFrame:
    """Clips cut and written; their manifest rows, with `outcome` written, kept or error.

    Segments are brought together by stretches of their source, so a recording
    with very many of them is many tasks, and each decodes only its own part of
    the file. A source that cannot be opened is tried once a task.
    """
    out = clip_rows(segments, config.output_format)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema) + ", outcome string"
    names = [*out.columns, "outcome"]

    def work(frames):
        broken: tuple[str | None, Exception | None] = (None, None)
        for frame in frames:
            rows = []
            for r in frame.to_dict("records"):
                source = r["source_audio_path"]
                try:
                    if broken[0] == source:
                        raise broken[1]
                    try:
                        clip, rate = audio.load(source, r["source_start"], r["source_end"])
                    except OSError as e:
                        broken = (source, e)
                        raise
                    if not len(clip):
                        raise ValueError("the segment is empty")
                    new = audio.write_audio(f"{folder}/{r['audio_path']}", clip, rate, config.overwrite, config.output_format, config.subtype)
                    rows.append(r | {"duration": round(len(clip) / rate, 3), "sample_rate": rate, "channels": clip.shape[1], "outcome": "written" if new else "kept"})
                except Exception:  # noqa: BLE001
                    if fail_fast:
                        raise
                    rows.append(r | {"outcome": "error"})
            yield pd.DataFrame(rows, columns=names, dtype=object)

    stretch = F.floor(F.coalesce(F.nanvl("source_start", F.lit(0.0)), F.lit(0.0)) / STRETCH)
    placed = out.repartition("source_audio_path", stretch).sortWithinPartitions("source_audio_path", "source_start")
    return placed.mapInPandas(work, schema)


def run_ssl_selection(manifest: DataFrame, quality: DataFrame | None, overlap: DataFrame | None, music: DataFrame | None = None,
                      config: Selection = Selection(), ties: tuple[str, ...] = ()) -> DataFrame:
    """Every manifest row with selection_score, reject_reasons (empty: selected) and the stage that rejected it.

    The feature tables have one row a clip (features.last_wins). Gates name all
    failed reasons; only passing clips meet the cap, only capped ones the
    budget. Rows that a manifest repeats are rows each, in the order of `ties`.
    """
    joined = features.join_features(manifest, quality, overlap, music)
    q, o, m = F.col("q"), F.col("o"), F.col("m")
    reasons = gates.all_reasons(
        gates.quality_reasons(F.col("duration"), F.col("sample_rate"), q, o, m, config.gates),
        gates.language_reason(F.col("language"), config.allowed_languages))
    scored = joined.drop("selection_score").withColumns(
        {"selection_score": features.selection_score(q, o), "reject_reasons": reasons}).drop("q", "o", "m")
    scored = cut(scored)
    passing = scored.where(F.size("reject_reasons") == 0)
    out = scored.where(F.size("reject_reasons") > 0).withColumn("stage", F.lit("gates"))
    if config.max_clips_per_source is not None:
        marked = selection.mark_source_cap(passing, config.max_clips_per_source, ties=ties)
        out = out.unionByName(_rejected(marked.where(F.col("place").isNull()).drop("place"), "source_cap"))
        passing = marked.where(F.col("place").isNotNull()).drop("place")
    if config.target_hours is not None:
        marked = selection.mark_budget(passing, config.target_hours, ties=ties)
        out = out.unionByName(_rejected(marked.where(~F.col("in_budget")).drop("in_budget"), "budget"))
        passing = marked.where("in_budget").drop("in_budget")
    return out.unionByName(passing.withColumn("stage", F.lit("selected")))


def _rejected(rows: DataFrame, reason: str) -> DataFrame:
    return rows.withColumn("reject_reasons", F.array(F.lit(reason))).withColumn("stage", F.lit(reason))


def labeled_reasons(manifest: DataFrame, quality: DataFrame | None, overlap: DataFrame | None, music: DataFrame | None = None,
                    config: LabeledSplit = LabeledSplit(), normalization: TextNormalization = TextNormalization()) -> DataFrame:
    """The manifest with reject_reasons: quality gates, then text gates, then language."""
    joined = features.join_features(manifest.withColumn("__clean", normalize_text(F.col("text"), normalization)), quality, overlap, music)
    reasons = gates.all_reasons(
        gates.quality_reasons(F.col("duration"), F.col("sample_rate"), F.col("q"), F.col("o"), F.col("m"), config.gates),
        gates.text_reasons(F.col("text"), F.col("__clean"), F.col("duration"), config.text_gates),
        gates.language_reason(F.col("language"), config.allowed_languages))
    return joined.withColumn("reject_reasons", reasons).drop("q", "o", "m", "__clean")


def run_labeled_split(manifest: DataFrame, quality: DataFrame | None, overlap: DataFrame | None, music: DataFrame | None = None,
                      config: LabeledSplit = LabeledSplit(), normalization: TextNormalization = TextNormalization()) -> tuple[DataFrame, DataFrame]:
    """(assigned, rejected)."""
    judged = cut(labeled_reasons(manifest, quality, overlap, music, config, normalization))
    passing = judged.where(F.size("reject_reasons") == 0).drop("reject_reasons")
    rejected = judged.where(F.size("reject_reasons") > 0).select(
        none_string(F.col("audio_id")).alias("audio_id"), "reject_reasons", "duration", "language", "dataset")
    return split.assign_splits(passing, config.ratios, config.group_key, list(config.stratify_keys), config.salt), rejected
