"""Stages from the command line: python -m sonorant.cli STAGE ...; each prints a JSON report.

Outputs are folders of JSON lines (one file a task); any of them may be read as
a manifest or feature file by the next stage. Options and defaults are fixed
values, the interface of the stages.
"""

from __future__ import annotations

import argparse
import json
import time
from dataclasses import asdict, fields
from pathlib import PurePosixPath

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import config as c
from .functions.hashing import run_id, stage_run_id
from .operators import features, gates, report, sharding, split
from .plans import pipelines
from .runtime import cut
from .schemas import RAW_LABELED, RAW_UNLABELED
from .scorers import device as resolve_device, music_classifier, overlap_detector, runtime_metadata, speech_detector
from .sources.manifest import load_env, read_manifest, write_json, write_jsonl

FEATURES = {
    "quality": "audio_id string, status string, clipping_ratio double, silence_ratio double, rms_dbfs double, snr_estimate_db double, dc_offset_mean_abs double, quality_score double",
    "overlap": "audio_id string, status string, overlap_ratio double",
    "music": "audio_id string, status string, is_music boolean",
}
#: Gate options whose command-line default is not the library's.
GATE_OPTIONS = (
    "min_duration", "max_duration", "target_sample_rate", "max_clipping_ratio", "max_silence_ratio", "min_rms_dbfs", "max_rms_dbfs",
    "min_snr_db", "max_overlap_ratio", "max_dc_offset",
)
STAGES = {"vad": c.Vad, "quality": c.AudioQuality, "overlap": c.Overlap, "music": c.Music}
NOT_OPTIONS = {"target_sample_rate", "music_label", "max_threads"}


def _option(parser: argparse.ArgumentParser, name: str, default) -> None:
    parser.add_argument(f"--{name.replace('_', '-')}", type=type(default), default=default)


def _scorer_options(s: argparse.ArgumentParser, device: str, scorers: tuple[str, ...], token: bool) -> None:
    s.add_argument("--device", default=device, help="cpu, cuda, cuda:0 or auto")
    s.add_argument("--max-threads", type=int, default=1, help="CPU threads of a model in each task; 0 keeps the model's default")
    s.add_argument("--scorer", choices=scorers, default=scorers[0], help="a model, if its packages are installed, or the stand-in without one")
    if token:
        s.add_argument("--hf-token")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sonorant")
    stages = p.add_subparsers(dest="stage", required=True)
    for name, kind in STAGES.items():
        s = stages.add_parser(name)
        if name == "vad":
            s.add_argument("--input-manifest", default="data/raw/unlabeled/manifest.jsonl")
            s.add_argument("--output-segments", default="data/interim/vad/unlabeled_segments.jsonl")
            s.add_argument("--output-summary")
            s.add_argument("--vad-run-id", dest="run_id")
            _scorer_options(s, "cpu", ("energy", "silero"), False)
        else:
            s.add_argument("--input-manifest", required=True)
            s.add_argument("--output-features", required=True)
            s.add_argument("--run-id")
        if name in ("overlap", "music"):
            _scorer_options(s, "auto", {"overlap": ("none", "pyannote"), "music": ("flatness", "ast")}[name], True)
        for f in fields(kind):
            if f.name not in NOT_OPTIONS:
                _option(s, f.name, f.default)
        s.add_argument("--output-metadata")
        s.add_argument("--shard-index", type=int, default=0)
        s.add_argument("--num-shards", type=int, default=1)
        s.add_argument("--limit", type=int)
        s.add_argument("--fail-fast", action="store_true")
    s = stages.add_parser("materialize")
    s.add_argument("--segments", default="data/interim/vad/unlabeled_segments.jsonl")
    s.add_argument("--output-dir", default="data/processed/unlabeled_vad")
    s.add_argument("--output-manifest")
    s.add_argument("--output-metadata")
    s.add_argument("--format", choices=("flac", "wav"), default="flac")
    s.add_argument("--subtype")
    s.add_argument("--overwrite", action="store_true")
    s.add_argument("--fail-fast", action="store_true")
    for name, base in (("select", c.SSL_GATES), ("split", c.LABELED_GATES)):
        s = stages.add_parser(name)
        s.add_argument("--input-manifest", required=True)
        for kind in FEATURES:
            s.add_argument(f"--{kind}-features", nargs="+" if kind == "quality" else "*", default=[], required=kind == "quality")
        for option in GATE_OPTIONS:
            _option(s, option, c.CLI_LAYER.get(option, getattr(base, option)))
        s.add_argument("--keep-music", action="store_true")
        s.add_argument("--languages", nargs="*")
        s.add_argument("--run-id")
    s = stages.choices["select"]
    s.add_argument("--output-selected", required=True)
    s.add_argument("--output-rejected")
    s.add_argument("--output-metadata")
    s.add_argument("--max-clips-per-source", type=int)
    s.add_argument("--target-hours", type=float)
    s = stages.choices["split"]
    s.add_argument("--output-dir", required=True)
    for part in ("train", "val", "test"):
        s.add_argument(f"--{part}-ratio", type=float, default=getattr(c.SplitRatios, part))
    s.add_argument("--group-key", default=c.LabeledSplit.group_key)
    s.add_argument("--stratify-keys", nargs="*", default=list(c.LabeledSplit.stratify_keys))
    s.add_argument("--salt", default=c.LabeledSplit.salt)
    s.add_argument("--no-require-text", action="store_true")
    for option in ("min_chars_per_second", "max_chars_per_second"):
        _option(s, option, getattr(c.LabeledSplit, option))
    return p


def feature_tables(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame | None]:
    out = {}
    for kind, schema in FEATURES.items():
        paths = getattr(args, f"{kind}_features")
        columns = [x.split()[0] for x in schema.split(", ")][1:]
        out[kind] = features.last_wins(read_manifest(spark, paths, schema), ["file_ord", "line_number"], columns) if paths else None
    return out


def gates_of(args: argparse.Namespace) -> c.QualityGates:
    return c.QualityGates(
        **{k: getattr(args, k) for k in GATE_OPTIONS}, drop_music=not args.keep_music,
        require_overlap=bool(args.overlap_features), require_music=bool(args.music_features))


def stage_config(args: argparse.Namespace):
    kind = STAGES[args.stage]
    given = {f.name: getattr(args, f.name) for f in fields(kind) if hasattr(args, f.name)}
    if "max_threads" in given:
        given["max_threads"] = given["max_threads"] or None
    return kind(**given)


def _counted(rows: DataFrame, key: str, *more: str) -> dict:
    """Nested counts by one or two columns; a missing value is the string None."""
    out: dict = {}
    for r in rows.groupBy(key, *more).count().collect():
        at = out
        for k in [key, *more][:-1]:
            at = at.setdefault(str(r[k]), {})
        at[str(r[[key, *more][-1]])] = r["count"]
    return dict(sorted(out.items()))


def _features(spark: SparkSession, args: argparse.Namespace, manifest: str) -> dict:
    """vad, quality, overlap and music: rows of the shard in, a feature table out."""
    config, on = stage_config(args), resolve_device(getattr(args, "device", "cpu"))
    name = args.run_id or stage_run_id(args.stage, manifest, config, args.shard_index, args.num_shards, args.limit)
    run = pipelines.Run(manifest, name, args.shard_index, args.num_shards, args.limit, args.fail_fast)
    rows = read_manifest(spark, manifest, RAW_UNLABELED)
    said = {f"{'audio_quality' if args.stage == 'quality' else args.stage}_config": asdict(config)}
    key = f"{args.stage}_run_id"
    if args.stage == "vad":
        segments, summary = pipelines.run_vad(rows, run, speech_detector(args.scorer, config, on), config)
        said["num_segments"] = write_jsonl(segments, args.output_segments)
        summary = cut(summary)
        if args.output_summary:
            said["num_summaries"] = write_jsonl(summary, args.output_summary)
        out = summary
    else:
        if args.stage == "quality":
            out = pipelines.run_audio_quality(rows, run, config)
        elif args.stage == "overlap":
            out = pipelines.run_overlap(rows, run, overlap_detector(args.scorer, config, on, args.hf_token), config)
        else:
            out = pipelines.run_music(rows, run, music_classifier(args.scorer, config, on, args.hf_token), config)
        write_jsonl(out, args.output_features)
        out = spark.read.schema(out.schema).json(args.output_features)
    totals = report.run_totals(out, "quality_score" if args.stage == "quality" else None).first().asDict()
    if args.stage == "overlap":
        totals |= report.ratio_of_sums(out, "overlap_duration", "duration", "corpus_overlap_ratio").first().asDict()
    if args.stage == "music":
        totals["num_music"] = out.where("status = 'ok' AND is_music").count()
    scanned = sharding.shard_totals(rows, args.shard_index, args.num_shards, args.limit).first().asDict()
    return {key: name, "input_manifest": manifest, **scanned, **totals, **said, **runtime_metadata(on)}


def _materialize(spark: SparkSession, args: argparse.Namespace) -> dict:
    config = c.Materialize(args.format, args.subtype, args.overwrite)
    segments = read_manifest(spark, args.segments, pipelines.SEGMENTS).drop("file_ord", "file", "line_number", "raw")
    done = cut(pipelines.materialize(segments, args.output_dir, config, args.fail_fast))
    good = done.where("outcome <> 'error'").drop("outcome")
    write_jsonl(good.orderBy("source_audio_path", "source_start"), args.output_manifest or f"{args.output_dir}/manifest.jsonl")
    counts = {r.outcome: r["count"] for r in done.groupBy("outcome").count().collect()}
    seconds = good.agg(F.round(F.coalesce(F.sum("duration"), F.lit(0.0)), 3)).first()[0]
    return {
        "segments_path": args.segments, "output_dir": args.output_dir, "num_input_segments": sum(counts.values()),
        "num_written_segments": counts.get("written", 0), "num_skipped_existing": counts.get("kept", 0), "num_errors": counts.get("error", 0),
        "audio_duration": seconds, "config": asdict(config)}


def _select(spark: SparkSession, args: argparse.Namespace, manifest: str) -> dict:
    config = c.Selection(gates_of(args), tuple(args.languages) if args.languages else None, args.max_clips_per_source, args.target_hours)
    name = args.run_id or run_id("ssl", manifest, config)
    tables = feature_tables(spark, args)
    rows = read_manifest(spark, manifest, RAW_UNLABELED + ", source_audio_id string")
    out = cut(pipelines.run_ssl_selection(rows, tables["quality"], tables["overlap"], tables["music"], config, ("file_ord", "line_number")))
    kept = out.where("stage = 'selected'")
    rejected = out.where("stage <> 'selected'").select("audio_id", "reject_reasons", "duration", "language", "dataset")
    _passed(kept, {"selection_score": F.col("selection_score"), "selection_run_id": F.lit(name)}).write.mode("overwrite").text(args.output_selected)
    if args.output_rejected:
        write_jsonl(rejected, args.output_rejected)
    totals = report.selected_hours(kept).first()
    return {
        "selection_run_id": name, "input_manifest": manifest, "output_selected": args.output_selected,
        "num_input_rows": out.count(), "num_selected": totals.n, "num_rejected": rejected.count(), "selected_hours": totals.hours,
        "reject_histogram": {r.reason: r.n for r in gates.histogram(rejected).orderBy("reason").collect()},
        "selected_by_language": _counted(kept, "language"), "selected_by_dataset": _counted(kept, "dataset"), "config": asdict(config)}


def _split(spark: SparkSession, args: argparse.Namespace, manifest: str) -> dict:
    ratios = (args.train_ratio, args.val_ratio, args.test_ratio)
    config = c.LabeledSplit(
        gates_of(args), c.SplitRatios(*ratios), args.group_key, tuple(args.stratify_keys), not args.no_require_text,
        args.min_chars_per_second, args.max_chars_per_second, tuple(args.languages) if args.languages else None, args.salt)
    name = args.run_id or run_id("split", manifest, config)
    tables = feature_tables(spark, args)
    rows = read_manifest(spark, manifest, RAW_LABELED)
    out, rejected = pipelines.run_labeled_split(rows, tables["quality"], tables["overlap"], tables["music"], config)
    out = cut(out)
    # One pass writes all splits, each a folder, in the order of audio_id.
    _passed(out, {"split": F.col("split"), "split_run_id": F.lit(name)}, "split").write.mode("overwrite").partitionBy("__part").text(f"{args.output_dir}/splits")
    write_jsonl(rejected, f"{args.output_dir}/rejected")
    by = {r.split: r for r in split.split_counts(out).collect()}
    gone = {r.reason: r.n for r in gates.histogram(rejected).orderBy("reason").collect()}
    selected = sum(r.n for r in by.values())
    result = {
        "split_run_id": name, "input_manifest": manifest, "output_dir": args.output_dir, "num_input_rows": selected + rejected.count(),
        "num_selected": selected, "num_rejected": rejected.count(), "split_counts": {k: by[k].n for k in ("train", "val", "test")},
        "split_hours": {k: by[k].hours for k in ("train", "val", "test")}, "split_by_language": _counted(out, "split", "language"),
        "reject_histogram": gone, "config": asdict(config)}
    write_json(f"{args.output_dir}/split_metadata.json", result)
    return result


@F.arrow_udf(T.StringType())
def _with_keys(lines: pa.Array, new: pa.Array) -> pa.Array:
    """JSON objects with the keys of others set."""
    return pa.array([json.dumps(json.loads(a) | json.loads(b), ensure_ascii=False) for a, b in zip(lines.to_pylist(), new.to_pylist())], pa.string())


def _passed(rows: DataFrame, new: dict, part: str | None = None) -> DataFrame:
    """Manifest lines with all their keys, unknown ones too, and the new ones, in the order of audio_id."""
    added = F.to_json(F.struct(*[v.alias(k) for k, v in new.items()]), {"ignoreNullFields": "false"})
    line = _with_keys(F.col("raw"), added).alias("value")
    ordered = rows.select("audio_id", line, *([F.col(part).alias("__part")] if part else [])).orderBy(*(["__part"] if part else []), "audio_id")
    return ordered.drop("audio_id")


def main(argv: list[str] | None = None) -> dict:
    args = parser().parse_args(argv)
    if hasattr(args, "hf_token"):
        load_env(".env")
    spark = SparkSession.builder.appName(f"sonorant-{args.stage}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    began = time.time()
    manifest = getattr(args, "input_manifest", "")
    manifest = manifest if "://" in manifest else str(PurePosixPath(manifest))
    if args.stage in STAGES:
        result = _features(spark, args, manifest)
    elif args.stage == "materialize":
        result = _materialize(spark, args)
    else:
        result = (_select if args.stage == "select" else _split)(spark, args, manifest)
    seconds = round(time.time() - began, 3)
    result = {"stage": args.stage, **result, "processing_seconds": seconds}
    if args.stage == "vad":
        result["real_time_factor"] = report.real_time_factor(seconds, result["audio_duration"])
    if getattr(args, "output_metadata", None):
        write_json(args.output_metadata, result)
    print(json.dumps(result, ensure_ascii=False, default=str))
    return result


if __name__ == "__main__":
    main()
