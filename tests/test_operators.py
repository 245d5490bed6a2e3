"""Operators and whole stages against plain Python."""

import json
import random
from datetime import datetime

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sonorant import cli
from sonorant.config import Materialize, QualityGates, Selection, SplitRatios
from sonorant.functions import text
from sonorant.functions.text import normalize_text
from sonorant.operators import features, gates, report, selection, sharding, split
from sonorant.plans import pipelines, registry
from sonorant.scorers import EnergySpeech, FlatnessMusic, NoOverlap
from sonorant.sources import audio, manifest
from sonorant.streaming.manifests import judged_stream, reason_counts

Q = "struct<status:string,clipping_ratio:double,silence_ratio:double,rms_dbfs:double,snr_estimate_db:double,dc_offset_mean_abs:double,quality_score:double>"
O, M = "struct<status:string,overlap_ratio:double>", "struct<status:string,is_music:boolean>"
GOOD = ("ok", 0.0, 0.1, -20.0, 20.0, 0.0, 0.9)
NAN = float("nan")


def reasons_of(spark, duration=5.0, rate=16000, q=GOOD, o=("ok", 0.0), m=("ok", False), g=QualityGates(3.0, 30.0)):
    df = spark.createDataFrame([(duration, rate, q, o, m)], f"d double, r int, q {Q}, o {O}, m {M}")
    return df.select(gates.all_reasons(gates.quality_reasons(F.col("d"), F.col("r"), F.col("q"), F.col("o"), F.col("m"), g))).first()[0]


def test_gates(spark):
    assert reasons_of(spark) == []
    assert reasons_of(spark, None, 8000, None, None, None) == ["missing_quality", "missing_overlap", "missing_music", "missing_duration", "sample_rate_mismatch"]
    assert reasons_of(spark, 1.0, None, ("error", *[None] * 6), ("error", None), ("error", None)) == ["quality_error", "overlap_error", "music_error", "duration_too_short"]
    bad = ("ok", 0.5, 0.9, -60.0, 1.0, 0.5, 0.1)
    assert reasons_of(spark, 31.0, 16000, bad, ("ok", 0.5), ("ok", True)) == ["duration_too_long", "clipping", "silence", "rms_out_of_range", "low_snr", "dc_offset", "overlap", "music"]
    assert reasons_of(spark, q=("ok", None, None, None, None, None, None)) == ["snr_missing"]
    assert reasons_of(spark, NAN, q=("ok", NAN, NAN, NAN, NAN, NAN, NAN), o=("ok", NAN)) == []


def test_text_and_language_gates(spark):
    df = spark.createDataFrame([(None, 5.0, "uz"), ("!!!", 5.0, "ru"), ("salom", 0.1, None), ("salom dunyo", 30.0, "en"), ("salom dunyo", 2.0, "uz"), ("x", None, "uz"), ("x", 0.0, "uz")], "t string, d double, l string")
    got = [r[0] for r in df.select(gates.all_reasons(gates.text_reasons(F.col("t"), normalize_text(F.col("t")), F.col("d")), gates.language_reason(F.col("l"), ("uz", "ru")))).collect()]
    assert got == [["missing_text"], ["empty_text"], ["text_too_dense", "language"], ["text_too_sparse", "language"], [], [], []]
    hist = {r.reason: r.n for r in gates.histogram(spark.createDataFrame([(["a", "b"],), (["a"],), ([],)], "reject_reasons array<string>")).collect()}
    assert hist == {"a": 2, "b": 1}


def greedy(clips, budget):
    kept, acc = set(), 0
    for a, _, s, d in sorted(clips, key=lambda c: (-c[2], c[0])):
        ms = round((d or 0.0) * 1000)
        if not kept or acc + ms <= budget:
            kept.add(a)
            acc += ms
    return kept


@pytest.mark.parametrize("seed", range(4))
def test_budget_is_greedy_with_skips(spark, seed, monkeypatch):
    monkeypatch.setattr(selection, "CHUNK", 7)
    rng = random.Random(seed)
    clips = [(f"c{i:03d}", f"s{i % 5}", rng.choice([0.5, 0.7, rng.random()]), rng.choice([None, round(rng.uniform(3, 30), 1)])) for i in range(120)]
    df = spark.createDataFrame(clips, "audio_id string, source_audio_id string, selection_score double, duration double")
    for hours in (0.001, 0.1, 0.3, 2.0):
        got = {r.audio_id for r in selection.mark_budget(df, hours).where("in_budget").collect()}
        assert got == greedy(clips, round(hours * 3_600_000))
    assert selection.mark_budget(df.limit(0), 1.0).count() == 0


def test_source_cap(spark):
    clips = [(f"c{i}", None if i % 3 == 0 else "s", [0.5, 0.9][i % 2]) for i in range(20)]
    df = spark.createDataFrame(clips, "audio_id string, source_audio_id string, selection_score double")
    for cap in (0, 1, 4, 50):
        got = {r.audio_id for r in selection.mark_source_cap(df, cap).where("place is not null").collect()}
        want = {a for s in (None, "s") for a, _, _ in sorted([c for c in clips if c[1] == s], key=lambda c: (-c[2], c[0]))[:cap]}
        assert got == want


def test_scores_that_are_no_numbers_come_last(spark):
    """NaN and null lose the cap and the budget to any number, and a NaN feature adds nothing to a score."""
    clips = [("a", "s", NAN, 10.0), ("b", "s", None, 10.0), ("c", "s", -1.0, 10.0), ("d", "s", 0.5, 10.0)]
    df = spark.createDataFrame(clips, "audio_id string, source_audio_id string, selection_score double, duration double")
    assert {r.audio_id: r.place for r in selection.mark_source_cap(df, 2).collect()} == {"a": None, "b": None, "c": 2, "d": 1}
    assert {r.audio_id for r in selection.mark_budget(df, 20 / 3600).where("in_budget").collect()} == {"c", "d"}
    q = [("ok", 0.0, 0.1, -20.0, snr, 0.0, score) for snr, score in ((20.0, NAN), (NAN, 0.9), (30.0, 0.9), (None, None))]
    rows = spark.createDataFrame([(i, x, ("ok", NAN)) for i, x in enumerate(q)], f"i int, q {Q}, o {O}")
    got = [r.s for r in rows.select("i", features.selection_score(F.col("q"), F.col("o")).alias("s")).orderBy("i").collect()]
    assert got == [0.066667, 0.9, 1.0, 0.0]


def test_repeated_rows_of_a_clip_count_each(spark):
    rows = [("a", "s", 0.5, 10.0, t) for t in (3, 1, 2)] + [("b", "s", 0.4, 10.0, 1)]
    df = spark.createDataFrame(rows, "audio_id string, source_audio_id string, selection_score double, duration double, t int")
    got = {(r.audio_id, r.t): r.place for r in selection.mark_source_cap(df, 2, ties=("t",)).collect()}
    assert got == {("a", 1): 1, ("a", 2): 2, ("a", 3): None, ("b", 1): None}
    assert {(r.audio_id, r.t) for r in selection.mark_budget(df, 20 / 3600, ties=("t",)).where("in_budget").collect()} == {("a", 1), ("a", 2)}


def test_last_wins_and_shards(spark):
    a = spark.createDataFrame([(1, "x", "ok"), (2, "x", "ok"), (3, None, "ok")], "line_number int, audio_id string, status string")
    b = spark.createDataFrame([(1, "x", "error"), (2, "y", "ok")], "line_number int, audio_id string, status string")
    got = {r.audio_id: (r.status, r.line_number) for r in features.last_wins(features.read_shards([a, b]), ["file_ord", "line_number"], ["status", "line_number"]).collect()}
    assert got == {"x": ("error", 1), "y": ("ok", 2)}


def test_groups_stay_together_and_ratios_hold(spark):
    rows = [(f"a{i}", f"spk{i // 4}", "d", "uz", 1.0) for i in range(400)]
    df = spark.createDataFrame(rows, "audio_id string, speaker string, dataset string, language string, duration double")
    out = split.assign_splits(df, SplitRatios(), "speaker", ["language"], "x")
    assert out.groupBy("speaker").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    counts = {r.split: r.n for r in split.split_counts(out).collect()}
    assert counts == {"train": 320, "val": 40, "test": 40}
    assert {r.split: r.n for r in split.split_counts(out.where("split = 'val'")).collect()} == {"train": 0, "val": 40, "test": 0}


def test_shard_limit(spark):
    df = spark.range(1, 21).withColumnRenamed("id", "line_number")
    assert [r[0] for r in sharding.shard(df, 1, 3, 2).collect()] == [2, 5]
    for bad in ((3, 3, None), (0, 0, None), (0, 1, 0)):
        with pytest.raises(ValueError):
            sharding.shard(df, *bad)


def test_shard_totals(spark):
    df = spark.range(1, 21).withColumnRenamed("id", "line_number")

    def by_hand(index, count, limit):
        seen = done = skipped = 0
        for n in range(1, 21):
            if limit and done >= limit and (n - 1) % count == index:
                break
            seen += 1
            if (n - 1) % count == index:
                done += 1
            else:
                skipped += 1
        return seen, done, skipped

    for args in ((0, 3, 2), (2, 3, 2), (1, 3, None), (1, 3, 50), (0, 1, 20)):
        assert tuple(sharding.shard_totals(df, *args).first()) == by_hand(*args)


def test_manifest_lines_and_errors(spark, tmp_path):
    path = tmp_path / "m.jsonl"
    path.write_text('{"audio_id":"a","duration":"4.5","extra":[1]}\n\n  \n{"audio_id":"ў","duration":"x"}\n' + "".join(f'{{"audio_id":"n{i}"}}\n' for i in range(3000)), encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows = manifest.read_manifest(spark, str(path), "audio_id string, duration double").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    by = {r.audio_id: (r.line_number, r.duration) for r in rows}
    assert by["a"] == (1, 4.5) and by["ў"] == (4, None) and by["n0"] == (5, None) and by["n2999"] == (3004, None)
    for bad in ("[1]", "{bad"):
        path.write_text(f'{{"audio_id":"a"}}\n{bad}\n')
        with pytest.raises(Exception, match="line 2"):
            manifest.read_manifest(spark, str(path), "audio_id string").collect()
    assert manifest.write_jsonl(spark.createDataFrame([("a", None)], "x string, y double"), str(tmp_path / "out")) == 1
    assert '"y":null' in "".join(p.read_text() for p in (tmp_path / "out").glob("part*"))
    manifest.write_json(str(tmp_path / "r.json"), {"ў": 1})
    assert json.loads((tmp_path / "r.json").read_text(encoding="utf-8")) == {"ў": 1} and not list(tmp_path.glob("*.tmp"))


@pytest.fixture
def corpus(tmp_path):
    rate = 16_000
    tone = (0.3 * np.sin(np.arange(rate * 4) / 20)).astype(np.float32)
    wave = np.concatenate([np.zeros(rate), tone, np.zeros(2 * rate), tone, np.zeros(rate)]).astype(np.float32).reshape(-1, 1)
    audio.write_wav(str(tmp_path / "audio/a.wav"), wave, rate)
    lines = [{"audio_id": "a", "audio_path": "audio/a.wav", "duration": 12.0, "dataset": "d", "language": "uz", "split": None},
             {"audio_id": "gone", "audio_path": "audio/none.wav", "duration": 1.0, "dataset": "d", "language": "uz", "split": None}]
    (tmp_path / "m.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\n")
    return tmp_path


def test_stages_end_to_end(spark, corpus):
    rows = manifest.read_manifest(spark, str(corpus / "m.jsonl"), "audio_id string, audio_path string, duration double, dataset string, language string, split string")
    run = pipelines.Run(str(corpus / "m.jsonl"), "r1")
    segments, summary = pipelines.run_vad(rows, run, EnergySpeech())
    assert [(s.segment_id, s.vad_duration) for s in segments.orderBy("segment_id").collect()] == [("a_vad_00000_00", 4.6), ("a_vad_00001_00", 4.6)]
    by = {s.audio_id: s for s in summary.collect()}
    assert (by["a"].dataset, by["a"].metadata_duration, by["gone"].dataset) == ("d", 12.0, None)
    assert by["a"].num_vad_segments == 2 and by["a"].vad_kept_duration == 9.2 and by["gone"].error_type == "FileNotFoundError"
    clips = pipelines.materialize(segments, str(corpus / "clips")).collect()
    assert {c.outcome for c in clips} == {"written"} and all(abs(c.duration - 4.6) < 1e-6 for c in clips)
    assert {c.outcome for c in pipelines.materialize(segments, str(corpus / "clips")).collect()} == {"kept"}
    again = pipelines.materialize(segments, str(corpus / "clips"), Materialize("wav", "PCM_24", True)).collect()
    assert {c.outcome for c in again} == {"written"} and sorted(p.name for p in (corpus / "clips/audio").iterdir()) == ["a_vad_00000_00.wav", "a_vad_00001_00.wav"]
    lost = segments.withColumn("source_audio_path", F.lit("/nowhere/x.wav"))
    assert {c.outcome for c in pipelines.materialize(lost, str(corpus / "clips")).collect()} == {"error"}
    quality = pipelines.run_audio_quality(rows, run).collect()
    assert {(r.audio_id, r.status) for r in quality} == {("a", "ok"), ("gone", "error")} and quality[0].sample_rate == 16000
    music = {r.audio_id: r for r in pipelines.run_music(rows, run, FlatnessMusic()).collect()}
    assert music["a"].num_windows == 2 and music["a"].is_music and len(music["a"].top_labels) == 3
    over = {r.audio_id: r for r in pipelines.run_overlap(rows, run, NoOverlap()).collect()}
    assert over["a"].overlap_ratio == 0.0 and over["gone"].status == "error"
    with pytest.raises(Exception):
        pipelines.run_audio_quality(rows, pipelines.Run(str(corpus / "m.jsonl"), "r1", fail_fast=True)).collect()


def test_command_line(spark, corpus, capsys):
    """Each stage reads what the one before wrote."""
    lines = [
        {"audio_id": "a", "audio_path": "audio/a.wav", "duration": 12.0, "sample_rate": 16000, "dataset": "d", "language": "uz", "split": None, "text": "salom dunyo " * 5, "speaker_id": "s", "own": {"x": [1, "ў"]}},
        {"audio_id": "gone", "audio_path": "audio/none.wav", "duration": 1.0, "sample_rate": 16000, "dataset": "d", "language": "uz"}]
    (corpus / "m.jsonl").write_text("\n".join(json.dumps(x, ensure_ascii=False) for x in lines) + "\n", encoding="utf-8")
    m, out = str(corpus / "m.jsonl"), str(corpus / "out")
    q = cli.main(["quality", "--input-manifest", m, "--output-features", f"{out}/q", "--output-metadata", f"{out}/q.json", "--frame-ms", "20"])
    assert (q["num_rows"], q["num_errors"], q["num_input_rows"], q["audio_quality_config"]["frame_ms"]) == (2, 1, 2, 20.0)
    assert json.loads((corpus / "out/q.json").read_text())["quality_run_id"] == q["quality_run_id"]
    o = cli.main(["overlap", "--input-manifest", m, "--output-features", f"{out}/o", "--device", "cpu"])
    assert o["corpus_overlap_ratio"] == 0.0 and o["versions"]["pyspark"]
    k = cli.main(["music", "--input-manifest", m, "--output-features", f"{out}/m", "--music-threshold", "0.9", "--top-k-labels", "1", "--num-shards", "2"])
    assert (k["num_rows"], k["num_skipped_shard_rows"], k["num_music"]) == (1, 1, 1)
    v = cli.main(["vad", "--input-manifest", m, "--output-segments", f"{out}/v", "--output-summary", f"{out}/vs", "--min-segment-duration", "1.0"])
    assert v["num_segments"] == 2 and v["num_errors"] == 1 and v["real_time_factor"] > 0
    c = cli.main(["materialize", "--segments", f"{out}/v", "--output-dir", f"{out}/c", "--format", "wav", "--subtype", "PCM_16"])
    assert (c["num_written_segments"], c["num_errors"]) == (2, 0) and (corpus / "out/c/audio/a_vad_00000_00.wav").exists()
    with pytest.raises(SystemExit):
        cli.main(["materialize", "--format", "mp3"])
    features_of = ["--quality-features", f"{out}/q", "--overlap-features", f"{out}/o"]
    open_gates = ["--min-snr-db", "-99", "--max-silence-ratio", "1", "--max-rms-dbfs", "0"]
    s = cli.main(["select", "--input-manifest", m, *features_of, *open_gates, "--output-selected", f"{out}/s", "--output-rejected", f"{out}/r", "--output-metadata", f"{out}/s.json", "--target-hours", "1"])
    assert (s["num_selected"], s["num_rejected"], s["selected_by_language"], s["config"]["target_hours"]) == (1, 1, {"uz": 1}, 1.0)
    assert s["reject_histogram"] == {"quality_error": 1, "overlap_error": 1, "duration_too_short": 1}
    written = json.loads("".join(p.read_text(encoding="utf-8") for p in (corpus / "out/s").glob("part*")))
    assert written["own"] == {"x": [1, "ў"]} and written["selection_run_id"] == s["selection_run_id"] and written["selection_score"] > 0
    strict = cli.main(["select", "--input-manifest", m, *features_of, "--music-features", f"{out}/m", *open_gates, "--output-selected", f"{out}/s2"])
    assert strict["num_selected"] == 0 and strict["reject_histogram"]["music"] == 1 and strict["reject_histogram"]["missing_music"] == 1
    kept = cli.main(["select", "--input-manifest", m, *features_of, "--music-features", f"{out}/m", *open_gates, "--keep-music", "--languages", "uz", "--output-selected", f"{out}/s3"])
    assert kept["num_selected"] == 1
    d = cli.main(["split", "--input-manifest", m, *features_of, *open_gates, "--output-dir", f"{out}/l", "--min-chars-per-second", "2", "--stratify-keys", "dataset"])
    assert sum(d["split_counts"].values()) == 1 and d["reject_histogram"]["missing_text"] == 1 and d["config"]["salt"] == "labeled_split_v1"
    part = next(k for k, n in d["split_counts"].items() if n)
    row = json.loads("".join(p.read_text(encoding="utf-8") for p in (corpus / f"out/l/splits/__part={part}").glob("part*")))
    assert row["split"] == part and row["split_run_id"] == d["split_run_id"] and row["own"] == {"x": [1, "ў"]}
    assert (corpus / "out/l/split_metadata.json").exists()
    with pytest.raises(ValueError):
        cli.main(["split", "--input-manifest", m, *features_of, "--output-dir", f"{out}/l", "--train-ratio", "0.9"])


def test_many_files_are_one_scan_in_order(spark, tmp_path):
    for i, name in enumerate(["b c", "a+ў", "z"]):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-0.jsonl").write_text(f'\n{{"audio_id":"x{i}"}}\n', encoding="utf-8")
    (tmp_path / "one.jsonl").write_text('{"audio_id":"one"}\n')
    paths = [str(tmp_path / "z"), str(tmp_path / "one.jsonl"), str(tmp_path / "b*"), f"file://{tmp_path}/a+ў"]
    got = {r.audio_id: (r.file_ord, r.line_number) for r in manifest.read_manifest(spark, paths, "audio_id string").collect()}
    assert got == {"x2": (0, 2), "one": (1, 1), "x0": (2, 2), "x1": (3, 2)}


def test_scorers_travel_by_their_recipe():
    import pickle

    from sonorant import config, scorers

    made = pickle.loads(pickle.dumps(scorers.Lazy(list, "x", labels=["a"])))
    assert made.name == "x" and made.labels == ["a"] and made.made() == [] and made.made() is made.made()
    assert pickle.loads(pickle.dumps(made)).__dict__.keys() == {"_build", "name", "labels"}
    detector = scorers.speech_detector("energy", config.Vad(min_speech_duration_ms=100), "cpu")
    assert isinstance(detector, EnergySpeech) and detector.min_speech == 100
    assert isinstance(scorers.overlap_detector("none", config.Overlap()), NoOverlap) and isinstance(scorers.music_classifier("flatness", config.Music()), FlatnessMusic)
    assert scorers.overlap_detector("pyannote", config.Overlap()).name == "pyannote/overlapped-speech-detection"
    assert scorers.music_classifier("ast", config.Music()).name.startswith("MIT/")


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"audio_id":"a","duration":5.0,"sample_rate":16000,"text":"salom dunyo va hamma","at":"2024-01-01T00:10:00"}\n{"audio_id":"b","duration":0.1,"sample_rate":8000,"at":"2024-01-01T00:20:00"}\n')
    judged = judged_stream(spark, str(tmp_path / "in"), "audio_id string, duration double, sample_rate int, text string, at timestamp")
    q = reason_counts(judged, "at").writeStream.outputMode("complete").format("memory").queryName("reasons").start()
    q.processAllAvailable()
    q.stop()
    got = {r.reason: r.n for r in spark.table("reasons").collect()}
    assert got == {"duration_too_short": 1, "sample_rate_mismatch": 1, "missing_text": 1}


def test_totals(spark):
    df = spark.createDataFrame([("ok", 2.0, 0.5), ("ok", NAN, NAN), ("error", None, None)], "status string, duration double, s double")
    assert tuple(report.run_totals(df, "s").first()) == (3, 2, 1, 2.0, 0.5)
    assert report.run_totals(df.limit(0), "s").first().mean_score is None
    assert report.real_time_factor(1.0, 0.0) is None


def test_selection_marks_every_row_once(spark):
    rows = [(f"c{i:02d}", f"s{i % 2}", 10.0, 16000, "uz", "d") for i in range(20)]
    df = spark.createDataFrame(rows, "audio_id string, source_audio_id string, duration double, sample_rate int, language string, dataset string")
    q = spark.createDataFrame([(f"c{i:02d}", *GOOD) for i in range(18)], "audio_id string, " + Q[7:-1].replace(":", " ").replace(",", ", "))
    out = pipelines.run_ssl_selection(df, q, None, config=Selection(QualityGates(3, 30, require_overlap=False, require_music=False), None, 5, 60 / 3600))
    got = {r.stage: r["count"] for r in out.groupBy("stage").count().collect()}
    assert got == {"gates": 2, "source_cap": 8, "budget": 4, "selected": 6}


def test_top_labels_rank_every_label(spark, tmp_path):
    low = [float(i) / 100 - 3 for i in range(64)]
    rows = [(1, "a", [*low[:8], *low[8:60], 2.0, 0.5, 1.0, 0.0]), (2, "b", [3.0, *low[1:]]), (3, "b", [1.0, *low[1:]])]
    spark.createDataFrame(rows, "vec_id bigint, label string, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {(r.clip, r.place): r.label_idx for r in registry.music_top_labels(spark, str(tmp_path)).collect()}
    assert got == {("a", 1): 60, ("a", 2): 62, ("a", 3): 61, ("b", 1): 0, ("b", 2): 63, ("b", 3): 62}


LINES = "line_number bigint, audio_id string, text string, duration double, sample_rate int, language string, dataset string, split string, speaker_id string"


def write_labeled(spark, path, texts, quality=(), overlap=(), windows=()):
    rows = [(n, f"c{n}", t, 5.0, 16000, "uz", "d", None, "s") for n, t in enumerate(texts, 1)]
    spark.createDataFrame(rows, LINES).write.parquet(str(path / "labeled_manifest.parquet"))
    numbered = spark.createDataFrame(list(quality), "audio_id string, computed_at timestamp, " + Q[7:-1].replace(":", " ")).withColumn("source_line_number", F.substring("audio_id", 2, 9).cast("bigint"))
    numbered.write.parquet(str(path / "quality_features.parquet"))
    spark.createDataFrame(list(windows), "l_orderkey bigint, l_discount double").write.parquet(str(path / "lineitem.parquet"))
    spark.createDataFrame(list(overlap), "audio_id string, computed_at timestamp, " + O[7:-1].replace(":", " ")).write.parquet(str(path / "overlap_features.parquet"))


def test_gates_see_texts_under_nfkc(spark, tmp_path):
    """Lengths change both ways: one letter becomes many, a letter and its mark become one."""
    write_labeled(spark, tmp_path, ["\ufdfa\ufdfa", "e\u0301" * 100, "\u33c2" * 70, "salom dunyo va hamma"])
    got = {r.line_number: r.reasons for r in registry.text_gate_reasons(spark, str(tmp_path)).collect()}
    assert got == {1: "", 2: "", 3: "text_too_dense", 4: ""}
    assert sum(r.n for r in registry.labeled_split_counts(spark, str(tmp_path)).collect()) == 3


def test_labeled_split_counts_see_the_last_features(spark, tmp_path):
    """Clip 1 clips in its last row, clip 2 only in an earlier one, 3 overlaps; 4 has failed features and 5 none."""
    old, new = datetime(2024, 1, 1), datetime(2024, 1, 2)
    bad = ("ok", 0.5, *GOOD[2:])
    quality = [("c1", old, *GOOD), ("c1", new, *bad), ("c2", old, *bad), ("c2", new, *GOOD), ("c3", new, *GOOD), ("c4", new, "error", *[None] * 6)]
    write_labeled(spark, tmp_path, ["salom dunyo va hamma"] * 5, quality, [("c3", new, "ok", 0.9), ("c2", new, "ok", 0.0)])
    assert sum(r.n for r in registry.labeled_split_counts(spark, str(tmp_path)).collect()) == 3


def test_all_gates_of_labeled_rows(spark, tmp_path):
    """Clip 1 passes all but the text, 2 is music, 3 has no music row, 20 a failed one; the rest have nothing."""
    at = datetime(2024, 1, 1)
    good = [f"c{i}" for i in (1, 2, 3, 20)]
    write_labeled(spark, tmp_path, ["!!!", *["salom dunyo va hamma"] * 19], [(c, at, *GOOD) for c in good], [(c, at, "ok", 0.0) for c in good], [(1, 0.0), (2, 0.1), (2, 0.0), (20, 0.0)])
    got = {r.line_number: r.reasons for r in registry.labeled_gate_reasons(spark, str(tmp_path)).collect()}
    assert (got[1], got[2], got[3], got[20]) == ("empty_text", "music", "missing_music", "music_error")
    assert got[4] == "missing_quality,missing_overlap,missing_music"


def test_fixed_values_of_texts_are_pinned():
    """The SQL is made from the same constants, so they are written out here."""
    assert text.MAPPED == "\xa0\u02bb\u02bc\u2019\u2018`\xb4\u02b9\u201c\u201d\u201e\xab\xbb\u2013\u2014\u2212"
    assert text.REPLACED == " '''''''" + '"""""' + "---"
    assert text.BRACKETED == r"\[[^\]]*\]|\([^)]*\)|\{[^}]*\}"
    assert text.WORD == "0-9A-Za-z\u0410-\u042f\u0430-\u044f\u0401\u0451\u040e\u045e\u049a\u049b\u0492\u0493\u04b2\u04b3"


@pytest.mark.parametrize("name", sorted(set(registry.queries()) & set(registry.oracle_sql())))
def test_queries_equal_their_sql(spark, name):
    from verify import canonical

    d = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.execute("SET TimeZone='UTC'")
    for t in ("documents", "embeddings", "labeled_manifest", "raw_unlabeled", "ssl_candidates", "quality_features", "overlap_features", "lineitem", "orders", "nation"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    df = entry.queries()[name](spark, d)
    relation = db.sql(entry.oracle_sql()[name])
    assert canonical([tuple(r) for r in df.collect()], df.columns, "Spark") == canonical(relation.fetchall(), list(relation.columns), "SQL")
