"""Scalar functions and kernels against pinned values."""

import hashlib
import math
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonorant.config import AudioQuality, LabeledSplit, Music, Overlap, Selection, SplitRatios, TextNormalization, Vad
from sonorant.functions import hashing, intervals, signal, text
from sonorant.operators import music, sharding
from sonorant.plans.pipelines import windows_of
from sonorant.scorers import EnergySpeech, FlatnessMusic, device
from sonorant.sources import audio

TEXTS = [
    ("'Salom', dedi u.", "salom dedi u"), ("Oʻzbek tili", "o'zbek tili"), ("2024-yil yaxshi yil", "2024 yil yaxshi yil"), ("a''b", "a b"),
    ("l'été d'un", "l été d'un"), ("x (a (b) c) y", "x c y"), ("[a} b]c", "c"), ("ﬁ ① ½", "fi 1 1⁄2"), ("-a_b-", "a b"), ("", ""), ("!!!", ""), ("a'", "a"),
    ("a\xa0\x1f b", "a b"), (None, None), ("Ўзбек — тили…", "ўзбек тили"),
]


def test_normalized_text(spark):
    df = spark.createDataFrame([(t,) for t, _ in TEXTS], "t string")
    assert [r[0] for r in df.select(text.normalize_text(F.col("t"))).collect()] == [w for _, w in TEXTS]
    bare = TextNormalization(keep_word_apostrophe=False, remove_numbers=True)
    one = spark.createDataFrame([("g'oya 12",)], "t string")
    assert one.select(text.normalize_text(F.col("t"), bare)).first()[0] == "g oya"


def test_hash_and_run_ids(spark):
    df = spark.createDataFrame([("a",), (None,), ("ў",)], "v string")
    got = [r[0] for r in df.select(hashing.unit_hash(F.col("v"), "s")).collect()]
    want = [int.from_bytes(hashlib.sha256(f"s|{v}".encode()).digest()[:8], "big") / 2**64 for v in ("a", "None", "ў")]
    assert got == want
    a = hashing.stage_run_id("vad", "m.jsonl", Vad(), 0, 1, None)
    assert a == hashing.stage_run_id("vad", "m.jsonl", Vad(), 0, 1, None) != hashing.stage_run_id("vad", "m.jsonl", Vad(), 1, 2, None)
    assert a.startswith("vad_") and len(a) == 20


def test_run_ids_are_hashes_over_the_stages_own_settings():
    """The settings' names and defaults are an interface: the hashed text is written out here."""

    def want(prefix, text):
        return f"{prefix}_{hashlib.sha256(text.encode()).hexdigest()[:16]}"

    vad = ('{"max_segment_duration":30.0,"max_threads":1,"min_segment_duration":1.5,"min_silence_duration_ms":1000,"min_speech_duration_ms":250,'
           '"speech_pad_ms":300,"target_sample_rate":16000,"threshold":0.5}')
    assert hashing.stage_run_id("vad", "m.jsonl", Vad(), 2, 5, None) == want("vad", f"m.jsonl|{vad}|2|5|None")
    over = '{"max_threads":1,"min_overlap_duration":0.1,"model_name":"pyannote/overlapped-speech-detection"}'
    assert hashing.stage_run_id("overlap", "m.jsonl", Overlap(), 0, 1, 7) == want("overlap", f"m.jsonl|{over}|0|1|7")
    music = ('{"batch_size":8,"max_threads":1,"model_name":"MIT/ast-finetuned-audioset-10-10-0.4593","music_label":"Music","music_threshold":0.5,'
             '"target_sample_rate":16000,"top_k_labels":5,"window_seconds":10.0}')
    assert hashing.stage_run_id("music", "m.jsonl", Music()) == want("music", f"m.jsonl|{music}|0|1|None")
    gates = ('"gates":{"drop_music":true,"max_clipping_ratio":0.005,"max_dc_offset":0.01,"max_duration":30.0,"max_overlap_ratio":%s,"max_rms_dbfs":-8.0,'
             '"max_silence_ratio":%s,"min_duration":%s,"min_rms_dbfs":-40.0,"min_snr_db":%s,"require_music":true,"require_overlap":true,"require_quality":true,'
             '"require_sample_rate_match":true,"target_sample_rate":16000}')
    ssl = '{"allowed_languages":null,' + gates % (0.15, 0.5, 3.0, 8.0) + ',"max_clips_per_source":null,"target_hours":null}'
    assert hashing.run_id("ssl", "m.jsonl", Selection()) == want("ssl", f"m.jsonl|{ssl}|")
    labeled = ('{"allowed_languages":null,' + gates % (0.2, 0.6, 0.8, 5.0) + ',"group_key":"audio_id","max_chars_per_second":25.0,"min_chars_per_second":3.0,'
               '"ratios":{"test":0.1,"train":0.8,"val":0.1},"require_text":true,"salt":"labeled_split_v1","stratify_keys":["dataset","language"]}')
    assert hashing.run_id("split", "m.jsonl", LabeledSplit()) == want("split", f"m.jsonl|{labeled}|")


def test_sine_and_clipping():
    t = np.arange(16_000) / 16_000
    sine = (0.1 * np.sin(2 * np.pi * 440 * t)).astype(np.float32).reshape(-1, 1)
    m = signal.metrics(sine, 16_000)
    assert m["peak_dbfs"] == -20.0 and m["duration"] == 1.0 and abs(m["zero_crossing_rate"] - 880) <= 2
    full = signal.metrics(np.ones((100, 1), np.float32), 100)
    assert full["clipping_ratio"] == 1.0
    silent = signal.metrics(np.zeros((1600, 2), np.float32), 16_000)
    assert silent["rms_dbfs"] == -240.0 and silent["snr_estimate_db"] is None and silent["channels"] == 2
    nothing = signal.metrics(np.zeros((0, 1), np.float32), 16_000)
    assert nothing["rms_dbfs"] == -240.0 and math.isnan(nothing["noise_floor_dbfs"]) and nothing["snr_estimate_db"] is None
    assert signal.crossings_per_second(np.array([0.0, -0.0, 0.0], np.float32), 3) == 2.0


def test_frames_match_direct_sums():
    rng = np.random.default_rng(1)
    wave = rng.normal(size=1000).astype(np.float32)
    got = signal.frame_rms(wave, 44_100, 25.0, 10.0)
    assert len(got) == 1  # 1102 samples a frame, half to even
    got = signal.frame_rms(wave, 1000, 25.0, 10.0)
    want = [np.sqrt(np.mean(wave[s : s + 25].astype(np.float64) ** 2)) for s in range(0, 976, 10)]
    assert np.allclose(got, want)


def test_metrics_in_arrow_batches(spark):
    df = spark.createDataFrame([(1, [0.1, -0.2, 0.3, -0.1]), (2, None), (3, []), (4, [1.0] * 100)], "id int, s array<float>")
    got = {r.id: r.m for r in df.select("id", signal.metrics_of(F.col("s"), F.lit(4)).alias("m")).collect()}
    assert got[1].num_samples == 4 and got[1].zero_crossing_rate == 3.0
    assert got[2].rms_dbfs is None and got[2].num_samples is None and got[2].quality_score is None
    assert got[4].clipping_ratio == 1.0 and got[4].quality_score < 0.7
    two = spark.createDataFrame([([0.5, -0.5, 0.5, 0.5],)], "s array<float>")
    both = two.select(signal.metrics_of(F.col("s"), F.lit(4), F.lit(2)).alias("m")).first().m
    assert (both.channels, both.num_samples, both.dc_offset_mean_abs, both.dc_offset_max_abs) == (2, 2, 0.25, 0.5)
    assert got[3].num_samples == 0 and math.isnan(got[3].noise_floor_dbfs) and got[3].snr_estimate_db is None


def test_score_column_equals_kernel(spark):
    rng = np.random.default_rng(2)
    data = [(float(a), float(b), float(c), None if i % 5 == 0 else float(d)) for i, (a, b, c, d) in enumerate(zip(rng.uniform(-70, 0, 50), rng.uniform(0, 0.05, 50), rng.uniform(0, 1, 50), rng.uniform(-5, 30, 50)))]
    df = spark.createDataFrame(data, "rms double, clip double, silence double, snr double")
    got = [r[0] for r in df.select(signal.quality_score(F.col("rms"), F.col("clip"), F.col("silence"), F.col("snr"))).collect()]
    c = AudioQuality()
    for (rms, clip, silence, snr), x in zip(data, got):
        score = 1 - (min((c.target_min_dbfs - rms) / 30, 0.4) if rms < c.target_min_dbfs else 0) - (min((rms - c.target_max_dbfs) / 20, 0.4) if rms > c.target_max_dbfs else 0)
        score -= min(clip * 20, 0.4) + min(max(silence - 0.4, 0), 0.4) + (min((10 - snr) / 30, 0.3) if snr is not None and snr < 10 else 0)
        assert abs(x - max(min(score, 1), 0)) < 2e-6


def test_intervals(spark):
    df = spark.createDataFrame([(0.0, 65.0), (10.0, 12.0), (5.0, 5.0), (0.0, 60.0)], "s double, e double")
    got = [[(p.part, p.start, p.end) for p in r[0]] for r in df.select(intervals.split_long(F.col("s"), F.col("e"), 30.0)).collect()]
    assert got == [[(0, 0.0, 30.0), (1, 30.0, 60.0), (2, 60.0, 65.0)], [(0, 10.0, 12.0)], [], [(0, 0.0, 30.0), (1, 30.0, 60.0)]]
    with pytest.raises(ValueError):
        intervals.split_long(F.lit(0.0), F.lit(1.0), 0)
    s = spark.createDataFrame([([(0.1, 0.4), (1.0, 1.05), (3.0, 2.0)],)], "x array<struct<start:double,end:double>>")
    kept = s.select(intervals.at_least(intervals.rounded(F.col("x")), 0.1)).first()[0]
    assert [(k.start, k.end, k.duration) for k in kept] == [(0.1, 0.4, 0.3)]
    a = spark.createDataFrame([([float(i) for i in range(10)],)], "a array<float>")
    cut = lambda x, y: a.select(intervals.sample_slice(F.col("a"), F.lit(10), F.lit(x), F.lit(y))).first()[0]
    assert cut(0.2, 0.5) == [2.0, 3.0, 4.0] and cut(0.5, 0.2) == [] and cut(0.9, 5.0) == [9.0] and cut(-1.0, 0.1) == [0.0]
    w = spark.createDataFrame([([float(i) for i in range(25)],)], "a array<float>").select(intervals.windows(F.col("a"), 10)).first()[0]
    assert [len(x) for x in w] == [10, 10, 10] and w[2][5:] == [0.0] * 5
    assert windows_of(np.arange(25, dtype=np.float32), 10).shape == (3, 10)


def test_segment_names(spark):
    one = spark.createDataFrame([("unlabeled_001", 3, 1, 10.1234, 12.9876)], "a string, v int, p int, s double, e double")
    r = one.select(sharding.segment_id(F.col("a"), F.col("v"), F.col("p")), F.round("s", 3), F.round("e", 3), F.round(F.col("e") - F.col("s"), 3)).first()
    assert tuple(r) == ("unlabeled_001_vad_00003_01", 10.123, 12.988, 2.864)


@pytest.mark.parametrize("rate,target", [(44_100, 16_000), (8_000, 16_000), (48_000, 16_000), (22_050, 16_000)])
def test_resampling_keeps_low_tones_and_drops_high_ones(rate, target):
    t, u = np.arange(rate) / rate, np.arange(target) / target
    got = audio.resample(np.sin(2 * np.pi * 440 * t), rate, target)
    assert len(got) == target and np.abs(got - np.sin(2 * np.pi * 440 * u))[200:-200].max() < 1e-3
    if rate > 2.6 * target:
        high = audio.resample(np.sin(2 * np.pi * 11_000 * t), rate, target)
        assert np.abs(high)[200:-200].max() < 1e-3  # would fold to 5 kHz
    assert len(audio.resample(np.zeros(0), rate, target)) == 0 and len(audio.resample(np.ones(3), rate, target)) == round(3 * target / rate)


def test_music_rollup(spark):
    df = spark.createDataFrame([("c", 0.2), ("c", 0.9)], "clip string, p double")
    r = music.clip_rollup(df, "clip", "p", 0.5).first()
    assert (r.music_probability, r.music_ratio, r.is_music, r.num_windows) == (0.9, 0.5, True, 2)
    labels = spark.createDataFrame([("Speech", 0), ("MUSIC", 1)], "label string, index int")
    assert music.label_index(labels, "Music").first()[0] == 1 and music.label_index(labels, "x").count() == 0


def test_wav_and_resampling(tmp_path):
    wave = np.sin(np.arange(800) / 9).astype(np.float32).reshape(-1, 2) * 0.5
    path = str(tmp_path / "a" / "x.wav")
    assert audio.write_wav(path, wave, 8000) and not audio.write_wav(path, wave, 8000) and audio.write_wav(path, wave, 8000, True)
    back, rate = audio.load(path)
    assert rate == 8000 and back.shape == (400, 2) and np.abs(back - wave).max() < 1e-4
    part, _ = audio.load(path, 0.01, 0.0301)
    assert np.array_equal(part, back[80:241]) and len(audio.load(path, 0.02, 0.01)[0]) == 0 and len(audio.load(path, 0.04, 9.0)[0]) == 80
    for subtype, near in (("PCM_U8", 1 / 100), ("PCM_24", 1e-6), ("PCM_32", 1e-6)):
        assert np.abs(audio.decode(audio.encode(wave, 8000, "wav", subtype))[0] - wave).max() < near
    with pytest.raises(ValueError):
        audio.encode(wave, 8000, "mp3")
    assert len(audio.load_mono(path, 16000)) == 800 and audio.load_channels(path)[0].shape == (2, 400)
    with pytest.raises(ValueError):
        audio.decode(b"fLaC....")


def test_scorers():
    rate = 1000
    wave = np.concatenate([np.zeros(2000), 0.5 * np.ones(1000), np.zeros(3000), 0.5 * np.ones(50), np.zeros(500)]).astype(np.float32)
    assert EnergySpeech().detect(wave, rate) == [(1700, 3300)]
    assert EnergySpeech().detect(wave[:5], rate) == []
    assert FlatnessMusic().score(np.zeros((2, 100), np.float32)).shape == (2, 3)
    assert device("cpu") == "cpu"
    with pytest.raises(ValueError):
        device("tpu")


def test_settings_are_checked():
    for bad in (lambda: SplitRatios(0.9, 0.2, 0.1), lambda: Selection(max_clips_per_source=-1), lambda: Vad(max_segment_duration=0)):
        with pytest.raises(ValueError):
            bad()
    assert unicodedata.normalize("NFKC", "ﬁ") == "fi"
