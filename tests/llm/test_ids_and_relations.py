"""Caps, samples, rankings and grouped splits against plain Python."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sonorant.llm.skew import looked_up
from sonorant.llm import ids, p03_leximin, p04_grouped_split, p05_contributor_cap, p07_stable_sample

CANDIDATES = "audio_id string, source_audio_id string, selection_score double, delivered_at timestamp_ntz, source string, salt int"


def candidates(spark, data):
    rows = [(a, s, x, f"2024-01-01 00:00:{t:02d}" if t is not None else None, "clash", 1) for a, s, x, t in data]
    text = CANDIDATES.replace("timestamp_ntz", "string")
    return spark.createDataFrame(rows, text).withColumn("delivered_at", F.col("delivered_at").cast("timestamp_ntz"))


def test_spellings(spark, rows):
    df = spark.createDataFrame(
        [(" Audio/UZVOX_000000012_VAD_00001_00.WAV ",), ("uzradio-000000150-002",), ("callbase_00000007b.20",), ("./Lekto_000003347_utt0007",), ("",), (None,), ("odd",)],
        "a string")
    got = [tuple(r) for r in df.select(ids.clip_key(F.col("a")), ids.recording_key(F.col("a"))).collect()]
    assert got == [
        ("uzvox_000000012_vad_00001_00", "uzvox_000000012"), ("uzradio-000000150-002", "uzradio_000000150"),
        ("callbase_00000007b.20", "callbase_00000007b"), ("lekto_000003347_utt0007", "lekto_000003347"), (None, None), (None, None), ("odd", "odd")]
    labels = spark.createDataFrame([("uz_Latn",), ("O‘zbek",), ("EN-gb",), ("und",), ("",), (None,), (" RU ",)], "l string")
    assert [r[0] for r in labels.select(ids.language_code(F.col("l"))).collect()] == ["uz", "uz", "en", None, None, None, "ru"]
    splits = spark.createDataFrame([(" Train",), ("dev",), ("validation",), ("eval_test",), (None,), ("x",)], "s string")
    assert [r[0] for r in splits.select(ids.split_name(F.col("s"))).collect()] == ["train", "val", "val", "test", None, None]


def cap_by_hand(data, cap):
    last = {}
    for a, s, x, t in data:
        if a is not None:
            x = None if x is None or x != x else x
            key = (t is not None, t or 0, x is not None, x or 0)
            if a not in last or key > last[a][0]:
                last[a] = (key, s, x)
    by = defaultdict(list)
    for a, (_, s, x) in last.items():
        s = (s or "").strip().lower().rsplit("/", 1)[-1].removesuffix(".wav")
        if s:
            by[s].append((x is None, -(x or 0), a))
    return sorted((a,) for v in by.values() for _, _, a in sorted(v)[cap:])


@pytest.mark.parametrize("seed", range(3))
def test_cap_matches_plain_python(spark, rows, seed):
    rng = random.Random(seed)
    data = []
    for i in range(400):
        a = f"c{rng.randrange(250):04d}" if rng.random() > 0.02 else None
        s = rng.choice(["Big", " audio/big.wav", "big", "small", None, "", f"s{rng.randrange(9)}"])
        data.append((a, s, rng.choice([None, float("nan"), 0.5, 0.5, rng.random()]), None))
    # delivered_at decides between rows of a clip; make it unique so the expected row is.
    data = [(a, s, x, i % 60 if i < 60 else None) for i, (a, s, x, _) in enumerate(data)]
    seen, unique = set(), []
    for r in data:
        if r[0] is not None and (r[0], r[3]) in seen:
            continue
        seen.add((r[0], r[3]))
        unique.append(r)
    df = candidates(spark, unique)
    assert rows(p05_contributor_cap.over_cap(df, 5)) == cap_by_hand(unique, 5)
    assert rows(p05_contributor_cap.over_cap(df, 5, salts=1)) == cap_by_hand(unique, 5)
    left = {r[0] for r in rows(p05_contributor_cap.over_cap(df, 5))}
    kept = {r[0] for r in rows(p05_contributor_cap.kept(df, 5))}
    assert not left & kept


def test_cap_of_nothing(spark, rows):
    empty = candidates(spark, [])
    assert rows(p05_contributor_cap.over_cap(empty)) == []
    with pytest.raises(ValueError):
        p05_contributor_cap.over_cap(empty, -1)


@pytest.mark.parametrize("seed", range(2))
def test_share_of_each_source(spark, rows, seed):
    rng = random.Random(seed)
    data = [(f"c{i:04d}", rng.choice(["big", "big", " Audio/BIG.wav", "mid", None, "", f"s{rng.randrange(40)}"]), rng.choice([None, float("nan"), 0.5, rng.random()]), i % 60) for i in range(300)]
    df = candidates(spark, data + data[:50])
    counted = sum(bool(s) for _, s, _, _ in data)
    for share in (0.01, 0.1, 1.0):
        assert rows(p05_contributor_cap.over_share(df, share)) == cap_by_hand(data, max(1, int(share * counted)))
    assert rows(p05_contributor_cap.over_share(df.limit(0))) == []
    with pytest.raises(ValueError):
        p05_contributor_cap.over_share(df, 0)


def test_hot_keys_meet_their_values_where_they_lie(spark):
    data = [("hot", i) for i in range(3000)] + [(f"k{i}", i) for i in range(500)] + [(None, -1), ("gone", -2)]
    df = spark.createDataFrame(data, "k string, i int")
    values = spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(500)]], "k string, m int")
    got = sorted((r.k or "", r.i, r.m) for r in looked_up(df, "k", values, len(data)).collect())
    assert got == sorted((k or "", i, 1 if k == "hot" else i if k and k[0] == "k" else None) for k, i in data)
    assert looked_up(df.limit(0), "k", values, 0).count() == 0


def test_sample_is_stable_and_grows(spark, rows):
    data = [(f"clip_{i:05d}", i) for i in range(2000)] + [(" CLIP_00007.wav", -1), (None, -2), ("", -3)]
    df = spark.createDataFrame(data, "audio_id string, n int")
    first = p07_stable_sample.sample(df, 0.2)
    assert rows(first) == rows(p07_stable_sample.sample(df.repartition(7), 0.2))
    chosen = {r.n for r in first.collect()}
    assert 300 < len(chosen) < 500 and not {-2, -3} & chosen
    assert (7 in chosen) == (-1 in chosen)
    more = df.unionByName(spark.createDataFrame([(f"late_{i}", 5000 + i) for i in range(500)], "audio_id string, n int"))
    assert chosen <= {r.n for r in p07_stable_sample.sample(more, 0.2).collect()}
    assert chosen <= {r.n for r in p07_stable_sample.sample(df, 0.3).collect()}
    assert p07_stable_sample.sample(df, 0.0).count() == 0
    assert p07_stable_sample.sample(df, 1.0).count() == 2001
    assert p07_stable_sample.sample(df.limit(0), 0.5).count() == 0


def leximin_by_hand(data):
    n = [sum(r[i] is not None for r in data) for i in (1, 2, 3)]
    out = []
    for a, *v in data:
        p = []
        for i, x in enumerate(v):
            col = [r[i + 1] for r in data if r[i + 1] is not None]
            worse = sum((y < x if i < 2 else y > x) for y in col) if x is not None else 0
            p.append(0.0 if x is None else (worse + col.count(x) / 2) / n[i])
        out.append((sorted(p), a))
    order = sorted(out, key=lambda x: ([-y for y in x[0]], x[1]))
    return sorted((a, k + 1) for k, (_, a) in enumerate(order))


def test_leximin(spark):
    rng = random.Random(4)
    data = [(f"a{i:03d}", rng.choice([None, round(rng.random(), 2)]), rng.choice([None, 3.0, rng.uniform(-5, 40)]), rng.choice([0.0, 0.0, None, rng.random()])) for i in range(150)]
    df = spark.createDataFrame(data, "audio_id string, quality_score double, snr_estimate_db double, overlap_ratio double")
    got = sorted((r.audio_id, r.place) for r in p03_leximin.leximin_ranking(df, p03_leximin.DIRECTIONS).collect())
    assert got == leximin_by_hand(data)
    assert p03_leximin.leximin_ranking(df.limit(0), p03_leximin.DIRECTIONS).count() == 0


def test_units_are_found(spark):
    quality = [(f"c{i}", "ok", f"run{i % 3}", float(i), (50 + i % 40) / (1 if i % 3 == 1 else 100.0), (10 ** ((10 + i % 40) / 20) if i % 3 == 2 else 10.0 + i % 40)) for i in range(300)]
    quality += [("c0", "error", "run0", 999.0, 0.5, 1.0), ("c1", "ok", "run1", -1.0, 1.0, 1.0), (None, "ok", "run0", 1.0, 1.0, 1.0), ("c3", "ok", "run0", 1000.0, float("nan"), 999.0)]
    q = spark.createDataFrame(quality, "audio_id string, status string, quality_run_id string, computed_at double, quality_score double, snr_estimate_db double")
    overlap = [(f"c{i}", "ok", f"o{i % 2}", 1.0, (i % 5) / (1 if i % 2 else 100.0) * 10) for i in range(300)]
    o = spark.createDataFrame(overlap, "audio_id string, status string, overlap_run_id string, computed_at double, overlap_ratio double")
    got = {r.audio_id: r for r in p03_leximin.usable_scores(q, o).collect()}
    assert len(got) == 300
    for i in (4, 5, 6, 299):
        r = got[f"c{i}"]
        assert abs(r.quality_score - (50 + i % 40) / 100) < 1e-9
        assert abs(r.snr_estimate_db - (10 + i % 40)) < 1e-9
        assert abs(r.overlap_ratio - (i % 5) / 10) < 1e-9
    assert got["c0"].quality_score is None and got["c3"].quality_score is None and got["c3"].snr_estimate_db is None
    ranked = p03_leximin.rank_clips(q, o).collect()
    assert sorted(r.place for r in ranked) == list(range(1, 301)) and {r.audio_id for r in ranked} == set(got)


MANIFEST = "line_number bigint, audio_id string, speaker_id string, split string, dataset string, language string, component string"


def groups_by_hand(data):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a, s, *_ in data:
        for e in ([f"r{a}"] if a else []) + ([f"s{s}"] if s and s != "unknown" else []):
            parent[find(f"l{n}")] = find(e)
    by = defaultdict(list)
    for r in data:
        by[find(f"l{r[0]}")].append(r)
    return list(by.values())


@pytest.mark.parametrize("seed", range(2))
def test_groups(spark, rows, seed):
    rng = random.Random(seed)
    data = [
        (n, f"uzvox_{rng.randrange(60):09d}" if rng.random() > 0.1 else None, rng.choice([None, "unknown", f"spk{rng.randrange(50)}"]),
         rng.choice(["train", "val", "test", None]), rng.choice(["a", None]), "uz", "clash") for n in range(1, 200)]
    hand = groups_by_hand(data)
    df = spark.createDataFrame([(n, f"{a}_vad_00000_0{n % 9}" if a else None, *x) for n, a, *x in data], MANIFEST)
    want = sorted((r[0], min(x[0] for x in g)) for g in hand if len({x[3] for x in g} - {None}) > 1 for r in g)
    assert sorted(rows(p04_grouped_split.straddling(df))) == want
    got = {r.line_number: r.split for r in p04_grouped_split.assign(df).collect()}
    assert len(got) == len(data)
    assert all(len({got[r[0]] for r in g}) == 1 for g in hand)


def test_long_chain_and_hub(spark):
    chain = [(f"n{i:04d}", f"n{i + 1:04d}") for i in range(300)] + [("hub", f"h{i:04d}") for i in range(300)] + [("x", "x"), ("y", "z"), ("z", "y"), ("y", "z")]
    got = {r.node: r.component for r in p04_grouped_split.connected_components(spark.createDataFrame(chain, "a string, b string")).collect()}
    assert {got[f"n{i:04d}"] for i in range(301)} == {"n0000"}
    assert {got[f"h{i:04d}"] for i in range(300)} == {"h0000"} and got["hub"] == "h0000"
    assert got["x"] == "x" and got["z"] == "y"


def test_split_stays_as_data_grow(spark):
    """Without giants, rows that come in new groups move no old one."""
    row = lambda n: (n, f"uzvox_{n // 3:09d}", f"spk{n // 6}", None, "d", "uz", None)
    small = spark.createDataFrame([row(n) for n in range(3000)], MANIFEST)
    large = spark.createDataFrame([row(n) for n in range(9000)], MANIFEST)
    old = {r.line_number: r.split for r in p04_grouped_split.assign(small).collect()}
    new = {r.line_number: r.split for r in p04_grouped_split.assign(large).collect()}
    assert all(new[n] == s for n, s in old.items())
    share = [sum(s == k for s in new.values()) / 9000 for k in ("train", "val", "test")]
    assert abs(share[0] - 0.8) < 0.03 and abs(share[1] - 0.1) < 0.03


def test_proportions_and_giants(spark):
    rng = random.Random(1)
    data = [(n, "uzvox_999999999" if n <= 600 else f"uzvox_{rng.randrange(700):09d}", None, None, "d", "uz", None) for n in range(1, 2001)]
    df = spark.createDataFrame(data, MANIFEST)
    got = p04_grouped_split.assign(df).groupBy("split").count().collect()
    share = {r.split: r["count"] / 2000 for r in got}
    assert abs(share["train"] - 0.8) < 0.02 and abs(share["val"] - 0.1) < 0.02
    quota = {r.split: r["count"] / 2000 for r in p04_grouped_split.assign_by_quota(df).groupBy("split").count().collect()}
    assert abs(quota["train"] - 0.8) < 0.02 and abs(quota["val"] - 0.1) < 0.02
    again = {r.line_number: r.split for r in p04_grouped_split.assign(df.repartition(5)).collect()}
    assert again == {r.line_number: r.split for r in p04_grouped_split.assign(df).collect()}
    empty = df.limit(0)
    assert p04_grouped_split.straddling(empty).count() == 0 and p04_grouped_split.assign(empty).count() == 0
    assert p04_grouped_split.assign_by_quota(empty).count() == 0
    with pytest.raises(ValueError):
        p04_grouped_split.assign(df, {"train": 0.9, "val": 0.2, "test": 0.1})
