"""Text operators against brute force, libraries and held-out rows."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from sonorant.llm import p01_split_overlap, p02_language, p06_canonical, p08_tokenize, p09_packing, p10_spam
from sonorant.llm.plain import comparable_words, plain

SEEDS = "/root/testdata/sf0.001/language_seed.parquet"
WORDS = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "te", "su") for b in ("r", "n", "sh") for c in ("a", "il", "od", "um")]
MANIFEST = "line_number bigint, audio_id string, text string, split string, dataset string, language string, words string, gram bigint"


def manifest(spark, data):
    return spark.createDataFrame([(n, a, t, s, "D", None, "clash", 1) for n, a, t, s in data], MANIFEST)


def agreeing(a, b):
    """Words that two lists have in common in order."""
    row = [0] * (len(b) + 1)
    for x in a:
        old = row
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(old[j - 1] + 1 if x == y else max(old[j], row[-1]))
    return row[-1]


def test_banded_distance():
    rng = random.Random(2)
    for _ in range(600):
        a = [rng.choice("abc") for _ in range(rng.randrange(0, 12))]
        b = [rng.choice("abc") for _ in range(rng.randrange(0, 12))]
        for k in range(0, 5):
            assert p01_split_overlap.within(a, b, k) == (len(a) + len(b) - 2 * agreeing(a, b) <= k), (a, b, k)


def overlaps_by_hand(data):
    part = lambda s: None if s is None else "t" if "train" in s.lower() else "e"
    out = set()
    words = {n: comparable_words(t) if t else [] for n, _, t, _ in data}
    key = lambda a: a.strip().lower() if a and a.strip() else None
    for n, a, _, s in data:
        for m, b, _, u in data:
            if part(s) == "t" and part(u) == "e":
                same = key(a) is not None and key(a) == key(b)
                x, y = words[n], words[m]
                if same or min(len(x), len(y)) >= 6 and 5 * agreeing(x, y) >= 4 * max(len(x), len(y)):
                    out.add((min(n, m), max(n, m)))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_overlaps_match_brute_force(spark, seed):
    rng = random.Random(seed)
    base = [[rng.choice(WORDS) for _ in range(rng.choice([5, 6, 7, 8, 9, 10, 11, 13, 16, 24, 40]))] for _ in range(25)]
    data = []
    for n in range(1, 140):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(0, 5)):
            at = rng.randrange(len(w) + 1)
            what = rng.random()
            if what < 0.2 and 0 < at < len(w):
                w[at - 1], w[at] = w[at], w[at - 1]
            elif what < 0.4 and len(w) > 3 and at < len(w):
                del w[at]
            elif what < 0.7:
                w.insert(at, rng.choice(WORDS))
            elif at < len(w):
                w[at] = rng.choice(WORDS)
        text = " ".join(w)
        text = rng.choice([text, text.upper(), text.capitalize() + ".", "[kulgi] " + text, text.replace("a", "а"), text.replace(" ", ", ", 1)])
        data.append((n, rng.choice([None, "", f"x_{n}", f"clip_{rng.randrange(40)}", f" CLIP_{rng.randrange(40)}"]), rng.choice([text, text, text, None, ""]), rng.choice(["train", "TRAIN ", "dev", "test", None])))
    got = sorted(tuple(r) for r in p01_split_overlap.overlaps(manifest(spark, data)).collect())
    assert got == overlaps_by_hand(data)
    report = p01_split_overlap.report(manifest(spark, data)).collect()
    assert sum(r.pairs for r in report) == len(got)


@pytest.mark.parametrize("seed", range(2))
def test_overlaps_with_a_hot_phrase(spark, seed, monkeypatch):
    """A phrase that most texts share is no key, or one with place and length where a text has little else; no pair is lost for it."""
    monkeypatch.setattr(p01_split_overlap, "HOT_LEAST", 20)
    rng = random.Random(seed)
    phrase = "har kuni ertalab bizning dasturda".split()
    data = []
    for n in range(1, 130):
        w = [rng.choice(WORDS) for _ in range(rng.choice([1, 2, 4, 6, 9, 12, 20]))]
        at = rng.choice([0, 0, 2])
        w[at:at] = phrase
        if n > 40 and rng.random() < 0.6:
            w = data[rng.randrange(30)][2].split()
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(WORDS)
        data.append((n, None, " ".join(w), rng.choice(["train", "train", "val"])))
    assert sorted(tuple(r) for r in p01_split_overlap.overlaps(manifest(spark, data)).collect()) == overlaps_by_hand(data)
    hot = frozenset(range(10))
    assert p01_split_overlap.segments(9, {2: [10] * 8, 1: [10] * 9}, hot) == [(2, 0, False), (2, 3, False), (2, 6, False)]
    assert p01_split_overlap.segments(9, {2: [0, 10, 0, 0, 10, 10, 0, 10], 1: [0] * 9}, hot) == [(2, 1, False), (2, 4, False), (2, 7, False)]
    assert p01_split_overlap.segments(9, {2: [0] * 8, 1: [0, 10, 10, 0, 0, 0, 0, 10, 0]}, hot) == [(1, 1, False), (1, 2, False), (1, 7, False)]
    assert p01_split_overlap.segments(9, {2: [0] * 7 + [10], 1: [0] * 9}, hot) == [(2, 7, False), (2, 0, True), (2, 2, True)]


@pytest.mark.parametrize("all_hot", [False, True])
def test_segments_are_disjoint_and_places_are_complete(all_hot):
    """Of any two lists that agree enough, so many segments meet as the filter asks for, where it looks for them."""
    rng = random.Random(int(all_hot))
    for _ in range(400):
        n = rng.choice([6, 7, 9, 10, 13, 15, 20, 33, 64, 70])
        a = [rng.randrange(9) if all_hot else rng.randrange(200) for _ in range(n)]
        b = list(a)
        for _ in range(rng.randrange(0, n // 5 + 1)):
            i = rng.randrange(len(b))
            x = b.pop(i)
            if rng.random() < 0.6:
                b.insert(max(0, min(len(b), i + rng.choice([-2, -1, 0, 1, 2]))), rng.choice([x, -1]))
        m = len(b)
        apart = p01_split_overlap.most_apart(n, m)
        if m < 6 or n + m - 2 * agreeing(a, b) > apart:
            continue
        grams = {w: [hash(tuple(a[i : i + w])) for i in range(n - w + 1)] for w in (1, 2)}
        hot = frozenset(g for x in grams.values() for g in x) if all_hot else frozenset(rng.sample(grams[2], len(grams[2]) // 2))
        chosen = p01_split_overlap.segments(n, grams, hot)
        covered = [j + i for w, j, _ in chosen for i in range(w)]
        assert len(chosen) == 2 * (n // 5) + 1 and len(covered) == len(set(covered)) and max(covered) < n
        met = 0
        for w, p, is_hot in chosen:
            at = [j for j in range(m - w + 1) if b[j : j + w] == a[p : p + w] and abs(j - p) + abs(m - n - j + p) <= apart]
            if is_hot:
                by = p01_split_overlap.step(n)
                assert {(j // by, m // by) for j in at} <= p01_split_overlap._places(n, p)
            met += bool(at)
        assert met >= len(chosen) - apart


def test_overlaps_of_copies_and_of_nothing(spark):
    text = "bir ikki uch tort besh olti yetti"
    data = [(n, None, text, "train" if n % 10 else "val") for n in range(1, 101)]
    assert p01_split_overlap.overlaps(manifest(spark, data)).count() == 90 * 10
    assert p01_split_overlap.overlaps(manifest(spark, [])).count() == 0
    long = " ".join(f"w{i}" for i in range(3000))
    pairs = p01_split_overlap.overlaps(manifest(spark, [(1, None, long, "train"), (2, None, long + " x y", "test")])).collect()
    assert [tuple(r) for r in pairs] == [(1, 2)]
    swapped = "olti yetti bir ikki uch tort besh sakkiz toqqiz on".split()
    moved = [*swapped[:2], swapped[3], swapped[2], *swapped[4:7], swapped[8], swapped[7], swapped[9]]  # two words each are out of place
    pairs = p01_split_overlap.overlaps(manifest(spark, [(1, None, " ".join(swapped), "train"), (2, None, " ".join(moved), "test"), (3, None, " ".join(reversed(swapped)), "test")])).collect()
    assert [tuple(r) for r in pairs] == [(1, 2)]


def test_plain_words():
    assert plain("Ｓalom o‘zbek​") == "salom o'zbek"
    assert comparable_words("[kulgi] Мен ВОТ кeлдим!") == comparable_words("мен вот келдим")
    assert comparable_words("TİL ISIK") == comparable_words("til ısık")


def test_canonical_form_equals_nfc_of_marks():
    rng = random.Random(3)
    alphabet = "aeoucszẓ̧̣́̂̈̆"
    texts = ["".join(rng.choice(alphabet) for _ in range(9)) for _ in range(2000)]
    assert p06_canonical.canonical_texts(texts) == [unicodedata.normalize("NFC", t) for t in texts]


def test_canonical_pairs():
    same = [("ＡＢＣ １", "ABC 1"), ("a b\tc\r\n", "a b c"), ("so​z﻿", "soz"), ("é", "é"), ("оrtа", "orta"), ("g‘oya gʻoya", "g'oya g´oya"), ("ﬁn", "fin"), ("ё", "ё"), ("Βοr", "Bor"),
            ("օne", "one"), ("ᎪᏴ", "AB"), ("ɡap", "gap"), ("ⲞⲔ", "OK"), ("ꓮꓐ", "AB"), ("ѕսm", "sum")]
    different = [("A", "a"), ("1", "2"), ("é", "e"), ("so'z", "soz"), ("a.", "a"), ("ı", "i"), ("ш", "щ"), ("ab", "a b"), ("үн", "ун"), ("ն", "n")]
    for a, b in same:
        assert len(set(p06_canonical.canonical_texts([a, b]))) == 1, (a, b)
    for a, b in different:
        assert len(set(p06_canonical.canonical_texts([a, b]))) == 2, (a, b)
    once = p06_canonical.canonical_texts([x for p in same + different for x in p])
    assert p06_canonical.canonical_texts(once) == once
    assert p06_canonical.canonical_texts([None, "", " ​"]) == [None, "", ""]
    long = "ｏʻ " * 700_000
    assert p06_canonical.canonical_texts([long])[0] == ("o' " * 700_000).strip()


def test_look_alike_pairs(spark):
    data = [(1, "salom dunyo"), (2, "sаlom dunyo"), (3, "salom dunyo"), (4, "salom dunyo"), (5, "Salom dunyo"), (6, None), (7, " "), (8, "​"), (9, ""), (None, "salom dunyo"), (4, "salom dunyo")]
    df = spark.createDataFrame([(i, t, "clash") for i, t in data], "doc_id bigint, text string, look string")
    got = sorted(tuple(r) for r in p06_canonical.same_looking_pairs(df).collect())
    assert got == [(1, 2), (1, 3), (2, 3), (2, 4), (3, 4)]
    assert p06_canonical.same_looking_pairs(df.limit(0)).count() == 0
    assert p06_canonical.canonicalize(df, "doc_id").count() == len(data)


def test_ids_equal_the_library_and_round_trip(spark):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(f"{p08_tokenize.TOKENIZERS}/byte_bpe_50k.json")
    library.encode_special_tokens = True
    rng = random.Random(5)
    texts = ["", " ", "  a", "a  b   c", "a \n b\n\n c ", "it's 's 'S", "<|endoftext|>", "o’zbek ўзбек 12345 ½ ①", "👩🏽‍🎤", "\x1f\x01\x85x", "a" * 5000, "аб" * 3000, " " * 300, "  　x"]
    texts += ["".join(rng.choice("ab щ'1.\n\t   éß") for _ in range(40)) for _ in range(400)]
    bpe = p08_tokenize.encoder(f"{p08_tokenize.TOKENIZERS}/{p08_tokenize.VOCABULARY}")
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [bpe.encode(t) for t in texts] == want
    assert [bpe.decode(x) for x in want] == texts
    assert [bpe.count(t) for t in texts] == [len(x) for x in want]
    data = [(i, t) for i, t in enumerate(texts)] + [(None, None), (3, texts[3])]
    df = spark.createDataFrame([(i, t, [1]) for i, t in data], "doc_id bigint, text string, ids array<int>")
    got = p08_tokenize.encode(df, "doc_id")
    assert got.count() == len(data) and got.where("doc_id is null").first().ids == []
    back = {r.doc_id: r.text for r in p08_tokenize.decode(got.where("doc_id is not null"), "doc_id").collect()}
    assert back == dict(enumerate(texts))
    assert p08_tokenize.encode(df.limit(0), "doc_id").count() == 0


def test_packing(spark):
    rng = random.Random(6)
    data = [(i, rng.choice([0, 1, 5, 50, rng.randrange(1, 100), 100, 101, 350])) for i in range(3000)] + [(9999, None)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in data], "doc_id bigint, tokens bigint, container string")
    packed = p09_packing.pack(df, 100)
    out = packed.collect()
    load, total, parts = {}, {}, {}
    for r in out:
        load[r.container] = load.get(r.container, 0) + r.tokens
        total[r.doc_id] = total.get(r.doc_id, 0) + r.tokens
        parts[r.doc_id] = parts.get(r.doc_id, 0) + 1
    assert max(load.values()) <= 100
    assert total == {i: t or 0 for i, t in data}
    assert all(parts[i] == 1 for i, t in data if (t or 0) <= 100)
    least = -(-sum(total.values()) // 100)
    assert len(load) <= 1.02 * least + 3
    again = {(r.doc_id, r.piece): r.container for r in p09_packing.pack(df.repartition(7), 100).collect()}
    assert again == {(r.doc_id, r.piece): r.container for r in out}
    assert p09_packing.pack(df.limit(0), 100).count() == 0
    with pytest.raises(ValueError):
        p09_packing.pack(df, 0)
    assert len(load) <= least + 1  # what shards leave unused does not add up
    assert tuple(p09_packing.check(packed, df, 100).first()) == (3001, 0, 0, 0, 0, 0)
    broken = packed.where("doc_id <> 5").withColumn("container", F.when(F.col("doc_id") < 400, "x").otherwise(F.col("container")))
    broken = broken.unionByName(broken.where("doc_id = 9999")).withColumn("doc_id", F.when(F.col("doc_id") == 7, -7).otherwise(F.col("doc_id")))
    got = p09_packing.check(broken, df, 100).first()
    assert (got.missing, got.strange, got.repeated, got.overfull > 0) == (2, 1, 1, True)
    assert tuple(p09_packing.check(packed.limit(0), df.limit(0), 100).first()) == (0, 0, 0, 0, 0, 0)


def test_genetic_steps_keep_every_item_and_improve():
    rng = random.Random(7)
    size = [rng.randrange(20, 60) for _ in range(120)]
    start = p09_packing.best_fit(list(range(120)), size, 100, [])
    shuffled = p09_packing.best_fit(rng.sample(range(120), 120), size, 100, [])
    for child in (p09_packing.crossover(start, shuffled, size, 100, rng), p09_packing.mutate(start, size, 100, rng)):
        assert sorted(i for _, b in child for i in b) == list(range(120))
        assert all(load == sum(size[i] for i in b) <= 100 for load, b in child)
    grown, born = p09_packing.evolve(size, 100, [start, shuffled], rng)
    assert born >= p09_packing.STAGNATION and p09_packing.fitness(grown[0], 100) >= p09_packing.fitness(start, 100)


def test_evolution_beats_best_fit():
    """Items of a quarter to a half of a container leave best fit with much unused; evolved packings need clearly fewer containers."""
    rng = random.Random(1)
    size = [rng.randrange(500, 1101) for _ in range(1024)]
    fit = p09_packing.best_fit(sorted(range(1024), key=lambda i: (-size[i], i)), size, 2048, [])
    grown, _ = p09_packing.evolve(size, 2048, [], random.Random(2))
    least = -(-sum(size) // 2048)
    assert len(grown[0]) - least <= 0.7 * (len(fit) - least)
    assert p09_packing.evolve([], 100, [], rng) == ([[]], 0) and p09_packing.evolve([5], 100, [], rng)[0][0] == [(5, [0])]


@pytest.fixture(scope="module")
def seeds(spark):
    return spark.read.parquet(SEEDS)


def test_languages_of_held_out_sentences(seeds):
    rows = p02_language.seed_rows(seeds)
    model = p02_language.fit(rows[::2])
    held = rows[1::2]
    found = p02_language.languages_of_texts([t for _, t in held], model)
    assert sum(f[0][0] == language for f, (language, _) in zip(found, held)) / len(held) > 0.98


def test_labels(spark, seeds):
    rows = p02_language.seed_rows(seeds)
    by = {}
    for language, text in rows:
        by.setdefault(language, []).append(text.rstrip(".") + ".")
    mixed = " ".join(by["ru"][:3] + by["en"][:2])
    once = " ".join(by["ru"][:3] + by["en"][:1])
    documents = spark.createDataFrame([
        (1, by["tr"][0], "tr"), (2, by["tr"][1], "ru"), (3, by["tr"][2], None), (4, by["kk"][0], "und"), (5, mixed, "ru"), (6, once, "ru"),
        (7, None, "ru"), (8, "", None), (9, "salom", None), (10, by["uz"][0], "uz_Latn"), (2, by["tr"][1], "ru"), (11, "дом " * 40, None),
        (12, "\n".join(["buy shop"] * 50), None),
    ], "doc_id bigint, text string, lang string")
    lines = spark.createDataFrame([(1, " ".join(by["ru"][:5] + by["en"][:1]), "en"), (2, by["en"][3], ""), (3, by["en"][4], "EN")], "line_number bigint, text string, language string")
    got = sorted(tuple(r) for r in p02_language.wrong_labels(documents, lines, seeds).collect())
    want = [("documents", 2, "tr"), ("documents", 2, "tr"), ("documents", 3, "tr"), ("documents", 4, "kk"), ("documents", 5, "en"), ("documents", 5, "ru"), ("labeled_manifest", 1, "ru"), ("labeled_manifest", 2, "en")]
    assert [g for g in got if g[1] not in (11,)] == want
    labels = p02_language.all_labels(documents, lines, seeds).collect()
    assert all(0 < r.confidence <= 1 for r in labels)
    # Every record with any text has a row, the one-word text and the keyword pages too.
    assert {r.record_id for r in labels if r.record_table == "documents"} == {1, 2, 3, 4, 5, 6, 9, 10, 11, 12} and sum(r.record_id == 2 for r in labels) == 2 + 1
    assert p02_language.wrong_labels(documents.limit(0), lines.limit(0), seeds).count() == 0


FOREIGN = {
    "de": "Am frühen Morgen ging der alte Mann mit seinem Hund durch den Park und grüßte die Nachbarn, die auf dem Weg zur Arbeit waren. "
          "Die Kinder spielten den ganzen Nachmittag im Garten, während ihre Mutter in der Küche das Abendessen vorbereitete. "
          "Wir haben gestern lange über das neue Projekt gesprochen, aber am Ende konnte sich niemand für eine Lösung entscheiden.",
    "fr": "Le matin, le vieil homme se promenait avec son chien dans le parc et saluait les voisins qui allaient au travail. "
          "Les enfants ont joué tout l'après-midi dans le jardin pendant que leur mère préparait le dîner dans la cuisine. "
          "Nous avons longtemps parlé hier du nouveau projet, mais à la fin personne n'a pu choisir une solution.",
    "es": "Por la mañana el viejo paseaba con su perro por el parque y saludaba a los vecinos que iban al trabajo. "
          "Los niños jugaron toda la tarde en el jardín mientras su madre preparaba la cena en la cocina. "
          "Ayer hablamos mucho tiempo sobre el nuevo proyecto, pero al final nadie pudo decidirse por una solución.",
    "ar": "في الصباح الباكر خرج الرجل العجوز مع كلبه إلى الحديقة وسلم على الجيران الذين كانوا في طريقهم إلى العمل. "
          "لعب الأطفال طوال فترة بعد الظهر في الحديقة بينما كانت أمهم تعد العشاء في المطبخ. "
          "تحدثنا أمس طويلا عن المشروع الجديد لكن في النهاية لم يستطع أحد أن يختار حلا.",
}


def test_other_languages_are_told_and_are_no_spam(spark, seeds):
    """Prose in languages without seed sentences is labelled other, keeps its row and is no keyword list."""
    rows = p02_language.seed_rows(seeds)
    known = {language: " ".join(t for other, t in rows if other == language)[:600] for language in ("en", "kk")}
    texts = {**FOREIGN, **known, "long": FOREIGN["de"] * 30, "bare": FOREIGN["fr"].lower().replace(".", "").replace(",", ""), "digits": "12345 67890 " * 4}
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts.values())], "doc_id bigint, text string, lang string")
    lines = spark.createDataFrame([], "line_number bigint, text string, language string")
    got = {r.record_id: r for r in p02_language.all_labels(docs, lines, seeds).collect()}
    assert len(got) == len(texts)
    found = dict(zip(texts, (got[i].language for i in range(len(texts)))))
    assert found == {"de": "other", "fr": "other", "es": "other", "ar": "other", "en": "en", "kk": "kk", "long": "other", "bare": "other", "digits": "other"}
    assert all(got[i].confidence > 0.8 for i in range(6)) and got[len(texts) - 1].confidence == 0.0
    assert {r.language for r in p02_language.wrong_labels(docs, lines, seeds).collect()} == {"en", "kk"}
    shares = {r.doc_id: r.share for r in p10_spam.spam_shares(docs, seeds).collect()}
    assert all(shares[i] < 0.1 for i in range(len(texts) - 1))
    german = ["billig kaufen", "kaufen angebot", "angebot billig", "preis angebot"]
    more = spark.createDataFrame([(1, "\n".join(german * 20)), (2, ", ".join(german * 20))], "doc_id bigint, text string")
    assert sorted(r.doc_id for r in p10_spam.spam(more, seeds).collect()) == [1, 2]


def test_seeds_are_a_bounded_sample_of_each_language(spark, seeds, monkeypatch):
    from sonorant.llm import kernel

    monkeypatch.setattr(kernel, "ROWS_A_LANGUAGE", 7)
    rows = kernel.seed_rows(seeds)
    by = {language: sum(x == language for x, _ in rows) for language, _ in rows}
    assert len(by) >= 5 and set(by.values()) == {7}
    assert rows == kernel.seed_rows(seeds.repartition(5).withColumn("count", F.lit(1)))
    assert kernel.seed_rows(seeds.limit(0)) == () and kernel.fit(()).languages == ["other"]
    docs = spark.createDataFrame([(1, FOREIGN["de"], None)], "doc_id bigint, text string, lang string")
    assert p02_language.all_labels(docs, docs.select(F.col("doc_id").alias("line_number"), "text", F.col("lang").alias("language")).limit(0), seeds.limit(0)).first().language == "other"


def test_segments_of_mixed_documents(spark, seeds):
    rows = p02_language.seed_rows(seeds)
    by = {}
    for language, text in rows:
        by.setdefault(language, []).append(text.rstrip(".") + ".")
    quoted = by["ru"][5].rstrip(".") + " («thank you»)."
    parts = [" ".join(by["ru"][:3]), " ".join(by["en"][:2]), " ".join([*by["ru"][3:5], quoted])]
    whole = " ".join(parts)
    df = spark.createDataFrame([(1, whole, "x"), (2, parts[0], "x"), (3, None, "x"), (4, "", "x")], "doc_id bigint, text string, segment string")
    got = sorted(p02_language.mixed_segments(df, seeds).collect(), key=lambda r: r.segment)
    assert [(r.doc_id, r.language) for r in got] == [(1, "ru"), (1, "en"), (1, "ru")]
    assert [whole[r.first : r.last].strip() for r in got] == parts and all(0.5 < r.confidence <= 1 for r in got)
    assert p02_language.mixed_segments(df.limit(0), seeds).count() == 0


def test_boundaries_of_segments_of_held_out_sentences(seeds):
    """Documents put together from sentences that the model never saw, two to five of a language in turn."""
    rows = p02_language.seed_rows(seeds)
    model = p02_language.fit(rows[::2])
    held = {}
    for language, text in rows[1::2]:
        held.setdefault(language, []).append(text.rstrip(".") + ".")
    rng = random.Random(3)
    right = total = 0
    for _ in range(60):
        text, want = "", []
        for language in rng.sample(sorted(held), rng.choice([2, 3])):
            start = len(text)
            text += (" " if text else "") + " ".join(rng.sample(held[language], rng.randrange(2, 6)))
            want += [language] * (len(text) - start)
        got = p02_language.segments_of_texts([text], model)[0]
        assert got[0][0] == 0 and got[-1][1] == len(text) and all(a[1] == b[0] for a, b in zip(got, got[1:]))
        labels = [language for first, last, language, _ in got for _ in range(first, last)]
        right += sum(map(str.__eq__, labels, want))
        total += len(want)
    assert right / total > 0.97


def test_mixed_documents_of_short_or_unmarked_sentences(spark, seeds):
    rows = p02_language.seed_rows(seeds)
    short = [" ".join(t.split()[:6]).rstrip(".,") + "." for language in ("ru", "en") for t in [t for other, t in rows if other == language][:2]]
    ru = "вчера мы всей семьёй ходили в новый театр а потом долго гуляли по городу и говорили о том что скоро наступит лето"
    en = "yesterday the whole family went to the new theatre and then we walked through the town and talked about the summer that is coming"
    df = spark.createDataFrame([(1, " ".join(short), "x"), (2, f"{ru} {ru} {en} {en}", "x"), (3, " ".join(short[:3]), "x"), (4, f"{ru}. {ru}. {short[2]}", "x")], "doc_id bigint, text string, segment string")
    lines = spark.createDataFrame([], "line_number bigint, text string, language string")
    labels = p02_language.all_labels(df.withColumn("lang", F.lit("ru")), lines, seeds).where("mixed").collect()
    assert sorted((r.record_id, r.language) for r in labels) == [(1, "en"), (1, "ru"), (2, "en"), (2, "ru")]
    got = sorted((r.doc_id, r.segment, r.language) for r in p02_language.mixed_segments(df, seeds).collect())
    assert got == [(1, 0, "ru"), (1, 1, "en"), (2, 0, "ru"), (2, 1, "en")]


def test_spam(spark, seeds):
    sentences = [r.text.rstrip(".") + "." for r in seeds.where("language = 'uz'").orderBy("seed_id").limit(12).collect()]
    prose = "\n".join(sentences)
    data = [
        (1, prose), (2, "\n".join(sentences[:3] * 15)), (3, prose + "\nhttps://x.example/a\nwww.y.test/b"), (4, None), (5, ""), (6, " \n "), (7, "salom"),
        (8, " ".join(["kitob arzon", "kitob chegirma", "narxi kitob"] * 30)), (9, "\n".join(f"https://x.example/p{i}" for i in range(40))),
        (10, ", ".join(f"#kitob{i}larga" for i in range(60))), (11, sentences[0] + "\n" + "\n".join(f"* kitob narxi {i}000" for i in range(60))),
        (12, "\n".join(f"- {s}" for s in sentences)), (13, prose + "\n" + ", ".join(["kitob arzon"] * 6)), (14, "x" * 100_000),
        (15, "\n".join(f'<a href="http://x.test/{i}">kitob narxi</a>' for i in range(30))), (8, " ".join(["kitob arzon", "kitob chegirma", "narxi kitob"] * 30)),
        (17, "\n".join(["Mijoz: ha, ha.", "Operator: xo'p."] * 40)), (16, prose.lower().replace(".", "").replace("\n", " ") * 4),
    ]
    df = spark.createDataFrame([(i, t, 0.0) for i, t in data], "doc_id bigint, text string, share double")
    assert sorted(r.doc_id for r in p10_spam.spam(df, seeds).collect()) == [8, 8, 9, 10, 11, 15]
    assert p10_spam.spam_shares(df, seeds).count() == len(data)
    assert p10_spam.spam(df.limit(0), seeds).count() == 0
    assert p10_spam.spam_shares(df.limit(3), seeds.limit(0)).count() == 3


def test_spam_of_attributes_and_short_tags(spark, seeds):
    data = [
        (1, "\n".join(["brand: nike | color: red | price: low"] * 20)), (2, "\n".join(["brand: nike", "color: red", "price: low"] * 20)),
        (3, "#arzon #kitob #narx"), (4, "\n".join(f"A-{i}" for i in range(1000, 1060))), (5, "salom dunyo"), (6, "2024 yil 5 may"),
        (7, "\n".join(["Mijoz: ha, ha.", "Operator: xo'p."] * 40)), (8, "\n".join(["Ali: ha ha ha ha.", "Vali: yo'q yo'q yo'q.", "Olim: mayli mayli mayli."] * 20)), (9, "+998 90 123 45 67"),
    ]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    assert sorted(r.doc_id for r in p10_spam.spam(df, seeds).collect()) == [1, 2, 3, 4]
