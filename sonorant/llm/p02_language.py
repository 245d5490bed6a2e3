"""Problem 2: the language of every record and of every segment of mixed documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .ids import language_code
from .kernel import OTHER, LanguageModel, fit, gram_keys, letters_of, seed_rows, shares, squeeze
from .p10_spam import ProseModel, SPAM_SHARE, fit as fit_prose, spam_share

#: Words of a text that counts, of a whole sentence, of a part of one that counts as a sentence, and of a piece of a text without sentence ends.
MIN_WORDS, WHOLE_WORDS, SENTENCE_WORDS, PIECE_WORDS = 6, 4, 8, 12
#: A sentence up to its mark is one, but each so many words of it count as one.
LONG_WORDS = 24
#: Whole sentences that make a language one of a mixed document, and the confidence they need, those under SENTENCE_WORDS more.
SENTENCES, SURE, SHORT_SURE = 2, 0.8, 0.95
#: Share of the bound of known languages below which a text is in none of them.
FAR = 0.4
#: Characters handled at once, which bounds a worker's memory.
BLOCK = 400_000


def pieces(texts: list[str], model: LanguageModel) -> tuple[np.ndarray, ...]:
    """Pieces of all texts in order: (text, language index, confidence, words, sentence, start, whether its sentence ends with a mark, best score).

    A piece is a sentence, or PIECE_WORDS words of one without an end. Pieces of
    fewer than four words say little: they take the language of the last longer
    piece of their text. A language index beyond the model's is none of them.
    """
    codes, owner, ends, place = letters_of([" " + t for t in texts])
    none = np.zeros(0, np.int64)
    nothing = none, none, none.astype(np.float32), none, none, none, none.astype(bool), none.astype(np.float32)
    if not len(codes):
        return nothing
    word_start = (codes > 0) & np.concatenate(([True], (codes[:-1] == 0) | (owner[1:] != owner[:-1])))
    # A sentence begins after an end, or with a text.
    cut = np.concatenate(([True], (ends[:-1] > 0) | (owner[1:] != owner[:-1])))
    sentence = np.cumsum(cut) - 1
    marked = ends[np.append(np.flatnonzero(cut)[1:], len(codes)) - 1] == 2
    words = np.cumsum(word_start)
    first = words[np.flatnonzero(cut)] - word_start[np.flatnonzero(cut)]
    nth = words - first[sentence]  # words of the sentence so far
    # Long sentences are cut at a word start every PIECE_WORDS words.
    cut |= word_start & (nth > 1) & ((nth - 1) % PIECE_WORDS == 0)
    piece = np.cumsum(cut) - 1
    number = int(piece[-1]) + 1
    count = np.bincount(piece[word_start], minlength=number)
    starts = np.flatnonzero(cut)
    scores = model.scores(gram_keys(*squeeze(codes, piece)), number)
    keep = count > 0
    if not keep.any():
        return nothing
    best, confidence, top = scores.argmax(1), shares(scores).astype(np.float32), scores.max(1)
    of, best, confidence, count, top = owner[starts][keep], best[keep], confidence[keep], count[keep], top[keep]
    # A whole piece that every one-versus-rest classifier denies is in another language.
    best = np.where((count >= PIECE_WORDS - 1) & (top < min(0.0, model.bound)), len(model.languages), best)
    firm = np.where(count >= 4, np.arange(len(of)), -1)
    last = np.maximum.accumulate(firm)
    follow = (firm < 0) & (last >= 0)
    follow[follow] = of[last[follow]] == of[follow]
    best[follow] = best[last[follow]]
    # The space put in front of each text is no part of it.
    return of, best, confidence, count, sentence[starts][keep], np.maximum(place[starts][keep] - 1, 0), marked[sentence[starts][keep]], top


def _runs(best: np.ndarray, confidence: np.ndarray, count: np.ndarray, sentence: np.ndarray) -> tuple[np.ndarray, ...]:
    """Neighbouring pieces of one sentence in one language: (first piece, words, confidence)."""
    starts = np.flatnonzero(np.concatenate(([True], (best[1:] != best[:-1]) | (sentence[1:] != sentence[:-1]))))
    total = np.add.reduceat(count, starts)
    return starts, total, np.add.reduceat(confidence * count, starts) / total


def _settled(model: LanguageModel, language: int, share: float, top: float, words: int) -> tuple[str, float]:
    """Language and confidence of words in one language: none of those known where their mean best score lies far below the bound.

    Odd characters, names and noise lower the score of a known language too, so
    FAR of the bound decides; between it and the bound the confidence is low. The
    score grows with the words seen, so fewer than PIECE_WORDS are only in none
    where every classifier says no.
    """
    known = float(model.known(np.float64(top)))
    if language == len(model.languages) or top < min(0.0 if words < PIECE_WORDS else FAR * model.bound, model.bound):
        return OTHER, 1 - known
    return model.languages[language], share * (known if words >= PIECE_WORDS else max(known, 0.5))


def languages_of_texts(texts: list[str], model: LanguageModel) -> list[list[tuple[str, float, int, int]]]:
    """For each text its languages as (language, confidence, words, whole sentences), most words first.

    Neighbouring pieces of one sentence in one language are joined. A joined
    piece counts as one whole sentence if it is the whole sentence and has
    WHOLE_WORDS, or is long enough to be one; without a mark at its end each
    PIECE_WORDS of it count as one.
    """
    of, best, confidence, count, sentence, _, marked, top = pieces(texts, model)
    out: list[list[tuple[str, float, int, int]]] = [[] for _ in texts]
    if not len(of):
        return out
    starts, total, sure = _runs(best, confidence, count, sentence)
    within = sentence[starts]
    apart = np.concatenate(([True], within[1:] != within[:-1], [True]))
    alone = apart[:-1] & apart[1:]
    estimated = total // np.where(alone & marked[starts], LONG_WORDS, PIECE_WORDS)
    whole = np.where(total < np.where(alone, WHOLE_WORDS, SENTENCE_WORDS), 0, np.maximum(1, estimated))
    k = len(model.languages) + 1
    cell = of[starts].astype(np.int64) * k + best[starts]
    size = len(texts) * k
    height = np.add.reduceat(top * count, starts) / total
    certain = (sure >= np.where(total < SENTENCE_WORDS, SHORT_SURE, SURE)) | (best[starts] == k - 1)
    n_words = np.bincount(cell, total, size).reshape(-1, k)
    n_sure = np.bincount(cell, sure * total, size).reshape(-1, k)
    n_top = np.bincount(cell, height * total, size).reshape(-1, k)
    n_whole = np.bincount(cell, whole * certain, size).reshape(-1, k)
    for i in np.flatnonzero(n_words.sum(1) > 0).tolist():
        found: dict[str, tuple[str, float, int, int]] = {}
        for c in np.flatnonzero(n_words[i]).tolist():
            words = int(n_words[i, c])
            language, share = _settled(model, c, float(n_sure[i, c] / words), float(n_top[i, c] / words), words)
            _, old, more, sentences = found.get(language, (language, 0.0, 0, 0))
            found[language] = (language, (old * more + share * words) / (more + words), more + words, sentences + int(n_whole[i, c]))
        out[i] = sorted(found.values(), key=lambda x: (-x[2], x[0]))
    return out


def segments_of_texts(texts: list[str], model: LanguageModel) -> list[list[tuple[int, int, str, float]]]:
    """For each text its stretches of one language: (start, end, language, confidence), whole sentences, end to end.

    Within a sentence the language of most of its words counts, so that a quoted
    phrase opens no stretch of its own; but PIECE_WORDS sure words of a sentence
    without a mark (LONG_WORDS of one with it) are a stretch, and what follows
    them is theirs up to the next.
    """
    of, best, confidence, count, sentence, start, marked, top = pieces(texts, model)
    out: list[list[tuple[int, int, str, float]]] = [[] for _ in texts]
    if not len(of):
        return out
    k = len(model.languages) + 1
    order = np.unique(sentence, return_inverse=True)[1]
    votes = np.bincount(order * k + best, count, (order.max() + 1) * k).reshape(-1, k)
    runs, total, certain = _runs(best, confidence, count, sentence)
    other = best[runs] == k - 1  # a single such piece may be one in which two languages meet
    firm = (total >= np.where(marked[runs] | other, LONG_WORDS, PIECE_WORDS)) & ((certain >= SURE) | other)
    held = np.repeat(firm, np.diff(np.append(runs, len(best))))
    last = np.maximum.accumulate(np.where(held, np.arange(len(best)), -1))
    theirs = (last >= 0) & (sentence[last] == sentence)
    best = np.where(theirs, best[last], votes.argmax(1)[order])
    new = np.flatnonzero(np.concatenate(([True], (of[1:] != of[:-1]) | (best[1:] != best[:-1]))))
    words = np.add.reduceat(count, new)
    sure = np.add.reduceat(confidence * count, new) / words
    height = np.add.reduceat(top * count, new) / words
    for at, i in enumerate(new.tolist()):
        text = int(of[i])
        following = at + 1 < len(new) and of[new[at + 1]] == text
        end = int(start[new[at + 1]]) if following else len(texts[text])
        language, share = _settled(model, int(best[i]), float(sure[at]), float(height[at]), int(words[at]))
        out[text].append((int(start[i]) if out[text] else 0, end, language, share))
    return out


def _blocks(texts: list[str]):
    """Bounds of neighbouring texts of about BLOCK characters."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= BLOCK:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


_FIELDS = (("record_table", pa.string()), ("record_id", pa.int64()), ("code", pa.string()), ("language", pa.string()), ("confidence", pa.float64()), ("mixed", pa.bool_()))
_RESULT = "record_table string, record_id bigint, code string, language string, confidence double, mixed boolean"


def label_records(records: DataFrame, seeds: DataFrame, wrong_only: bool = False) -> DataFrame:
    """(record_table, record_id, code, language, confidence, mixed) for records (record_table, record_id, text, may_mix, code).

    Every record with any text gets its language, `other` where it is in none of
    the seeds' languages or has no letters (then with confidence 0). A record
    with at least SENTENCES whole sentences in each of several languages gives a
    row for each, mixed. Null and blank texts give none, repeated rows come out
    repeated. A map over Arrow batches with the fitted models as a broadcast.

    With `wrong_only`, texts under MIN_WORDS give none, nor do records in one
    language that is their label's `code` or is none of the seeds'; `other`
    makes no record mixed; and of what is left, where may_mix, no spam
    pages (the operator of problem 10).
    """
    rows = seed_rows(seeds)
    models = records.sparkSession.sparkContext.broadcast((fit(rows), fit_prose(rows) if wrong_only else None))

    def run(batches):
        model, prose = models.value
        for batch in batches:
            tables, ids, texts, may, codes = (batch.column(i).to_pylist() for i in range(5))
            texts = [t or "" for t in texts]
            for a, b in _blocks(texts):
                found = languages_of_texts(texts[a:b], model)
                out: tuple[list, ...] = tuple([] for _ in _FIELDS)
                for i, langs in zip(range(a, b), found):
                    labels = _wrong(texts[i], may[i], codes[i], langs, prose) if wrong_only else _all(texts[i], may[i], langs)
                    for language, sure, mixed in labels:
                        for column, value in zip(out, (tables[i], ids[i], codes[i], language, sure, mixed)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(out, _FIELDS)], names=[n for n, _ in _FIELDS])

    chosen = records.select("record_table", "record_id", F.col("text").cast("string").alias("text"), "may_mix", "code")
    return chosen.mapInArrow(run, _RESULT)


def _several(may: bool, langs: list) -> list:
    several = [x for x in langs if x[3] >= SENTENCES] if may else []
    return several if len(several) > 1 else []


def _all(text: str, may: bool, langs: list) -> list[tuple[str, float, bool]]:
    if not langs:
        return [(OTHER, 0.0, False)] if text.strip() else []
    several = _several(may, langs)
    return [(x[0], x[1], bool(several)) for x in several or langs[:1]]


def _wrong(text: str, may: bool, code: str | None, langs: list, prose: ProseModel) -> list[tuple[str, float, bool]]:
    if sum(x[2] for x in langs) < MIN_WORDS:
        return []
    several = _several(may, [x for x in langs if x[0] != OTHER])
    out = [(x[0], x[1], bool(several)) for x in several or langs[:1] if x[0] != OTHER and (several or x[0] != code)]
    return [] if out and may and spam_share(text, prose) > SPAM_SHARE else out


def mixed_segments(documents: DataFrame, seeds: DataFrame) -> DataFrame:
    """(doc_id, segment, first, last, language, confidence) of mixed documents: characters [first, last) of each stretch.

    The stretches of a document cover it in order. Documents in one language,
    blank and null texts give none.
    """
    model_of = documents.sparkSession.sparkContext.broadcast(fit(seed_rows(seeds)))
    fields = (("doc_id", pa.int64()), ("segment", pa.int32()), ("first", pa.int32()), ("last", pa.int32()), ("language", pa.string()), ("confidence", pa.float64()))

    def run(batches):
        model = model_of.value
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _blocks(texts):
                mixed = [a + i for i, langs in enumerate(languages_of_texts(texts[a:b], model)) if _several(True, langs)]
                out: tuple[list, ...] = tuple([] for _ in fields)
                for i, found in zip(mixed, segments_of_texts([texts[i] for i in mixed], model)):
                    for n, segment in enumerate(found):
                        for column, value in zip(out, (keys[i], n, *segment)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(out, fields)], names=[n for n, _ in fields])

    chosen = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id bigint, segment int, first int, last int, language string, confidence double")


def records_of(documents: DataFrame, manifest: DataFrame) -> DataFrame:
    """Both tables as records; only documents may be mixed. `code` is the language that the label names, if any."""
    return documents.select(
        F.lit("documents").alias("record_table"), F.col("doc_id").cast("bigint").alias("record_id"),
        "text", F.lit(True).alias("may_mix"), language_code(F.col("lang")).alias("code"),
    ).unionByName(manifest.select(
        F.lit("labeled_manifest").alias("record_table"), F.col("line_number").cast("bigint").alias("record_id"),
        "text", F.lit(False).alias("may_mix"), language_code(F.col("language")).alias("code"),
    ))


def wrong_labels(documents: DataFrame, manifest: DataFrame, seeds: DataFrame) -> DataFrame:
    """(record_table, record_id, language) of mixed documents, one row a language, and of records whose label is missing, no language or wrong."""
    return label_records(records_of(documents, manifest), seeds, wrong_only=True).select("record_table", "record_id", "language")


def all_labels(documents: DataFrame, manifest: DataFrame, seeds: DataFrame) -> DataFrame:
    """Every record's language or languages with confidence."""
    return label_records(records_of(documents, manifest), seeds).select("record_table", "record_id", "language", "confidence", "mixed")
