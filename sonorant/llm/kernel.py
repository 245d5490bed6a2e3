"""String-kernel classification of short texts: presence of one- to three-grams, Nyström landmarks, ridge regression."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from .p06_canonical import APOSTROPHES, LOOK_ALIKES

#: Labelled sentences of a language used for fitting at most, chosen by the hash of their ids, and landmarks among all.
ROWS_A_LANGUAGE = 200
LANDMARKS = 320
#: Times so many sentences are taken in all at most.
LANGUAGES = 40
#: Grams are hashed to so many features.
BITS = 16
RIDGE = 0.05
#: Softmax temperature of the share of the best language.
TEMPERATURE = 0.2
#: Parts in cross validation, and words of the short cuts that are calibrated on beside whole sentences.
FOLDS, CUT_WORDS = 4, 6
#: What a text in none of the languages is labelled.
OTHER = "other"


def _folded() -> np.ndarray:
    """What each code point below 2^16 counts as: 0 ends a word, a letter is its lower case, look-alikes are one letter."""
    latin = {o: k for k, others in LOOK_ALIKES.items() for o in others if k.islower() or "Ͱ" <= o <= "Ͽ"}
    out = np.zeros(1 << 16, np.uint16)
    for code in range(1 << 16):
        ch = chr(code)
        if 0xFF21 <= code <= 0xFF5A:
            ch = chr(code - 0xFEE0)
        if ch in APOSTROPHES:
            ch = "'"
        elif not ch.isalpha():
            continue
        ch = latin.get(ch, ch).lower()
        out[code] = ord(latin.get(ch, ch)[0])
    return out


_FOLDED: np.ndarray | None = None
#: Characters without ink, which do not end a word.
_SKIP = np.array([0xAD, *range(0x200B, 0x2010), *range(0x2060, 0x2065), 0xFEFF], np.int32)
_MARKS = np.array([ord(c) for c in ".!?…。！？؟"], np.int32)
_ENDS = np.append(_MARKS, np.array([10, 13], np.int32))


def folded(points: np.ndarray) -> np.ndarray:
    global _FOLDED
    if _FOLDED is None:
        _FOLDED = _folded()
    return _FOLDED[np.minimum(points, 0xFFFF)]


def gram_keys(letters: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Distinct (owner, feature) of the grams of one to three letters, packed into sorted integers.

    `letters` are folded with single zeros between words; a gram never spans two owners.
    """
    c = letters.astype(np.uint64)
    o = owner.astype(np.int64) << BITS

    def hashed(grams, order):
        mixed = (grams + np.uint64(order << 50)) * np.uint64(0x9E3779B97F4A7C15)  # wraps around, as meant
        return (mixed >> np.uint64(64 - BITS)).astype(np.int64)

    wide = np.uint64(16)
    parts = [(o + hashed(c, 1))[letters > 0]]
    if len(c) > 1:
        two = (c[:-1] << wide) | c[1:]
        parts.append((o[:-1] + hashed(two, 2))[owner[1:] == owner[:-1]])
    if len(c) > 2:
        three = (two[:-1] << wide) | c[2:]
        parts.append((o[:-2] + hashed(three, 3))[(owner[2:] == owner[:-2]) & (letters[1:-1] > 0)])
    keys = np.concatenate(parts)
    keys.sort()
    if len(keys):
        keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))]
    return keys


def letters_of(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Folded characters of all texts, their text, whether a sentence ends there (2 with a mark, 1 with a line), and their place in the text."""
    lengths = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    place = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    seen = ~np.isin(points, _SKIP)
    points, owner, place = points[seen], owner[seen], place[seen]
    return folded(points), owner, np.isin(points, _ENDS).astype(np.int8) + np.isin(points, _MARKS), place


def squeeze(letters: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without all but the first of the zeros that meet."""
    zero = letters == 0
    keep = ~zero
    if len(letters):
        keep[0] = True
        keep[1:] |= zero[1:] & ~(zero[:-1] & (owner[1:] == owner[:-1]))
    return letters[keep], owner[keep]


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # features x languages: landmarks' presence vectors times their coefficients
    bound: float  # best score from which a text is rather in one of the languages than in another
    slope: float

    def scores(self, keys: np.ndarray, owners: int) -> np.ndarray:
        """One-versus-rest scores of each owner: its normalised presence vector times the weights."""
        own = keys >> BITS
        starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.zeros(0, np.int64)
        out = np.zeros((owners, len(self.languages)), np.float32)
        if len(starts):
            sums = np.add.reduceat(self.weights[keys & ((1 << BITS) - 1)], starts, axis=0)
            sizes = np.diff(np.append(starts, len(own)))
            out[own[starts]] = sums / np.sqrt(sizes)[:, None]
        return out

    def of_texts(self, texts: list[str]) -> np.ndarray:
        letters, owner, _, _ = letters_of([" " + t for t in texts])
        return self.scores(gram_keys(*squeeze(letters, owner)), len(texts))

    def known(self, best: np.ndarray) -> np.ndarray:
        """Probability that a text with this best score is in one of the languages."""
        return 1 / (1 + np.exp(-np.clip(self.slope * (best - self.bound), -50, 50)))


def shares(scores: np.ndarray) -> np.ndarray:
    """Softmax share of each row's best score."""
    return 1 / np.exp((scores - scores.max(1, keepdims=True)) / TEMPERATURE).sum(1)


def _presence(texts: list[str]) -> np.ndarray:
    letters, owner, _, _ = letters_of([" " + t for t in texts])
    keys = gram_keys(*squeeze(letters, owner))
    x = np.zeros((len(texts), 1 << BITS), np.float32)
    x[keys >> BITS, keys & ((1 << BITS) - 1)] = 1
    x /= np.sqrt(np.maximum(1, x.sum(1, keepdims=True)))
    return x


def _ridge(kernel: np.ndarray, rows: np.ndarray, marks: np.ndarray, labels: np.ndarray, languages: list[str]) -> np.ndarray:
    """Coefficients of the landmarks: kernel ridge regression, one language versus the rest, over whitened landmark kernels."""
    values, vectors = np.linalg.eigh(kernel[np.ix_(marks, marks)])
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    phi = kernel[np.ix_(rows, marks)] @ whiten
    y = np.where(labels[rows][:, None] == np.array(languages)[None, :], 1.0, -1.0)
    return whiten @ np.linalg.solve(phi.T @ phi + RIDGE * np.eye(phi.shape[1]), phi.T @ y)


def _landmarks(rows: np.ndarray) -> np.ndarray:
    return rows[:: max(1, -(-len(rows) // LANDMARKS))]


def _boundary(inside: np.ndarray, outside: np.ndarray) -> tuple[float, float]:
    """Threshold and slope of a logistic curve between two sets of scores, by a few Newton steps with a little shrinkage."""
    if not len(inside) or not len(outside):
        return -np.inf, 1.0
    x = np.concatenate([inside, outside]).astype(np.float64)
    y = np.concatenate([np.ones(len(inside)), np.zeros(len(outside))])
    w = np.where(y > 0, 0.5 / len(inside), 0.5 / len(outside))  # both sides weigh the same
    a, b = 4.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * x + b)))
        g = np.array([(w * (p - y) * x).sum() + 1e-3 * a, (w * (p - y)).sum()])
        h = w * p * (1 - p)
        hess = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-9]])
        step = np.linalg.solve(hess, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return (-b / a, a) if a > 0 else (-np.inf, 1.0)


@lru_cache(maxsize=4)
def fit(rows: tuple[tuple[str, str], ...]) -> LanguageModel:
    """Kernel ridge regression, one language versus the rest, over Nyström landmarks; one fit for equal rows in a process.

    The kernel of two texts is the number of grams both have over the root of
    the product of their numbers of grams. Features are the kernel values with
    the landmarks, whitened by the landmarks' own kernel matrix. A score is a
    kernel row times coefficients; since the kernel is a product of presence
    vectors, the landmarks' vectors and the coefficients are multiplied once,
    here, and scoring is one product of presence vectors with that matrix.

    What is in none of the languages is told by the best score. Its bound lies
    between the scores of held-out sentences and short cuts of them (cross
    validation) and those of each language under a model that never saw it.
    """
    rows = tuple((language, text) for language, text in rows if language and text)
    languages = sorted({r[0] for r in rows})
    if not rows:
        return LanguageModel([OTHER], np.zeros((1 << BITS, 1), np.float32), np.inf, 1.0)
    labels = np.array([r[0] for r in rows])
    cuts = [" ".join(t.split()[:CUT_WORDS]) for _, t in rows]
    n = len(rows)
    x = _presence([t for _, t in rows])
    short = _presence(cuts)
    kernel = (x @ x.T).astype(np.float64)
    meets = (short @ x.T).astype(np.float64)
    every = np.arange(n)
    inside: list[np.ndarray] = []
    outside: list[np.ndarray] = []
    tests = [(every % FOLDS != k, every % FOLDS == k, inside) for k in range(FOLDS)] if n >= 2 * FOLDS else []
    tests += [(labels != language, labels == language, outside) for language in languages] if len(languages) > 2 else []
    for train, test, out in tests:
        seen, held = np.flatnonzero(train), np.flatnonzero(test)
        if len(seen) and len(held):
            marks = _landmarks(seen)
            w = _ridge(kernel, seen, marks, labels, sorted(set(labels[seen])))
            out += [(k[np.ix_(held, marks)] @ w).max(1) for k in (kernel, meets)]
    bound, slope = _boundary(np.concatenate(inside or [np.zeros(0)]), np.concatenate(outside or [np.zeros(0)]))
    marks = _landmarks(every)
    w = _ridge(kernel, every, marks, labels, languages)
    return LanguageModel(languages, (x[marks].T @ w).astype(np.float32), float(bound), float(slope))


def seed_rows(seeds: DataFrame) -> tuple[tuple[str, str], ...]:
    """(language, text) of at most ROWS_A_LANGUAGE labelled sentences of each language, chosen by hash, and LANGUAGES times as many in all."""
    rows = seeds.where(F.col("language").isNotNull() & (F.trim("text") != "")).select("seed_id", "language", "text", F.xxhash64("seed_id").alias("h"))
    order = Window.partitionBy("language").orderBy("h", "seed_id", "text")
    placed = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= ROWS_A_LANGUAGE)
    # The first of every language, then the second, and so on: languages with few sentences are whole.
    chosen = placed.orderBy("n", "language").limit(LANGUAGES * ROWS_A_LANGUAGE).collect()
    # In the order of the hashes, so that neighbours are of all languages and any part of the list is a sample.
    return tuple((r.language, r.text) for r in sorted(chosen, key=lambda r: (r.h, r.seed_id, r.text)))
