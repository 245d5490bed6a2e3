"""Problem 10: pages of repeated keywords, link lists or product tags."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .kernel import LanguageModel, fit as fit_kernel, seed_rows
from .plain import plain

#: Seed sentences of its language a function word occurs in at least; calibrated upwards for each language.
FUNCTION_DF = 3
#: Share of a text that makes it spam.
SPAM_SHARE = 0.5
#: Words in a run at least before it can count, and in a window of a text without sentence ends.
RUN_WORDS, WINDOW = 8, 16
#: Share of function words, in units of the least of a sentence, below which a run lacks them (nearly all sentences have two or more).
MISSING = 0.75
#: Words of a run that is keywords for want of function words alone.
LONG_RUN = 24
#: Least bounds of the shares of repeated words (alone; with another sign), of repeated pairs and of separators a word, and of digits and
#: repeated lines. A language's own are higher where its prose comes near them: so many times what nearly all its prose stays under.
ALONE, REPEATED, PAIRED, DENSE, DIGITS, DOUBLED = 0.6, 0.35, 0.3, 0.15, 0.15, 0.3
ABOVE_PROSE = 1.25
#: Separators a word from which a run is a list in any language, and words of its units on average up to which it may be one.
LISTED, SHORT_UNIT = 0.3, 6
#: Where the language is not known: letters of words that its function words are among, their share in any prose, and letters of words on
#: average beyond which a script does not part words.
SHORT_LETTERS, SHORT_SHARE, UNPARTED = 3, 0.1, 14
#: Words in which repetitions of prose are counted.
STRETCH = 48
#: A window of a text without sentence ends needs so many times a sentence's least share of function words, which a list may reach by chance.
WINDOW_SHARE = 1.5
#: Labels of one page that may be speakers', and words each says on average where there are more than two.
SPEAKERS, SPOKEN_WORDS = 8, 3

_URL = re.compile(r"(?:https?://|www\.)[^\s<>\"')\]]+")
_TAG_CODE = re.compile(r"(?<=\w)-[a-z]?\d+\b")
_MARKUP = re.compile(r"</?[a-z][^<>]*>|[\[\]()]")
_LEAD = re.compile(r"^\s*(?:\[[\d:. ]+\]\s*)?(?:[^\W\d_]{2,20}:\s)?")
_LABEL = re.compile(r"[^\W\d_]{2,20}:\s")
_TOKEN = re.compile(r"[^\s,|/;•*»>·+]+")
_UNITS = re.compile(r"[^.!?…|;•\n]+[.!?…|;•]*")
_WORD = re.compile(r"[^\W\d_]+(?:['-][^\W\d_]+)*")
_SEPARATORS = re.compile(r"[,|/;•*»>#·+]")


@dataclass(frozen=True)
class ProseModel:
    """What prose looks like in each language: its function words, and how many different ones a sentence has."""

    words: dict[str, frozenset[str]]
    least: dict[str, float]  # different function words for each word of a sentence, calibrated
    languages_of: dict[str, tuple[str, ...]] = field(default_factory=dict)
    bounds: dict[str, tuple[float, float, float, float]] = field(default_factory=dict)  # ALONE, REPEATED, PAIRED and DENSE of a language, calibrated
    kernel: LanguageModel | None = None

    def language(self, words: list[str]) -> str | None:
        """The language of a run of words, null where it is none of those known: its function words are then unknown."""
        scores = self.kernel.of_texts([" ".join(words)])[0]
        return self.kernel.languages[int(scores.argmax())] if scores.max() >= self.kernel.bound else None

    def bounds_of(self, language: str | None) -> tuple[float, float, float, float]:
        """Of a language, or the highest of all where it is not known."""
        if language in self.bounds:
            return self.bounds[language]
        return tuple(max(x) for x in zip((ALONE, REPEATED, PAIRED, DENSE), *self.bounds.values()))


def _repeats(words: list[str]) -> tuple[float, float]:
    """Share of words that come three times, and of pairs that come twice, within stretches of STRETCH words."""
    repeated = paired = pairs = 0
    for i in range(0, len(words), STRETCH):
        part = words[i : i + STRETCH]
        repeated += sum(k for k in Counter(part).values() if k >= 3)
        both = Counter(zip(part, part[1:]))
        paired += sum(k for k in both.values() if k >= 2)
        pairs += len(part) - 1
    return repeated / max(1, len(words)), paired / max(1, pairs)


def _bounds(texts: list[str]) -> tuple[float, float, float, float]:
    """Bounds above the shares that stretches of a language's prose have."""
    each: tuple[list[float], ...] = ([], [], [])
    for turn in range(4):  # the same sentences in other company
        words: list[str] = []
        separators = 0
        for text in texts[turn::2] + texts[turn % 2 :: 2]:
            words += _WORD.findall(plain(text))
            separators += len(_SEPARATORS.findall(text))
            if len(words) >= STRETCH:
                repeated, paired = _repeats(words[:STRETCH])
                for out, x in zip(each, (repeated, paired, separators / len(words))):
                    out.append(x)
                words, separators = [], 0
    top = [sorted(x)[len(x) * 49 // 50] * ABOVE_PROSE if x else 0.0 for x in each]
    return max(ALONE, top[0]), max(REPEATED, top[0]), max(PAIRED, top[1]), max(DENSE, top[2])


@lru_cache(maxsize=4)
def fit(rows: tuple[tuple[str, str], ...]) -> ProseModel:
    """From clean sentences (language, text). The bound of a language is half of what nearly all its sentences reach."""
    sentences: dict[str, list[list[str]]] = {}
    for language, text in rows:
        if language and text:
            sentences.setdefault(language, []).append(_WORD.findall(plain(text)))
    words, least, of = {}, {}, {}
    for language, lists in sentences.items():
        df = Counter(w for ws in lists for w in set(ws))
        # The rarest words that still give nearly every sentence two of them; a sentence does not vouch for its own words.
        for cutoff in range(max(FUNCTION_DF, max(df.values(), default=0)), FUNCTION_DF - 1, -1):
            others = {w for w, n in df.items() if n > cutoff}
            hits = sorted((len(others.intersection(ws)), len(others.intersection(ws)) / max(1, len(ws))) for ws in lists)
            if hits[len(hits) // 50][0] >= 2:
                break
        cutoff = max(FUNCTION_DF, cutoff // 3)  # some rarer ones as well, for a margin
        others = {w for w, n in df.items() if n > cutoff}
        hits = sorted((len(others.intersection(ws)), len(others.intersection(ws)) / max(1, len(ws))) for ws in lists)
        words[language] = frozenset(w for w, n in df.items() if n >= cutoff)
        shares = sorted(share for _, share in hits)
        least[language] = min(0.2, max(0.05, shares[len(shares) // 50] / 2))
        for w in words[language]:
            of[w] = (*of.get(w, ()), language)
    texts: dict[str, list[str]] = {}
    for language, text in rows:
        if language and text:
            texts.setdefault(language, []).append(text)
    return ProseModel(words, least, of, {language: _bounds(own) for language, own in texts.items()}, fit_kernel(rows))


def features(text: str | None, model: ProseModel) -> dict:
    """Shares of a text's visible characters: in links, in keyword runs, in prose.

    Lines with links count as links unless a sentence stands beside them. The
    rest is cut into units; a unit is prose if it has enough different function
    words of one language for its length, calibrated on that language's
    sentences. Neighbouring other units form a run, and a run is keywords if
    its most repeated words make up most of it, if it lacks function words, or
    if words repeat along with word pairs or whole units or among dense
    separators, codes and numbers. In a language that the seeds do not hold
    the function words are not known: there want of short words stands for want
    of them, and repetitions are counted within stretches of words. Repeated sentences are prose however
    often they come, and replies under speakers' labels are speech; labels of
    attributes are words as any others. A run of few words counts if it is the
    page and made of hash tags or codes.
    """
    out = {"total": 0, "links": 0, "keywords": 0, "prose": 0}
    if not text:
        return out
    runs: list[list] = []  # [characters, words, separators, digits, units, labels with their words]
    said: Counter = Counter()  # units and words under each label that may be a speaker's
    turns: Counter = Counter()
    open_run: list | None = None
    shown = plain(text)
    has_links = "http" in shown or "www." in shown
    for line in shown.split("\n"):
        size = len(line) - line.count(" ")
        if not size:
            continue
        out["total"] += size
        if has_links and (links := _URL.findall(line)):
            rest = _MARKUP.sub(" ", _URL.sub(" ", line))
            words = _WORD.findall(rest)
            linked = min(size, sum(map(len, links)))
            if len(words) > 6 and _prose(words, model):
                out["links"] += linked
                out["prose"] += size - linked
            elif len(words) > 12 * len(links):
                # Many words beside few links are judged as a run of words.
                out["links"] += linked
                runs.append([size - linked, words, len(_SEPARATORS.findall(rest)), 0, [rest], []])
            else:
                out["links"] += size
            continue
        listed = False  # whether a separator other than a sentence's end came before
        for unit, share in _windows(_UNITS.findall(line)):
            before, listed = listed, unit.rstrip()[-1:] in ("|", ";", "•")
            chars = len(unit) - unit.count(" ")
            tags = 2 * unit.count("#") >= max(1, len(unit.split()))
            if not tags and _prose(unit.split(), model, share):
                out["prose"] += chars
                open_run = None
                continue
            lead = _LEAD.match(unit)
            words = _WORD.findall(_TAG_CODE.sub("", unit[lead.end() :]))
            label = lead[0].rstrip().rpartition("]")[2].strip()
            label = label[:-1] if label.endswith(":") else ""
            attribute = bool(label) and (before or listed or len(_LABEL.findall(unit)) > 1)
            if label and not attribute:
                turns[label] += 1
                said[label] += len(words)
            if not tags and _prose(words, model, share):
                out["prose"] += chars
                open_run = None
                continue
            if open_run is None:
                open_run = [0, [], 0, 0, [], []]
                runs.append(open_run)
            open_run[0] += chars
            open_run[1] += words
            open_run[2] += len(_SEPARATORS.findall(unit))
            open_run[3] += sum(map(str.isdigit, unit))
            open_run[4].append(unit.strip())
            if label:
                open_run[5].append((label, attribute))
    if not runs:
        return out
    dialogue = len(turns) <= 2 or len(turns) <= SPEAKERS and sum(said.values()) >= SPOKEN_WORDS * sum(turns.values())
    for r in runs:
        spoken = sum(dialogue and not attribute for _, attribute in r[5])
        if 2 * spoken <= len(r[4]):
            r[1] += [label for label, attribute in r[5] if attribute or not dialogue]
        r[5] = spoken
    counts = Counter(w for r in runs for w in r[1])
    for chars, words, separators, digits, units, spoken in runs:
        n = len(words)
        if 2 * spoken > len(units):
            continue
        if n < RUN_WORDS:
            if 10 * chars >= 9 * out["total"] and _tags(units):
                out["keywords"] += chars
            continue
        own = Counter(words)
        hashes = sum(u.count("#") for u in units)
        digital = digits / max(1, chars) >= DIGITS
        short = n <= SHORT_UNIT * len(units)
        listed = separators >= LISTED * n or short and digital
        repeated = sum(k for w, k in own.items() if counts[w] >= 3) / n
        if 2 * hashes >= n or (short or listed) and repeated >= model.bounds_of(None)[0]:
            out["keywords"] += chars  # in whatever language
            continue
        language = model.language(words)
        alone, some, pairwise, often = model.bounds_of(language)
        if language is None and not listed and not short:
            # Long sentences without a known function word: prose of another language as well as words strung together.
            repeated, paired = _repeats(words)
        else:
            pairs = Counter(zip(words, words[1:]))
            paired = sum(k for k in pairs.values() if k >= 2) / (n - 1)
        doubled = 1 - len(set(units)) / len(units)
        dense = separators / n >= often or digital
        missing = _function_share(own, n, model) < MISSING if language is not None or listed else _no_short_words(words)
        bare = (dense or n >= LONG_RUN) and missing
        if repeated >= alone or bare or (repeated >= some and (dense or paired >= pairwise or doubled >= DOUBLED)):
            out["keywords"] += chars
    return out


def _tags(units: list[str]) -> bool:
    """Whether nearly all of a short page are hash tags (three at least) or codes with digits (as many as a run's words)."""
    tokens = [t for u in units for t in _TOKEN.findall(u)]
    hashes = sum(t.startswith("#") for t in tokens)
    codes = sum(not t.startswith("#") and any(map(str.isdigit, t)) for t in tokens)
    return 4 * (hashes + codes) >= 3 * len(tokens) and (hashes >= 3 or hashes + codes >= RUN_WORDS)


def _windows(units: list[str]) -> list[tuple[str, float]]:
    """Units as they are, very long ones (text without sentence ends) in windows; with how much prose they must show."""
    out = []
    for unit in units:
        if len(unit) > 160 and len(words := unit.split()) > 24:
            out += [(" ".join(words[i : i + WINDOW]), WINDOW_SHARE) for i in range(0, len(words), WINDOW)]
        else:
            out.append((unit, 1.0))
    return out


def _no_short_words(words: list[str]) -> bool:
    """Whether a run in no known language lacks function words: in any language with spaces many of them are short.

    Different words count, within stretches, so that one short keyword makes no prose.
    """
    short = different = 0
    for i in range(0, len(words), STRETCH):
        part = set(words[i : i + STRETCH])
        short += sum(len(w) <= SHORT_LETTERS for w in part)
        different += len(part)
    return short < SHORT_SHARE * different and sum(map(len, words)) <= UNPARTED * len(words)


def _function_share(own: Counter, n: int, model: ProseModel) -> float:
    """Share of function words in a run, in units of the least share of a sentence; the best language counts."""
    found: Counter = Counter()
    for w, k in own.items():
        for language in model.languages_of.get(w, ()):
            found[language] += k
    return max((k / n / model.least[language] for language, k in found.items()), default=0.0)


def _prose(words: list[str], model: ProseModel, share: float = 1.0) -> bool:
    n = len(words)
    if n < 3:
        return False
    found: dict[str, int] = {}
    of = model.languages_of
    for w in set(words):
        if w in of:
            for language in of[w]:
                found[language] = found.get(language, 0) + 1
    return any(k >= 2 and k >= n * share * model.least[language] for language, k in found.items())


def spam_share(text: str | None, model: ProseModel) -> float:
    f = features(text, model)
    return (f["links"] + f["keywords"]) / f["total"] if f["total"] else 0.0


def spam_shares(documents: DataFrame, seeds: DataFrame) -> DataFrame:
    """(doc_id, share): the share of each text that is keywords, links or tags; 0 for null and blank texts.

    A map over Arrow batches with the small fitted model as a broadcast; whole
    texts, no shuffle. Repeated rows come out repeated.
    """
    model = documents.sparkSession.sparkContext.broadcast(fit(seed_rows(seeds)))

    def run(batches):
        fitted = model.value
        for batch in batches:
            shares = pa.array([spam_share(t, fitted) for t in batch.column(1).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), shares], names=["k", "share"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    out = documents.select(F.col("doc_id").alias("k"), F.col("text").cast("string").alias("t"))
    return out.mapInArrow(run, f"k {kind}, share double").select(F.col("k").alias("doc_id"), "share")


def spam(documents: DataFrame, seeds: DataFrame) -> DataFrame:
    """(doc_id) of the documents of which more than half of the text is keywords, links or tags."""
    return spam_shares(documents, seeds).where(F.col("share") > SPAM_SHARE).select("doc_id")
