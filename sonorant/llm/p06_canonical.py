"""Problem 6: one form for texts that look the same."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..runtime import cut

# Letters of other scripts that look like a Latin one, each under the letter it looks like. Cyrillic and Greek come first;
# then Armenian, Cherokee, Coptic, Lisu and phonetic letters.
LOOK_ALIKES = {
    "A": "АΑᎪⲀꓮ", "B": "ВΒᏴⲂꓐ", "C": "СϹᏟⲤꓚ", "D": "Ꭰꓓᗞ", "E": "ЕΕᎬⲈꓰ", "F": "ꓝ", "G": "ᏀꓖԌ", "H": "НΗᎻⲎꓧ", "I": "ІΙӀᏆⲒꓲ", "J": "ЈͿᎫꓙ",
    "K": "КΚᏦⲔꓗ", "L": "ᏞԼꓡ", "M": "МΜᎷⲘꓟ", "N": "ΝⲚꓠ", "O": "ОΟՕⲞꓳ", "P": "РΡᏢⲢꓑ", "Q": "Ԛ", "R": "ᎡᏒꓣ", "S": "ЅՏᏚꓢ", "T": "ТΤᎢⲦꓔ", "U": "Սꓴ",
    "V": "ᏙꓦѴ", "W": "ԜᎳꓪ", "X": "ХΧⲬꓫ", "Y": "УΥҮⲨꓬ", "Z": "ΖᏃꓜ",
    "a": "аɑ", "c": "сϲⲥ", "d": "ԁ", "e": "е", "g": "ɡց", "h": "һհ", "i": "і", "j": "јϳ", "l": "ӏ", "o": "оοօⲟ", "p": "рρⲣ", "q": "ԛզ",
    "s": "ѕꜱ", "u": "ս", "v": "νѵᴠ", "w": "ԝᴡ", "x": "х", "y": "у", "z": "ᴢ", "Ə": "Ә", "ə": "ә",
}
# Signs read as an apostrophe.
APOSTROPHES = "'`´ʹʻʼʽˈˊˋ‘’‛′‵＇｀ꞌ՚׳"
HYPHENS = "‐‑"
# Kinds of compatibility mapping that keep the look of a character.
SAME_LOOK = ("<wide>", "<narrow>", "<compat>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>")
# Characters without ink that no category tells.
UNSEEN = (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0))
#: Characters handled at once, which bounds a worker's memory.
BLOCK = 1_000_000

DROP, MANY = -1, -2


def _visible(ch: str) -> str:
    """What a character becomes before its marks are ordered: decomposed, blanks as spaces, look-alikes as Latin."""
    if ch in APOSTROPHES:
        return "'"
    if ch in HYPHENS:
        return "-"
    code, kind = ord(ch), unicodedata.category(ch)
    if kind in ("Zs", "Zl", "Zp") or ch in "\t\n\v\f\r\x85⠀":
        return " "
    if kind in ("Cf", "Cc") or code in UNSEEN:
        return ""
    parts = unicodedata.decomposition(ch).split()
    if parts and (parts[0][0] != "<" or parts[0] in SAME_LOOK):
        return "".join(_visible(chr(int(p, 16))) for p in parts if p[0] != "<")
    return _LATIN.get(ch, ch)


_LATIN = {other: latin for latin, others in LOOK_ALIKES.items() for other in others}


@lru_cache(maxsize=1)
def tables():
    """The mappings as arrays by code point, made by rule from the Unicode data. Size: that of Unicode, whatever the corpus."""
    top = sys.maxunicode + 1
    one = np.arange(top, dtype=np.int32)
    order = np.zeros(top, np.uint8)
    many: list[np.ndarray] = []
    pairs: dict[int, int] = {}
    # Ideographs, Hangul, surrogates and private use stand for themselves.
    ranges = ((0, 0x3400), (0xA000, 0xAC00), (0xF900, 0x20000), (0x2F800, 0x2FA20), (0xE0000, 0xE0200))
    special = {*APOSTROPHES, *HYPHENS, *_LATIN, "⠀", *map(chr, UNSEEN)}
    for code in (c for low, high in ranges for c in range(low, high)):
        ch = chr(code)
        kind, parts = unicodedata.category(ch), unicodedata.decomposition(ch).split()
        if not parts and kind[0] not in "ZCM" and ch not in special:
            continue
        order[code] = unicodedata.combining(ch)
        out = _visible(ch)
        if out == "":
            one[code] = DROP
        elif len(out) == 1:
            one[code] = ord(out)
        else:
            one[code] = MANY - len(many)
            many.append(np.array([ord(c) for c in out], np.int32))
        if len(parts) == 2 and parts[0][0] != "<" and unicodedata.normalize("NFC", ch) == ch:
            base, mark = (int(p, 16) for p in parts)
            base = ord(_LATIN.get(chr(base), chr(base)))
            pairs.setdefault((base << 21) | mark, ord(_LATIN.get(ch, ch)))
    keys = np.array(sorted(pairs), np.int64)
    return one, order, many, keys, np.array([pairs[k] for k in keys.tolist()], np.int32)


def _canonical_block(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in canonical form, and where each text ends."""
    one, order, many, keys, composed = tables()
    lengths = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    # Decomposition and look-alikes: every positioned code point meets its mapping.
    mapped = one[points]
    if (special := mapped < 0).any():
        size = np.ones(len(mapped), np.int64)
        size[mapped == DROP] = 0
        wide = np.flatnonzero(mapped <= MANY)
        size[wide] = [len(many[MANY - m]) for m in mapped[wide].tolist()]
        starts = np.cumsum(size) - size
        out = np.empty(int(size.sum()), np.int32)
        plain = np.flatnonzero(~special)
        out[starts[plain]] = mapped[plain]
        for at, m in zip(starts[wide].tolist(), mapped[wide].tolist()):
            seq = many[MANY - m]
            out[at : at + len(seq)] = seq
        mapped, owner = out, np.repeat(owner, size)
    # Combining marks in the order of their classes.
    ccc = order[mapped]
    if ccc.any():
        same = owner[1:] == owner[:-1]
        while True:
            swap = np.flatnonzero((ccc[:-1] > ccc[1:]) & (ccc[1:] > 0) & same)
            if not len(swap):
                break
            swap = swap[np.concatenate(([True], np.diff(swap) > 1))]
            for a in (mapped, ccc):
                a[swap], a[swap + 1] = a[swap + 1].copy(), a[swap].copy()
        # Recomposition: each mark that nothing blocks joins its base, the first mark of a base first.
        while True:
            index = np.arange(len(mapped))
            base = np.maximum.accumulate(np.where(ccc == 0, index, -1))
            marks = np.flatnonzero((ccc > 0) & (base >= 0))
            marks = marks[owner[base[marks]] == owner[marks]]
            before = ccc[marks - 1]
            marks = marks[(base[marks] == marks - 1) | (before < ccc[marks])]
            if not len(marks) or not len(keys):
                break
            wanted = (mapped[base[marks]].astype(np.int64) << 21) | mapped[marks]
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = keys[at] == wanted
            marks, at = marks[hit], at[hit]
            if not len(marks):
                break
            bases, first = np.unique(base[marks], return_index=True)
            mapped[bases] = composed[at[first]]
            keep = np.ones(len(mapped), bool)
            keep[marks[first]] = False
            mapped, owner, ccc = mapped[keep], owner[keep], ccc[keep]
    # Runs of blanks count as one, those at the ends as none.
    blank = mapped == 32
    if len(mapped):
        starts = np.concatenate(([True], owner[1:] != owner[:-1]))
        ends = np.concatenate((owner[1:] != owner[:-1], [True]))
        after_blank = np.concatenate(([False], blank[:-1])) & ~starts
        drop = blank & (starts | ends | after_blank)
        # A run at the end of a text keeps one blank in front of the dropped last one; cut it as well.
        last = np.flatnonzero(blank & ends & ~starts)
        while len(last):
            last = last[last > 0] - 1
            last = last[blank[last] & (owner[last] == owner[last + 1])]
            drop[last] = True
        mapped, owner = mapped[~drop], owner[~drop]
    return mapped, np.cumsum(np.bincount(owner, minlength=len(texts))) if len(texts) else np.zeros(0, np.int64)


def _blocks(texts: list[str | None]):
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= BLOCK:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def canonical_texts(texts: list[str | None]) -> list[str | None]:
    """The canonical form of each text; null stays null."""
    out: list[str | None] = []
    for a, b in _blocks(texts):
        points, ends = _canonical_block([t or "" for t in texts[a:b]])
        whole = points.astype("<u4").tobytes()
        at = 0
        for t, end in zip(texts[a:b], ends.tolist()):
            out.append(None if t is None else whole[4 * at : 4 * end].decode("utf-32-le", "surrogatepass"))
            at = end
    return out


def canonical_keys(texts: list[str | None]) -> list[bytes | None]:
    """16-byte digests of the canonical forms; null for null and for texts that show nothing."""
    out: list[bytes | None] = []
    for a, b in _blocks(texts):
        points, ends = _canonical_block([t or "" for t in texts[a:b]])
        whole = memoryview(points.astype("<u4").tobytes())
        at = 0
        for end in ends.tolist():
            out.append(blake2b(whole[4 * at : 4 * end], digest_size=16).digest() if end > at else None)
            at = end
    return out


def canonicalize(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, text): every text in its canonical form, in which texts that look the same are equal.

    Full and normal width, all kinds of blank (runs as one), invisible
    characters, composed and decomposed letters, ligatures, look-alike letters
    and apostrophe-like signs become one; letter case, digits, marks and signs
    stay. Null stays null, a blank text is empty. Explode, mapping join, mark
    order, recomposition and rebuild run on arrays of code points inside each
    Arrow batch, with the mappings as arrays over Unicode, so nothing is
    shuffled and no text is cut.
    """

    def run(batches):
        for batch in batches:
            texts = pa.array(canonical_texts(batch.column(1).to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], names=["k", "text"])

    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).mapInArrow(run, f"k {kind}, text string")
    return out.select(F.col("k").alias(key), "text")


def look_keys(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, look, raw): digests of the canonical and of the stored text; texts that show nothing are left out."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            raw = [blake2b((t or "").encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in texts]
            columns = [batch.column(0), pa.array(canonical_keys(texts), pa.binary()), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["k", "look", "raw"])

    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).mapInArrow(run, f"k {kind}, look binary, raw binary")
    return out.where(F.col("look").isNotNull()).select(F.col("k").alias(key), "look", "raw")


def same_looking_pairs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_lo, doc_hi): pairs of rows whose texts differ as strings but look the same, smaller id first.

    Pairs are formed between the distinct strings of a look, of which there are
    few, and only then joined to their rows: copies of one string, however many,
    never meet each other. Null and blank texts do not count.
    """
    rows = cut(look_keys(df, key, text).withColumnRenamed(key, "id").where(F.col("id").isNotNull()))
    looks = rows.groupBy("look").agg(F.min("raw").alias("a"), F.max("raw").alias("b")).where(F.col("a") != F.col("b")).select("look")
    members = rows.join(looks, "look").select("look", "raw", "id").distinct()
    variants = members.select("look", "raw").distinct()
    pairs = (
        variants.alias("x").join(variants.alias("y"), "look").where(F.col("x.raw") < F.col("y.raw"))
        .select("look", F.col("x.raw").alias("ra"), F.col("y.raw").alias("rb"))
    )
    left = members.select("look", F.col("raw").alias("ra"), F.col("id").alias("ia"))
    right = members.select("look", F.col("raw").alias("rb"), F.col("id").alias("ib"))
    both = pairs.join(left, ["look", "ra"]).join(right, ["look", "rb"])
    return both.select(F.least("ia", "ib").alias("doc_lo"), F.greatest("ia", "ib").alias("doc_hi"))
