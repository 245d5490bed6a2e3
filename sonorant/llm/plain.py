"""Plain lower-case words of a text, in one script, for comparing and counting words."""

from __future__ import annotations

import re
import unicodedata

from .p06_canonical import APOSTROPHES, LOOK_ALIKES

_SIGN = re.compile("[" + re.escape(APOSTROPHES.replace("'", "")) + "]")
_UNSEEN = {c: None for c in (0xAD, 0x34F, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2070), 0xFEFF, *range(0xFE00, 0xFE10))}
_LATIN = str.maketrans({o: latin for latin, others in LOOK_ALIKES.items() for o in others})
# A letter with both a Greek and a Cyrillic twin goes to the Cyrillic one, the first in its list.
_CYRILLIC = str.maketrans({
    **{latin: others[0] for latin, others in LOOK_ALIKES.items() if "\u0400" <= others[0] <= "\u052f"},
    **{o: others[0] for others in LOOK_ALIKES.values() for o in others if "\u0400" <= others[0] <= "\u052f"},
})
_ODD = re.compile(
    r"[\xa0\xad\u0300-\u03ff\u1680\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufb00-\ufb06\ufe00-\ufe0f\ufeff\uff00-\uffef]"
    r"|[A-Za-z][\u0400-\u04ff]|[\u0400-\u04ff][A-Za-z]"
)
_ONLY_LATIN = re.compile("[bdfghklmnrtuvwzqğışçöüDFGLNRUVWQ]")
_ONLY_CYRILLIC = re.compile("[бвгджзийклмнптфцчшщъыьэюяқғҳўңүұөәБГДЖЗИЙЛПФЦЧШЩЪЫЬЭЮЯ]")
_NOTES = re.compile(r"\[[^\[\]]*\]|\([^()]*\)|\{[^{}]*\}|<[^<>]*>")
_NOT_WORD = re.compile(r"[^\w]|_")


def plain(text: str) -> str:
    """Lower case without invisible characters, with one apostrophe, full-width and look-alike letters undone.

    Look-alikes become letters of the script that the text's other letters are
    of, before the case is dropped, so that capitals of either script agree.
    """
    if _SIGN.search(text):
        for sign in set(_SIGN.findall(text)):
            text = text.replace(sign, "'")
    if _ODD.search(text):
        text = unicodedata.normalize("NFKC", text.translate(_UNSEEN))
        latin = len(_ONLY_LATIN.findall(text))
        cyrillic = len(_ONLY_CYRILLIC.findall(text))
        text = text.translate(_CYRILLIC if cyrillic > latin else _LATIN)
        text = unicodedata.normalize("NFC", text)
    return text.lower().replace("i\u0307", "i")


def comparable_words(text: str) -> list[str]:
    """Words for comparing transcripts: no bracketed notes, no punctuation, dotted and dotless i alike."""
    spoken = _NOTES.sub(" ", plain(text)).replace("ı", "i")
    words = (_NOT_WORD.sub("", w) for w in spoken.split())
    return [w for w in words if w]
