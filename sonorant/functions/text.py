"""Transcript normalisation as column expressions; only NFKC leaves the JVM, and only for texts that are not ASCII."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from ..config import TextNormalization

# Characters replaced one by one, and what replaces them.
MAPPED = "\u00a0ʻʼ’‘`´ʹ“”„«»–—−"
REPLACED = " '''''''\"\"\"\"\"---"
# Bracketed notes, punctuation, and the letters and digits an apostrophe may stand between.
BRACKETED = r"\[[^\]]*\]|\([^)]*\)|\{[^}]*\}"
PUNCTUATION = r"""[!"#$%&()*+,./:;<=>?@\[\]^_`{|}~\\«»“”„…-]"""
WORD = "0-9A-Za-zА-Яа-яЁёЎўҚқҒғҲҳ"
STRAY_APOSTROPHE = f"(?<![{WORD}])'|'(?![{WORD}])"
BLANK = r"(?U)[\s\x1c-\x1f]+"


@F.pandas_udf(T.StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def normalize_text(text: Column, config: TextNormalization = TextNormalization()) -> Column:
    """The text without case, notes, punctuation, stray apostrophes and doubled blanks; null stays null."""
    if config.normalize_unicode:
        foreign = F.when(text.rlike(r"[^\x00-\x7f]"), text)
        text = F.coalesce(nfkc(foreign), text)
    text = F.translate(text, MAPPED, REPLACED)
    if config.lowercase:
        text = F.lower(text)
    if config.remove_bracketed_text:
        text = F.regexp_replace(text, BRACKETED, " ")
    if config.remove_numbers:
        text = F.regexp_replace(text, r"(?U)\d+", " ")
    text = F.regexp_replace(text, PUNCTUATION, " ")
    text = F.regexp_replace(text, STRAY_APOSTROPHE if config.keep_word_apostrophe else "'", " ")
    return F.trim(F.regexp_replace(text, BLANK, " "))
