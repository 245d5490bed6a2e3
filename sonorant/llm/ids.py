"""One spelling for audio ids, speakers, splits and language labels, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Spellings that name no speaker.
NO_SPEAKER = ("", "-", "--", "?", "??", "n/a", "na", "nan", "nil", "none", "null", "unk", "unknown",
              "spk_unknown", "spk_unk", "spk_none", "speaker_unknown", "no_speaker", "anonymous")

# Spellings of the language labels.
LANGUAGE_LABELS = {
    "uz": ("uz", "uzb", "uzn", "uzbek", "o'zbek", "ozbek", "o'zbekcha", "ўзбек", "узбекский"),
    "ru": ("ru", "rus", "russian", "русский"),
    "en": ("en", "eng", "english"),
    "kk": ("kk", "kaz", "kazakh", "kz", "қазақ", "қазақша", "казахский"),
    "tr": ("tr", "tur", "turkish", "türkçe", "turkce"),
}

#: Blanks and invisible characters.
BLANKS = "\t\n\v\f\r \xa0\xad\u1680\u3000\ufeff" + "".join(
    chr(c) for low, high in ((0x2000, 0x200F), (0x2028, 0x202F), (0x205F, 0x2064)) for c in range(low, high + 1))


def tidy(value: Column) -> Column:
    """Lower case, without blanks and invisible characters at the ends."""
    return F.lower(F.btrim(value.cast("string"), F.lit(BLANKS)))


def clip_key(audio_id: Column) -> Column:
    """The clip an audio id names, however it is written: no folder, no file ending, lower case; null if blank."""
    name = F.substring_index(F.translate(tidy(audio_id), "\\", "/"), "/", -1)
    name = tidy(F.regexp_replace(name, r"\.(wav|flac|mp3|ogg|opus|m4a)$", ""))
    return F.nullif(name, F.lit(""))


RECORDING = r"^([a-z][a-z_]*?)[_-]([0-9a-f]{6,})(?:[_.-].*)?$"


def recording_key(audio_id: Column) -> Column:
    """The source recording a clip id names (collection and number); the clip key itself where the layout is unknown."""
    return F.regexp_replace(clip_key(audio_id), RECORDING, "$1_$2")


def speaker_key(speaker: Column) -> Column:
    """A real speaker in one spelling, else null."""
    name = tidy(speaker)
    return F.when(~name.isin(*NO_SPEAKER), name)


def split_name(split: Column) -> Column:
    """train, val or test for any spelling; null where none is named."""
    name = tidy(split)
    return (
        F.when(name.contains("train"), "train")
        .when(name.contains("test"), "test")
        .when(name.rlike("dev|val"), "val")
    )


def language_code(label: Column) -> Column:
    """The language a label names, null where it names none of the five."""
    name = F.regexp_replace(tidy(label), "[\u2018\u2019\u02bb\u02bc`\xb4]", "'")
    base = F.regexp_extract(name, "^([^_-]+)", 1)
    out = None
    for code, spellings in LANGUAGE_LABELS.items():
        hit = base.isin(*spellings)
        out = F.when(hit, code) if out is None else out.when(hit, code)
    return out
