"""Quality and transcript gates: every failed reason, in a fixed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import QualityGates, TextGates


def _over(value: Column, bound: float) -> Column:
    """NaN passes a gate, as null does."""
    return (value > bound) & ~F.isnan(value)


def _reasons(*pairs: tuple[Column, str]) -> list[Column]:
    return [F.when(condition, F.lit(name)) for condition, name in pairs]


def quality_reasons(duration: Column, sample_rate: Column, q: Column, o: Column, m: Column, gates: QualityGates) -> list[Column]:
    """One nullable string for each gate; q, o and m are the feature structs of a clip."""
    out: list[Column] = []
    ok = {}
    for name, feature, required in (("quality", q, gates.require_quality), ("overlap", o, gates.require_overlap), ("music", m, gates.require_music)):
        ok[name] = F.coalesce(feature["status"] == "ok", F.lit(False))
        if required:
            out.append(F.when(~ok[name], F.when(feature.isNull(), F.lit(f"missing_{name}")).otherwise(F.lit(f"{name}_error"))))
    out += _reasons(
        (duration.isNull(), "missing_duration"),
        (duration < gates.min_duration, "duration_too_short"),
        (_over(duration, gates.max_duration), "duration_too_long"),
    )
    if gates.require_sample_rate_match:
        out += _reasons((sample_rate != gates.target_sample_rate, "sample_rate_mismatch"))
    rms, snr = q["rms_dbfs"], q["snr_estimate_db"]
    out += _reasons(
        (ok["quality"] & _over(q["clipping_ratio"], gates.max_clipping_ratio), "clipping"),
        (ok["quality"] & _over(q["silence_ratio"], gates.max_silence_ratio), "silence"),
        (ok["quality"] & ((rms < gates.min_rms_dbfs) | _over(rms, gates.max_rms_dbfs)), "rms_out_of_range"),
    )
    out.append(F.when(ok["quality"], F.when(snr.isNull(), F.lit("snr_missing")).when(snr < gates.min_snr_db, F.lit("low_snr"))))
    out += _reasons(
        (ok["quality"] & _over(q["dc_offset_mean_abs"], gates.max_dc_offset), "dc_offset"),
        (ok["overlap"] & _over(o["overlap_ratio"], gates.max_overlap_ratio), "overlap"),
    )
    if gates.drop_music:
        out += _reasons((ok["music"] & m["is_music"].eqNullSafe(True), "music"))
    return out


def text_reasons(text: Column, clean: Column, duration: Column, gates: TextGates = TextGates()) -> list[Column]:
    """Missing and empty texts stand alone; others by characters a second of their normalised text `clean`.

    Give `clean` as a column computed before, so that it is not computed once
    for every reason.
    """
    if not gates.require_text:
        return []
    rate = F.when(duration > 0, F.length(clean) / duration)
    present = text.isNotNull() & (clean != "")
    return [
        F.when(text.isNull(), F.lit("missing_text")).when(clean == "", F.lit("empty_text")),
        F.when(present & (rate < gates.min_chars_per_second), F.lit("text_too_sparse")),
        F.when(present & _over(rate, gates.max_chars_per_second), F.lit("text_too_dense")),
    ]


def language_reason(language: Column, allowed: tuple[str, ...] | None) -> list[Column]:
    """No list means no filter; with one, a missing language is rejected."""
    if not allowed:
        return []
    return [F.when(~F.coalesce(language.isin(*allowed), F.lit(False)), F.lit("language"))]


def all_reasons(*groups: list[Column]) -> Column:
    """array<string> of the failed gates, in order; empty where all pass. Nothing is short-circuited."""
    columns = [c for g in groups for c in g]
    return F.array_compact(F.array(*columns)) if columns else F.array().cast("array<string>")


def histogram(rejected: DataFrame, reasons: str = "reject_reasons") -> DataFrame:
    """(reason, n): a row counts in each of its reasons."""
    return rejected.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))
