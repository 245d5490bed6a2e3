"""The same queries in DuckDB's SQL."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from ..functions.text import BRACKETED, MAPPED, PUNCTUATION, REPLACED, WORD


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _normalized(column: str, lower: bool = True, brackets: bool = True, numbers: bool = False, apostrophes: bool = True) -> str:
    x = f"translate({column}, {_quoted(MAPPED)}, {_quoted(REPLACED)})"
    sub = lambda x, p, r: f"regexp_replace({x}, {_quoted(p)}, {_quoted(r)}, 'g')"
    if lower:
        x = f"lower({x})"
    if brackets:
        x = sub(x, BRACKETED, " ")
    if numbers:
        x = sub(x, r"\p{Nd}+", " ")
    x = sub(x, PUNCTUATION, " ")
    if apostrophes:
        # The pattern language has no look-around: doubled ones first, then those without a letter before or after.
        x = sub(sub(sub(x, "''+", " "), f"(^|[^{WORD}])'", r"\1 "), f"'($|[^{WORD}])", r" \1")
    else:
        x = sub(x, "'", " ")
    return f"trim({sub(x, r'[\s\p{Z}\x{1c}-\x{1f}\x{85}\x{0b}]+', ' ')})"


_LAST_Q = """SELECT * FROM quality_features WHERE audio_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY audio_id ORDER BY computed_at DESC) = 1"""
_LAST_O = """SELECT * FROM overlap_features WHERE audio_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY audio_id ORDER BY computed_at DESC) = 1"""

_FEATURES = f"""
q AS ({_LAST_Q}), o AS ({_LAST_O}),
rolled AS (SELECT l_orderkey AS clip, max(l_discount * 10 + 0.0::DOUBLE) >= 0.95::DOUBLE AS is_music FROM lineitem GROUP BY 1),
m AS (SELECT audio_id, CASE WHEN clip % 20 = 0 THEN 'error' ELSE 'ok' END AS status, is_music FROM q JOIN rolled ON source_line_number = clip)
"""


def _reasons(low: str, silence: str, snr: str, overlap: str, required: bool, text: str, languages: str) -> str:
    """List of the failed gates over joined rows with columns q_*, o_*, m_* and the clip's own."""
    missing = """
      CASE WHEN NOT coalesce(q_status = 'ok', false) THEN CASE WHEN q_id IS NULL THEN 'missing_quality' ELSE 'quality_error' END END,
      CASE WHEN NOT coalesce(o_status = 'ok', false) THEN CASE WHEN o_id IS NULL THEN 'missing_overlap' ELSE 'overlap_error' END END,
      CASE WHEN NOT coalesce(m_status = 'ok', false) THEN CASE WHEN m_id IS NULL THEN 'missing_music' ELSE 'music_error' END END,"""
    return f"""list_filter([{missing if required else ''}
      CASE WHEN duration IS NULL THEN 'missing_duration' END,
      CASE WHEN duration < {low}::DOUBLE THEN 'duration_too_short' END,
      CASE WHEN duration > 30 AND NOT isnan(duration) THEN 'duration_too_long' END,
      CASE WHEN sample_rate <> 16000 THEN 'sample_rate_mismatch' END,
      CASE WHEN q_status = 'ok' AND clipping_ratio > 0.005::DOUBLE AND NOT isnan(clipping_ratio) THEN 'clipping' END,
      CASE WHEN q_status = 'ok' AND silence_ratio > {silence}::DOUBLE AND NOT isnan(silence_ratio) THEN 'silence' END,
      CASE WHEN q_status = 'ok' AND (rms_dbfs < -40 OR rms_dbfs > -8 AND NOT isnan(rms_dbfs)) THEN 'rms_out_of_range' END,
      CASE WHEN q_status = 'ok' THEN CASE WHEN snr IS NULL THEN 'snr_missing' WHEN snr < {snr} THEN 'low_snr' END END,
      CASE WHEN q_status = 'ok' AND dc > 0.01::DOUBLE AND NOT isnan(dc) THEN 'dc_offset' END,
      CASE WHEN o_status = 'ok' AND overlap_ratio > {overlap}::DOUBLE AND NOT isnan(overlap_ratio) THEN 'overlap' END,
      CASE WHEN m_status = 'ok' AND coalesce(is_music, false) THEN 'music' END,
      {text}
      {f"CASE WHEN NOT coalesce(language IN ({languages}), false) THEN 'language' END" if languages else 'NULL'}
    ], lambda x: x IS NOT NULL)"""


def _joined(rows: str) -> str:
    return f"""SELECT s.*, q.audio_id AS q_id, q.status AS q_status, q.clipping_ratio, q.silence_ratio, q.rms_dbfs, q.snr_estimate_db AS snr,
         q.dc_offset_mean_abs AS dc, q.quality_score AS score, o.audio_id AS o_id, o.status AS o_status, o.overlap_ratio,
         m.audio_id AS m_id, m.status AS m_status, m.is_music
  FROM ({rows}) s LEFT JOIN q ON s.audio_id = q.audio_id LEFT JOIN o ON s.audio_id = o.audio_id LEFT JOIN m ON s.audio_id = m.audio_id"""


_SSL = f"""{_FEATURES},
j AS ({_joined("SELECT audio_id, delivered_at, duration, sample_rate, language, dataset, source_audio_id FROM ssl_candidates")}),
r AS (
  SELECT *, coalesce(q_status = 'ok', false) AS qk, coalesce(o_status = 'ok', false) AS ok,
    {_reasons('3', '0.5', '8', '0.15', True, '', "'uz', 'ru'")} AS reasons
  FROM j)
"""
@lru_cache(maxsize=1)
def _compatible() -> str:
    """Rows (c, t): each character with a compatibility form and that form. Composing what replaces them gives NFKC."""
    pairs = []
    for code in range(0x80, sys.maxunicode + 1):
        if not 0xAC00 <= code <= 0xD7A3 and not 0xD800 <= code <= 0xDFFF:
            c = chr(code)
            if (t := unicodedata.normalize("NFKC", c)) != unicodedata.normalize("NFC", c):
                pairs.append(f"({_quoted(c)},{_quoted(t)})")
    return ",".join(pairs)


#: lines: the labeled manifest with its texts under NFKC. Only texts with such a character are taken apart.
_NFKC = f"""compatible(c, t) AS MATERIALIZED (SELECT * FROM (VALUES {_compatible()}) x(c, t)),
  parts AS MATERIALIZED (SELECT line_number, unnest(regexp_extract_all(text, '(?s).')) AS c, generate_subscripts(regexp_extract_all(text, '(?s).'), 1) AS i
    FROM labeled_manifest WHERE regexp_matches(text, '[^\\x00-\\x7f]')),
  changed AS MATERIALIZED (SELECT line_number, string_agg(coalesce(t, p.c), '' ORDER BY i) AS k FROM parts p LEFT JOIN compatible USING (c)
    GROUP BY line_number HAVING bool_or(t IS NOT NULL)),
  lines AS MATERIALIZED (SELECT m.* REPLACE (nfc_normalize(coalesce(k, text)) AS text) FROM labeled_manifest m LEFT JOIN changed USING (line_number))"""


def _number(column: str) -> str:
    """NaN as null."""
    return f"CASE WHEN isnan({column}) THEN NULL ELSE {column} END"


_CLEAN = _normalized("text")
_SECONDS = "coalesce(CASE WHEN isnan(duration) THEN 0 ELSE duration END, 0)"

_SPLIT = """
k AS (SELECT *, coalesce(language, 'None') AS k1, coalesce(dataset, 'None') AS k2, coalesce(speaker_id, 'None') AS g FROM base),
g AS (SELECT k1, k2, g, count(*) AS n, ('0x' || substr(sha256('s1|' || g), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0 AS h FROM k GROUP BY ALL),
p AS (SELECT *, sum(n) OVER (PARTITION BY k1, k2 ORDER BY h, g ROWS UNBOUNDED PRECEDING) - n AS acc, sum(n) OVER (PARTITION BY k1, k2) AS total FROM g),
a AS (
  SELECT k.*, CASE WHEN (acc + acc + n)::DOUBLE / 2.0::DOUBLE / total::DOUBLE < 0.8::DOUBLE THEN 'train'
                   WHEN (acc + acc + n)::DOUBLE / 2.0::DOUBLE / total::DOUBLE < 0.8::DOUBLE + 0.1::DOUBLE THEN 'val' ELSE 'test' END AS new_split
  FROM k JOIN p USING (k1, k2, g))
"""

_TEXT_REASONS = """
  CASE WHEN text IS NULL THEN 'missing_text' WHEN clean = '' THEN 'empty_text' END,
  CASE WHEN clean <> '' AND duration > 0 AND length(clean) / duration < 3 THEN 'text_too_sparse' END,
  CASE WHEN clean <> '' AND duration > 0 AND length(clean) / duration > 25 AND NOT isnan(length(clean) / duration) THEN 'text_too_dense' END,"""


def _labeled(required: bool, languages: str) -> str:
    return f"""{_FEATURES}, {_NFKC},
  j AS ({_joined(f"SELECT *, {_CLEAN} AS clean FROM lines")}),
  judged AS (SELECT * EXCLUDE (q_id, o_id, m_id), {_reasons('0.8', '0.6', '5', '0.2', required, _TEXT_REASONS, languages)} AS reasons FROM j)"""


_CLIPS = """
clips AS (SELECT o_orderkey::VARCHAR AS audio_id, o_custkey::VARCHAR AS source, round(o_totalprice, 2) AS score,
                 30000 + (o_orderkey % 271) * 1000 AS unused, 3000 + (o_orderkey % 271) * 100 AS ms FROM orders)
"""

_PIECES = """
s AS (SELECT audio_id AS source, delivered_at, source_start AS a, source_end AS b FROM ssl_candidates WHERE source_end > source_start),
n AS (SELECT *, greatest(ceil((b - a) / 5.0::DOUBLE)::INT, 1) AS c0 FROM s),
c AS (SELECT * EXCLUDE c0, CASE WHEN a + (c0 - 1) * 5.0::DOUBLE >= b THEN greatest(c0 - 1, 1) ELSE c0 END AS c FROM n),
u AS (SELECT *, unnest(range(c)) AS part FROM c),
pieces AS (SELECT source, delivered_at, part, a + part * 5.0::DOUBLE AS x, CASE WHEN part = c - 1 THEN b ELSE a + (part + 1) * 5.0::DOUBLE END AS y FROM u)
"""

_WAVES = "w AS (SELECT vec_id, label, list_transform(embedding, lambda x: (x * (1 + vec_id % 4)::FLOAT)::FLOAT) AS s FROM embeddings)"

_PENALISED = """round(greatest(least(1.0::DOUBLE
  - CASE WHEN {rms} < -35 THEN least((-35 - {rms}) / 30.0::DOUBLE, 0.4::DOUBLE) ELSE 0 END
  - CASE WHEN {rms} > -8 AND NOT isnan({rms}) THEN least(({rms} + 8) / 20.0::DOUBLE, 0.4::DOUBLE) ELSE 0 END
  - least({clipping} * 20.0::DOUBLE, 0.4::DOUBLE) - least(greatest({silence} - 0.4::DOUBLE, 0), 0.4::DOUBLE)
  - CASE WHEN {snr} < 10 THEN least((10.0::DOUBLE - {snr}) / 30.0::DOUBLE, 0.3::DOUBLE) ELSE 0 END, 1.0::DOUBLE), 0), 6)"""
_SCORE = f"""
SELECT audio_id, computed_at, {_PENALISED.format(rms='rms_dbfs', clipping='clipping_ratio', silence='silence_ratio', snr='snr')} AS estimate
FROM (SELECT *, CASE WHEN isnan(snr_estimate_db) THEN NULL ELSE snr_estimate_db END AS snr FROM quality_features WHERE status = 'ok')
"""

_RANK = f"""round(CASE WHEN qk THEN coalesce({_number('score')}, 0) ELSE 0 END
      - CASE WHEN ok THEN coalesce({_number('overlap_ratio')}, 0) ELSE 0 END * 0.2::DOUBLE
      + least(greatest(CASE WHEN qk THEN coalesce({_number('snr')}, 0) ELSE 0 END / 30.0::DOUBLE, 0), 1) * 0.1::DOUBLE, 6)"""



def _metrics(mono: str, every: str, channels: int, frames: list[int]) -> str:
    """All metrics of signals of 64 samples at 1000 Hz: 25 samples a frame, frames starting at `frames`."""
    per = [f"list_avg(list_transform(list_filter(every, lambda x, i: (i - 1) % {channels} = {c}), lambda x: x::DOUBLE))" for c in range(channels)]
    offsets = "[" + ", ".join(f"abs({x})" for x in per) + "]"
    return f"""WITH {_WAVES}, d0 AS (SELECT vec_id, {every} AS every, {mono} AS mono FROM w),
      d AS (SELECT *, list_transform(mono, lambda x: abs(x)) AS a, list_transform(mono, lambda x: x::DOUBLE * x::DOUBLE) AS p,
        pow(10.0::DOUBLE, -2.5::DOUBLE)::FLOAT AS t, {offsets} AS offsets FROM d0),
      f AS (SELECT *, list_transform({frames}, lambda k: 20 * log10(greatest(sqrt(list_sum(p[k + 1:k + 25]) / 25), 1e-12))) AS fr,
        list_filter(p, lambda x, i: a[i] > t) AS act FROM d),
      e AS (SELECT *, 20 * log10(greatest(sqrt(list_avg(p)), 1e-12)) AS rms, list_aggregate(fr, 'quantile_cont', 0.1) AS noise,
        20 * log10(greatest(sqrt(list_avg(act)), 1e-12)) AS active, list_avg(list_transform(a, lambda x: (x <= t)::INT)) AS silence,
        list_avg(list_transform(every, lambda x: (abs(x) >= 0.999::FLOAT)::INT)) AS clipping FROM f)
      SELECT vec_id, round(len(mono) / 1000.0::DOUBLE, 3) AS duration, 1000 AS sample_rate, {channels} AS channels, len(mono) AS num_samples,
        round(rms, 3) AS rms_dbfs, round(20 * log10(greatest(list_max(a)::DOUBLE, 1e-12)), 3) AS peak_dbfs, round(noise, 3) AS noise_floor_dbfs,
        round(active, 3) AS active_rms_dbfs, round(active - noise, 3) AS snr_estimate_db, round(silence, 6) AS silence_ratio,
        round(list_avg(list_transform(a, lambda x: (x > t)::INT)), 6) AS active_ratio, round(clipping, 8) AS clipping_ratio,
        round(list_avg(offsets), 8) AS dc_offset_mean_abs, round(list_max(offsets), 8) AS dc_offset_max_abs,
        round(list_sum(list_transform(range(1, len(mono)), lambda i: ((mono[i] < 0) <> (mono[i + 1] < 0))::INT)) / (len(mono) / 1000.0::DOUBLE), 3) AS zero_crossing_rate,
        {_PENALISED.format(rms='rms', clipping='clipping', silence='silence', snr='(active - noise)')} AS quality_score FROM e"""


SQL = {
    "gate_reasons": f"WITH {_SSL} SELECT audio_id, delivered_at, array_to_string(reasons, ',') AS reasons FROM r",
    "reject_histogram": f"WITH {_SSL} SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM r) GROUP BY 1",
    "selection_score": f"""WITH {_SSL} SELECT audio_id, delivered_at, {_RANK} AS score FROM r""",
    "selected_by_language_dataset": f"""WITH {_SSL}, x AS (SELECT * FROM r WHERE len(reasons) = 0)
      SELECT 'language' AS key, coalesce(language, 'None') AS value, count(*) AS n FROM x GROUP BY 2
      UNION ALL SELECT 'dataset', coalesce(dataset, 'None'), count(*) FROM x GROUP BY 2""",
    "selected_hours": f"WITH {_SSL} SELECT count(*) AS n, round(coalesce(sum({_SECONDS}), 0) / 3600, 4) AS hours FROM r WHERE len(reasons) = 0",
    "ssl_selection": f"""WITH RECURSIVE {_SSL},
      c AS MATERIALIZED (SELECT audio_id, delivered_at, coalesce(source_audio_id, 'None') AS source, round({_SECONDS} * 1000)::BIGINT AS ms, {_RANK} AS points
        FROM r WHERE len(reasons) = 0),
      k AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source ORDER BY points DESC, audio_id, delivered_at) AS place FROM c),
      ranked AS MATERIALIZED (SELECT audio_id, delivered_at, ms, row_number() OVER (ORDER BY points DESC, audio_id, delivered_at) AS rn FROM k WHERE place <= 3),
      f AS (
        SELECT rn, audio_id, delivered_at, ms AS acc, true AS fits FROM ranked WHERE rn = 1
        UNION ALL
        SELECT n.rn, n.audio_id, n.delivered_at, CASE WHEN f.acc + n.ms <= 1800000 THEN f.acc + n.ms ELSE f.acc END, f.acc + n.ms <= 1800000
        FROM f JOIN ranked n ON n.rn = f.rn + 1)
      SELECT audio_id, delivered_at, 'gates' AS stage FROM r WHERE len(reasons) > 0
      UNION ALL SELECT audio_id, delivered_at, 'source_cap' FROM k WHERE place > 3
      UNION ALL SELECT audio_id, delivered_at, CASE WHEN fits THEN 'selected' ELSE 'budget' END FROM f""",
    "labeled_split_counts": f"""WITH {_labeled(False, '')}, base AS (SELECT * FROM judged WHERE len(reasons) = 0), {_SPLIT}
      SELECT new_split AS split, coalesce(language, 'None') AS language, count(*) AS n, round(sum({_SECONDS}) / 3600, 4) AS hours FROM a GROUP BY 1, 2""",
    "labeled_gate_reasons": f"""WITH {_labeled(True, "'uz', 'ru', 'kk'")} SELECT line_number, array_to_string(reasons, ',') AS reasons FROM judged""",
    "clip_manifest": """SELECT audio_id || '_vad_00000_' || lpad(p::VARCHAR, 2, '0') AS audio_id, 'audio/' || audio_id || '_vad_00000_' || lpad(p::VARCHAR, 2, '0') || '.wav' AS audio_path,
      CASE WHEN starts_with(audio_path, '/') THEN audio_path ELSE '/data/manifests/' || audio_path END AS source_audio_path,
      (0.5 + 5 * p)::DOUBLE AS source_start, least(5.5 + 5 * p, 12.75)::DOUBLE AS source_end, (least(5.5 + 5 * p, 12.75) - 0.5 - 5 * p)::DOUBLE AS duration, dataset
      FROM (SELECT DISTINCT * FROM raw_unlabeled), (VALUES (0), (1), (2)) x(p)""",
    "feature_last_wins": f"""SELECT audio_id, status, {", ".join(f"{_number(c)} AS {c}" for c in ("clipping_ratio", "silence_ratio", "rms_dbfs", "snr_estimate_db", "dc_offset_mean_abs", "quality_score"))}, computed_at
      FROM quality_features WHERE audio_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY audio_id ORDER BY computed_at DESC) = 1""",
    "shard_union": """SELECT audio_id, (CASE WHEN day(computed_at) % 2 = 0 THEN 0 ELSE 1 END)::INT AS file_ord, status, overlap_ratio FROM overlap_features
      WHERE audio_id IS NOT NULL AND computed_at IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY audio_id ORDER BY CASE WHEN day(computed_at) % 2 = 0 THEN 0 ELSE 1 END DESC, computed_at DESC) = 1""",
    "anti_missing": """SELECT audio_id, delivered_at FROM ssl_candidates s
      WHERE NOT EXISTS (SELECT 1 FROM quality_features q WHERE q.audio_id = s.audio_id)""",
    "normalized_text": f"SELECT line_number, {_CLEAN} AS normalized FROM labeled_manifest",
    "normalized_text_unicode": f"WITH {_NFKC} SELECT line_number, {_CLEAN} AS normalized FROM lines",
    "normalized_text_options": f"SELECT doc_id, {_normalized('text', False, False, True, False)} AS normalized FROM documents",
    "text_gate_reasons": f"""WITH {_NFKC} SELECT line_number, array_to_string(list_filter([{_TEXT_REASONS} NULL], lambda x: x IS NOT NULL), ',') AS reasons
      FROM (SELECT *, {_CLEAN} AS clean FROM lines)""",
    "labeled_split_assignment": f"WITH base AS (SELECT * FROM labeled_manifest), {_SPLIT} SELECT line_number, new_split AS split FROM a",
    "split_totals": f"""WITH base AS (SELECT * FROM labeled_manifest), {_SPLIT}
      SELECT d.split, coalesce(n, 0) AS n, coalesce(hours, 0) AS hours FROM (VALUES ('train'), ('val'), ('test')) d(split)
      LEFT JOIN (SELECT new_split, count(*) AS n, round(sum({_SECONDS}) / 3600, 4) AS hours FROM a GROUP BY 1) x ON x.new_split = d.split""",
    "stable_hash": """SELECT line_number, ('0x' || substr(sha256('salt|' || coalesce(speaker_id, 'None')), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0 AS h
      FROM labeled_manifest""",
    "source_cap": f"WITH {_CLIPS} SELECT audio_id, row_number() OVER (PARTITION BY source ORDER BY score DESC, audio_id) > 3 AS over FROM clips",
    "hours_budget": f"""WITH RECURSIVE {_CLIPS.replace('clips AS', 'clips AS MATERIALIZED')},
      o AS MATERIALIZED (SELECT audio_id, ms, row_number() OVER (ORDER BY score DESC, audio_id) AS rn FROM clips),
      f AS (
        SELECT rn, audio_id, ms::BIGINT AS acc, true AS in_budget FROM o WHERE rn = 1
        UNION ALL
        SELECT o.rn, o.audio_id, CASE WHEN f.acc + o.ms <= 7200000 THEN f.acc + o.ms ELSE f.acc END, f.acc + o.ms <= 7200000
        FROM f JOIN o ON o.rn = f.rn + 1)
      SELECT audio_id, in_budget FROM f""",
    "split_long_segments": f"""WITH {_PIECES} SELECT source || '_vad_00000_' || lpad(part::VARCHAR, 2, '0') AS segment_id, delivered_at,
      round(x, 3) AS vad_start, round(y, 3) AS vad_end, round(y - x, 3) AS vad_duration FROM pieces WHERE y - x >= 1.5""",
    "vad_source_summary": f"""WITH {_PIECES} SELECT source, delivered_at, count(*) FILTER (y - x >= 1.5) AS num_segments,
      coalesce(round(sum(y - x) FILTER (y - x >= 1.5), 3), 0) AS kept_duration, count(*) FILTER (y - x < 1.5) AS dropped_short,
      count(*) FILTER (part > 0) AS extra_parts FROM pieces GROUP BY 1, 2""",
    "materialized_slices": f"""WITH {_WAVES}, b AS (SELECT vec_id, s, round_even((vec_id % 50) / 1000.0::DOUBLE * 1000, 0)::INT AS f,
      least(round_even((vec_id % 70) / 1000.0::DOUBLE * 1000, 0)::INT, len(s)) AS l FROM w)
      SELECT vec_id, greatest(l - f, 0) AS n, round(coalesce(CASE WHEN l > f THEN list_sum(list_transform(s[f + 1:l], lambda x: x::DOUBLE)) END, 0), 5) AS total FROM b""",
    "overlap_features": """WITH x AS (SELECT audio_id, computed_at, duration, list_filter(list_transform(overlap_segments, lambda s:
        round(greatest(s.end_sec - s.start_sec, 0), 3)), lambda d: d >= 0.3::DOUBLE) AS ds FROM overlap_features WHERE status = 'ok')
      SELECT audio_id, computed_at, len(ds)::INT AS num_overlap_segments,
        CASE WHEN ds IS NULL THEN NULL ELSE round(coalesce(list_sum(ds), 0), 3) END AS overlap_duration,
        CASE WHEN duration > 0 THEN CASE WHEN ds IS NULL THEN NULL ELSE round(coalesce(list_sum(ds), 0) / duration, 6) END ELSE 0 END AS overlap_ratio FROM x""",
    "overlap_corpus_ratio": """SELECT round(CASE WHEN sum(duration) > 0 THEN sum(overlap_duration) / sum(duration) END, 6) AS corpus_overlap_ratio
      FROM overlap_features WHERE status = 'ok' AND NOT isnan(overlap_duration) AND NOT isnan(duration)""",
    "music_clip_rollup": """SELECT l_orderkey AS clip, round(max(p), 6) AS music_probability, round(avg(p), 6) AS music_mean_probability,
      round(avg((p >= 0.5)::INT), 6) AS music_ratio, max(p) >= 0.5 AS is_music, count(*) AS num_windows
      FROM (SELECT l_orderkey, l_discount * 10 + 0.0::DOUBLE AS p FROM lineitem) GROUP BY 1""",
    "music_totals": """SELECT count(*) AS num_rows, count(*) FILTER (m) AS num_music, round(count(*) FILTER (m) / count(*), 6) AS music_share
      FROM (SELECT max(l_discount * 10 + 0.0::DOUBLE) >= 0.5 AS m FROM lineitem GROUP BY l_orderkey)""",
    "music_top_labels": """WITH x AS (SELECT label AS clip, unnest(range(len(embedding)))::INT AS label_idx, embedding FROM embeddings),
      m AS (SELECT clip, label_idx, avg(1.0::DOUBLE / (1.0::DOUBLE + exp(-embedding[label_idx + 1]::DOUBLE))) AS p FROM x GROUP BY 1, 2)
      SELECT clip, row_number() OVER (PARTITION BY clip ORDER BY p DESC, label_idx DESC)::INT AS place, label_idx, round(p, 6) AS probability
      FROM m QUALIFY place <= 3""",
    "music_windows_padded": f"""WITH {_WAVES}, x AS (SELECT vec_id, s, unnest(range(greatest(ceil(len(s) / 10.0)::INT, 1)))::INT AS k FROM w)
      SELECT vec_id, k, 10 AS n, round(list_sum(list_transform(s[k * 10 + 1:least(k * 10 + 10, len(s))], lambda x: x::DOUBLE)), 5) AS total FROM x""",
    "label_index": "SELECT min(n_nationkey) AS index FROM nation WHERE lower(n_name) = 'nation_7' HAVING count(*) > 0",
    "quality_metrics_mono": _metrics("s", "s", 1, [0, 10, 20, 30]),
    "quality_metrics_stereo": _metrics("list_transform(range(1, len(s), 2), lambda i: ((s[i] + s[i + 1]) / 2)::FLOAT)", "s", 2, [0]),
    "quality_score": _SCORE,
    "level_round_trip": """SELECT audio_id, computed_at, round(20 * log10(greatest(pow(10.0::DOUBLE, peak_dbfs / 20), 1e-12)), 6) AS level
      FROM quality_features WHERE status = 'ok'""",
    "shard_and_limit": "SELECT line_number, audio_id FROM labeled_manifest WHERE (line_number - 1) % 3 = 1 ORDER BY line_number LIMIT 100",
    "shard_totals": """WITH m AS (SELECT line_number, (line_number - 1) % 3 = 1 AS mine FROM labeled_manifest),
      b AS (SELECT CASE WHEN count(*) > 100 THEN max(line_number) END AS stop FROM (SELECT line_number FROM m WHERE mine ORDER BY line_number LIMIT 101))
      SELECT count(*) AS num_input_rows, count(*) FILTER (mine) AS num_processed_rows, count(*) FILTER (NOT mine) AS num_skipped_shard_rows
      FROM m, b WHERE stop IS NULL OR line_number < stop""",
    "run_totals": f"""SELECT count(*) AS num_rows, count(*) FILTER (status = 'ok') AS num_ok, count(*) FILTER (status <> 'ok') AS num_errors,
      round(coalesce(sum({_SECONDS}) FILTER (status = 'ok'), 0), 3) AS audio_duration,
      round(avg(quality_score) FILTER (status = 'ok' AND NOT isnan(quality_score)), 6) AS mean_score FROM quality_features""",
    "path_resolution": """SELECT line_number, CASE WHEN line_number % 3 = 0 THEN '/' || audio_path WHEN starts_with(audio_path, '/') THEN audio_path
      ELSE '/data/manifests/' || audio_path END AS path FROM labeled_manifest""",
    "energy_vad_segments": f"""WITH {_WAVES},
      f AS (SELECT vec_id, len(s) AS n, k, sqrt(list_avg(list_transform(s[k * 5 + 1:k * 5 + 5], lambda x: x::DOUBLE * x::DOUBLE))) > pow(10.0::DOUBLE, -1.1::DOUBLE) AS loud
        FROM w, (SELECT unnest(range(12))::INT AS k)),
      g AS (SELECT *, CASE WHEN k - lag(k) OVER (PARTITION BY vec_id ORDER BY k) <= 2 THEN 0 ELSE 1 END AS new FROM f WHERE loud),
      h AS (SELECT *, sum(new) OVER (PARTITION BY vec_id ORDER BY k) AS span FROM g),
      s AS (SELECT vec_id, span, min(n) AS n, min(k) * 5 AS a, max(k) * 5 + 5 AS b FROM h GROUP BY 1, 2 HAVING max(k) > min(k)),
      p AS (SELECT vec_id, greatest(a - 2, 0) AS a, least(b + 2, n)::INT AS b FROM s)
      SELECT vec_id, greatest(a, coalesce(lag(b) OVER (PARTITION BY vec_id ORDER BY a), 0))::INT AS first, b AS last FROM p""",
    "jsonl_roundtrip": """SELECT audio_id, audio_path, duration, sample_rate, channels, dataset, language, split, source_clips,
      recorded_at::VARCHAR AS recorded_at,
      count(*) OVER () AS num_lines, 1::BIGINT AS first_line, count(*) OVER () AS last_lines FROM raw_unlabeled""",
    "error_rows": "SELECT line_number AS source_line_number, 'error' AS status, 'FileNotFoundError' AS error_type FROM labeled_manifest",
}
