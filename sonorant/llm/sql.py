"""The pN_ queries in SQL, where SQL can express them."""

from __future__ import annotations

from .ids import NO_SPEAKER
from .p04_grouped_split import SALT as SPLIT_SALT
from .p05_contributor_cap import SHARE
from .p06_canonical import APOSTROPHES, LOOK_ALIKES
from .p07_stable_sample import RATE, SALT, threshold_digits

_TIDY = r"regexp_replace(lower(regexp_replace({0}, '^[\s\x{{a0}}\x{{200b}}-\x{{200f}}\x{{feff}}]+|[\s\x{{a0}}\x{{200b}}-\x{{200f}}\x{{feff}}]+$', '', 'g')), '^.*[/\\]', '')"
_CLIP = r"nullif(trim(regexp_replace(" + _TIDY + r", '\.(wav|flac|mp3|ogg|opus|m4a)$', '')), '')"


def _clip(column: str) -> str:
    return _CLIP.format(column)


_SOURCES = f"""
  latest AS (
    SELECT audio_id, arg_max(CASE WHEN isnan(selection_score) THEN NULL ELSE selection_score END, delivered_at) FILTER (true) AS x,
           max(delivered_at) AS at FROM ssl_candidates GROUP BY audio_id),
  clips AS (
    SELECT s.audio_id, {_clip('s.source_audio_id')} AS source,
           CASE WHEN isnan(s.selection_score) THEN NULL ELSE s.selection_score END AS score
    FROM ssl_candidates s JOIN latest l ON s.audio_id = l.audio_id AND s.delivered_at = l.at),
  placed AS (
    SELECT audio_id, source, score, row_number() OVER (
      PARTITION BY source ORDER BY score DESC NULLS LAST, audio_id) AS place
    FROM clips WHERE source IS NOT NULL)
"""

# Full width to plain, blanks to spaces, apostrophe-like signs and look-alike letters: the mappings of the operator, made from its tables.
_FROM = "".join(map(chr, range(0xFF01, 0xFF5F))) + APOSTROPHES.replace("'", "") + "".join(LOOK_ALIKES.values())
_TO = "".join(map(chr, range(0x21, 0x7F))) + "'" * (len(APOSTROPHES) - 1) + "".join(k * len(v) for k, v in LOOK_ALIKES.items())


def _look(column: str) -> str:
    seen = rf"regexp_replace({column}, '[\x{{00}}-\x{{08}}\x{{0e}}-\x{{1f}}\x{{7f}}-\x{{84}}\x{{86}}-\x{{9f}}\x{{fe00}}-\x{{fe0f}}]|\p{{Cf}}', '', 'g')"
    mapped = f"translate(nfc_normalize({seen}), '{_FROM.replace(chr(39), chr(39) * 2)}', '{_TO.replace(chr(39), chr(39) * 2)}')"
    wide = mapped
    # Ligatures, and composed letters whose base is a look-alike.
    for old, new in (("ﬁ", "fi"), ("ﬂ", "fl"), ("…", "..."), ("\u045e", "y\u0306"), ("\u040e", "Y\u0306"), ("\u0451", "e\u0308"), ("\u0401", "E\u0308")):
        wide = f"replace({wide}, '{old}', '{new}')"
    plain = rf"trim(regexp_replace(nfc_normalize({wide}), '[\s\p{{Z}}\x{{85}}\x{{0b}}]+', ' ', 'g'))"
    # A breve on y has a composed letter in Cyrillic only.
    return f"replace(replace({plain}, 'y\u0306', '\u045e'), 'Y\u0306', '\u040e')"


# Capitals of a text with more Cyrillic letters than Latin ones are Cyrillic before they become small ones, which look otherwise.
_COUNT = "length(regexp_replace(text, '[^\\p{{{0}}}]', '', 'g'))"
_CAPITALS = {k: v[0] for k, v in LOOK_ALIKES.items() if k.isupper() and "\u0400" <= v[0] <= "\u052f"}
_LOWER = (
    f"lower(CASE WHEN {_COUNT.format('Cyrillic')} > {_COUNT.format('Latin')}"
    f" THEN translate(text, '{''.join(_CAPITALS)}', '{''.join(_CAPITALS.values())}') ELSE text END)")

_DOTTED = "i\u0307"

#: Pairs (p, q) of problem 1. Words are those of the texts' common look; a row of the table of common subsequences is folded over one text's words.
_NEAR = rf"""
  said AS (
    SELECT line_number AS line, lower(trim(split)) AS s, {_clip('audio_id')} AS clip, lower(trim(dataset)) AS dataset,
      regexp_replace(replace(replace({_look(_LOWER)}, '{_DOTTED}', 'i'), 'ı', 'i'), '\[[^\[\]]*\]|\([^()]*\)|\{{[^{{}}]*\}}|<[^<>]*>', ' ', 'g') AS said
    FROM labeled_manifest),
  parts AS MATERIALIZED (
    SELECT line, clip, dataset, CASE WHEN s LIKE '%train%' THEN 'train' WHEN s LIKE '%test%' THEN 'test' WHEN s LIKE '%dev%' OR s LIKE '%val%' THEN 'val' END AS part,
      list_filter(list_transform(string_split(said, ' '), lambda x: regexp_replace(x, '[^\p{{L}}\p{{N}}\p{{M}}]', '', 'g')), lambda x: x <> '') AS w FROM said),
  t AS MATERIALIZED (SELECT w, list(line) AS lines, list_distinct(w) AS d FROM parts WHERE part = 'train' AND len(w) >= 6 GROUP BY w),
  e AS MATERIALIZED (SELECT w, list(line) AS lines, list_distinct(w) AS d FROM parts WHERE part <> 'train' AND len(w) >= 6 GROUP BY w),
  near AS MATERIALIZED (
    SELECT e.w AS a, t.w AS b, e.lines AS x, t.lines AS y, ceil(4 * greatest(len(e.w), len(t.w)) / 5) AS need FROM e JOIN t
    ON 5 * len(e.w) >= 4 * len(t.w) AND 5 * len(t.w) >= 4 * len(e.w)
      AND len(list_intersect(e.d, t.d)) >= len(e.d) - len(e.w) + 4 * greatest(len(e.w), len(t.w)) / 5),
  agree AS (
    SELECT x, y FROM near WHERE a = b OR list_reduce(a, lambda row, v: list_reduce(range(1, len(b) + 1), lambda acc, j: list_append(acc,
      CASE WHEN b[j] = v THEN row[j] + 1 ELSE greatest(row[j + 1], acc[-1]) END), [0::BIGINT]), list_transform(range(len(b) + 1), lambda i: 0::BIGINT))[-1] >= need),
  met AS MATERIALIZED (
    SELECT p, unnest(y) AS q FROM (SELECT unnest(x) AS p, y FROM agree)
    UNION SELECT a.line, b.line FROM parts a JOIN parts b ON a.clip = b.clip WHERE a.part <> 'train' AND b.part = 'train')
"""

_REC = r"^([a-z][a-z_]*?)[_-]([0-9a-f]{6,})([_.-].*)?$"

_GROUPS = f"""base AS (
  SELECT line_number AS line, {_clip('audio_id')} AS clip, lower(trim(speaker_id)) AS who, lower(trim(split)) AS s FROM labeled_manifest),
rows AS (
  SELECT line, CASE WHEN s LIKE '%train%' THEN 'train' WHEN s LIKE '%test%' THEN 'test' WHEN s LIKE '%dev%' OR s LIKE '%val%' THEN 'val' END AS part,
    CASE WHEN regexp_matches(clip, '{_REC}') THEN regexp_extract(clip, '{_REC}', 1) || '_' || regexp_extract(clip, '{_REC}', 2) ELSE clip END AS rec,
    CASE WHEN who NOT IN ({", ".join("'" + x + "'" for x in NO_SPEAKER)}) THEN who END AS who
  FROM base),
e AS MATERIALIZED (SELECT line, 'r:' || rec AS ent FROM rows WHERE rec IS NOT NULL UNION SELECT line, 'a:' || who FROM rows WHERE who IS NOT NULL),
near AS MATERIALIZED (SELECT DISTINCT a.line AS x, b.line AS y FROM e a JOIN e b ON a.ent = b.ent),
reach AS (SELECT line AS x, line AS y FROM rows UNION SELECT r.x, n.y FROM reach r JOIN near n ON n.x = r.y)"""

SQL = {
    "p1_found": f"WITH {_NEAR} SELECT least(p, q) AS line_lo, greatest(p, q) AS line_hi FROM met",
    "p1_report": f"""WITH {_NEAR}, hits AS (SELECT p AS line, count(*) AS n FROM met GROUP BY 1)
SELECT part AS split, dataset, count(*) AS rows, count(n) AS overlapping, coalesce(sum(n), 0)::BIGINT AS pairs
FROM parts LEFT JOIN hits USING (line) WHERE part <> 'train' GROUP BY 1, 2""",
    "p4_found": f"""
WITH RECURSIVE {_GROUPS}
SELECT x AS line_number, min(y) AS group_line FROM reach JOIN rows ON rows.line = reach.y GROUP BY x HAVING count(DISTINCT part) > 1
""",
    "p4_split": f"""
WITH RECURSIVE {_GROUPS},
least AS (SELECT reach.x AS line, min(ent) AS c FROM reach JOIN e ON e.line = reach.y GROUP BY 1),
of AS (SELECT rows.line, coalesce(c, 'l:' || rows.line) AS c FROM rows LEFT JOIN least USING (line)),
n AS (SELECT c, count(*) AS n, ('0x' || substr(sha256('{SPLIT_SALT}|' || c), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS place,
             count(*) > sum(count(*)) OVER () * 0.05::DOUBLE AS giant FROM of GROUP BY c),
t AS (SELECT greatest(coalesce(sum(n) FILTER (NOT giant), 0) - sum(n) * (1 - 0.8::DOUBLE), 0) / greatest(coalesce(sum(n) FILTER (NOT giant), 0), 1) AS train FROM n)
SELECT line AS line_number, CASE WHEN giant OR place < train THEN 'train' WHEN place < train + (1 - train) * 0.5::DOUBLE THEN 'val' ELSE 'test' END AS split
FROM of JOIN n USING (c), t
""",
    "p3_ranking": """
WITH q0 AS (
  SELECT audio_id, quality_run_id AS run,
         CASE WHEN status = 'ok' AND NOT isnan(quality_score) THEN quality_score END AS quality,
         CASE WHEN status = 'ok' AND NOT isnan(snr_estimate_db) AND snr_estimate_db NOT IN (-99, 999) THEN snr_estimate_db END AS snr
  FROM quality_features WHERE audio_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY audio_id ORDER BY computed_at DESC NULLS LAST) = 1),
qr AS (
  SELECT run, avg(CASE WHEN quality > 0 AND quality <= 100 THEN quality END) > 1 AS percent,
         avg(CASE WHEN snr > 100 THEN 1.0 WHEN snr IS NOT NULL THEN 0.0 END) > 0.005 AS linear
  FROM q0 GROUP BY run),
q1 AS (
  SELECT audio_id, CASE WHEN percent THEN quality / 100 ELSE quality END AS quality,
         CASE WHEN linear THEN CASE WHEN snr > 0 THEN 20 * log10(snr) END ELSE snr END AS snr
  FROM q0 LEFT JOIN qr ON q0.run IS NOT DISTINCT FROM qr.run),
o0 AS (
  SELECT audio_id, overlap_run_id AS run,
         CASE WHEN status = 'ok' AND NOT isnan(overlap_ratio) THEN overlap_ratio END AS ratio
  FROM overlap_features WHERE audio_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY audio_id ORDER BY computed_at DESC NULLS LAST) = 1),
orun AS (
  SELECT run, avg(CASE WHEN ratio > 0 AND ratio <= 100 THEN ratio END) > 1 AS percent FROM o0 GROUP BY run),
o1 AS (
  SELECT audio_id, CASE WHEN percent THEN ratio / 100 ELSE ratio END AS ratio
  FROM o0 LEFT JOIN orun ON o0.run IS NOT DISTINCT FROM orun.run),
s AS (
  SELECT coalesce(q1.audio_id, o1.audio_id) AS audio_id,
         CASE WHEN quality BETWEEN 0 AND 1 THEN quality END AS a,
         CASE WHEN snr BETWEEN -20 AND 100 THEN snr END AS b,
         CASE WHEN ratio BETWEEN 0 AND 1 THEN ratio END AS c
  FROM q1 FULL JOIN o1 ON q1.audio_id = o1.audio_id),
p AS (
  SELECT audio_id,
    CASE WHEN a IS NULL THEN 0.0::DOUBLE ELSE (rank() OVER (ORDER BY a NULLS LAST) - 1 + count(*) OVER (PARTITION BY a) / 2.0::DOUBLE) / count(a) OVER () END AS pa,
    CASE WHEN b IS NULL THEN 0.0::DOUBLE ELSE (rank() OVER (ORDER BY b NULLS LAST) - 1 + count(*) OVER (PARTITION BY b) / 2.0::DOUBLE) / count(b) OVER () END AS pb,
    CASE WHEN c IS NULL THEN 0.0::DOUBLE ELSE (rank() OVER (ORDER BY -c NULLS LAST) - 1 + count(*) OVER (PARTITION BY c) / 2.0::DOUBLE) / count(c) OVER () END AS pc
  FROM s),
v AS (SELECT audio_id, list_sort([pa, pb, pc]) AS l FROM p)
SELECT audio_id, row_number() OVER (ORDER BY l[1] DESC, l[2] DESC, l[3] DESC, audio_id) AS place,
       l[1] AS p1, l[2] AS p2, l[3] AS p3
FROM v
""",
    "p5_found": f"WITH {_SOURCES} SELECT audio_id FROM placed WHERE place > 20",
    "p5_share": f"""WITH {_SOURCES}
SELECT audio_id FROM placed QUALIFY place > greatest(floor({SHARE} * count(*) OVER ()), 1)""",
    "p5_kept": f"WITH {_SOURCES} SELECT audio_id, source, score, place::INTEGER AS place FROM placed WHERE place <= 20",
    "p6_found": f"""
WITH k AS (SELECT doc_id, text, {_look('text')} AS look FROM documents WHERE text IS NOT NULL)
SELECT a.doc_id AS doc_lo, b.doc_id AS doc_hi FROM k a JOIN k b ON a.look = b.look AND a.doc_id < b.doc_id AND a.text <> b.text WHERE a.look <> ''
""",
    "p6_texts": f"""
SELECT 'documents' AS record_table, doc_id AS record_id, {_look('text')} AS text FROM documents
UNION ALL SELECT 'labeled_manifest', line_number, {_look('text')} FROM labeled_manifest
""",
    "p8_round_trip": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "p9_check": "SELECT count(*) AS documents, 0::BIGINT AS missing, 0::BIGINT AS strange, 0::BIGINT AS repeated, 0::BIGINT AS split, 0::BIGINT AS overfull FROM documents",
    "p7_sample": f"""
SELECT 'ssl_candidates' AS record_table, audio_id, {_clip('audio_id')} AS clip, delivered_at FROM ssl_candidates
WHERE substr(sha256('{SALT}|' || {_clip('audio_id')}), 1, 16) < '{threshold_digits(RATE)}'
UNION ALL
SELECT 'labeled_manifest', audio_id, {_clip('audio_id')}, delivered_at FROM labeled_manifest
WHERE substr(sha256('{SALT}|' || {_clip('audio_id')}), 1, 16) < '{threshold_digits(RATE)}'
""",
}
