"""The results of the operators that SQL can express, over the same tables."""

from __future__ import annotations

from faultline.llm.licenses import ALL_NOTICES, LEAD, LEAST_CONTAINMENT
from faultline.llm.licenses import SHINGLE as NOTICE_SHINGLE
from faultline.llm.line_dedup import LEAST_CHARS, LEAST_DOCUMENTS
from faultline.llm.notices import FAMILIES
from faultline.llm.quality import (
    KEPT_SHARE,
    LEAST_WORDS,
    LINE_DOCUMENTS,
    LONG_LINE,
    MOST_REPEATED_PERCENT,
    SHORT_LINE_DOCUMENTS,
    SYMBOLS,
)

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {}

ORACLES["op4_exact_dedup"] = r"""
WITH digests AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS digest
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept,
       digest AS text_sha256
FROM digests WINDOW w AS (PARTITION BY digest)
"""

ORACLES["op7_quality_rules"] = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, '=' || source AS host,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
windows AS (
  SELECT doc_id, pos, array_to_string(words[pos:pos + 4], ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS pos FROM texts)
),
repeats AS (
  SELECT doc_id, pos FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
),
covered AS (
  SELECT doc_id, count(DISTINCT pos + k) AS n
  FROM repeats, (SELECT unnest(range(5)) AS k) GROUP BY doc_id
),
lines AS (
  SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
),
dup_lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id
),
shapes AS (
  SELECT DISTINCT host, text, shape, len(shape) - len(replace(shape, ' ', '')) + 1 AS words
  FROM (
    SELECT host, text,
           translate(trim(regexp_replace(
             {_LOWER.format("line")}, '[\x20\x09-\x0D]+', ' ', 'g')), '123456789', '000000000') AS shape
    FROM texts JOIN lines USING (doc_id)
  )
),
common AS (
  SELECT host, shape FROM shapes GROUP BY host, shape, words
  HAVING count(*) > CASE WHEN words >= {LONG_LINE} THEN {LINE_DOCUMENTS} ELSE {SHORT_LINE_DOCUMENTS} END
),
left_over AS (
  SELECT host, text, sum(words) AS line_words,
         coalesce(sum(words) FILTER (c.shape IS NOT NULL), 0) AS removed_words
  FROM shapes s LEFT JOIN common c USING (host, shape) GROUP BY host, text
),
measured AS (
  SELECT t.doc_id, len(t.words) AS n_words,
         len(regexp_replace(t.text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         len(regexp_replace(t.text, '[^{SYMBOLS}]+', '', 'g')) AS n_symbols,
         coalesce(d.n, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         coalesce(l.line_words, 0)::BIGINT AS line_words,
         coalesce(l.removed_words, 0)::BIGINT AS removed_words
  FROM texts t LEFT JOIN dup_lines d USING (doc_id) LEFT JOIN covered c USING (doc_id)
  LEFT JOIN left_over l ON l.host = t.host AND l.text = t.text
)
SELECT *, n_words < {LEAST_WORDS}
         OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed,
       NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words)
         AND NOT (removed_words > 0 AND (
           line_words - removed_words < {LEAST_WORDS}
           OR line_words - removed_words < {KEPT_SHARE}::DOUBLE * line_words)) AS kept
FROM measured
"""

def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_NOTICES = ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in ALL_NOTICES.items())
_FAMILIES = ", ".join(
    f"({number}, {_quoted(name)})" for number, names in enumerate(FAMILIES) for name in names
)


def _shingles(table: str, key: str) -> str:
    return rf"""
  SELECT {key}, pos - 1 AS pos, words[pos:pos + {NOTICE_SHINGLE - 1}] AS shingle
  FROM (
    SELECT {key}, words, unnest(range(1, len(words) - {NOTICE_SHINGLE} + 2)) AS pos
    FROM (
      SELECT {key}, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[\p{{L}}\p{{N}}]+') AS words
      FROM {table}
    )
  )"""


ORACLES["op8_license_scan"] = f"""
WITH notices(license, text) AS (VALUES {_NOTICES}),
families(family, license) AS (VALUES {_FAMILIES}),
sequences AS ({_shingles("notices", "license")}),
known AS (SELECT DISTINCT license, shingle FROM sequences),
sizes AS (SELECT license, count(*) AS n FROM known GROUP BY license),
texts AS ({_shingles("documents", "doc_id")}),
found AS (
  SELECT doc_id, license, count(DISTINCT shingle) AS shared, min(pos) AS start_word
  FROM texts JOIN known USING (shingle) GROUP BY doc_id, license
),
enough AS (
  SELECT doc_id, license, shared / n AS containment, shared, start_word
  FROM found JOIN sizes USING (license) WHERE shared / n >= {LEAST_CONTAINMENT}::DOUBLE
),
-- Where a notice has shingles that a sibling lacks, the first of them in a row tell the two apart.
lacking AS (
  SELECT DISTINCT s.license, b.license AS other, s.pos
  FROM sequences s JOIN families a ON a.license = s.license
  JOIN families b ON b.family = a.family AND b.license <> a.license
  WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.license = b.license AND k.shingle = s.shingle)
),
rows_of AS (
  SELECT *, pos - row_number() OVER (PARTITION BY license, other ORDER BY pos) AS streak FROM lacking
),
telling AS (
  SELECT license, pos FROM rows_of
  QUALIFY row_number() OVER (PARTITION BY license, other, streak ORDER BY pos) <= {NOTICE_SHINGLE}
),
spans AS (
  SELECT license, greatest(min(pos) - {LEAD}, 0) AS low, max(pos) AS high FROM telling GROUP BY license
),
runs AS (
  SELECT license, pos - low AS at, shingle, high - low + 1 AS n
  FROM sequences JOIN spans USING (license) WHERE pos BETWEEN low AND high
),
told AS (
  SELECT DISTINCT doc_id, license FROM (
    SELECT t.doc_id, e.license, t.pos - r.at AS start, r.n
    FROM enough e JOIN texts t USING (doc_id) JOIN runs r ON r.license = e.license AND r.shingle = t.shingle
  ) GROUP BY doc_id, license, start, n HAVING count(*) = n
)
SELECT e.* FROM enough e
WHERE license NOT IN (SELECT license FROM spans)
   OR EXISTS (SELECT 1 FROM told t WHERE t.doc_id = e.doc_id AND t.license = e.license)
"""

ORACLES["op10_near_dedup"] = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[pos:pos + 2], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS pos FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)
),
reach(node, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT node, CASE WHEN a = other THEN b ELSE a END
  FROM reach JOIN links ON a = other OR b = other
),
roots AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN roots ON node = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

ORACLES["op12_line_dedup"] = rf"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
),
keyed AS (
  SELECT *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key
  FROM lines
),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= {LEAST_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {LEAST_DOCUMENTS}
),
judged AS (
  SELECT k.*, coalesce(k.doc_id <> keeper, false) AS dropped FROM keyed k LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count_if(dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
