"""The queries that SQL can express, written the direct way."""

from __future__ import annotations

import string

from forumgauge.llm import grid_join, line_dedup, quality_rules, repeats, resampling

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _listed(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


OP4 = f"""
WITH docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
windows AS (SELECT doc_id, p, sha256(array_to_string(w[p:p + {repeats.WINDOW - 1}], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {repeats.WINDOW - 2})) AS p FROM docs WHERE len(w) >= {repeats.WINDOW})),
firsts AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + {repeats.WINDOW})) AS i
  FROM windows JOIN firsts USING (h) WHERE first < doc_id),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t
  FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""


def _broken(rule: quality_rules.Rule) -> str:
    scale = f"CAST({rule.per} AS DOUBLE)" if rule.per else "CAST(1 AS DOUBLE)"
    parts = ([f"{rule.measure} < {scale} * CAST({rule.least} AS DOUBLE)"] if rule.least is not None else []) + (
        [f"{rule.measure} > {scale} * CAST({rule.most} AS DOUBLE)"] if rule.most is not None else [])
    return "(" + " OR ".join(parts) + ")"


BASE = " OR ".join(map(_broken, quality_rules.BASE_RULES))
MORE = " OR ".join(map(_broken, quality_rules.RULES))
FORMS = [f for w in quality_rules.STOP_WORDS for f in (w, w.capitalize(), w.upper())]

OP7 = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents),
windows AS (SELECT doc_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM docs WHERE len(w) >= 3)),
twice AS (SELECT doc_id, g FROM windows GROUP BY doc_id, g HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT i) AS n
  FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS i FROM windows JOIN twice USING (doc_id, g)) GROUP BY doc_id),
measured AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(list_filter(w, lambda x: x IN ({_listed(FORMS)}))) AS BIGINT) AS n_stop_words, CAST(len(l) AS BIGINT) AS n_lines,
    CAST(len(list_filter(l, lambda x: contains(x, '!!'))) AS BIGINT) AS n_loud_lines
  FROM docs LEFT JOIN covered USING (doc_id))
SELECT *, ({BASE}) AS base_failed, NOT ({BASE} OR {MORE}) AS kept FROM measured"""

OP9 = f"""
WITH RECURSIVE vectors AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) >= {grid_join.COSINE}::DOUBLE * sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))),
reached AS (SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other),
groups AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM groups LEFT JOIN counts USING (vec_id)"""

LOWER = f"translate(%s, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

# The crc32 of a text: its bytes, as pairs of hex digits, run through a table made by eight halvings.
_HALF = "CASE WHEN %s & 1 = 1 THEN xor(%s >> 1, 3988292384) ELSE %s >> 1 END"
OP11 = f"""
WITH RECURSIVE halved AS (SELECT CAST(n AS BIGINT) AS n, CAST(n AS BIGINT) AS c, 0 AS turn FROM range(256) t(n)
  UNION ALL SELECT n, {_HALF.replace('%s', 'c')}, turn + 1 FROM halved WHERE turn < 8),
codes AS (SELECT list(c ORDER BY n) AS code FROM halved WHERE turn = 8),
texts AS (SELECT 0 AS target, doc_id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
docs AS (SELECT target, doc_id, regexp_extract_all({LOWER % "coalesce(text, '')"}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
placed AS (SELECT target, doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM docs),
runs AS (SELECT target, doc_id, array_to_string(w[p:p + n - 1], ' ') AS f
  FROM placed, range(1, {resampling.LONGEST + 1}) t(n) WHERE p + n - 1 <= len(w)),
counted AS (SELECT target, doc_id, f, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (SELECT f, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, strlen(f) + 1),
      lambda i: CAST('0x' || substr(h, 2 * i - 1, 2) AS BIGINT))),
      lambda c, b: xor(c >> 8, code[xor(c & 255, b) + 1])), 4294967295) % {resampling.BUCKETS} AS b
  FROM (SELECT DISTINCT f, hex(encode(f)) AS h FROM counted), codes),
held AS (SELECT target, doc_id, b, sum(n) AS n FROM counted JOIN hashed USING (f) GROUP BY ALL),
sides AS (SELECT b, coalesce(sum(n) FILTER (target = 0), 0) AS s, coalesce(sum(n) FILTER (target = 1), 0) AS t
  FROM range({resampling.BUCKETS}) r(b) LEFT JOIN held USING (b) GROUP BY b),
gains AS (SELECT b, CAST(floor(1000 * ln(CAST((t + 1) * (sum(s) OVER () + {resampling.BUCKETS}) AS DOUBLE)
    / CAST((s + 1) * (sum(t) OVER () + {resampling.BUCKETS}) AS DOUBLE))) AS BIGINT) AS gain FROM sides),
weights AS (SELECT doc_id, sum(n) AS n_features, sum(n * gain) AS weight FROM held JOIN gains USING (b) WHERE target = 0 GROUP BY doc_id),
scored AS (SELECT doc_id, len(w) >= {resampling.LEAST_WORDS} AS fits, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
    CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{resampling.SEED}:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296))) AS BIGINT) AS score
  FROM docs LEFT JOIN weights USING (doc_id) WHERE target = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY fits ORDER BY score DESC, doc_id) AS r, count(*) FILTER (fits) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN fits AND r <= floor({resampling.PERCENT} * n / 100) THEN r END AS rank FROM ranked"""

_BLANKS = " || ".join(f"chr({ord(c)})" for c in line_dedup.BLANKS)
OP13 = f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, i, line, {LOWER % f"trim(line, {_BLANKS})"} AS k
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i FROM docs)),
common AS (SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= {line_dedup.LEAST_CHARS}
  GROUP BY k HAVING count(DISTINCT doc_id) >= {line_dedup.LEAST_DOCUMENTS}),
marked AS (SELECT doc_id, i, line, coalesce(doc_id <> keeper, FALSE) AS gone FROM lines LEFT JOIN common USING (k))
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

LLM_ORACLE = {"op4_repeats": OP4, "op7_quality_rules": OP7, "op9_grid_join": OP9, "op11_resampling": OP11, "op13_line_dedup": OP13}
