"""DuckDB SQL of the operators that SQL can express over whole tables."""

from __future__ import annotations

from tessera.llm import quality_rules as rules
from tessera.llm.archives import REVISIT_BYTES
from tessera.llm.substring_dedup import MIN_WORDS

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORD = r"'[^\x20\x09-\x0D]+'"
_GAP = r"'[\x20\x09-\x0D]+'"

NEAR_DEDUP = f"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), {_WORD}) AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
        WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_transform(generate_series(1, len(words) - 4), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS sh
      FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
      WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
linked AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach AS (SELECT doc_id, doc_id AS other FROM n UNION SELECT r.doc_id, l.y FROM reach r JOIN linked l ON r.other = l.x),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least.component_id, w.doc_id) AS component_id,
       w.doc_id = coalesce(least.component_id, w.doc_id) AS kept
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN least ON w.doc_id = least.doc_id"""

SUBSTRING_DEDUP = f"""WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, k, line, regexp_extract_all(line, {_WORD}) AS words,
             sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY k) - length(line) - 1 AS start FROM l),
u AS (SELECT doc_id, start, length(line) AS length, len(words) AS n_words,
             translate(array_to_string(words, ' '), {_LOWER}) AS unit,
             row_number() OVER (PARTITION BY doc_id ORDER BY k) AS line FROM w WHERE len(words) > 0),
f AS (SELECT *, first_value(doc_id) OVER o AS kept_doc_id, first_value(start) OVER o AS kept_start FROM u
      WINDOW o AS (PARTITION BY unit ORDER BY doc_id, start)),
r AS (SELECT *, line - row_number() OVER (PARTITION BY doc_id ORDER BY line) AS run FROM f
      WHERE doc_id <> kept_doc_id OR start <> kept_start),
t AS (SELECT *, sum(n_words) OVER (PARTITION BY doc_id, run) AS run_words FROM r),
lines AS (SELECT doc_id, start, length, n_words, kept_doc_id, kept_start FROM t WHERE run_words >= {MIN_WORDS}),
tw AS (SELECT doc_id, regexp_extract_all(translate(text, {_LOWER}), {_WORD}) AS words,
              regexp_extract_all(text, {_GAP}) AS gaps, regexp_matches(text, '^' || {_GAP}) AS lead
       FROM documents WHERE text IS NOT NULL),
wl AS (SELECT doc_id, unnest(list_transform(words, lambda x: length(x))) AS n, generate_subscripts(words, 1) AS i,
              unnest(list_transform(CASE WHEN lead THEN gaps[2:] ELSE gaps END || [''], lambda x: length(x))[1:len(words)]) AS gap,
              CASE WHEN lead THEN length(gaps[1]) ELSE 0 END AS first FROM tw),
wo AS (SELECT doc_id, i - 1 AS p, n, first + sum(n + gap) OVER (PARTITION BY doc_id ORDER BY i) - n - gap AS start FROM wl),
win AS (SELECT doc_id, unnest(list_transform(range(len(words) - {MIN_WORDS - 1}),
               lambda i: md5(array_to_string(words[i + 1:i + {MIN_WORDS}], ' ')))) AS digest,
               unnest(range(len(words) - {MIN_WORDS - 1})) AS place FROM tw WHERE len(words) >= {MIN_WORDS}),
again AS (SELECT * FROM (SELECT doc_id, place, first_value(doc_id) OVER o AS kept_doc_id, first_value(place) OVER o AS kept_place
          FROM win WINDOW o AS (PARTITION BY digest ORDER BY doc_id, place))
          WHERE doc_id <> kept_doc_id OR place >= kept_place + {MIN_WORDS}),
reach AS (SELECT doc_id, p, start, n, last_value(place IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY p) AS nearest
          FROM (SELECT wo.doc_id, p, start, n, place FROM wo LEFT JOIN again ON again.doc_id = wo.doc_id AND again.place = wo.p)),
gone AS (SELECT reach.doc_id, p, reach.start, n, p - row_number() OVER (PARTITION BY reach.doc_id ORDER BY p) AS run
         FROM reach LEFT JOIN lines ON lines.doc_id = reach.doc_id AND reach.start >= lines.start
              AND reach.start < lines.start + lines.length
         WHERE nearest > p - {MIN_WORDS} AND lines.doc_id IS NULL),
spans AS (SELECT doc_id, min(p) AS p, min(start) AS start, max(start + n) - min(start) AS length, count(*) AS n_words
          FROM gone GROUP BY doc_id, run),
passages AS (SELECT spans.doc_id, spans.start, length, n_words, kept_doc_id, kept_place,
                    row_number() OVER (PARTITION BY spans.doc_id, spans.p ORDER BY place <> spans.p, place) AS choice
             FROM spans JOIN again ON again.doc_id = spans.doc_id AND place > spans.p - {MIN_WORDS} AND place <= spans.p)
SELECT doc_id, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length, CAST(n_words AS BIGINT) AS n_words,
       kept_doc_id, CAST(kept_start AS BIGINT) AS kept_start
FROM lines
UNION ALL
SELECT passages.doc_id, CAST(passages.start AS BIGINT), CAST(length AS BIGINT), n_words, kept_doc_id, CAST(wo.start AS BIGINT)
FROM passages JOIN wo ON wo.doc_id = kept_doc_id AND wo.p = kept_place WHERE choice = 1"""

ARC_TO_WARC = f"""WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN n >= {REVISIT_BYTES} AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {REVISIT_BYTES} AND page_id <> last THEN last END AS refers_to
FROM g"""

QUALITY_RULES = f"""WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD}) AS words FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
lw AS (SELECT doc_id, line, regexp_extract_all(line, {_WORD}) AS words FROM l),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lw WHERE len(words) > 0 GROUP BY doc_id),
win AS (SELECT doc_id, unnest(range(len(words) - 2)) AS i,
               unnest(list_transform(range(len(words) - 2), lambda i: array_to_string(words[i + 1:i + 3], ' '))) AS three
        FROM d WHERE len(words) >= 3),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, three) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
base AS (SELECT d.doc_id, source, text, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
                len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
                coalesce(rep.n, 0) AS n_repeat_words
         FROM d LEFT JOIN dup ON dup.doc_id = d.doc_id LEFT JOIN rep ON rep.doc_id = d.doc_id),
norm AS (SELECT doc_id, line, n, sum(n) AS w
         FROM (SELECT doc_id, translate(array_to_string(words, ' '), {_LOWER}) AS line, len(words) AS n FROM lw)
         WHERE n >= {rules.MIN_LINE_WORDS} GROUP BY doc_id, line, n),
carried AS (SELECT norm.*, source, text FROM norm JOIN base ON base.doc_id = norm.doc_id),
hosts AS (SELECT source, count(DISTINCT text) AS documents FROM base GROUP BY source),
frequent AS (SELECT c.source, line, n, min(doc_id) AS first FROM carried c JOIN hosts h ON h.source IS NOT DISTINCT FROM c.source
             GROUP BY c.source, line, n, h.documents HAVING count(DISTINCT text) > {rules.LINE_LIMIT}
               AND 100 * count(DISTINCT text) * least(n, {rules.FULL_LINE_WORDS})
                   >= {rules.LINE_PERCENT * rules.FULL_LINE_WORDS} * h.documents),
lost AS (SELECT doc_id, sum(w) AS n FROM carried c JOIN frequent f ON f.source IS NOT DISTINCT FROM c.source AND f.line = c.line
         WHERE doc_id <> first GROUP BY doc_id),
v AS (SELECT base.*, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed,
             coalesce(lost.n, 0) AS lost FROM base LEFT JOIN lost ON lost.doc_id = base.doc_id)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words - lost >= CAST({rules.MIN_LEFT} AS DOUBLE) * n_words AS kept FROM v"""
