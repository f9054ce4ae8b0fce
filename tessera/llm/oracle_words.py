"""DuckDB SQL of the sharding and spelling operators; both need a crc32 in SQL."""

from __future__ import annotations

from tessera.llm.oracle import _LOWER
from tessera.llm.spelling import DOMINANCE, DROP_ONE_IN, MIN_COUNT, MIN_LETTERS

#: Table of the reflected polynomial, from its rule.
_TABLE = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def _crc32(text: str) -> str:
    """crc32 of a text's UTF-8 bytes; ``t`` is the table."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295, {octets}), "
            f"lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))")


def _draws(shards: int) -> str:
    """Shard of least cost at equal weights: the largest draw, ties to the smaller number."""
    def draw(shard: str) -> str:
        return f"CAST('0x' || substr(md5(k || ':' || {shard}), 1, 13) AS BIGINT)"

    return f"list_reduce(range({shards}), lambda a, b: CASE WHEN {draw('b')} > {draw('a')} THEN b ELSE a END)"


SHARDING = f"""WITH {_TABLE},
d AS (SELECT doc_id, coalesce(text, '') AS x, coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(coalesce(text, ''))) AS k
      FROM documents),
s AS (SELECT doc_id, CAST(octet_length(encode(x)) + 1 AS BIGINT) AS size, CAST({_crc32('x')} AS BIGINT) AS text_crc32,
             CAST({_draws(8)} AS INTEGER) AS shard, CAST({_draws(9)} AS INTEGER) AS grown_shard FROM d, crc)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, CAST(row_number() OVER (PARTITION BY shard
       ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS BIGINT) AS slot, grown_shard FROM s"""

SPELLING = f"""WITH RECURSIVE {_TABLE},
r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS k,
             unnest(regexp_extract_all(translate(text, {_LOWER}), '[a-zÀ-ÿ]+')) AS run FROM documents),
c AS (SELECT k, run, count(*) AS n FROM r WHERE length(run) >= {MIN_LETTERS} GROUP BY k, run),
h AS (SELECT run, n, CAST({_crc32("k || ':' || run")} AS BIGINT) AS h FROM c, crc),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT n, CASE WHEN h % {DROP_ONE_IN} = 0
          THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word
        FROM h) GROUP BY word HAVING length(word) >= {MIN_LETTERS} AND sum(n) >= {MIN_COUNT}),
gaps AS (SELECT DISTINCT word, n, substr(word, 1, i) || substr(word, i + 2) AS gap
         FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)
         UNION ALL SELECT word, n, word FROM v),
near AS (SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.gap = b.gap
         WHERE a.word <> b.word AND abs(length(a.word) - length(b.word)) <= 1
           AND (length(a.word) <> length(b.word) OR len(list_filter(range(1, length(a.word) + 1),
                lambda i: substr(a.word, i, 1) <> substr(b.word, i, 1))) = 1)
           AND (length(a.word) = length(b.word) OR a.gap = a.word OR b.gap = b.word)),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, encode(near))) AS form, max(near_n) AS form_n
         FROM near GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= {DOMINANCE} * v.n THEN form END AS form,
             CASE WHEN form_n >= {DOMINANCE} * v.n THEN form_n END AS form_n FROM v LEFT JOIN best ON v.word = best.word),
walk AS (SELECT word, word AS here, 0 AS steps FROM f
         UNION ALL SELECT w.word, f.form, steps + 1 FROM walk w JOIN f ON f.word = w.here WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(here, steps) AS root FROM walk GROUP BY word)
SELECT f.word, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form, f.form_n, ends.root
FROM f JOIN ends ON ends.word = f.word"""
