"""SQL for the queries of the subpackage that SQL can express."""

from __future__ import annotations

OP8 = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
p AS (
  SELECT conv_id, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS turns,
    string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10)
      || replace(replace(coalesce(text, ''), '<|im_start|>', '<|im_start |>'), '<|im_end|>', '<|im_end |>')
      || '<|im_end|>' || chr(10), '') OVER (w ROWS UNBOUNDED PRECEDING) AS rendered
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST)
),
whole AS (
  SELECT turns, rendered, min(conv_id) AS conv_id, count(*) AS n_equal FROM p WHERE place = turns GROUP BY turns, rendered
)
SELECT conv_id, turns AS n_turns, n_equal, rendered FROM whole
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.place < p.turns AND p.place = whole.turns AND p.rendered = whole.rendered)
"""

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, 1 AS k, unnest(w) AS p FROM words
  UNION ALL SELECT lang, 2, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM words
  UNION ALL SELECT lang, 3, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) FROM words
),
f AS MATERIALIZED (SELECT lang, k, p, count(*) AS c FROM grams GROUP BY ALL),
cand AS (SELECT lang, k, p, c, string_split(p, ' ') AS w FROM f WHERE k > 1 AND c >= 10),
cuts AS (
  SELECT lang, k, p, c, 1 AS cut, w[1] AS x, array_to_string(w[2:], ' ') AS y FROM cand
  UNION ALL SELECT lang, k, p, c, 2, w[1] || ' ' || w[2], w[3] FROM cand WHERE k = 3
),
scored AS (
  SELECT cuts.lang, cuts.p, cuts.c AS a, cut, l.c AS l, r.c AS r,
    (1000000::HUGEINT * cuts.c * cuts.c // (l.c::HUGEINT * r.c))::BIGINT AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.p = x JOIN f r ON r.lang = cuts.lang AND r.p = y
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, w[1] || ' ' || w[2] AS p, c FROM cand WHERE k = 3 UNION ALL SELECT lang, w[2] || ' ' || w[3], c FROM cand WHERE k = 3
),
kept AS (
  SELECT * FROM best
  WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = best.lang AND i.p = best.p AND 100 * i.c >= 50 * best.a)
),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM kept),
total AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang)
SELECT lang, rank, p AS phrase, a, l, r, n, score FROM placed JOIN total USING (lang) WHERE rank <= 2000
"""



def _clean_words(table: str, key: str) -> str:
    return rf"SELECT {key}, coalesce(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM {table}"


# the CRC of a feature is folded byte by byte with a table that the first part derives
OP12 = rf"""
WITH RECURSIVE step(i, c, k) AS (
  SELECT i, i::UBIGINT, 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END, k + 1 FROM step WHERE k < 8
),
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS v FROM step WHERE k = 8),
doc AS MATERIALIZED ({_clean_words('documents', 'doc_id')}),
runs AS MATERIALIZED (
  SELECT doc_id, unnest(w) AS f FROM doc
  UNION ALL SELECT doc_id, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM doc
  UNION ALL SELECT doc_id, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) FROM doc
),
goal AS ({_clean_words('benchmark', 'item_id')}),
goals AS (
  SELECT unnest(w) AS f FROM goal
  UNION ALL SELECT unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM goal
  UNION ALL SELECT unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) FROM goal
),
names AS (SELECT DISTINCT f, hex(f) AS h FROM (SELECT f FROM runs UNION ALL SELECT f FROM goals)),
codes AS (SELECT f, [4294967295::UBIGINT] || [('0x' || h[2 * i + 1 : 2 * i + 2])::UBIGINT FOR i IN range(0, len(h) // 2)] AS b FROM names),
bucketed AS MATERIALIZED (
  SELECT f, xor(list_reduce(b, lambda c, x: xor(c // 256, v[(xor(c, x) % 256 + 1)::BIGINT])), 4294967295::UBIGINT) % 10000 AS bucket
  FROM codes CROSS JOIN crc
),
placed AS MATERIALIZED (SELECT doc_id, bucket FROM runs JOIN bucketed USING (f)),
s AS (SELECT bucket, count(*) AS s FROM placed GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM goals JOIN bucketed USING (f) GROUP BY bucket),
whole AS (SELECT (SELECT count(*) FROM runs) AS s_all, (SELECT count(*) FROM goals) AS t_all),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS g
  FROM s LEFT JOIN t USING (bucket) CROSS JOIN whole
),
weighed AS (SELECT doc_id, count(*) AS n_features, sum(g)::BIGINT AS weight FROM placed JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS fit,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM doc LEFT JOIN weighed USING (doc_id)
),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id) AS place,
    (SELECT count(*) FROM scored WHERE fit) * 5 // 100 AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= n THEN place END AS rank FROM ordered
"""

OP13 = rf"""
WITH RECURSIVE words AS (SELECT doc_id, coalesce(regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) BETWEEN 1 AND 3 THEN [array_to_string(w, ' ')]
    ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] FOR i IN range(1, len(w) - 2)] END) AS s
  FROM words
),
sizes AS MATERIALIZED (SELECT doc_id, count(s) AS n FROM documents LEFT JOIN shingles USING (doc_id) GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
near AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)
),
links AS MATERIALIZED (SELECT x, y FROM near UNION ALL SELECT y, x FROM near),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sizes UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.other
)
SELECT doc_id, any_value(n) AS n_shingles, min(other) AS component_id FROM reach JOIN sizes USING (doc_id) GROUP BY doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_chat_formatting": OP8, "op11_collocations": OP11, "op12_importance_resampling": OP12, "op13_jaccard_join": OP13}
