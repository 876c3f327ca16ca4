"""DuckDB SQL for the queries of ``queries.py`` that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLDED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

NEAR_DUP = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n na ON na.doc_id = x JOIN n nb ON nb.doc_id = y
      WHERE 100 * c >= 85 * (na.n + nb.n - c)),
r AS (SELECT doc_id, doc_id AS reach FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.reach),
m AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d JOIN m ON m.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

MIX = r"""
WITH d AS (SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS digest, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
z AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
k AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight,
             row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM z),
l AS (SELECT *, row_number() OVER o AS place,
             1.5::DOUBLE * (sum(source_size) OVER ())::BIGINT
               - 2.0::DOUBLE * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS left_,
             ((sum(weight) OVER ()) - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS open_
      FROM k WINDOW o AS (ORDER BY source_size::DOUBLE / weight, rank)),
f AS (SELECT left_, open_, place AS from_ FROM l WHERE left_ * weight / open_ <= 2.0::DOUBLE * source_size ORDER BY place LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN place < from_ THEN 2.0::DOUBLE * source_size
                                  ELSE f.left_ * weight / f.open_ END AS target FROM l, f),
p AS (SELECT d.*, CASE WHEN size = 0 THEN -1 ELSE (length(bin(size)) - 1) * 4
                    + ((size - (1::BIGINT << (length(bin(size)) - 1)::INT)) * 4) // (1::BIGINT << (length(bin(size)) - 1)::INT) END AS bin_ FROM d),
q AS (SELECT *, ('0x' || substr(digest, 1, 8))::BIGINT
               % ((count(*) OVER (PARTITION BY source, bin_) + 999) // 1000) AS salt FROM p),
i AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY bin_, salt, size, doc_id) AS place,
             floor(('0x' || substr(md5('17:' || coalesce('s' || source, 'null')), 1, 8))::BIGINT::DOUBLE
                   / 4294967296.0::DOUBLE * 1048576)::BIGINT AS offset_ FROM q),
r AS (SELECT i.*, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size * 1048576)::BIGINT ELSE 0 END AS rate
      FROM i JOIN t ON i.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (((place * rate + offset_) // 1048576 - ((place - 1) * rate + offset_) // 1048576) * size)::BIGINT AS taken FROM r
"""

_ITEM_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
DECONTAMINATE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_FOLDED}, {_ITEM_WORDS}) AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({_FOLDED}, {_ITEM_WORDS}) AS w FROM benchmark),
g AS (SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS t
      FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
k AS (SELECT DISTINCT k FROM g),
o AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS t
      FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, k)),
h AS (SELECT doc_id, o.k, i, item FROM o JOIN g ON g.t = o.t AND g.k = o.k),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""

LINE_DEDUP = f"""
WITH s AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents),
l AS (SELECT row, doc_id, i, x[i] AS line, translate(trim(x[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             '{_UPPER}', '{_LOWER}') AS key FROM (SELECT row, doc_id, x, unnest(range(1, len(x) + 1)) AS i FROM s)),
c AS (SELECT key FROM l WHERE key <> '' GROUP BY key HAVING count(DISTINCT row) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (c.key IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN c ON c.key = l.key GROUP BY row, doc_id
"""

_TERMS = rf"regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
RANKED_SEARCH = f"""
WITH d AS (SELECT doc_id, len(w)::BIGINT AS n, w FROM (SELECT doc_id, {_TERMS} AS w FROM documents) WHERE len(w) > 0),
c AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM d),
q AS (SELECT item_id, t, count(*)::BIGINT AS times FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY 1, 2),
p AS (SELECT doc_id, t, n, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(w) AS t FROM d)
      WHERE t IN (SELECT t FROM q) GROUP BY ALL),
f AS (SELECT t, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, c GROUP BY t),
i AS (SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))) AS impact FROM p JOIN f USING (t), c),
s AS (SELECT item_id, doc_id, sum(times * impact)::BIGINT AS score FROM q JOIN i USING (t) GROUP BY 1, 2)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 20
"""

ORACLE_SQL: dict[str, str] = {
    "op4_decontaminate": DECONTAMINATE,
    "op5_line_dedup": LINE_DEDUP,
    "op8_mix": MIX,
    "op10_near_dup": NEAR_DUP,
    "op13_ranked_search": RANKED_SEARCH,
}
