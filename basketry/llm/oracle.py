"""DuckDB SQL of the operators that SQL can state (the others are tested by brute force)."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LETTERS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_SPACED = r"regexp_extract_all(" + _LOWER + r", '[^\x20\x09-\x0D]+')"

SQL = {
    "op1_decontaminate": f"""
WITH d AS (SELECT doc_id, {_LETTERS} AS w FROM documents),
b AS (SELECT item_id, {_LETTERS} AS w FROM benchmark),
cut AS (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(len(w) - least(13, len(w)) + 1)) AS s FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[s + 1:s + k], ' ') AS t FROM cut),
sizes AS (SELECT DISTINCT k FROM win),
run AS (SELECT doc_id, k, s, array_to_string(w[s + 1:s + k], ' ') AS t
        FROM (SELECT doc_id, w, k, unnest(range(len(w) - k + 1)) AS s FROM d, sizes WHERE len(w) >= k)),
hit AS (SELECT doc_id, run.k, s, item_id FROM run JOIN win USING (t)),
covered AS (SELECT doc_id, COUNT(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM hit) GROUP BY doc_id),
listed AS (SELECT doc_id, COUNT(*) AS n, string_agg(i, ',' ORDER BY i) AS ids
           FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(l.n, 0) AS n_items,
       sha256(coalesce(l.ids, '')) AS items_sha256, coalesce(c.n, 0) > 0 AND 20 * coalesce(c.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN listed l USING (doc_id)
""",
    "op10_ngram_join": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACED} AS w FROM documents),
shingle AS (SELECT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM d WHERE len(w) >= 4)
            UNION SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 3),
size AS (SELECT doc_id, COUNT(*) AS n FROM shingle GROUP BY doc_id),
pair AS (SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS i FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM pair JOIN size s ON s.doc_id = x JOIN size t ON t.doc_id = y WHERE 100 * i >= 85 * (s.n + t.n - i)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.c AS component_id
FROM d LEFT JOIN size s USING (doc_id) JOIN (SELECT x AS doc_id, MIN(y) AS c FROM reach GROUP BY x) r USING (doc_id)
""",
    "op11_ranked_search": f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_TERMS}') AS w FROM documents),
sizes AS (SELECT doc_id, len(w) AS n FROM d WHERE len(w) > 0),
total AS (SELECT COUNT(*) AS nn, CAST(SUM(n) AS BIGINT) AS ll FROM sizes),
asked AS (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERMS}')) AS t FROM benchmark),
posting AS (SELECT doc_id, t, COUNT(*) AS tf FROM (SELECT doc_id, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM asked) GROUP BY doc_id, t),
weight AS (SELECT t, CAST(floor(1000 * ln((2 * nn + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS w FROM posting, total GROUP BY t, nn),
impact AS (SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * nn) // ll))) AS i
           FROM posting JOIN sizes USING (doc_id) JOIN weight USING (t), total),
scored AS (SELECT item_id, doc_id, CAST(SUM(i) AS BIGINT) AS score FROM asked JOIN impact USING (t) GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
           FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
""",
}
