"""DuckDB SQL for the corpus queries that SQL can express over whole tables.

Each statement is the plain definition of the result, without the operator's method:
op2 counts the common shingles of every pair of documents that share one, op6 lists every
50-byte string of the corpus.
"""

from __future__ import annotations

import string

# Fixed value: the words of the contracts end at these characters.
_SPACE = "[\\x20\\x09-\\x0D]+"

NEAR_DUP = f"""
WITH RECURSIVE _w AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(COALESCE(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{_SPACE}'),
           lambda x: x <> '') AS w
  FROM documents
),
_s AS (
  SELECT DISTINCT doc_id, UNNEST(CASE WHEN len(w) = 1 THEN w
           ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM _w WHERE len(w) > 0
),
_n AS (SELECT doc_id, COUNT(*) AS n FROM _s GROUP BY doc_id),
_both AS (
  SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS c
  FROM _s a JOIN _s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
),
_link AS (
  SELECT x, y FROM _both JOIN _n p ON p.doc_id = x JOIN _n q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)
),
_edge AS (SELECT x, y FROM _link UNION ALL SELECT y, x FROM _link),
_reach AS (
  SELECT DISTINCT x, x AS y FROM _edge
  UNION
  SELECT r.x, e.y FROM _reach r JOIN _edge e ON e.x = r.y
),
_comp AS (SELECT x, MIN(y) AS least FROM _reach GROUP BY x)
SELECT d.doc_id, CAST(COALESCE(n, 0) AS BIGINT) AS n_shingles, COALESCE(least, d.doc_id) AS component_id,
       COALESCE(least, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN _n ON _n.doc_id = d.doc_id LEFT JOIN _comp ON x = d.doc_id
"""

SUFFIX_DEDUP = """
WITH _d AS (
  SELECT doc_id, lower(hex(encode(COALESCE(text, '')))) AS h, octet_length(encode(COALESCE(text, ''))) AS n
  FROM documents
),
_win AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS w
  FROM (SELECT doc_id, h, UNNEST(range(0, n - 49)) AS i FROM _d WHERE n >= 50)
),
_first AS (SELECT w, MIN(doc_id) AS m FROM _win GROUP BY w HAVING MIN(doc_id) < MAX(doc_id)),
_hit AS (SELECT doc_id, i FROM _win JOIN _first USING (w) WHERE m < doc_id),
_step AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM _hit
),
_run AS (
  SELECT doc_id, MIN(i) AS a, MAX(i) + 50 AS z
  FROM (SELECT doc_id, i, SUM(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM _step) GROUP BY doc_id, run
),
_gap AS (
  SELECT doc_id, a, z, COALESCE(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM _run
),
_kept AS (
  SELECT d.doc_id, SUM(z - a) AS n_removed, COUNT(*) AS n_spans,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * MAX(z) + 1) AS k
  FROM _d d JOIN _gap g ON d.doc_id = g.doc_id GROUP BY d.doc_id
)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(COALESCE(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(COALESCE(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(COALESCE(k, h))) AS kept_sha256
FROM _d d LEFT JOIN _kept ON _kept.doc_id = d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_near_dup": NEAR_DUP, "op6_suffix_dedup": SUFFIX_DEDUP}
