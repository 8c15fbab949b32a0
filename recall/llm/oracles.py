"""DuckDB SQL for the operators whose results SQL can express."""

from __future__ import annotations

NGRAM_JACCARD = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 4], ' ') END AS s
  FROM d, unnest(range(1, greatest(len(w) - 3, 2))) t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT o.a, o.b FROM o JOIN n x ON x.doc_id = o.a JOIN n y ON y.doc_id = o.b WHERE 100 * o.o >= 75 * (x.n + y.n - o.o)),
reach(d, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.d, link.b FROM reach JOIN link ON link.a = reach.r)
SELECT d AS doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r) AS component_id FROM reach LEFT JOIN n ON n.doc_id = reach.d GROUP BY d
"""

SUFFIX_DEDUP = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s FROM d, unnest(range(0, greatest(length(h) // 2 - 99, 0))) t(i)),
f AS (SELECT s, min((doc_id::HUGEINT << 40) + i) AS first FROM w GROUP BY s HAVING count(*) > 1),
g AS (SELECT w.doc_id, w.i FROM w JOIN f ON f.s = w.s WHERE (w.doc_id::HUGEINT << 40) + w.i <> f.first),
e AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span
      FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM g)),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM e GROUP BY doc_id, span),
gaps AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS lo, a AS hi FROM spans
         UNION ALL SELECT d.doc_id, coalesce(max(s.b), 0), length(any_value(d.h)) // 2 FROM d LEFT JOIN spans s ON s.doc_id = d.doc_id GROUP BY d.doc_id),
kept AS (SELECT g.doc_id, string_agg(substr(d.h, 2 * lo + 1, 2 * (hi - lo)), '' ORDER BY lo, hi) AS h FROM gaps g JOIN d ON d.doc_id = g.doc_id GROUP BY g.doc_id)
SELECT d.doc_id, (length(d.h) // 2)::BIGINT AS n_bytes, ((length(d.h) - length(k.h)) // 2)::BIGINT AS n_removed,
       coalesce(s.n, 0)::BIGINT AS n_spans, sha256(unhex(k.h)) AS kept_sha256
FROM d JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN (SELECT doc_id, count(*) AS n FROM spans GROUP BY doc_id) s ON s.doc_id = d.doc_id
"""
