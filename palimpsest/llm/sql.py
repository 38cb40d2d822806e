"""The same results in SQL, for the queries that SQL can express."""

from __future__ import annotations

from ..plans.sql_common import MOMENTS

_RUNS = f"""
{MOMENTS},
o AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ts) - row_number() OVER (PARTITION BY url, digest ORDER BY ts) AS g FROM moments),
r AS (SELECT url, digest, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n FROM o GROUP BY url, digest, g)
"""

# a window of five words is repeated if it began before; a word is repeated if one of the five windows over it is
_SHARES = r"""
w AS (SELECT doc_id, unnest(regexp_extract_all(text, '[\p{L}\p{N}]+')) AS w, generate_subscripts(regexp_extract_all(text, '[\p{L}\p{N}]+'), 1) AS i FROM documents),
g AS (SELECT doc_id, i, lower(w) || ' ' || lead(lower(w), 1) OVER d || ' ' || lead(lower(w), 2) OVER d || ' ' || lead(lower(w), 3) OVER d || ' ' || lead(lower(w), 4) OVER d AS gram
  FROM w WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i, gram IS NOT NULL AND i > min(i) OVER (PARTITION BY doc_id, gram) AS again FROM g),
c AS (SELECT doc_id, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS covered FROM r),
s AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (covered) AS n_repeated FROM c GROUP BY doc_id)
"""

SQL: dict[str, str] = {
    "p8_found": f"WITH {_SHARES} SELECT doc_id FROM s WHERE n_repeated * 100 >= n_words * 40",
    "p8_shares": f"""WITH {_SHARES} SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_repeated, 0) AS n_repeated, coalesce(n_repeated / n_words, 0.0) AS share FROM documents d LEFT JOIN s USING (doc_id)""",
    "p6_chunked": "SELECT doc_id, true AS same FROM documents",
    "p7_targets": """SELECT mix_id, source, weight / sum(weight) OVER (PARTITION BY mix_id) AS target_share, max_repeats,
        weight > 0 AND EXISTS (SELECT 1 FROM documents d WHERE d.source = t.source AND length(d.text) > 0) AS used FROM mix_targets t""",
    "p1_found": f"WITH {_RUNS} SELECT url, first_ts, last_ts FROM r WHERE n >= 2",
    "p1_runs": f"""WITH {_RUNS} SELECT url, digest, first_ts, last_ts, n,
        date_diff('second', strptime(first_ts, '%Y%m%d%H%M%S'), strptime(last_ts, '%Y%m%d%H%M%S')) AS seconds FROM r""",
}
