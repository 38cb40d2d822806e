"""Queries of the general history operators (p3, p5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.snapshot_diff import snapshot_changes
from ..operators.versions import attribute_versions
from ..sources.tables import table
from .sql_common import MOMENTS


def p3_versions(spark: SparkSession, d: str) -> DataFrame:
    """Every version of a place's address, phone and website with its period."""
    return attribute_versions(table(spark, d, "current_list"), "place_id", "source_url", "as_of_ts", "fetched_at", ["address", "phone", "website"])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_versions(spark, d).select("place_id", "valid_from", "valid_to")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Items added, removed or changed between consecutive snapshots of a url."""
    return snapshot_changes(table(spark, d, "captures"), table(spark, d, "contents"))


QUERIES = {"p3_found": p3_found, "p3_versions": p3_versions, "p5_found": p5_found}

_VERSIONS = r"""
rws AS (SELECT place_id, source_url, as_of_ts, fetched_at,
    nullif(trim(address, E' \t\n\r'), '') AS address, nullif(trim(phone, E' \t\n\r'), '') AS phone, nullif(trim(website, E' \t\n\r'), '') AS website
  FROM current_list WHERE place_id IS NOT NULL AND as_of_ts IS NOT NULL),
snaps AS (SELECT source_url, as_of_ts, row_number() OVER w AS idx, lead(as_of_ts) OVER w AS next_ts
  FROM (SELECT DISTINCT source_url, as_of_ts FROM rws) WINDOW w AS (PARTITION BY source_url ORDER BY as_of_ts)),
held AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY place_id, as_of_ts
    ORDER BY fetched_at DESC NULLS LAST, address DESC NULLS LAST, phone DESC NULLS LAST, website DESC NULLS LAST, source_url DESC NULLS LAST) AS k FROM rws) WHERE k = 1),
placed AS (SELECT h.*, s.idx, s.next_ts FROM held h JOIN snaps s ON h.source_url IS NOT DISTINCT FROM s.source_url AND h.as_of_ts = s.as_of_ts),
marked AS (SELECT *, CASE WHEN lag(idx) OVER w = idx - 1 AND lag(address) OVER w IS NOT DISTINCT FROM address
    AND lag(phone) OVER w IS NOT DISTINCT FROM phone AND lag(website) OVER w IS NOT DISTINCT FROM website THEN 0 ELSE 1 END AS fresh
  FROM placed WINDOW w AS (PARTITION BY place_id, source_url ORDER BY idx)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY place_id, source_url ORDER BY idx) AS v FROM marked),
versions AS (SELECT place_id, source_url, min(as_of_ts) AS valid_from, coalesce(arg_max(struct_pack(n := next_ts), idx).n, 'open') AS valid_to,
    any_value(address) AS address, any_value(phone) AS phone, any_value(website) AS website
  FROM numbered GROUP BY place_id, source_url, v)
"""

_CHANGES = f"""
{MOMENTS},
latest AS (SELECT * FROM (SELECT url, digest, payload, row_number() OVER (PARTITION BY url, digest ORDER BY fetched_at DESC NULLS LAST) AS k
  FROM contents WHERE url IS NOT NULL AND digest IS NOT NULL) WHERE k = 1),
good AS (SELECT url, digest, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS p FROM latest),
listed AS (SELECT url, digest, json_extract(p, '$.items[*]') AS items FROM good WHERE p IS NOT NULL),
full_ AS (SELECT * FROM listed WHERE len(items) > 0),
exploded AS (SELECT url, digest, unnest(items) AS item, generate_subscripts(items, 1) AS pos FROM full_),
vals AS (SELECT url, digest, pos, item->>'$.slug' AS slug, list_transform(['name', 'website', 'address', 'phone', 'price'],
    lambda f: coalesce(trim(json_extract_string(item, f), E' \\t\\n\\r'), '')) AS v FROM exploded),
items AS (SELECT url, digest, slug, arg_min(v, pos) AS v FROM vals WHERE trim(slug) <> '' GROUP BY url, digest, slug),
steps AS (SELECT m.url, m.ts, m.digest, lag(m.digest) OVER (PARTITION BY m.url ORDER BY m.ts) AS prev
  FROM moments m JOIN full_ f ON m.url = f.url AND m.digest = f.digest),
moved AS (SELECT * FROM steps WHERE prev <> digest),
now_ AS (SELECT s.url, s.ts, s.prev, i.slug, i.v FROM moved s JOIN items i ON s.url = i.url AND s.digest = i.digest),
then_ AS (SELECT s.url, s.ts, i.slug, i.v FROM moved s JOIN items i ON s.url = i.url AND s.prev = i.digest),
changes AS (SELECT coalesce(n.url, t.url) AS url, coalesce(n.ts, t.ts) AS by_ts, coalesce(n.slug, t.slug) AS slug,
    CASE WHEN t.slug IS NULL THEN 'added' WHEN n.slug IS NULL THEN 'removed' WHEN n.v <> t.v THEN 'changed' END AS kind
  FROM now_ n FULL JOIN then_ t ON n.url = t.url AND n.ts = t.ts AND n.slug = t.slug)
"""

SQL = {
    "p3_found": f"WITH {_VERSIONS} SELECT place_id, valid_from, valid_to FROM versions",
    "p3_versions": f"WITH {_VERSIONS} SELECT * FROM versions",
    "p5_found": f"WITH {_CHANGES} SELECT url, by_ts, slug, kind FROM changes WHERE kind IS NOT NULL",
}
