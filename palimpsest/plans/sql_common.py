"""SQL fragments that several oracle statements share."""

#: Captures as operators.captures.moments has them: ``moments(url, ts, digest)``.
MOMENTS = r"""
bare AS (
  SELECT url, regexp_replace(ts, '[^0-9]', '', 'g') AS ts,
         trim(regexp_replace(upper(trim(regexp_replace(digest, '\s+', ' ', 'g'))), '^(URN:)?SHA1:', '')) AS digest, first_seen
  FROM captures),
valued AS (
  SELECT url, ts, first_seen,
         CASE WHEN digest IN ('', '-') THEN NULL
              WHEN regexp_full_match(digest, '[0-9A-F]{40}') THEN list_aggregate(list_transform(range(32), lambda i:
                substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  CAST((CAST(('0x' || substr(digest, CAST((i // 4) * 5 + 1 AS BIGINT), 5)) AS BIGINT)
                   // [32768, 1024, 32, 1][CAST(i % 4 + 1 AS BIGINT)]) % 32 + 1 AS BIGINT), 1)), 'string_agg', '')
              ELSE digest END AS digest
  FROM bare WHERE url IS NOT NULL AND length(ts) = 14),
held AS (
  SELECT url, ts, digest, row_number() OVER (PARTITION BY url, ts ORDER BY first_seen DESC NULLS LAST, digest DESC NULLS LAST) AS k FROM valued),
moments AS (SELECT url, ts, digest FROM held WHERE k = 1 AND digest IS NOT NULL)
"""


def normal(name: str) -> str:
    """functions.text.normalize in SQL."""
    return f"trim(regexp_replace(replace(lower(strip_accents({name})), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"


def slug(key: str) -> str:
    return f"coalesce(nullif(replace({key}, ' ', '-'), ''), 'unknown')"


#: The latest contents and their items: ``full_(url, digest)``, ``listed(url, digest, pos, name, raw_key, key, item)``.
LISTED = f"""
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url, digest ORDER BY fetched_at DESC NULLS LAST, payload DESC NULLS LAST) AS k
  FROM contents WHERE url IS NOT NULL AND digest IS NOT NULL) WHERE k = 1),
good AS (SELECT url, digest, json_extract(CAST(payload AS JSON), '$.items[*]') AS items FROM latest WHERE json_valid(payload)),
full_ AS (SELECT * FROM good WHERE len(items) > 0),
exploded AS (SELECT url, digest, unnest(items) AS item, generate_subscripts(items, 1) - 1 AS pos FROM full_),
named AS (SELECT url, digest, pos, item, coalesce(item->>'$.name', '') AS name FROM exploded),
listed AS (SELECT *, {normal("name")} AS raw_key, {normal("name")} AS key FROM named)
"""

#: ``observed(url, ts, digest)`` and ``members(url, ts, pos, key, name, item)``, the first of a key in each observation.
OBSERVED = f"""
{MOMENTS},
{LISTED},
observed AS (SELECT m.url, m.ts, m.digest FROM moments m JOIN full_ f ON m.url = f.url AND m.digest = f.digest),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url, digest, key ORDER BY pos) AS k FROM listed WHERE key <> '') WHERE k = 1),
members AS (SELECT o.url, o.ts, f.pos, f.key, f.name, f.item FROM observed o JOIN firsts f ON o.url = f.url AND o.digest = f.digest)
"""


def runs_sql(observations: str, members: str) -> str:
    """CTEs ``at_`` and ``runs(list, member, i, j, from_ts, to_ts, before_ts, after_ts, still_on)`` from two relations."""
    return f"""
at_ AS (SELECT list, ts, row_number() OVER w - 1 AS idx, lag(ts) OVER w AS prev_ts, lead(ts) OVER w AS next_ts FROM (SELECT DISTINCT list, ts FROM {observations}) WINDOW w AS (PARTITION BY list ORDER BY ts)),
on_ AS (SELECT DISTINCT m.list, m.member, a.ts, a.idx, a.prev_ts, a.next_ts FROM {members} m JOIN at_ a ON m.list = a.list AND m.ts = a.ts),
isl AS (SELECT *, idx - row_number() OVER (PARTITION BY list, member ORDER BY idx) AS g FROM on_),
runs AS (SELECT list, member, min(idx) AS i, max(idx) AS j, min(ts) AS from_ts, max(ts) AS to_ts, arg_min(struct_pack(v := prev_ts), idx).v AS before_ts,
    arg_max(struct_pack(v := next_ts), idx).v AS after_ts, arg_max(struct_pack(v := next_ts), idx).v IS NULL AS still_on FROM isl GROUP BY list, member, g)
"""
