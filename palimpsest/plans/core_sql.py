"""The queries of plans.core in SQL, independent of the engine."""

from __future__ import annotations

from ..functions.hours import DAYS, MEAL_WORDS, MEALS, RANGE, SINGLE
from .sql_common import LISTED, MOMENTS, OBSERVED, normal, runs_sql, slug

WS = r"E' \t\n\r'"


def shown(c: str) -> str:
    return f"nullif(trim({c}, {WS}), '')"


def day(c: str) -> str:
    return f"CASE WHEN length(coalesce({c}, '')) >= 8 THEN substr({c}, 1, 4) || '-' || substr({c}, 5, 2) || '-' || substr({c}, 7, 2) WHEN coalesce({c}, '') = '' THEN '?' ELSE {c} END"


_RUNS = f"""
{OBSERVED},
o_ AS (SELECT url AS list, ts FROM observed),
m_ AS (SELECT url AS list, ts, key AS member FROM members),
{runs_sql("o_", "m_")}
"""

# an alias leads to the key without its article; a key that is itself an alias leads on
_ALIASED_RUNS = f"""
{OBSERVED},
al AS (SELECT DISTINCT raw_key AS alias, regexp_replace(raw_key, '^(the|la|le|il|el) ', '') AS target FROM listed WHERE regexp_matches(raw_key, '^(the|la|le|il|el) .')),
chain AS (SELECT a.alias, coalesce(c.target, b.target, a.target) AS target FROM al a LEFT JOIN al b ON a.target = b.alias LEFT JOIN al c ON b.target = c.alias),
led AS (SELECT l.url, l.digest, coalesce(c.target, l.raw_key) AS k FROM listed l LEFT JOIN chain c ON l.raw_key = c.alias),
o_ AS (SELECT url AS list, ts FROM observed),
m_ AS (SELECT o.url AS list, o.ts, l.k AS member FROM observed o JOIN (SELECT DISTINCT url, digest, k FROM led WHERE k <> '') l ON o.url = l.url AND o.digest = l.digest),
{runs_sql("o_", "m_")}
"""

_LOG = f"""
{OBSERVED},
steps AS (SELECT * FROM (SELECT url AS list, ts AS by_ts, digest AS new, lag(ts) OVER w AS after_ts, lag(digest) OVER w AS old FROM observed WINDOW w AS (PARTITION BY url ORDER BY ts)) WHERE old <> new),
came AS (SELECT s.list, s.by_ts, string_agg(f.name, '; ' ORDER BY f.pos) AS names, string_agg(f.key, '; ' ORDER BY f.pos) AS keys FROM steps s JOIN firsts f ON s.list = f.url AND s.new = f.digest
  WHERE NOT EXISTS (SELECT 1 FROM firsts x WHERE x.url = s.list AND x.digest = s.old AND x.key = f.key) GROUP BY ALL),
went AS (SELECT s.list, s.by_ts, string_agg(f.name, '; ' ORDER BY f.pos) AS names, string_agg(f.key, '; ' ORDER BY f.pos) AS keys FROM steps s JOIN firsts f ON s.list = f.url AND s.old = f.digest
  WHERE NOT EXISTS (SELECT 1 FROM firsts x WHERE x.url = s.list AND x.digest = s.new AND x.key = f.key) GROUP BY ALL),
idx AS (SELECT url AS list, ts, row_number() OVER (PARTITION BY url ORDER BY ts) AS n FROM moments),
log AS (SELECT s.list, s.after_ts, s.by_ts, coalesce(c.names, '') AS added, coalesce(w.names, '') AS removed, greatest(b.n - a.n - 1, 0) AS unsampled, c.keys AS ak, w.keys AS rk
  FROM steps s LEFT JOIN came c ON s.list = c.list AND s.by_ts = c.by_ts LEFT JOIN went w ON s.list = w.list AND s.by_ts = w.by_ts
  JOIN idx a ON s.list = a.list AND s.after_ts = a.ts JOIN idx b ON s.list = b.list AND s.by_ts = b.ts WHERE c.names IS NOT NULL OR w.names IS NOT NULL)
"""

_SIGNED = f"""
{OBSERVED},
sigs AS (SELECT url, digest, md5(string_agg(key, chr(31) ORDER BY key)) AS sig FROM firsts GROUP BY url, digest),
signed AS (SELECT o.url AS list, o.ts, s.sig, row_number() OVER (PARTITION BY o.url ORDER BY o.ts) - 1 AS idx FROM observed o JOIN sigs s ON o.url = s.url AND o.digest = s.digest),
points AS (SELECT list, after_ts, by_ts FROM (SELECT list, ts AS by_ts, sig, lag(ts) OVER w AS after_ts, lag(sig) OVER w AS before FROM signed WINDOW w AS (PARTITION BY list ORDER BY ts)) WHERE before <> sig)
"""

_BISECT = _SIGNED + """,
spans AS (
  SELECT list, min(idx) AS lo, max(idx) AS hi FROM signed GROUP BY list
  UNION ALL
  SELECT s.list, CASE WHEN h.side = 0 THEN s.lo ELSE (s.lo + s.hi) // 2 END, CASE WHEN h.side = 0 THEN (s.lo + s.hi) // 2 ELSE s.hi END
  FROM spans s JOIN signed a ON s.list = a.list AND s.lo = a.idx JOIN signed b ON s.list = b.list AND s.hi = b.idx, (VALUES (0), (1)) h(side)
  WHERE a.sig <> b.sig AND s.hi - s.lo > 1)
"""

_FIELDS = ["address", "phone", "website", "source_anchor", "price", "tip"]
_text = ", ".join(f"arg_max(CASE WHEN item->>'$.{f}' <> '' THEN item->>'$.{f}' END, CASE WHEN item->>'$.{f}' <> '' THEN ts END) AS {f}" for f in _FIELDS)
_numbers = ", ".join(f"arg_max(TRY_CAST(item->>'$.{f}' AS DOUBLE), CASE WHEN item->>'$.{f}' IS NOT NULL THEN ts END) AS {f}" for f in ("lat", "lng"))
_MERGED = f"merged AS (SELECT url, key, {_text}, {_numbers} FROM members GROUP BY url, key)"

_CLOSED = f"closed AS (SELECT DISTINCT {slug(normal('place'))} AS id FROM eater38_places WHERE on_list_now = 'no' AND place IS NOT NULL)"


def _clock(v: str) -> str:
    bare = f"regexp_replace(lower(trim({v})), '[. ]', '', 'g')"
    core = f"regexp_replace({bare}, 'am|pm', '', 'g')"
    h = f"TRY_CAST(split_part({core}, ':', 1) AS INT)"
    m = f"CASE WHEN contains({core}, ':') THEN TRY_CAST(split_part({core}, ':', 2) AS INT) ELSE 0 END"
    hour = f"CASE WHEN contains({bare}, 'pm') AND {h} < 12 THEN {h} + 12 WHEN contains({bare}, 'am') AND {h} = 12 THEN 0 WHEN {h} = 24 THEN 0 ELSE {h} END"
    return f"CASE WHEN {h} BETWEEN 0 AND 24 AND {m} BETWEEN 0 AND 59 THEN lpad(CAST({hour} AS VARCHAR), 2, '0') || ':' || lpad(CAST({m} AS VARCHAR), 2, '0') END"


_dow = lambda w: f"list_position({DAYS}, substr(lower({w}), 1, 3)) - 1"
_all = lambda p, g: f"unnest(regexp_extract_all(t, '(?i){p}', {g}))"
_HOURS = f"""
docs AS (SELECT doc_id, regexp_replace(text, '\\s+', ' ', 'g') AS t FROM documents WHERE text IS NOT NULL),
rng AS (SELECT doc_id, {_all(RANGE, 1)} AS a, {_all(RANGE, 2)} AS b, {_all(RANGE, 3)} AS o, {_all(RANGE, 4)} AS c FROM docs),
rng2 AS (SELECT doc_id, {_dow('a')} AS i, {_dow('b')} AS j, {_clock('o')} AS opens, {_clock('c')} AS closes FROM rng),
rng3 AS (SELECT doc_id, {DAYS}[CAST(unnest(range(i, CASE WHEN j < i THEN j + 7 ELSE j END + 1)) % 7 + 1 AS INT)] AS day, opens, closes FROM rng2),
one AS (SELECT doc_id, {_all(SINGLE, 1)} AS a, {_all(SINGLE, 2)} AS o, {_all(SINGLE, 3)} AS c FROM docs),
one2 AS (SELECT doc_id, {DAYS}[CAST({_dow('a')} + 1 AS INT)] AS day, {_clock('o')} AS opens, {_clock('c')} AS closes FROM one),
spans AS (SELECT DISTINCT * FROM (SELECT * FROM rng3 UNION ALL SELECT * FROM one2) WHERE opens IS NOT NULL AND closes IS NOT NULL)
"""
_mins = lambda c: f"(CAST(substr({c}, 1, 2) AS INT) * 60 + CAST(substr({c}, 4, 2) AS INT))"
_over = lambda lo, hi: f"bool_or({_mins('opens')} < {hi} AND {_mins('closes')} + CASE WHEN {_mins('closes')} <= {_mins('opens')} THEN 1440 ELSE 0 END > {lo})"

_CURRENT = f"""
held AS (SELECT * FROM (SELECT source_url AS list, as_of_ts AS ts, place_id AS member, coalesce(pos, 0) AS pos, {shown('name')} AS name,
    row_number() OVER (PARTITION BY source_url, as_of_ts, place_id ORDER BY fetched_at DESC NULLS LAST, coalesce(pos, 0) DESC, {shown('name')} DESC NULLS LAST) AS k FROM current_list) WHERE k = 1),
{runs_sql("held", "held")}
"""

_PERIODS = """
parts AS (SELECT place_id, place, periods, unnest(string_split_regex(coalesce(periods, ''), '\\s*;\\s*')) AS p FROM (SELECT DISTINCT place_id, place, periods FROM eater38_places)),
per AS (SELECT place_id, place, substr(trim(p), 1, 10) AS a, substr(trim(p), 15, 10) AS b FROM parts WHERE regexp_full_match(p, '\\s*\\d{4}-\\d\\d-\\d\\d to \\d{4}-\\d\\d-\\d\\d\\s*'))
"""

_PLACES = "p AS (SELECT DISTINCT place_id, place, address FROM eater38_places)"
_named = lambda words: " OR ".join(f"contains(lower(text), '{w}')" for w in words)

SQL = {
    "capture_moments": f"WITH {MOMENTS} SELECT * FROM moments",
    "observations": f"WITH {OBSERVED} SELECT url, ts, pos, key, name FROM members",
    "presence_periods": f"WITH {_RUNS} SELECT * FROM runs",
    "aliased_periods": f"WITH {_ALIASED_RUNS} SELECT list, member, from_ts, to_ts, still_on FROM runs",
    "history_rows": f"""WITH {_RUNS}, last_ AS (SELECT url AS list, key AS member, arg_max(name, (ts, name)) AS name FROM members GROUP BY ALL)
        SELECT name AS place, {day('from_ts')} AS on_list_from, {day('to_ts')} AS on_list_through,
          CASE WHEN before_ts IS NULL THEN 'before coverage' ELSE ({day('before_ts')}) || ' - ' || ({day('from_ts')}) END AS added_between,
          CASE WHEN after_ts IS NULL THEN 'still on list' ELSE ({day('to_ts')}) || ' - ' || ({day('after_ts')}) END AS removed_between,
          CASE WHEN still_on THEN 'yes' ELSE 'no' END AS still_on_list FROM runs JOIN last_ USING (list, member)""",
    "change_log": f"WITH {_LOG} SELECT list, after_ts, by_ts, added, removed, unsampled FROM log",
    "change_log_open": f"""WITH {_LOG}, {_CLOSED},
        ids AS (SELECT list, by_ts, 'a' AS k, unnest(string_split(ak, '; ')) AS key, generate_subscripts(string_split(ak, '; '), 1) AS n FROM log WHERE ak IS NOT NULL
          UNION ALL SELECT list, by_ts, 'r', unnest(string_split(rk, '; ')), generate_subscripts(string_split(rk, '; '), 1) FROM log WHERE rk IS NOT NULL),
        kept AS (SELECT *, {slug('key')} AS id FROM ids WHERE {slug('key')} NOT IN (SELECT id FROM closed)),
        back AS (SELECT list, by_ts, coalesce(string_agg(id, '; ' ORDER BY n) FILTER (k = 'a'), '') AS added_ids, coalesce(string_agg(id, '; ' ORDER BY n) FILTER (k = 'r'), '') AS removed_ids FROM kept GROUP BY ALL)
        SELECT list, after_ts, by_ts, added, removed, added_ids, removed_ids FROM log JOIN back USING (list, by_ts)""",
    "transitions": f"WITH {_LOG} SELECT list, by_ts, 'added' AS kind, unnest(string_split(ak, '; ')) AS key FROM log WHERE ak IS NOT NULL UNION ALL SELECT list, by_ts, 'removed', unnest(string_split(rk, '; ')) FROM log WHERE rk IS NOT NULL",
    "alias_suggestions": f"""WITH {_LOG}, a AS (SELECT list, by_ts AS by, unnest(string_split(ak, '; ')) AS added, len(string_split(ak, '; ')) AS na FROM log WHERE ak IS NOT NULL),
        r AS (SELECT list, by_ts AS by, unnest(string_split(rk, '; ')) AS removed, len(string_split(rk, '; ')) AS nr FROM log WHERE rk IS NOT NULL)
        SELECT list, "by", removed, added FROM a JOIN r USING (list, "by") WHERE CASE WHEN na = 1 AND nr = 1
          THEN contains(added, removed) OR contains(removed, added) OR len(list_intersect(string_split(added, ' '), string_split(removed, ' '))) >= 2
          ELSE (contains(added, removed) OR contains(removed, added)) AND abs(length(added) - length(removed)) <= 12 END""",
    "change_points": f"WITH {_SIGNED} SELECT * FROM points",
    "bisected_changes": f"""WITH RECURSIVE {_BISECT} SELECT s.list, a.ts AS after_ts, b.ts AS by_ts FROM spans s JOIN signed a ON s.list = a.list AND s.lo = a.idx
        JOIN signed b ON s.list = b.list AND s.hi = b.idx WHERE a.sig <> b.sig AND s.hi - s.lo = 1""",
    "bisect_probes": f"WITH RECURSIVE {_BISECT} SELECT list, count(DISTINCT i) AS probes FROM (SELECT list, lo AS i FROM spans UNION ALL SELECT list, hi FROM spans) GROUP BY list",
    "list_versions": f"""WITH {_SIGNED}, marked AS (SELECT *, CASE WHEN lag(sig) OVER w = sig THEN 0 ELSE 1 END AS fresh FROM signed WINDOW w AS (PARTITION BY list ORDER BY ts)),
        numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY list ORDER BY ts) AS v FROM marked)
        SELECT list, any_value(sig) AS sig, min(ts) AS from_ts, max(ts) AS to_ts, count(*) AS n FROM numbered GROUP BY list, v""",
    "long_gaps": f"WITH {_SIGNED}, d AS (SELECT *, date_diff('day', strptime(substr(after_ts, 1, 8), '%Y%m%d'), strptime(substr(by_ts, 1, 8), '%Y%m%d')) AS days FROM points) SELECT * FROM d WHERE days > 30",
    "merged_attributes": f"WITH {OBSERVED}, {_MERGED} SELECT * FROM merged",
    "member_names": f"WITH {OBSERVED} SELECT url, key, arg_max(name, (ts, name)) AS name, string_agg(DISTINCT name, '; ' ORDER BY name) AS names_seen FROM members GROUP BY ALL",
    "own_sites": """WITH c AS (SELECT DISTINCT place_id, as_of_ts, coalesce(source_anchor, '') AS w, coalesce(website, '') AS g FROM current_list)
        SELECT DISTINCT place_id, as_of_ts, CASE WHEN w <> '' AND NOT contains(w, 'guide.example') THEN w WHEN NOT contains(g, 'guide.example') THEN g ELSE '' END AS website,
          CASE WHEN contains(w, 'guide.example') THEN w WHEN contains(g, 'guide.example') THEN g ELSE '' END AS anchor FROM c""",
    "capture_statistics": f"""WITH {MOMENTS}, s AS (SELECT url, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts, count(DISTINCT digest) AS digests FROM moments GROUP BY url),
        h AS (SELECT url, count(DISTINCT digest) AS cached FROM contents GROUP BY url)
        SELECT s.*, coalesce(cached, 0) AS cached, greatest(digests - coalesce(cached, 0), 0) AS missing FROM s LEFT JOIN h USING (url)""",
    "fetch_list": f"""WITH {MOMENTS}, h AS (SELECT url, digest, max(extractor_version) AS v FROM contents GROUP BY ALL)
        SELECT m.url, m.digest, min(m.ts) AS ts, CASE WHEN any_value(v) IS NULL THEN 'fetch' ELSE 'parse' END AS why FROM moments m LEFT JOIN h USING (url, digest) WHERE v IS NULL OR v < 6 GROUP BY m.url, m.digest""",
    "since_anchor": f"""WITH {MOMENTS}, k AS (SELECT url, max(effective_ts) AS last_ts FROM contents GROUP BY url), known AS (SELECT k.* FROM k JOIN moments m ON k.url = m.url AND k.last_ts = m.ts)
        SELECT m.url, m.ts, m.digest FROM moments m LEFT JOIN known k ON m.url = k.url WHERE k.last_ts IS NULL OR m.ts >= k.last_ts""",
    "latest_extractions": "SELECT url, digest, fetched_at, extractor_version, length(payload) AS size FROM (SELECT *, row_number() OVER (PARTITION BY url, digest ORDER BY fetched_at DESC NULLS LAST, payload DESC NULLS LAST, extractor_version DESC NULLS LAST) AS k FROM contents WHERE url IS NOT NULL AND digest IS NOT NULL) WHERE k = 1",
    "last_write": "SELECT url, effective_ts, fetched_at, digest FROM (SELECT *, row_number() OVER (PARTITION BY url, effective_ts ORDER BY fetched_at DESC NULLS LAST, digest DESC NULLS LAST) AS k FROM contents WHERE effective_ts IS NOT NULL AND url IS NOT NULL) WHERE k = 1",
    "current_entries": f"""WITH {_CURRENT}, gone AS (SELECT DISTINCT place_id FROM documents WHERE source = 'closure_note' AND place_id IS NOT NULL),
        now_ AS (SELECT h.* FROM held h JOIN (SELECT list, max(ts) AS ts FROM held GROUP BY list) USING (list, ts) WHERE member NOT IN (SELECT place_id FROM gone))
        SELECT n.list, n.member, row_number() OVER (PARTITION BY n.list ORDER BY n.pos, n.member) AS position, n.name, {day('r.from_ts')} AS on_since FROM now_ n LEFT JOIN runs r ON n.list = r.list AND n.member = r.member AND r.still_on""",
    "list_periods": f"WITH {_CURRENT} SELECT list, member, from_ts, to_ts, before_ts, after_ts, still_on FROM runs",
    "shown_in_window": f"WITH {_PERIODS} SELECT place_id FROM (SELECT DISTINCT place_id, periods FROM eater38_places) e WHERE EXISTS (SELECT 1 FROM parts p WHERE p.place_id = e.place_id AND p.periods = e.periods AND regexp_full_match(p.p, '\\s*\\d{{4}}-\\d\\d-\\d\\d to \\d{{4}}-\\d\\d-\\d\\d\\s*') AND substr(trim(p.p), 1, 10) <= '2019-05-31' AND substr(trim(p.p), 15, 10) >= '2019-03-01')",
    "touching_periods": f"""WITH {_PERIODS}, n AS (SELECT DISTINCT {normal('place')} AS name, a, b FROM per WHERE {normal('place')} <> ''),
        m AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY name ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM n),
        i AS (SELECT *, sum(fresh) OVER (PARTITION BY name ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM m) SELECT name, min(a) AS a, max(b) AS b, count(*) AS parts FROM i GROUP BY name, g""",
    "search": f"WITH {_PLACES} SELECT place_id FROM p WHERE contains(lower(concat_ws(' ', place, address)), 'bar')",
    "opening_hours": f"WITH {_HOURS} SELECT doc_id, day, opens, closes FROM spans",
    "meals_by_hours": f"WITH {_HOURS} SELECT doc_id, concat_ws(',', " + ", ".join(f"CASE WHEN {_over(lo, hi)} THEN '{m}' END" for m, lo, hi in MEALS) + ") AS meals FROM spans GROUP BY doc_id",
    "meal_facets": " UNION ALL ".join(f"SELECT '{m}' AS facet, count(*) FILTER ({_named(ws)}) AS n, {i} AS rank FROM documents" for i, (m, ws) in enumerate(MEAL_WORDS)),
    "normal_names": f"""WITH n AS (SELECT name FROM current_list WHERE name IS NOT NULL UNION SELECT place FROM eater38_places WHERE place IS NOT NULL)
        SELECT name, {normal('name')} AS key, {slug(normal('name'))} AS slug, trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) AS bare FROM n""",
    "link_slugs": """WITH c AS (SELECT DISTINCT source_anchor, website FROM current_list) SELECT source_anchor, website,
        CASE WHEN coalesce(source_anchor, '') = '' THEN '' WHEN contains(source_anchor, '#') THEN trim(substr(source_anchor, position('#' IN source_anchor) + 1), '/') ELSE regexp_extract(rtrim(source_anchor, '/'), '([^/]*)$', 1) END AS slug,
        substr(sha1(website), 1, 12) AS bucket, trim(coalesce(website, '')) <> '' AND NOT regexp_matches(coalesce(website, ''), '(?i)instagram\\.com|facebook\\.com|twitter\\.com|linktr\\.ee|tiktok\\.com') AS own FROM c""",
    "day_labels": f"""SELECT doc_id, {day('captured_ts')} AS day, date_diff('day', DATE '2000-01-01', TRY_CAST({day('captured_ts')} AS DATE)) AS n,
        length(replace(replace(replace(replace(replace(coalesce(text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;')) AS safe FROM documents""",
    "fetch_outcomes": """SELECT url, CASE WHEN s IS NULL OR s = 429 OR s >= 500 THEN 'retry' WHEN s IN (403, 404) THEN 'gone' WHEN s >= 400 THEN 'again' ELSE 'ok' END AS outcome, count(*) AS n
        FROM (SELECT url, TRY_CAST(status AS INT) AS s FROM captures) GROUP BY ALL""",
    "positions": f"""WITH q AS (SELECT {shown('address')} AS a, lat, lng, row_number() OVER (PARTITION BY {shown('address')} ORDER BY lat DESC NULLS LAST, lng DESC NULLS LAST) AS k FROM eater38_places WHERE coalesce(lat, 0) <> 0),
        c AS (SELECT DISTINCT place_id, as_of_ts, {shown('address')} AS address, lat, lng FROM current_list)
        SELECT c.place_id, c.as_of_ts, c.address, coalesce(c.lat, q.lat) AS lat, CASE WHEN c.lat IS NULL THEN coalesce(q.lng, c.lng) ELSE c.lng END AS lng FROM c LEFT JOIN q ON c.address = q.a AND q.k = 1 AND c.lat IS NULL""",
    "enrichment_targets": f"SELECT place_id, max(as_of_ts) AS as_of_ts FROM current_list GROUP BY place_id HAVING max({shown('address')}) IS NULL OR max({shown('website')}) IS NULL OR max(lat) IS NULL",
    "alias_ends": f"""WITH RECURSIVE n AS (SELECT DISTINCT {normal('place')} AS alias FROM eater38_places WHERE regexp_matches({normal('place')}, '^(the|la|le|il|el) .')),
        al AS (SELECT * FROM (VALUES ('a', 'b'), ('b', 'c'), ('s', 's'), ('p', 'q'), ('q', 'p'), ('t', 'p')) v(alias, target) UNION ALL SELECT alias, regexp_replace(alias, '^(the|la|le|il|el) ', '') FROM n),
        walk AS (SELECT alias, target AS key, [alias] AS seen FROM al UNION ALL SELECT w.alias, a.target, list_append(w.seen, w.key) FROM walk w JOIN al a ON w.key = a.alias WHERE NOT list_contains(w.seen, w.key))
        SELECT alias, arg_max(key, len(seen)) AS target FROM walk GROUP BY alias""",
    "size_histogram": f"WITH {LISTED.strip()} SELECT items, count(*) AS n FROM (SELECT url, digest, count(*) AS items FROM listed GROUP BY ALL) GROUP BY items",
    "site_checks": """SELECT 'repeated id' AS "check", place_id AS key FROM eater38_places GROUP BY place_id HAVING count(*) > 1
        UNION ALL SELECT 'missing field', place_id FROM eater38_places WHERE place_id IS NULL OR coalesce(place, '') = '' OR coalesce(periods, '') = ''
        UNION ALL SELECT 'position out of bounds', place_id FROM eater38_places WHERE abs(lat) > 90 OR abs(lng) > 180 AND lat IS NOT NULL
        UNION ALL SELECT 'unknown id', place_id FROM (SELECT DISTINCT place_id FROM documents WHERE place_id IS NOT NULL) WHERE place_id NOT IN (SELECT place_id FROM eater38_places WHERE place_id IS NOT NULL)
        UNION ALL SELECT 'closed but published', place_id FROM (SELECT DISTINCT place_id FROM eater38_places) WHERE place_id IN (SELECT place_id FROM current_list WHERE lat IS NULL)""",
    "summary_counts": f"""WITH {_RUNS}, {_MERGED}, sigs AS (SELECT url, digest, string_agg(key, chr(31) ORDER BY key) AS sig FROM firsts GROUP BY url, digest),
        pts AS (SELECT s.sig <> lag(s.sig) OVER (PARTITION BY o.url ORDER BY o.ts) AS moved FROM observed o JOIN sigs s ON o.url = s.url AND o.digest = s.digest)
        SELECT 'places' AS metric, count(*) AS n FROM merged UNION ALL SELECT 'on_list_now', count(DISTINCT (list, member)) FROM runs WHERE still_on
        UNION ALL SELECT 'mapped', count(*) FROM merged WHERE lat IS NOT NULL AND lng IS NOT NULL UNION ALL SELECT 'stretches', count(*) FROM runs UNION ALL SELECT 'changes', count(*) FROM pts WHERE moved""",
    "series_split": f"WITH {MOMENTS} SELECT DISTINCT c.url, c.effective_ts AS ts, EXISTS (SELECT 1 FROM moments m WHERE m.url = c.url AND m.ts = c.effective_ts) AS known FROM contents c WHERE url IS NOT NULL AND effective_ts IS NOT NULL",
    "repaired_payloads": r"SELECT url, count(*) FILTER (json_valid(payload)) AS valid, 0 AS dirty, count(*) FILTER (json_valid(payload)) AS repaired FROM contents WHERE payload IS NOT NULL GROUP BY url",
    "extracted_pages": f"""WITH {_CURRENT} SELECT concat_ws(' ', list, ts) AS page, row_number() OVER (PARTITION BY list, ts ORDER BY member) AS position, member AS place_id, trim(regexp_replace(name, '\\s+', ' ', 'g')) AS name FROM held WHERE name IS NOT NULL""",
    "map_features": "SELECT DISTINCT 'Feature' AS type, place_id AS id, lng, lat FROM (SELECT DISTINCT place_id, place, lat, lng FROM eater38_places WHERE lat IS NOT NULL AND lng IS NOT NULL)",
    "place_rows": f"""WITH {_RUNS}, {_MERGED} SELECT r.member AS place, count(*) AS stretches, string_agg(({day('from_ts')}) || ' to ' || ({day('to_ts')}), '; ' ORDER BY from_ts) AS periods,
        CASE WHEN bool_or(still_on) THEN 'yes' ELSE 'no' END AS on_list_now, coalesce(any_value(m.address), '') AS address FROM runs r JOIN merged m ON r.list = m.url AND r.member = m.key GROUP BY r.list, r.member""",
}
# one row per key of all rows, whatever the split into stored and incoming
SQL["upserted_captures"] = f"""WITH {MOMENTS}, bare2 AS (SELECT row_number() OVER () AS n, * FROM captures),
    v2 AS (SELECT n, url, regexp_replace(ts, '[^0-9]', '', 'g') AS t, trim(regexp_replace(upper(trim(regexp_replace(digest, '\\s+', ' ', 'g'))), '^(URN:)?SHA1:', '')) AS b, status, mimetype, length, first_seen FROM bare2),
    v3 AS (SELECT url, CASE WHEN length(t) = 14 THEN t END AS ts, status, mimetype, CASE WHEN b IN ('', '-') THEN NULL WHEN regexp_full_match(b, '[0-9A-F]{{40}}') THEN list_aggregate(list_transform(range(32), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST(('0x' || substr(b, CAST((i // 4) * 5 + 1 AS BIGINT), 5)) AS BIGINT) // [32768, 1024, 32, 1][CAST(i % 4 + 1 AS BIGINT)]) % 32 + 1 AS BIGINT), 1)), 'string_agg', '') ELSE b END AS digest, length, first_seen FROM v2)
    SELECT url, ts, status, mimetype, digest, length, first_ AS first_seen FROM (SELECT *, min(first_seen) OVER (PARTITION BY url, ts) AS first_, row_number() OVER (PARTITION BY url, ts
      ORDER BY first_seen DESC NULLS LAST, status DESC NULLS LAST, mimetype DESC NULLS LAST, digest DESC NULLS LAST, length DESC NULLS LAST) AS k FROM v3) WHERE k = 1"""
