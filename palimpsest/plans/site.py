"""Queries of what a site is built from and checked by: hours, fetch and geocode needs, bounds, links, page shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fetching, hours, text
from ..functions.text import shown
from ..operators import changes as ch
from ..operators import extract, identity, presence, state, views
from ..operators.captures import digest_value, moment14, moments
from ..operators.observations import first_of, latest_contents, listed, observed
from ..sources import sinks
from ..sources.tables import table
from .core_sql import _ALIASED_RUNS, _HOURS, _named, _over, day
from .core_sql import shown as shown_sql
from .sql_common import LISTED, MOMENTS, OBSERVED, normal, slug


def _slug(c: str) -> Column:
    return text.slug_of_key(text.normalize(F.col(c)))


def stored_hours(spark: SparkSession, d: str) -> DataFrame:
    """U4: opening hours of places as stored JSON, read back as rows."""
    t = table(spark, d, "documents").filter("place_id is not null").select("place_id", "doc_id", hours.spans_in_text(F.regexp_replace("text", r"(?U)\s+", " ")).alias("s"))
    kept = t.filter(F.size("s") > 0).groupBy("place_id").agg(F.max_by("s", "doc_id").alias("s")).select("place_id", F.to_json("s").alias("hours"))
    return state.decoded_hours(kept).select("place_id", F.explode("spans").alias("s")).select("place_id", "s.*")


def place_meals(spark: SparkSession, d: str) -> DataFrame:
    """The meals of every place by its stored hours, else by its texts."""
    p = table(spark, d, "current_list").select("place_id").distinct()
    h = stored_hours(spark, d).groupBy("place_id").agg(F.collect_list(F.struct("day", "opens", "closes")).alias("spans"))
    t = table(spark, d, "documents").filter("place_id is not null").groupBy("place_id").agg(F.max("text").alias("text"))
    return views.meals_or_text(p, h, t).select("place_id", "by", F.array_join("meals", ",").alias("meals"))


def serving_dinner(spark: SparkSession, d: str) -> DataFrame:
    """P5: texts that belong under a meal."""
    return table(spark, d, "documents").filter(F.array_contains(hours.meals_named(F.col("text")), "dinner")).select("doc_id")


def html_captures(spark: SparkSession, d: str) -> DataFrame:
    """Captures that are pages: answered with 200, and HTML."""
    c = table(spark, d, "captures").filter(state.is_page(F.col("status"), F.col("mimetype")))
    return c.select("url", moment14(F.col("ts")).alias("ts")).filter("url is not null and ts is not null").groupBy("url").agg(F.countDistinct("ts").alias("n"))


def pages_to_fetch(spark: SparkSession, d: str) -> DataFrame:
    """Digests of pages to download or to parse again; error pages and other files are not asked for."""
    c = table(spark, d, "captures").filter(state.is_page(F.col("status"), F.col("mimetype")))
    c = c.select("url", moment14(F.col("ts")).alias("ts"), digest_value(F.col("digest")).alias("digest")).dropna()
    return state.to_fetch(c, table(spark, d, "contents"), 6)


def rekeyed_contents(spark: SparkSession, d: str) -> DataFrame:
    """The digest under which each content belongs by its effective moment, and whether that is another."""
    return state.rekeyed(latest_contents(table(spark, d, "contents")), moments(table(spark, d, "captures")))


def geocode_targets(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of places that a snapshot shows without a position."""
    c = table(spark, d, "current_list").select("place_id", shown(F.col("address")).alias("address"), "lat")
    return c.filter("lat is null and address is not null").select("place_id", "address").distinct()


def geocoded(spark: SparkSession, d: str) -> DataFrame:
    """Addresses without a position, answered by the places file, else by the published lists, else marked as not found."""
    c = table(spark, d, "current_list").select(shown(F.col("address")).alias("address"), "lat", "lng").filter("address is not null")
    need = c.filter("lat is null").select("address").distinct()

    def answers(rows: DataFrame, name: str) -> DataFrame:
        at = F.struct("lat", "lng", F.lit(name).alias("source"))
        return rows.filter("lat <> 0 and lng is not null").groupBy("address").agg(F.max(at).alias(name))

    p = table(spark, d, "eater38_places").select(shown(F.col("address")).alias("address"), "lat", "lng")
    out = need.join(answers(p, "places"), "address", "left").join(answers(c, "lists"), "address", "left")
    return out.select("address", fetching.first_answer(F.col("places"), F.col("lists")).alias("a")).select("address", "a.*")


def observation_bounds(spark: SparkSession, d: str) -> DataFrame:
    """First and last observation of each list, and how many there are."""
    o = observed(table(spark, d, "captures"), table(spark, d, "contents"))
    return o.groupBy("url").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.min_by("digest", "ts").alias("first_digest"), F.max_by("digest", "ts").alias("last_digest"), F.count(F.lit(1)).alias("n"))


def count_checks(spark: SparkSession, d: str) -> DataFrame:
    """V3, V5: places whose number of stretches is not that of their periods, and the map's features against the positions."""
    p = table(spark, d, "eater38_places").select(F.col("place_id").alias("id"), "place", "stretches", "periods", "lat", "lng").distinct()
    return views.count_checks(p, sinks.features(p))


def slug_checks(spark: SparkSession, d: str) -> DataFrame:
    """The same checks on ids made of names, which the lists, the places and the closures share."""
    p = table(spark, d, "eater38_places").filter("place is not null").select(_slug("place").alias("id"), F.col("place").alias("name"), "periods", "lat", "lng").distinct()
    c = table(spark, d, "current_list").filter("name is not null").select("place_id", _slug("name").alias("id")).distinct()
    closed = table(spark, d, "documents").filter("source = 'closure_note' and place_id is not null").select("place_id").distinct()
    out = views.site_checks(p, c.select("id"), c.join(closed, "place_id").select("id").distinct())
    return out.groupBy("check", "key").agg(F.count(F.lit(1)).alias("n"))


def _aliased(spark: SparkSession, d: str) -> DataFrame:
    raw = listed(table(spark, d, "contents"))
    led = raw.select("raw_key").distinct().filter(F.col("raw_key").rlike("^(the|la|le|il|el) .")).select(F.col("raw_key").alias("alias"), F.regexp_replace("raw_key", "^(the|la|le|il|el) ", "").alias("target"))
    return first_of(listed(table(spark, d, "contents"), identity.closed_aliases(led)), "key")


def aliased_changes(spark: SparkSession, d: str) -> DataFrame:
    """The change log on keys led through an alias map."""
    rows = _aliased(spark, d)
    lists = rows.groupBy(F.col("url").alias("list"), F.col("digest").alias("content")).agg(F.array_sort(F.collect_list(F.struct("key", F.col("key").alias("name")))).alias("members"))
    o = observed(table(spark, d, "captures"), table(spark, d, "contents")).select(F.col("url").alias("list"), "ts", F.col("digest").alias("content"))
    keys = lambda c: F.array_join(F.transform(c, lambda x: x["key"]), "; ").alias(c)
    return ch.change_log(o.join(lists.select("list", "content"), ["list", "content"], "left_semi"), lists).select("list", "after_ts", "by_ts", keys("added"), keys("removed"))


def consolidated_periods(spark: SparkSession, d: str) -> DataFrame:
    """All runs of a canonical member of a list in one row."""
    o = observed(table(spark, d, "captures"), table(spark, d, "contents"))
    m = o.join(_aliased(spark, d), ["url", "digest"]).select(F.col("url").alias("list"), "ts", F.col("key").alias("member"))
    runs = presence.presence_runs(m, o.select(F.col("url").alias("list"), "ts"))
    per = F.array_sort(F.collect_list(F.struct("from_ts", "to_ts")))
    return runs.groupBy("list", "member").agg(F.array_join(F.transform(per, lambda p: F.concat(p["from_ts"], F.lit(" to "), p["to_ts"])), "; ").alias("periods"), F.count(F.lit(1)).alias("runs"), F.bool_or("still_on").alias("still_on"))


def split_links(spark: SparkSession, d: str) -> DataFrame:
    """F8: websites and anchors told apart; own and list links stand in each of the three places in turn."""
    c = table(spark, d, "current_list").select("place_id", "as_of_ts", "website", "source_anchor", "source_url").distinct()
    n = F.length("place_id") % 3
    site = F.when(n == 0, F.col("source_anchor")).otherwise(F.col("website"))
    anchor = F.when(n == 1, F.col("source_anchor"))
    legacy = F.when(n == 0, F.col("website")).otherwise(F.col("source_url"))
    return c.select("place_id", "as_of_ts", text.own_site(site, anchor, legacy, "guide.example").alias("l")).select("place_id", "as_of_ts", "l.*").distinct()


def content_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """What a fetch with a stored answer's status and body leads to."""
    c = table(spark, d, "contents")
    o = fetching.outcome(F.col("http_status"), F.col("payload"))
    return c.groupBy(o.alias("outcome"), "http_status").agg(F.count(F.lit(1)).alias("n"))


def enrichment_needs(spark: SparkSession, d: str) -> DataFrame:
    """What each place lacks throughout: position, address, website, blurb."""
    c = table(spark, d, "current_list").groupBy("place_id").agg(*[F.max(shown(F.col(f))).alias(f) for f in ("address", "website")], F.max("lat").alias("lat"))
    blurbs = table(spark, d, "documents").filter("source = 'guide_blurb'").filter(shown(F.col("text")).isNotNull()).select("place_id", F.lit("y").alias("blurb")).distinct()
    c = c.join(blurbs, "place_id", "left")
    return c.select("place_id", F.concat_ws(",", *[F.when(F.col(f).isNull(), F.lit(f)) for f in ("lat", "address", "website", "blurb")]).alias("lacks")).filter("lacks <> ''")


def digest_at(spark: SparkSession, d: str) -> DataFrame:
    """What each url showed at a moment: its last digest up to then."""
    m = moments(table(spark, d, "captures")).filter(F.col("ts") <= "20190101000000")
    return m.groupBy("url").agg(F.max("ts").alias("ts"), F.max_by("digest", "ts").alias("digest"))


def status_lines(spark: SparkSession, d: str) -> DataFrame:
    """A line of text about every url's captures."""
    return sinks.status_lines(state.capture_statistics(moments(table(spark, d, "captures")), table(spark, d, "contents")))


def extracted_shapes(spark: SparkSession, d: str) -> DataFrame:
    """Entries read back from pages made of the published lists, as application state or as cards."""
    c = table(spark, d, "current_list").groupBy("source_url", "as_of_ts", "place_id").agg(F.max(F.struct("fetched_at", shown(F.col("name")).alias("name"))).alias("r"))
    c = c.filter("r.name is not null").select(F.concat_ws(" ", "source_url", "as_of_ts").alias("page"), "place_id", F.col("r.name").alias("name"))
    lists = c.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("place_id", "name"))).alias("m")).filter(F.size("m") >= extract.PLAUSIBLE)
    safe = lambda x: F.replace(F.replace(x["name"], F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    point = lambda x: F.struct(safe(x).alias("name"), F.lit("x").alias("address"), F.struct(x["place_id"].alias("slug")).alias("venue"))
    script = F.concat(F.lit(f'<script id="{extract.STATE_ID}">'), F.to_json(F.struct(F.transform("m", point).alias("points"))), F.lit("</script>"))
    card = lambda x: F.concat(F.lit(f'<section class="{extract.CARD}" data-slug="'), x["place_id"], F.lit('"><h1><span class="c-mapstack__card-index">1.</span>'), safe(x), F.lit("</h1></section>"))
    body = F.when(F.length("page") % 2 == 0, script).otherwise(F.array_join(F.transform("m", card), "\n"))
    return extract.extract_entries(lists.select("page", F.concat(F.lit("<html>"), body, F.lit("</html>")).alias("body"))).select("page", "source", "position", F.col("slug").alias("place_id"), "name")


NAMES = """stored_hours place_meals serving_dinner html_captures pages_to_fetch rekeyed_contents geocode_targets geocoded observation_bounds count_checks slug_checks aliased_changes
consolidated_periods split_links content_outcomes enrichment_needs digest_at status_lines extracted_shapes""".split()
QUERIES = {n: globals()[n] for n in NAMES}

_PAGE = "status = '200' AND lower(mimetype) LIKE 'text/html%'"
_PLACE_HOURS = f"{_HOURS}, h AS (SELECT place_id, max(doc_id) AS doc_id FROM documents WHERE place_id IS NOT NULL AND doc_id IN (SELECT doc_id FROM spans) GROUP BY place_id)"
_BY_HOURS = ", ".join(f"CASE WHEN {_over(lo, hi)} THEN '{m}' END" for m, lo, hi in hours.MEALS)
_BY_WORDS = ", ".join(f"CASE WHEN {_named(ws).replace('text', 't.text')} THEN '{m}' END" for m, ws in hours.MEAL_WORDS)
# a space stands for an element's tags, and a list's text is shown with single spaces
_SAID = r"trim(regexp_replace(name, '\s+', ' ', 'g'))"
SQL: dict[str, str] = {
    "stored_hours": f"WITH {_PLACE_HOURS} SELECT h.place_id, s.day, s.opens, s.closes FROM h JOIN spans s USING (doc_id)",
    "place_meals": f"""WITH {_PLACE_HOURS}, p AS (SELECT DISTINCT place_id FROM current_list),
        m AS (SELECT h.place_id, concat_ws(',', {_BY_HOURS}) AS meals FROM h JOIN spans s USING (doc_id) GROUP BY h.place_id),
        t AS (SELECT place_id, max(text) AS text FROM documents WHERE place_id IS NOT NULL GROUP BY place_id)
        SELECT p.place_id, CASE WHEN m.place_id IS NOT NULL THEN 'hours' WHEN t.text IS NOT NULL THEN 'text' ELSE 'none' END AS "by",
          coalesce(m.meals, concat_ws(',', {_BY_WORDS}), '') AS meals FROM p LEFT JOIN m ON p.place_id = m.place_id LEFT JOIN t ON p.place_id = t.place_id""",
    "serving_dinner": f"SELECT doc_id FROM documents WHERE {_named(dict(hours.MEAL_WORDS)['dinner'])}",
    "html_captures": f"SELECT url, count(DISTINCT ts14) AS n FROM (SELECT url, regexp_replace(ts, '[^0-9]', '', 'g') AS ts14 FROM captures WHERE {_PAGE}) WHERE url IS NOT NULL AND length(ts14) = 14 GROUP BY url",
    "pages_to_fetch": f"""WITH {MOMENTS.replace('FROM captures)', f'FROM captures WHERE {_PAGE})')}, h AS (SELECT url, digest, max(extractor_version) AS v FROM contents GROUP BY ALL),
        n AS (SELECT url, digest, min(ts) AS ts FROM valued WHERE digest IS NOT NULL GROUP BY ALL)
        SELECT n.url, n.digest, n.ts, CASE WHEN v IS NULL THEN 'fetch' ELSE 'parse' END AS why FROM n LEFT JOIN h ON n.url = h.url AND n.digest = h.digest WHERE v IS NULL OR v < 6""",
    "rekeyed_contents": f"WITH {MOMENTS}, {LISTED} SELECT l.url, l.digest, l.effective_ts, m.digest AS effective_digest, l.digest <> m.digest AS moved FROM latest l JOIN moments m ON l.url = m.url AND l.effective_ts = m.ts",
    "geocode_targets": f"SELECT DISTINCT place_id, {shown_sql('address')} AS address FROM current_list WHERE lat IS NULL AND {shown_sql('address')} IS NOT NULL",
    "geocoded": f"""WITH c AS (SELECT {shown_sql('address')} AS address, lat, lng FROM current_list), p AS (SELECT {shown_sql('address')} AS address, lat, lng FROM eater38_places),
        a AS (SELECT address, max({{'lat': lat, 'lng': lng}}) AS r FROM p WHERE lat <> 0 AND lng IS NOT NULL GROUP BY address), b AS (SELECT address, max({{'lat': lat, 'lng': lng}}) AS r FROM c WHERE lat <> 0 AND lng IS NOT NULL GROUP BY address)
        SELECT n.address, coalesce(a.r.lat, b.r.lat, 0) AS lat, coalesce(a.r.lng, b.r.lng, 0) AS lng, CASE WHEN a.r IS NOT NULL THEN 'places' WHEN b.r IS NOT NULL THEN 'lists' ELSE 'notfound' END AS source
        FROM (SELECT DISTINCT address FROM c WHERE lat IS NULL AND address IS NOT NULL) n LEFT JOIN a ON n.address = a.address LEFT JOIN b ON n.address = b.address""",
    "observation_bounds": f"WITH {OBSERVED} SELECT url, min(ts) AS first_ts, max(ts) AS last_ts, arg_min(digest, ts) AS first_digest, arg_max(digest, ts) AS last_digest, count(*) AS n FROM observed GROUP BY url",
    "count_checks": """WITH p AS (SELECT DISTINCT place_id, place, stretches, periods, lat, lng FROM eater38_places)
        SELECT 'stretches' AS "check", place_id AS key, CAST(stretches AS BIGINT) AS stated, CAST(CASE WHEN coalesce(trim(periods), '') = '' THEN 0 ELSE len(list_filter(string_split(periods, ';'), lambda x: trim(x) <> '')) END AS BIGINT) AS counted FROM p
          WHERE stretches IS DISTINCT FROM CASE WHEN coalesce(trim(periods), '') = '' THEN 0 ELSE len(list_filter(string_split(periods, ';'), lambda x: trim(x) <> '')) END
        UNION ALL SELECT 'features', 'map', count(*) FILTER (lat IS NOT NULL AND lng IS NOT NULL), count(*) FILTER (lat IS NOT NULL AND lng IS NOT NULL) FROM p""",
    "slug_checks": f"""WITH p AS (SELECT DISTINCT {slug(normal('place'))} AS id, place AS name, periods, lat, lng FROM eater38_places WHERE place IS NOT NULL),
        c AS (SELECT DISTINCT place_id, {slug(normal('name'))} AS id FROM current_list WHERE name IS NOT NULL),
        k AS (SELECT DISTINCT id FROM c WHERE place_id IN (SELECT place_id FROM documents WHERE source = 'closure_note' AND place_id IS NOT NULL)),
        v AS (SELECT 'repeated id' AS "check", id AS key FROM p GROUP BY id HAVING count(*) > 1
          UNION ALL SELECT 'missing field', id FROM p WHERE coalesce(name, '') = '' OR coalesce(periods, '') = ''
          UNION ALL SELECT 'position out of bounds', id FROM p WHERE lat IS NOT NULL AND lng IS NOT NULL AND (abs(lat) > 90 OR abs(lng) > 180)
          UNION ALL SELECT 'unknown id', id FROM (SELECT DISTINCT id FROM c) WHERE id NOT IN (SELECT id FROM p)
          UNION ALL SELECT 'closed but published', id FROM (SELECT DISTINCT id FROM p) WHERE id IN (SELECT id FROM k))
        SELECT "check", key, count(*) AS n FROM v GROUP BY ALL""",
    "aliased_changes": f"""WITH {_ALIASED_RUNS}, f AS (SELECT DISTINCT url, digest, k FROM led WHERE k <> ''),
        steps AS (SELECT * FROM (SELECT url AS list, ts AS by_ts, digest AS new, lag(ts) OVER w AS after_ts, lag(digest) OVER w AS old FROM observed o
          WHERE EXISTS (SELECT 1 FROM f WHERE f.url = o.url AND f.digest = o.digest) WINDOW w AS (PARTITION BY url ORDER BY ts)) WHERE old <> new),
        came AS (SELECT s.list, s.by_ts, string_agg(k, '; ' ORDER BY k) AS keys FROM steps s JOIN f ON s.list = f.url AND s.new = f.digest WHERE NOT EXISTS (SELECT 1 FROM f x WHERE x.url = s.list AND x.digest = s.old AND x.k = f.k) GROUP BY ALL),
        went AS (SELECT s.list, s.by_ts, string_agg(k, '; ' ORDER BY k) AS keys FROM steps s JOIN f ON s.list = f.url AND s.old = f.digest WHERE NOT EXISTS (SELECT 1 FROM f x WHERE x.url = s.list AND x.digest = s.new AND x.k = f.k) GROUP BY ALL)
        SELECT s.list, s.after_ts, s.by_ts, coalesce(c.keys, '') AS added, coalesce(w.keys, '') AS removed FROM steps s LEFT JOIN came c USING (list, by_ts) LEFT JOIN went w USING (list, by_ts) WHERE c.keys IS NOT NULL OR w.keys IS NOT NULL""",
    "consolidated_periods": f"WITH {_ALIASED_RUNS} SELECT list, member, string_agg(from_ts || ' to ' || to_ts, '; ' ORDER BY from_ts, to_ts) AS periods, count(*) AS runs, bool_or(still_on) AS still_on FROM runs GROUP BY list, member",
    "split_links": """WITH c AS (SELECT DISTINCT place_id, as_of_ts, CASE length(place_id) % 3 WHEN 0 THEN coalesce(source_anchor, '') ELSE coalesce(website, '') END AS w,
          CASE WHEN length(place_id) % 3 = 1 THEN coalesce(source_anchor, '') ELSE '' END AS a, CASE length(place_id) % 3 WHEN 0 THEN coalesce(website, '') ELSE coalesce(source_url, '') END AS g FROM current_list)
        SELECT DISTINCT place_id, as_of_ts, CASE WHEN w <> '' AND NOT contains(w, 'guide.example') THEN w WHEN NOT contains(g, 'guide.example') THEN g ELSE '' END AS website,
          CASE WHEN a <> '' THEN a WHEN contains(w, 'guide.example') THEN w WHEN contains(g, 'guide.example') THEN g ELSE '' END AS anchor FROM c""",
    "content_outcomes": """SELECT CASE WHEN http_status IS NULL OR http_status = 429 OR http_status >= 500 THEN 'retry' WHEN http_status IN (403, 404) THEN 'gone' WHEN http_status >= 400 THEN 'again'
          WHEN contains(lower(substr(coalesce(payload, ''), 1, 4000)), 'temporarily offline') OR length(coalesce(payload, '')) < 512 THEN 'retry' ELSE 'ok' END AS outcome, http_status, count(*) AS n FROM contents GROUP BY ALL""",
    "enrichment_needs": f"""WITH c AS (SELECT place_id, max(lat) AS lat, max({shown_sql('address')}) AS address, max({shown_sql('website')}) AS website FROM current_list GROUP BY place_id),
        b AS (SELECT DISTINCT place_id FROM documents WHERE source = 'guide_blurb' AND {shown_sql('text')} IS NOT NULL AND place_id IS NOT NULL)
        SELECT * FROM (SELECT c.place_id, concat_ws(',', CASE WHEN lat IS NULL THEN 'lat' END, CASE WHEN address IS NULL THEN 'address' END, CASE WHEN website IS NULL THEN 'website' END, CASE WHEN b.place_id IS NULL THEN 'blurb' END) AS lacks
          FROM c LEFT JOIN b ON c.place_id = b.place_id) WHERE lacks <> ''""",
    "digest_at": f"WITH {MOMENTS} SELECT url, max(ts) AS ts, arg_max(digest, ts) AS digest FROM moments WHERE ts <= '20190101000000' GROUP BY url",
    "status_lines": f"""WITH {MOMENTS}, s AS (SELECT url, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts, count(DISTINCT digest) AS digests FROM moments GROUP BY url),
        h AS (SELECT url, count(DISTINCT digest) AS cached FROM contents GROUP BY url)
        SELECT s.url || ': ' || n || ' captures from ' || {day('first_ts')} || ' to ' || {day('last_ts')} || ', ' || digests || ' contents, ' || greatest(digests - coalesce(cached, 0), 0) || ' missing' AS line FROM s LEFT JOIN h ON s.url = h.url""",
    "extracted_shapes": f"""WITH r AS (SELECT source_url || ' ' || as_of_ts AS page, place_id, arg_max({{'n': {shown_sql('name')}}}, (fetched_at, {shown_sql('name')})).n AS name FROM current_list WHERE place_id IS NOT NULL GROUP BY source_url, as_of_ts, place_id),
        o AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY place_id) AS position, count(*) OVER (PARTITION BY page) AS size FROM r WHERE name IS NOT NULL)
        SELECT page, CASE WHEN length(page) % 2 = 0 THEN 'state' ELSE 'cards' END AS source, position, place_id, {_SAID} AS name FROM o WHERE size >= 5""",
}
