"""Queries of the list-history operators, each over whole tables.

captures and contents are the archive of list pages; a list is a url, a member an entry's normal name. current_list and
eater38_places hold published entries. Every result is a bag of scalar columns.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fetching, hours, text
from ..functions.text import shown
from ..operators import changes as ch
from ..operators import extract, identity, merge, presence, state, views
from ..operators.captures import digest_value, moment14, moments
from ..operators.observations import first_of, latest_contents, listed, observed
from ..session import checkpoint
from ..sources import sinks
from ..sources.tables import table

FIELDS = ["address", "phone", "website", "source_anchor", "lat", "lng", "price", "tip"]


class Archive(NamedTuple):
    """What most queries share, read once: observations (url, ts, digest), and the first item of every key of a content."""

    obs: DataFrame
    firsts: DataFrame


def _archive(spark: SparkSession, d: str, item: bool = False) -> Archive:
    """Payloads are parsed once and written compactly, with the whole ``item`` only if it is asked for."""
    rows = checkpoint(listed(table(spark, d, "contents")).select("url", "digest", "pos", "raw_key", "key", "name", *(["item"] if item else [])))
    obs = checkpoint(moments(table(spark, d, "captures")).join(rows.select("url", "digest").distinct(), ["url", "digest"]).select("url", "ts", "digest"))
    return Archive(obs, first_of(rows, "key"))


def _members(a: Archive) -> DataFrame:
    return a.obs.join(a.firsts, ["url", "digest"])


def _lists(a: Archive) -> DataFrame:
    """(list, content, members): each content's members in order."""
    f = a.firsts.groupBy("url", "digest").agg(F.array_sort(F.collect_list(F.struct("pos", "key", "name"))).alias("m"))
    return f.select(F.col("url").alias("list"), F.col("digest").alias("content"), F.transform("m", lambda x: F.struct(x["key"].alias("key"), x["name"].alias("name"))).alias("members"))


def _signed(a: Archive) -> DataFrame:
    """(list, ts, sig): observations with the signature of their members."""
    sig = a.firsts.groupBy("url", "digest").agg(ch.signature(F.collect_list("key")).alias("sig"))
    return a.obs.join(sig, ["url", "digest"]).select(F.col("url").alias("list"), "ts", "sig")


def _changes(a: Archive) -> DataFrame:
    return ch.change_log(a.obs.select(F.col("url").alias("list"), "ts", F.col("digest").alias("content")), _lists(a))


def _runs(a: Archive) -> DataFrame:
    m = a.firsts.select(F.col("url").alias("list"), F.col("digest").alias("content"), F.col("key").alias("member"))
    return presence.presence_runs_of_contents(a.obs.select(F.col("url").alias("list"), "ts", F.col("digest").alias("content")), m)


def _merged(a: Archive) -> DataFrame:
    m = _members(a).select("url", "key", "ts", *[F.col(f"item.{f}").alias(f) for f in FIELDS])
    return merge.latest_nonempty(m, ["url", "key"], "ts", FIELDS)


def _closed_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys of the places that are said to be off the list: a stand-in for a list of closed places."""
    p = table(spark, d, "eater38_places").filter("on_list_now = 'no' and place is not null")
    return p.select(text.slug_of_key(text.normalize(F.col("place"))).alias("id")).distinct()


def _joined(c: str, field: str = "name") -> Column:
    return F.array_join(F.transform(c, lambda x: x[field]), "; ").alias(c)


def capture_moments(spark, d):
    """Captures: one row per url and moment with a digest value."""
    return moments(table(spark, d, "captures"))


def observations(spark, d):
    """A1: members of every observation, the first of a key, in order."""
    return _members(_archive(spark, d)).select("url", "ts", "pos", "key", "name")


def presence_periods(spark, d):
    """A2, A3: runs of each member with brackets."""
    return _runs(_archive(spark, d))


def aliased_periods(spark, d):
    """Runs on keys led through an alias map (here: keys that begin with an article)."""
    keys = listed(table(spark, d, "contents")).select("raw_key").distinct().filter(F.col("raw_key").rlike("^(the|la|le|il|el) .")).select(F.col("raw_key").alias("alias"), F.regexp_replace("raw_key", "^(the|la|le|il|el) ", "").alias("target"))
    rows = first_of(listed(table(spark, d, "contents"), identity.closed_aliases(keys)), "key")
    o = observed(table(spark, d, "captures"), table(spark, d, "contents"))
    m = o.join(rows, ["url", "digest"]).select(F.col("url").alias("list"), "ts", F.col("key").alias("member"))
    return presence.presence_runs(m, o.select(F.col("url").alias("list"), "ts")).select("list", "member", "from_ts", "to_ts", "still_on")


def history_rows(spark, d):
    """K7: runs as rows of a spreadsheet."""
    a = _archive(spark, d)
    named = _members(a).groupBy(F.col("url").alias("list"), F.col("key").alias("member")).agg(F.max_by("name", F.struct("ts", "name")).alias("name"))
    return sinks.history_table(_runs(a).join(named, ["list", "member"]))


def change_log(spark, d):
    """Members that came and went, with the captures in between that were not looked at."""
    index = moments(table(spark, d, "captures")).select(F.col("url").alias("list"), "ts")
    return ch.unsampled(_changes(_archive(spark, d)), index).select("list", "after_ts", "by_ts", _joined("added"), _joined("removed"), "unsampled")


def change_log_open(spark, d):
    """A10: the change log without closed places."""
    ids = lambda c: F.transform(c, lambda x: text.slug_of_key(x["key"]))
    c = _changes(_archive(spark, d)).withColumns({"added_ids": ids("added"), "removed_ids": ids("removed")})
    out = ch.without_closed(c, _closed_keys(spark, d))
    return out.select("list", "after_ts", "by_ts", _joined("added"), _joined("removed"), F.array_join("added_ids", "; ").alias("added_ids"), F.array_join("removed_ids", "; ").alias("removed_ids"))


def transitions(spark, d):
    """Added and removed keys in order of the key, one row each."""
    c = _changes(_archive(spark, d))
    rows = lambda k: c.select("list", "by_ts", F.lit(k).alias("kind"), F.explode(F.array_sort(F.transform(k, lambda x: x["key"]))).alias("key"))
    return rows("added").unionByName(rows("removed"))


def alias_suggestions(spark, d):
    """Pairs of a step that may be one entry renamed."""
    t = transitions(spark, d).select("list", F.col("by_ts").alias("by"), "kind", "key")
    return identity.suggest_aliases(t)


def change_points(spark, d):
    """Every change between consecutive observations."""
    return ch.change_points(_signed(_archive(spark, d)))


def bisected_changes(spark, d):
    """The changes that bisection finds."""
    return ch.bisected_changes(_signed(_archive(spark, d)))[0]


def bisect_probes(spark, d):
    """How many observations of each list bisection looks at."""
    return ch.bisected_changes(_signed(_archive(spark, d)))[1].groupBy("list").agg(F.count(F.lit(1)).alias("probes"))


def list_versions(spark, d):
    """Neighbouring observations with the same members as one version."""
    return ch.collapsed_versions(_signed(_archive(spark, d)))


def long_gaps(spark, d):
    """Changes over more than 30 days."""
    day = lambda c: text.day_text(F.col(c)).try_cast("date")
    return change_points(spark, d).withColumn("days", F.datediff(day("by_ts"), day("after_ts"))).filter("days > 30")


def merged_attributes(spark, d):
    """The latest non-empty value of every field of a member."""
    return _merged(_archive(spark, d, item=True))


def member_names(spark, d):
    """Latest name and all names of a member."""
    return merge.names_of(_members(_archive(spark, d)), ["url", "key"], "ts", "name").select("url", "key", "name", F.array_join("names_seen", "; ").alias("names_seen"))


def own_sites(spark, d):
    """F8: websites apart from links to the list itself."""
    c = table(spark, d, "current_list").select("place_id", "as_of_ts", "website", "source_anchor").distinct()
    links = text.own_site(F.col("source_anchor"), F.lit(None).cast("string"), F.col("website"), "guide.example")
    return c.withColumn("l", links).select("place_id", "as_of_ts", F.col("l.website").alias("website"), F.col("l.anchor").alias("anchor")).distinct()


def capture_statistics(spark, d):
    """Figures of every url's captures."""
    return state.capture_statistics(moments(table(spark, d, "captures")), table(spark, d, "contents"))


def fetch_list(spark, d):
    """Digests to download or to parse again."""
    return state.to_fetch(moments(table(spark, d, "captures")), table(spark, d, "contents"), 6)


def since_anchor(spark, d):
    """C4: captures from the last extracted moment of each url on."""
    m = moments(table(spark, d, "captures"))
    checked = table(spark, d, "contents").groupBy("url").agg(F.max("effective_ts").alias("last_ts")).dropna()
    return state.since_anchor(m, checked)


def upserted_captures(spark, d):
    """Rows that arrived late merged into those before: latest attributes, earliest first_seen."""
    c = table(spark, d, "captures").select("url", moment14(F.col("ts")).alias("ts"), "status", "mimetype", digest_value(F.col("digest")).alias("digest"), "length", "first_seen")
    late = F.col("first_seen") >= F.lit("2015-01-01").cast("timestamp_ntz")
    return state.upsert(c.filter(~late), c.filter(late), ["url", "ts"], "first_seen", "first_seen")


def latest_extractions(spark, d):
    """The latest row of each content."""
    return latest_contents(table(spark, d, "contents")).select("url", "digest", "fetched_at", "extractor_version", F.length("payload").alias("size"))


def last_write(spark, d):
    """Per effective moment the content written last."""
    c = table(spark, d, "contents").filter("effective_ts is not null and url is not null")
    return c.groupBy("url", "effective_ts").agg(F.max(F.struct("fetched_at", "digest")).alias("r")).select("url", "effective_ts", "r.fetched_at", "r.digest")


def current_entries(spark, d):
    """The current list of every source without closed places, renumbered, with the day of its stretch."""
    c = table(spark, d, "current_list")
    held = c.groupBy("source_url", "as_of_ts", "place_id").agg(F.max(F.struct("fetched_at", F.coalesce("pos", F.lit(0)).alias("pos"), shown(F.col("name")).alias("name"))).alias("r"))
    rows = held.select(F.col("source_url").alias("list"), F.col("as_of_ts").alias("ts"), F.col("r.pos").alias("pos"), F.col("place_id").alias("member"), F.col("r.name").alias("name"))
    closed = table(spark, d, "documents").filter("source = 'closure_note' and place_id is not null").select(F.col("place_id").alias("member"))
    now = views.current_list(rows, closed)
    runs = presence.presence_runs(rows, rows).filter("still_on").select("list", "member", text.day_text(F.col("from_ts")).alias("on_since"))
    return now.join(runs, ["list", "member"], "left")


def list_periods(spark, d):
    """A2 over the published lists."""
    c = table(spark, d, "current_list").select(F.col("source_url").alias("list"), F.col("as_of_ts").alias("ts"), F.col("place_id").alias("member"))
    return presence.presence_runs(c, c).select("list", "member", "from_ts", "to_ts", "before_ts", "after_ts", "still_on")


def _period_rows(spark, d):
    p = table(spark, d, "eater38_places").select("place_id", "place", "periods").distinct()
    return p.select("place_id", "place", F.explode(views.period_array(F.col("periods"))).alias("p")).select("place_id", "place", F.col("p.a").alias("a"), F.col("p.b").alias("b"))


def shown_in_window(spark, d):
    """Places shown in the spring of 2019."""
    p = table(spark, d, "eater38_places").select("place_id", "periods").distinct()
    return p.filter(views.shown_between(views.period_array(F.col("periods")), "2019-03-01", "2019-05-31")).select("place_id")


def touching_periods(spark, d):
    """Stretches of one name over all its places, joined where they touch."""
    rows = _period_rows(spark, d).withColumn("name", text.normalize(F.col("place"))).filter("name <> ''").select("name", "a", "b").distinct()
    return presence.merge_touching(rows, "name", "a", "b")


def search(spark, d):
    """Places that a search for ``bar`` finds."""
    p = table(spark, d, "eater38_places").select("place_id", "place", "address").distinct()
    return p.filter(views.matches(text.haystack("place", "address"), " Bar ")).select("place_id")


def opening_hours(spark, d):
    """Spans of opening hours in texts."""
    t = table(spark, d, "documents").select("doc_id", F.explode(hours.spans_in_text(F.regexp_replace("text", r"(?U)\s+", " "))).alias("s"))
    return t.select("doc_id", "s.day", "s.opens", "s.closes")


def meals_by_hours(spark, d):
    """the meals that a text's opening hours cover."""
    t = table(spark, d, "documents").select("doc_id", hours.spans_in_text(F.regexp_replace("text", r"(?U)\s+", " ")).alias("s")).filter(F.size("s") > 0)
    return t.select("doc_id", F.array_join(hours.meals_of(F.col("s")), ",").alias("meals"))


def meal_facets(spark, d):
    """Texts by the meals that they name."""
    t = table(spark, d, "documents")
    return views.facets(hours.meals_named(F.col("text")), t, [m for m, _ in hours.MEAL_WORDS])


def normal_names(spark, d):
    """keys and identifiers of all names."""
    n = table(spark, d, "current_list").select("name").unionByName(table(spark, d, "eater38_places").select(F.col("place").alias("name"))).distinct().dropna()
    return n.withColumn("key", text.normalize(F.col("name"))).select("name", "key", text.slug_of_key(F.col("key")).alias("slug"), text.bare_key(F.col("name")).alias("bare"))


def link_slugs(spark, d):
    """What names an entry in its link; the page's folder; sites worth a visit."""
    c = table(spark, d, "current_list").select("source_anchor", "website").distinct()
    return c.select("source_anchor", "website", text.anchor_slug(F.col("source_anchor")).alias("slug"), text.url_bucket(F.col("website")).alias("bucket"), fetching.has_own_site(F.col("website")).alias("own"))


def day_labels(spark, d):
    """dates of moments, days since 2000, text made safe."""
    c = table(spark, d, "documents").select("doc_id", "captured_ts", "source", "text")
    day = text.day_text(F.col("captured_ts")).try_cast("date")
    return c.select("doc_id", text.day_text(F.col("captured_ts")).alias("day"), F.datediff(day, F.lit("2000-01-01").cast("date")).alias("n"), F.length(text.escaped(F.col("text"))).alias("safe"))


def fetch_outcomes(spark, d):
    """Captures by what a fetch with their status would lead to."""
    c = table(spark, d, "captures")
    o = fetching.outcome(F.expr("try_cast(status as int)"), F.lit("x" * 600))
    return c.groupBy("url", o.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def positions(spark, d):
    """Entries without a position take that of their address in the places file."""
    c = table(spark, d, "current_list").select("place_id", "as_of_ts", shown(F.col("address")).alias("address"), "lat", "lng").distinct()
    cache = table(spark, d, "eater38_places").select(shown(F.col("address")).alias("query"), F.col("lat").alias("c_lat"), F.col("lng").alias("c_lng"))
    return merge.with_cached_position(c, cache)


def enrichment_targets(spark, d):
    """Places that lack an address, website or position throughout, with the latest snapshot that has them."""
    c = table(spark, d, "current_list").select("place_id", "as_of_ts", "lat", *[F.coalesce(shown(F.col(f)), F.lit("")).alias(f) for f in ("address", "website")])
    best = merge.latest_nonempty(c, ["place_id"], "as_of_ts", ["address", "website", "lat"])
    need = best.filter("address is null or website is null or lat is null").select("place_id")
    return c.join(need, "place_id", "left_semi").groupBy("place_id").agg(F.max("as_of_ts").alias("as_of_ts"))


def alias_ends(spark, d):
    """Where the keys of a map lead: chains, a loop, a cycle and a tail into it, and all article-led names."""
    fixed = identity.alias_frame(spark, {"a": "b", "b": "c", "s": "s", "p": "q", "q": "p", "t": "p", "_note": "x"})
    n = table(spark, d, "eater38_places").select(text.normalize(F.col("place")).alias("alias")).distinct().filter(F.col("alias").rlike("^(the|la|le|il|el) ."))
    return identity.closed_aliases(fixed.unionByName(n.withColumn("target", F.regexp_replace("alias", "^(the|la|le|il|el) ", ""))))


def size_histogram(spark, d):
    """Contents by number of items."""
    return listed(table(spark, d, "contents")).groupBy("url", "digest").agg(F.count(F.lit(1)).alias("items")).groupBy("items").agg(F.count(F.lit(1)).alias("n"))


def site_checks(spark, d):
    """What is wrong with the published data."""
    p = table(spark, d, "eater38_places").select(F.col("place_id").alias("id"), F.col("place").alias("name"), "periods", "lat", "lng")
    e = table(spark, d, "documents").select(F.col("place_id").alias("id"))
    c = table(spark, d, "current_list").filter("lat is null").select(F.col("place_id").alias("id"))
    return views.site_checks(p, e, c)


def summary_counts(spark, d):
    """Counts of a summary."""
    a = _archive(spark, d, item=True)
    runs = checkpoint(_runs(a))
    now = runs.groupBy("list", "member").agg(F.bool_or("still_on").alias("on_list_now"))
    at = _merged(a).select(F.col("url").alias("list"), F.col("key").alias("member"), "lat", "lng")
    return sinks.counts(checkpoint(now.join(at, ["list", "member"])), runs, ch.change_points(_signed(a)))


def series_split(spark, d):
    """Moments of contents that the index knows, and those that it does not, with the url they belong to."""
    m = moments(table(spark, d, "captures"))
    c = table(spark, d, "contents").select("url", F.col("effective_ts").alias("ts")).dropna().distinct()
    known = c.join(m, ["url", "ts"], "left_semi").withColumn("known", F.lit(True))
    return known.unionByName(c.join(m, ["url", "ts"], "left_anti").withColumn("known", F.lit(False)))


def repaired_payloads(spark, d):
    """F16: payloads that parse at once, after repair, or not; here each is given a comma too many first."""
    c = table(spark, d, "contents").filter("payload is not null").select("url", "digest", "fetched_at", "payload")
    dirty = F.regexp_replace("payload", r"\]\s*\}\s*$", ",]}")
    return c.groupBy("url").agg(F.count_if(F.try_parse_json("payload").isNotNull()).alias("valid"), F.count_if(F.try_parse_json(dirty).isNotNull()).alias("dirty"), F.count_if(text.repaired_json(dirty).isNotNull()).alias("repaired"))


def extracted_pages(spark, d):
    """Entries read back from pages made of the published lists, one page per snapshot."""
    c = table(spark, d, "current_list").groupBy("source_url", "as_of_ts", "place_id").agg(F.max(F.struct("fetched_at", shown(F.col("name")).alias("name"))).alias("r"))
    c = c.filter("r.name is not null").select(F.concat_ws(" ", "source_url", "as_of_ts").alias("page"), "place_id", F.col("r.name").alias("name"))
    lists = c.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("place_id", "name"))).alias("m"))
    element = lambda x: F.struct(F.lit("ListItem").alias("@type"), F.struct(F.replace(x["name"], F.lit("&"), F.lit("&amp;")).alias("name"), F.concat(F.lit("https://x.example/l#"), x["place_id"]).alias("url")).alias("item"))
    doc = F.to_json(F.struct(F.lit("ItemList").alias("@type"), F.transform("m", element).alias("itemListElement")))
    pages = lists.select("page", F.concat(F.lit('<html><script type="application/ld+json">'), doc, F.lit("</script></html>")).alias("body"))
    return extract.extract_entries(pages).select("page", "position", F.col("slug").alias("place_id"), "name")


def map_features(spark, d):
    """Features of the places with a position."""
    p = table(spark, d, "eater38_places").select(F.col("place_id").alias("id"), F.col("place").alias("name"), "lat", "lng").distinct()
    get = lambda path: F.get_json_object("feature", path)
    return sinks.features(p).select(get("$.type").alias("type"), get("$.properties.id").alias("id"), get("$.geometry.coordinates[0]").cast("double").alias("lng"), get("$.geometry.coordinates[1]").cast("double").alias("lat"))


def place_rows(spark, d):
    """K1, K6: places of the archive's lists for a spreadsheet."""
    a = _archive(spark, d, item=True)
    r = _runs(a)
    own = ["list", "member"]
    per = r.groupBy(*own).agg(F.array_sort(F.collect_list(F.struct(text.day_text(F.col("from_ts")).alias("from_date"), text.day_text(F.col("to_ts")).alias("to_date")))).alias("periods"), F.bool_or("still_on").alias("on_list_now"))
    at = _merged(a).select(F.col("url").alias("list"), F.col("key").alias("member"), "address", "lat", "lng")
    return sinks.places_table(per.join(at, own).withColumn("name", F.col("member"))).drop("lat", "lng")


NAMES = """capture_moments observations presence_periods aliased_periods history_rows change_log change_log_open transitions alias_suggestions change_points bisected_changes bisect_probes
list_versions long_gaps merged_attributes member_names own_sites capture_statistics fetch_list since_anchor upserted_captures latest_extractions last_write current_entries list_periods
shown_in_window touching_periods search opening_hours meals_by_hours meal_facets normal_names link_slugs day_labels fetch_outcomes positions enrichment_targets alias_ends size_histogram
site_checks summary_counts series_split repaired_payloads extracted_pages map_features place_rows""".split()
QUERIES = {n: globals()[n] for n in NAMES}
