import gzip
import json
import zlib

import pytest
from pyspark.sql import functions as F

from palimpsest import session
from palimpsest.functions import fetching, markup
from palimpsest.operators import extract, state, views
from palimpsest.sources import files, sinks


def test_pages_and_their_keys(spark):
    c = spark.createDataFrame([("200", "text/html"), ("200", "TEXT/HTML; charset=x"), ("200", "image/png"), ("404", "text/html"), (None, "text/html"), ("200", None)], "s string, m string")
    assert [r[0] for r in c.select(F.coalesce(state.is_page(F.col("s"), F.col("m")), F.lit(False))).collect()] == [True, True, False, False, False, False]
    contents = spark.createDataFrame([("u", "A", "1"), ("u", "B", "2"), ("u", "C", None), ("v", "A", "1")], "url string, digest string, effective_ts string")
    captures = spark.createDataFrame([("u", "1", "A"), ("u", "2", "A"), ("u", "3", "C")], "url string, ts string, digest string")
    assert sorted(map(tuple, state.rekeyed(contents, captures).collect())) == [("u", "A", "1", "A", False), ("u", "B", "2", "A", True)]


def test_stored_hours_and_meals(spark):
    stored = spark.createDataFrame([("a", '[{"day":"mon","opens":"11:00","closes":"13:00"}]'), ("b", "broken"), ("c", None)], "place_id string, hours string")
    got = {r.place_id: [tuple(s) for s in r.spans] for r in state.decoded_hours(stored).collect()}
    assert got == {"a": [("mon", "11:00", "13:00")], "b": [], "c": []}
    places = spark.createDataFrame([("a",), ("b",), ("x",)], "place_id string")
    texts = spark.createDataFrame([("a", "Dinner only"), ("b", "Brunch and dinner")], "place_id string, text string")
    hours = state.decoded_hours(stored).filter("place_id = 'a'")
    assert {r.place_id: (r.by, r.meals) for r in views.meals_or_text(places, hours, texts).collect()} == {"a": ("hours", ["lunch"]), "b": ("text", ["brunch", "dinner"]), "x": ("none", [])}


def test_an_incomplete_run_is_no_anchor(spark):
    captures = spark.createDataFrame([("u", "1"), ("u", "2"), ("v", "1"), ("v", "2")], "url string, ts string")
    checked = spark.createDataFrame([("u", "2", True), ("v", "2", False)], "url string, last_ts string, complete boolean")
    assert sorted(map(tuple, state.since_anchor(captures, checked).collect())) == [("u", "2"), ("v", "1"), ("v", "2")]


def test_counts_of_a_site(spark):
    p = spark.createDataFrame([("a", 2, "x to y; z to w", 1.0, 2.0), ("b", 2, "x to y", None, None), ("c", None, None, 0.0, 1.0)], "id string, stretches int, periods string, lat double, lng double")
    got = sorted(map(tuple, views.count_checks(p, sinks.features(p).limit(1)).collect()), key=str)
    assert got == [("features", "map", 2, 1), ("stretches", "b", 2, 1), ("stretches", "c", None, 0)]


def test_names_in_a_readers_order(spark):
    d = spark.createDataFrame([(n, str(i)) for i, n in enumerate(["Zed", "Eb", "ea", "éa", "EA"])], "name string, id string")
    assert [r.name for r in d.orderBy(*sinks.by_name(d)).collect()] == ["ea", "EA", "éa", "Eb", "Zed"]


def test_status_and_updates(spark, tmp_path):
    s = spark.createDataFrame([("u", 3, "20200101000000", "20200201000000", 2, 1)], "url string, n long, first_ts string, last_ts string, digests long, missing long")
    assert sinks.status_lines(s).first().line == "u: 3 captures from 2020-01-01 to 2020-02-01, 2 contents, 1 missing"
    log = spark.createDataFrame([("u", "1", "2", ["a"], []), ("u", "2", "3", [], ["b"])], "list string, after_ts string, by_ts string, added array<string>, removed array<string>")
    sinks.updates_json(log.coalesce(1), str(tmp_path / "u"))
    assert [json.loads(r.value)["by_ts"] for r in spark.read.text(str(tmp_path / "u")).collect()] == ["3", "2"]


def test_raw_pages_come_back(spark, tmp_path):
    pages = spark.createDataFrame([("http://a", "D1", "<p>é</p>"), ("http://a", "D1", "<p>é</p>"), ("http://b", "D2", ""), (None, "D3", "x"), ("http://c", "D4", None)], "url string, digest string, body string")
    sinks.raw_pages(pages, str(tmp_path))
    sinks.raw_pages(pages.limit(0), str(tmp_path))
    assert sorted((r.digest, r.body) for r in files.raw_pages(spark, str(tmp_path)).collect()) == [("D1", "<p>é</p>"), ("D2", "")]


def test_an_index_that_is_away(spark, tmp_path):
    stored = spark.createDataFrame([("u",)], "url string")
    assert files.index_or_stored(lambda: spark.read.text(str(tmp_path / "none")), stored) == (stored, False)
    fresh, complete = files.index_or_stored(lambda: spark.range(3), stored)
    assert complete and fresh.count() == 3


def test_stale_pages_are_parsed_again(spark):
    page = '<script type="application/ld+json">{"@type": "ItemList", "itemListElement": [{"item": {"name": "A"}}]}</script>'
    raw = spark.createDataFrame([("u", "1", page), ("u", "2", page), ("u", "3", None)], "url string, digest string, body string")
    stale = spark.createDataFrame([("u", "1", "parse"), ("u", "2", "fetch"), ("u", "3", "parse"), ("u", "4", "parse")], "url string, digest string, why string")
    assert [(r.url, r.digest, r.position, r.name) for r in extract.reparsed(raw, stale).collect()] == [("u", "1", 1, "A")]


def test_site_pages_in_order(spark):
    d = spark.createDataFrame([("http://b/", '<a href="/visit">Visit</a><a href="/x">x</a>'), ("https://facebook.com/b", "<a href='/hours'>h</a>"), (None, None), ("http://c", None)], "home string, page string")
    got = [r[0] for r in d.select(fetching.site_pages(F.col("home"), F.col("page"))).collect()]
    assert got == [["http://b", "http://b/visit", "http://b/hours", "http://b/contact"], [], [], ["http://c", "http://c/hours", "http://c/contact"]]


def test_answers_are_unpacked():
    body = b"abc" * 50
    raw = zlib.compressobj(wbits=-zlib.MAX_WBITS)
    assert fetching.decoded(gzip.compress(body), " GZIP ") == fetching.decoded(zlib.compress(body), "deflate") == fetching.decoded(raw.compress(body) + raw.flush(), "deflate") == fetching.decoded(body, None) == body
    with pytest.raises(zlib.error):
        fetching.decoded(b"no", "gzip")


def test_markup_is_read_as_far_as_it_goes():
    events = markup.read('<div class="a b"><div>x</div>&amp; <span class="n">1</span>y</div><p>open')
    assert [markup.said(i) for _, i in markup.elements(events, markup.classed("div", "b"))] == ["x & 1 y"]
    assert [markup.said(i, without=markup.classed("span", "n")) for _, i in markup.elements(events, markup.classed("div", "b"))] == ["x & y"]
    assert [markup.said(i) for _, i in markup.elements(events, lambda e: e.tag == "p")] == ["open"]
    assert markup.read(None) == [] and markup.scripts(None, "id", "x") == []


def test_a_cluster_needs_a_shared_checkpoint_folder(spark):
    class Context:
        master = "spark://x"

        class _jsc:
            @staticmethod
            def sc():
                return Context._jsc

            @staticmethod
            def getCheckpointDir():
                return Context._jsc

            @staticmethod
            def isDefined():
                return False

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session)
