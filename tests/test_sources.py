import datetime as dt
import gzip
import json
import os


from palimpsest.operators.extract import extract_entries, from_cards, from_linked_data, from_state, labelled, page_hours
from palimpsest.sources import files, sinks
from palimpsest.streaming import incremental


def test_index_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("20200101000000 http://x 200 text/html AB 12\nshort line\n20200102000000  http://x\t200 text/html CD x\n<html>\n20200103000000 http://x 200 text/html EF 1\n")
    (tmp_path / "b.txt").write_text("20200104000000 http://y 301 text/html GH\r\n")
    (tmp_path / "c.txt").write_text("")
    got = sorted(map(tuple, files.index_lines(spark, str(tmp_path)).select("ts", "digest", "length").collect()))
    assert got == [("20200101000000", "AB", 12), ("20200102000000", "CD", None), ("20200104000000", "GH", None)]


def test_index_json(spark, tmp_path):
    head = ["timestamp", "original", "mimetype", "statuscode", "digest", "length"]
    (tmp_path / "a.json").write_text(json.dumps([head, ["2020", "u", "m", "200", "D", "7"], ["2021", "u", "m", "200", "E", "-"]]))
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "c.json").write_text(json.dumps([head]))
    assert sorted(map(tuple, files.index_json(spark, str(tmp_path)).collect())) == [("u", "2020", "200", "m", "D", 7), ("u", "2021", "200", "m", "E", 0)]


def test_imported_payloads(spark, tmp_path):
    p = tmp_path / "p.jsonl"
    p.write_text('{"ts": "1", "items": [{"name": "a"}]}\nbroken\n{"ts": "1", "items": []}\n{"ts": "9", "items": [{}]}\n{"items": [{}]}\n')
    known, lost = files.imported_payloads(spark, str(p), spark.createDataFrame([("u", "1")], "url string, ts string"))
    assert [(r.url, r.extractor_version) for r in known.collect()] == [("u", 1)] and [r.ts for r in lost.collect()] == ["9"]


def test_maps_batches_and_configuration(spark, tmp_path):
    a = tmp_path / "aliases.json"
    a.write_text('{"_x": "y", "a": "b"}')
    assert files.alias_file(str(a)) == {"a": "b"} and files.alias_file(str(tmp_path / "none")) == {}
    for name, content in (("b1", [{"id": "x", "v": "1"}, {"id": "x", "v": "2"}, {"v": "3"}]), ("b2", [{"id": "x", "v": "4"}, {"id": "y", "v": "5"}]), ("b3", {"id": "z"})):
        (tmp_path / f"{name}.json").write_text(json.dumps(content))
    (tmp_path / "b4.json").write_text("[{")
    rows, bad = files.json_batches(spark, str(tmp_path / "b*.json"), "id:string,v:string")
    assert sorted(map(tuple, rows.collect())) == [("x", "4"), ("y", "5")] and sorted(r.file for r in bad.collect()) == ["b3.json", "b4.json"]
    assert files.json_object(spark, str(tmp_path / "b3.json")).first().id == "z"
    c = tmp_path / "c.toml"
    c.write_text('[paths]\ndata = "d"\n[engine]\nleast_items = 9\n')
    conf = files.configuration(str(c))
    assert conf["paths"]["data"] == str(tmp_path / "d") and conf["engine"] == {"extractor_version": 6, "least_items": 9} and files.configuration()["engine"]["least_items"] == 5


def test_raw_pages_and_last_write(spark, tmp_path):
    (tmp_path / "u").mkdir()
    (tmp_path / "u" / "AB.html.gz").write_bytes(gzip.compress("<p>é</p>".encode()))
    (tmp_path / "u" / "CD.html.gz").write_bytes(b"no")
    assert sorted((r.digest, r.body) for r in files.raw_pages(spark, str(tmp_path)).collect()) == [("AB", "<p>é</p>"), ("CD", None)]
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("m", 1, "c")], "key string, n int, v string")
    assert sorted(r.v for r in files.latest_write(df, "key", "n").collect()) == ["b", "c"]


def point(i, **kw):
    return {"name": f"P{i} &amp; Co", "location": {"latitude": i + 0.5, "longitude": -1}, "address": f"{i} St", "venue": {"slug": f"p{i}"}, "url": "http://p", "phone": "1", **kw}


STATE = '<script id="__NEXT_DATA__" type="x">' + json.dumps({"a": [1, 2], "b": {"c": [point(i, description=[{"plaintext": "Open for: dinner"}, {"plaintext": "Nice."}, {"plaintext": "More."}]) for i in range(6)]}}) + "</script>"
LINKED = '<script type="application/ld+json">{"@type": "ItemList", "itemListElement": [' + ",".join(f'{{"position": 0, "item": {{"name": "P{i} & Co", "url": "http://l/m#p{i}"}}}}' for i in range(5)) + ",]}</script>"
CARD = '<section class="x c-mapstack__card y" data-slug="{0}"><h1><span class="c-mapstack__card-index">1</span> {0} <b>Bar</b></h1><div class="c-mapstack__address">1 A St</div><div class="c-mapstack__address">a@555</div><div class="c-mapstack__address">(555) 1</div><p>short</p><p>' + "long " * 20 + '</p><a href="http://s?a=1&amp;b">Visit website</a><a href="https://google.com/maps?q=1.5,-2.5">D</a></section>'


def test_page_shapes():
    s = from_state(STATE)
    assert len(s) == 6 and s[0]["name"] == "P0 & Co" and s[0]["open_for"] == "dinner" and s[0]["blurb"] == "Nice." and s[2]["lat"] == 2.5
    li = from_linked_data(LINKED)
    assert [x["position"] for x in li] == [1, 2, 3, 4, 5] and li[4]["slug"] == "p4"
    c = from_cards(CARD.format("intro") + CARD.format("a") * 3 + CARD.format("b"))
    assert [(x["name"], x["position"]) for x in c] == [("a Bar", 1), ("b Bar", 2)]
    assert (c[0]["address"], c[0]["phone"], c[0]["website"], c[0]["lat"], c[0]["lng"]) == ("1 A St", "(555) 1", "http://s?a=1&b", 1.5, -2.5) and c[0]["blurb"].startswith("long")
    assert from_state("<script id='__NEXT_DATA__'>{</script>") == from_linked_data("<script type='application/ld+json'>{</script>") == from_cards("") == []
    assert labelled(["Order: a", "ORDER: b", "x", "y"]) == {"order": "b", "blurb": "x"}


def test_extraction_prefers_and_fills(spark):
    cards = "".join(CARD.format(f"p{i}") for i in range(5))
    pages = spark.createDataFrame([("state", STATE + LINKED), ("linked", LINKED + cards), ("few", CARD.format("q")), ("none", "<p>x</p>"), ("null", None)], "page string, body string")
    rows = extract_entries(pages).collect()
    by = {}
    for r in rows:
        by.setdefault((r.page, r.source), []).append(r)
    assert {k: len(v) for k, v in by.items()} == {("state", "state"): 6, ("linked", "linked"): 5, ("few", "cards"): 1}
    filled = min(by["linked", "linked"], key=lambda r: r.position)
    assert filled.name == "P0 & Co" and filled.address == "1 A St" and filled.lat == 1.5 and filled.source_anchor == "http://l/m#p0"
    assert min(by["state", "state"], key=lambda r: r.position).source_anchor == "http://l/m#p0"
    assert extract_entries(pages.limit(0)).collect() == []


def test_page_hours(spark):
    ld = '<script type="application/ld+json">{"a": [{"openingHoursSpecification": {"dayOfWeek": ["https://schema.org/Monday", "Tu", "Someday"], "opens": "9:00", "closes": "17:00"}, "openingHours": ["Fri-Sat 10am-2pm", "Mo-Fr 9-17", "Sun 9-10"]}],}</script>'
    pages = [("ld", ld + "Wed 1pm-2pm"), ("text", "<b>Wed</b> 1pm-2pm<script>Thu 1pm-2pm</script>"), ("bad", '<script type="application/ld+json">{</script>Thu 3-4pm'), ("none", "x"), ("null", None)]
    got = sorted(map(tuple, page_hours(spark.createDataFrame(pages, "page string, body string")).collect()))
    assert got == [("bad", "text", "thu", "03:00", "16:00"), ("ld", "linked", "fri", "10:00", "14:00"), ("ld", "linked", "mon", "09:00", "17:00"), ("ld", "linked", "sat", "10:00", "14:00"), ("ld", "linked", "tue", "09:00", "17:00"), ("text", "text", "wed", "13:00", "14:00")]


def test_sinks(spark, tmp_path):
    p = spark.createDataFrame([("b", "x", 1.0, 2.0), ("A", "y", None, None)], "name string, id string, lat double, lng double")
    f = [json.loads(r.feature) for r in sinks.features(p).collect()]
    assert f == [{"type": "Feature", "geometry": {"type": "Point", "coordinates": [2.0, 1.0]}, "properties": {"name": "b", "id": "x"}}]
    sinks.site_json(p.coalesce(1), str(tmp_path / "j"), sinks.by_name(p))
    assert sorted(r.id for r in spark.read.json(str(tmp_path / "j")).collect()) == ["x", "y"]
    runs = spark.createDataFrame([("n", "20200101000000", "20200201000000", None, "20200301000000", False), ("m", "20200101000000", "20200201000000", "20190101000000", None, True)], "name string, from_ts string, to_ts string, before_ts string, after_ts string, still_on boolean")
    assert [tuple(r) for r in sinks.history_table(runs).collect()] == [("n", "2020-01-01", "2020-02-01", "before coverage", "2020-02-01 - 2020-03-01", "no"), ("m", "2020-01-01", "2020-02-01", "2019-01-01 - 2020-01-01", "still on list", "yes")]
    assert "start of coverage" in sinks.markdown(runs).first().line
    sinks.write_csv(sinks.history_table(runs).coalesce(1), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    pl = spark.createDataFrame([("n", [("a", "b"), ("c", "d")], True, None, 1.0, None)], "name string, periods array<struct<from_date:string,to_date:string>>, on_list_now boolean, lat double, lng double, address string")
    assert tuple(sinks.places_table(pl).first()) == ("n", 2, "a to b; c to d", "yes", "", "1.0", "")
    log = spark.createDataFrame([("20200101000000", "20200201000000", 1, [("k", "K"), ("l", "L")], [])], "after_ts string, by_ts string, unsampled int, added array<struct<key:string,name:string>>, removed array<struct<key:string,name:string>>")
    assert tuple(sinks.change_table(log).first()) == ("2020-01-01", "2020-02-01", 1, "K; L", "")
    assert {r.metric: r.n for r in sinks.counts(pl, runs, log).collect()} == {"places": 1, "on_list_now": 1, "mapped": 0, "stretches": 2, "changes": 1}


def test_incremental_captures(spark, tmp_path):
    schema = incremental.CAPTURE + ", first_seen timestamp_ntz"
    at = lambda i: dt.datetime(2020, 1, i)
    new, state, ck = (str(tmp_path / x) for x in ("new", "state", "ck"))
    os.makedirs(new)
    for rows in ([("u", "1", "200", "m", "a", 1, at(1)), ("u", "1", "200", "m", "a", 1, at(1)), ("u", "2", "200", "m", "b", 1, at(1))], [("u", "1", "404", "m", "c", 2, at(5)), ("v", "1", "200", "m", "d", 1, at(6))]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(new)
        incremental.follow_captures(spark, new, state, ck).awaitTermination(120)
    got = incremental.read_state(spark, state, 1)
    assert sorted((r.url, r.ts, r.status, r.digest, r.first_seen) for r in got.collect()) == [("u", "1", "404", "c", at(1)), ("u", "2", "200", "b", at(1)), ("v", "1", "200", "d", at(6))]
    n = incremental.activity(got.withColumn("first_seen", got.first_seen.cast("timestamp"))).groupBy().sum("n").first()[0]
    assert n == 3
