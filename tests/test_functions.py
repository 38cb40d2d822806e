import pytest
from pyspark.sql import functions as F

from palimpsest.functions import fetching, hours, text


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("name,key", [("Café Tørro & Sons", "cafe t rro and sons"), ("  L'Œuf—Bar ", "l uf bar"), ("ﬁn ①", "fin 1"), ("", ""), (None, None), ("!!!", "")])
def test_normalize(spark, name, key):
    assert one(spark, name, text.normalize) == key


def test_slugs_and_keys(spark):
    assert one(spark, "a b c", text.slug_of_key) == "a-b-c" and one(spark, "", text.slug_of_key) == one(spark, None, text.slug_of_key) == "unknown"
    assert one(spark, "Café & Bar!", text.bare_key) == "caf bar"
    for url, slug in (("http://x/a#b/", "b"), ("http://x/a/", "a"), ("", ""), (None, ""), ("x", "x")):
        assert one(spark, url, text.anchor_slug) == slug
    assert one(spark, "<p>a&amp;b  <b>c</b></p>", text.clean) == "a&b c" and one(spark, None, text.clean) == ""


def test_days(spark):
    for ts, day in (("20200102030405", "2020-01-02"), ("2020", "2020"), ("", "?"), (None, "?")):
        assert one(spark, ts, text.day_text) == day
    assert one(spark, "13:05", text.display_time) == "1:05pm" and one(spark, "00:00", text.display_time) == "12am"


@pytest.mark.parametrize("site,anchor,legacy,want", [("http://a", "", "", ("http://a", "")), ("http://list.x/#a", "", "", ("", "http://list.x/#a")), ("", "", "http://b", ("http://b", "")), ("", "", "http://list.x/m", ("", "http://list.x/m")), ("http://a", "q", "http://list.x/m", ("http://a", "q"))])
def test_own_site(spark, site, anchor, legacy, want):
    df = spark.createDataFrame([(site, anchor, legacy)], "s string, a string, l string")
    assert tuple(df.select(text.own_site(F.col("s"), F.col("a"), F.col("l"), "list.x").alias("r")).first().r) == want


def test_json_repair_and_escape(spark):
    ok = lambda c: text.repaired_json(c).isNotNull()
    assert one(spark, '{"a": [1,],}', ok) and one(spark, "{}", ok) and not one(spark, "{", ok) and not one(spark, None, ok)
    assert one(spark, "<a href='x'>&\"", text.escaped) == "&lt;a href=&#39;x&#39;&gt;&amp;&quot;"


@pytest.mark.parametrize("v,want", [("5pm", "17:00"), ("17:00", "17:00"), ("11:30 a.m.", "11:30"), ("12am", "00:00"), ("12 pm", "12:00"), ("24", "00:00"), ("25", None), ("7:61", None), ("noon", None), ("", None), (None, None)])
def test_clock(spark, v, want):
    assert one(spark, v, hours.clock) == want


@pytest.mark.parametrize("t,want", [
    ("Mon-Wed 11am-2pm", [("mon", "11:00", "14:00"), ("tue", "11:00", "14:00"), ("wed", "11:00", "14:00")]),
    ("Sat to Mon: 9:30 - 22", [("sat", "09:30", "22:00"), ("sun", "09:30", "22:00"), ("mon", "09:30", "22:00")]),
    ("Fridays 5pm–1am, Saturday 5pm–1am; Friday 5 pm - 1 am", [("fri", "17:00", "01:00"), ("sat", "17:00", "01:00")]),
    ("Mo-Fr 9-17", []), ("", []),
])
def test_spans(spark, t, want):
    got = [tuple(s) for s in one(spark, t, hours.spans_in_text)]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("o,c,want", [("08:00", "10:00", "breakfast"), ("12:00", "23:00", "lunch,dinner,late"), ("22:00", "02:00", "late"), ("00:30", "02:00", ""), ("09:00", "09:00", "breakfast,lunch,dinner,late"), ("15:00", "17:00", "")])
def test_meals(spark, o, c, want):
    df = spark.createDataFrame([([("mon", o, c)],)], "s array<struct<day:string,opens:string,closes:string>>")
    assert df.select(F.array_join(hours.meals_of(F.col("s")), ",")).first()[0] == want


def test_meal_words_and_summary(spark):
    assert one(spark, "Brunch, late-night", hours.meals_named) == ["brunch", "late"] and one(spark, None, hours.meals_named) == []
    df = spark.createDataFrame([([(d, "11:00", "22:30") for d in ("mon", "tue", "sat")],)], "s array<struct<day:string,opens:string,closes:string>>")
    assert df.select(hours.summary(F.col("s"))).first()[0] == "mon-tue 11am-10:30pm; sat 11am-10:30pm"
    assert one(spark, "<p>a<script>x</script>b</p>", hours.visible).strip() == "a b"


def test_fetching(spark):
    df = spark.createDataFrame([(200, "x" * 600), (200, "x"), (200, "Temporarily Offline" + "x" * 600), (429, ""), (503, ""), (None, None), (404, ""), (403, ""), (410, "")], "s int, b string")
    assert [r[0] for r in df.select(fetching.outcome(F.col("s"), F.col("b"))).collect()] == ["ok", "retry", "retry", "retry", "retry", "retry", "gone", "gone", "again"]
    w = spark.createDataFrame([(3, None), (30, None), (1, " 17 "), (1, "x")], "a int, r string").select(fetching.wait_seconds(F.col("a"), F.col("r"))).collect()
    assert 4 <= w[0][0] < 8 and 60 <= w[1][0] < 120 and w[2][0] == 17 and 1 <= w[3][0] < 2
    assert one(spark, "http://a/web/20200101000000/x", lambda c: fetching.effective_moment(c, F.lit("q"))) == "20200101000000"
    assert one(spark, "http://a/x", lambda c: fetching.effective_moment(c, F.lit("q"))) == "q"
    assert [one(spark, u, fetching.has_own_site) for u in ("http://a", "https://instagram.com/a", " ", None)] == [True, False, False, False]
    page = '<a href="/hours/">Hours</a><a href="/menu">Menu</a><a href="http://x/find us">Here</a><a href="/hours">again</a><a href="/location.pdf">Location</a><a href="/contact">c</a><a href="/visit">v</a>'
    assert one(spark, page, lambda c: fetching.hours_pages(c, F.lit("http://b/"))) == ["http://b/hours", "http://x/find us", "http://b/contact"]
    none = F.lit(None).cast("struct<lat:double,lng:double,source:string>")
    assert one(spark, "x", lambda c: fetching.first_answer(none, none))["source"] == "notfound"
