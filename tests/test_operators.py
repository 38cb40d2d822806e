import random

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import changes, identity, merge, presence, state, views


def runs(spark, obs, members, lst="l"):
    o = spark.createDataFrame([(lst, t) for t in obs], "list string, ts string")
    m = spark.createDataFrame([(lst, t, k) for t, k in members], "list string, ts string, member string")
    return sorted((r.member, r.from_ts, r.to_ts, r.before_ts, r.after_ts, r.still_on) for r in presence.presence_runs(m, o).collect())


T = [f"2020{m:02d}01000000" for m in range(1, 5)]


def test_periods_and_brackets(spark):
    m = [(T[0], "lilia"), (T[1], "lilia"), (T[2], "lilia"), (T[3], "lilia"), (T[0], "adda"), (T[1], "adda"), (T[2], "kab"), (T[2], "kab"), (T[0], None)]
    assert runs(spark, T, m) == [("adda", T[0], T[1], None, T[2], False), ("kab", T[2], T[2], T[1], T[3], False), ("lilia", T[0], T[3], None, None, True)]
    assert runs(spark, T[:3], [(T[0], "x"), (T[2], "x")]) == [("x", T[0], T[0], None, T[1], False), ("x", T[2], T[2], T[1], None, True)]
    assert runs(spark, [], []) == []


@pytest.mark.parametrize("block", [2, 3, 512])
def test_runs_equal_brute_force_whatever_the_block(spark, monkeypatch, block):
    monkeypatch.setattr(presence, "BLOCK", block)
    rng = random.Random(block)
    obs = sorted({f"{rng.randrange(2000, 2004)}{rng.randrange(1, 13):02d}{rng.randrange(1, 28):02d}000000" for _ in range(60)})
    on = {(t, k) for k in "abc" for t in obs if rng.random() < 0.7}
    want = []
    for k in "abc":
        i = 0
        while i < len(obs):
            if (obs[i], k) in on:
                j = i
                while j + 1 < len(obs) and (obs[j + 1], k) in on:
                    j += 1
                want.append((k, obs[i], obs[j], obs[i - 1] if i else None, obs[j + 1] if j + 1 < len(obs) else None, j + 1 == len(obs)))
                i = j
            i += 1
    assert runs(spark, obs, on) == sorted(want)


def signed(spark, script):
    rows = [("l", f"{20200101000000 + i}", s) for i, s in enumerate(script)]
    return spark.createDataFrame(rows, "list string, ts string, sig string")


def points(df):
    return sorted((r.after_ts[-3:], r.by_ts[-3:]) for r in df.collect())


@pytest.mark.parametrize("script", ["a" * 64, "a" * 40 + "b" * 40, "".join(c * 30 for c in "abcde"), "a", "ab"])
def test_bisection_equals_comparison_where_nothing_reverts(spark, script):
    df = signed(spark, script)
    found, probed = changes.bisected_changes(df)
    assert points(found) == points(changes.change_points(df))
    n = probed.count()
    assert n <= 2 if len(set(script)) == 1 else n <= len(script)


def test_bisection_misses_what_reverts(spark):
    df = signed(spark, "aaabbbaaa")
    assert points(changes.bisected_changes(df)[0]) == [] and len(points(changes.change_points(df))) == 2
    assert changes.bisected_changes(signed(spark, ""))[0].collect() == []
    v = [(r.sig, r.from_ts[-2:], r.to_ts[-2:], r.n) for r in changes.collapsed_versions(df).collect()]
    assert sorted(v, key=lambda r: r[1]) == [("a", "00", "02", 3), ("b", "03", "05", 3), ("a", "06", "08", 3)]


def test_change_log(spark):
    o = spark.createDataFrame([("l", t, c) for t, c in zip(T, "AABA")], "list string, ts string, content string")
    m = "list string, content string, members array<struct<key:string,name:string>>"
    lists = spark.createDataFrame([("l", "A", [("x", "X"), ("y", "Y"), ("z", "Z")]), ("l", "B", [("w", "W"), ("y", "Y2"), ("v", "V")])], m)
    got = sorted((r.after_ts, r.by_ts, [x.key for x in r.added], [x.name for x in r.removed]) for r in changes.change_log(o, lists).collect())
    assert got == [(T[1], T[2], ["w", "v"], ["X", "Z"]), (T[2], T[3], ["x", "z"], ["W", "V"])]
    log = changes.change_log(o, lists).withColumns({c: F.transform(k, lambda x: x["key"]) for c, k in (("added_ids", "added"), ("removed_ids", "removed"))})
    closed = spark.createDataFrame([("w",), ("x",), ("z",)], "id string")
    kept = sorted((r.by_ts, r.added_ids, r.removed_ids) for r in changes.without_closed(log, closed).collect())
    assert kept == [(T[2], ["v"], []), (T[3], [], ["v"])]
    index = spark.createDataFrame([("l", t) for t in [*T, "20200215000000", "20200216000000"]], "list string, ts string")
    assert sorted(r.unsampled for r in changes.unsampled(log, index).collect()) == [0, 2]


def test_alias_chains(spark):
    df = identity.alias_frame(spark, {"a": "b", "b": "c", "s": "s", "p": "q", "q": "p", "t": "p", "_c": "x"})
    assert {r.alias: r.target for r in identity.closed_aliases(df).collect()} == {"a": "c", "b": "c", "s": "s", "p": "p", "q": "q", "t": "p"}
    assert identity.closed_aliases(df.limit(0)).collect() == []


def test_alias_suggestions(spark):
    rows = [("l", "1", "removed", "the odeon"), ("l", "1", "added", "odeon"), ("l", "2", "removed", "big red bar"), ("l", "2", "added", "red bar cafe"), ("l", "3", "removed", "ab"), ("l", "3", "added", "xaby"), ("l", "3", "added", "other"), ("l", "4", "removed", "a b"), ("l", "4", "added", "c d"), ("l", "5", "removed", "joe"), ("l", "5", "removed", "sue"), ("l", "5", "added", "joe and a very long tail")]
    got = sorted((r.by, r.removed, r.added) for r in identity.suggest_aliases(spark.createDataFrame(rows, "list string, by string, kind string, key string")).collect())
    assert got == [("1", "the odeon", "odeon"), ("2", "big red bar", "red bar cafe"), ("3", "ab", "xaby")]


def test_latest_nonempty(spark):
    rows = [("k", "1", "a", 1.0), ("k", "2", "", None), ("k", "3", None, 0.0), ("m", "1", None, None)]
    df = spark.createDataFrame(rows, "key string, ts string, address string, lat double")
    assert sorted(map(tuple, merge.latest_nonempty(df, ["key"], "ts", ["address", "lat"]).collect())) == [("k", "a", 0.0), ("m", None, None)]


def test_cached_positions(spark):
    p = spark.createDataFrame([("x", None, None), ("y", 1.0, 2.0), ("z", None, None), ("", None, None), (None, None, None)], "address string, lat double, lng double")
    c = spark.createDataFrame([("x", 3.0, 4.0), ("x", 3.0, 4.0), ("y", 9.0, 9.0), ("z", 0.0, 0.0), ("", 5.0, 5.0)], "query string, c_lat double, c_lng double")
    got = {r.address: (r.lat, r.lng) for r in merge.with_cached_position(p, c).collect()}
    assert got == {"x": (3.0, 4.0), "y": (1.0, 2.0), "z": (None, None), "": (None, None), None: (None, None)}


def test_upsert_and_fetch_list(spark):
    s = "url string, ts string, digest string, first_seen int"
    stored = spark.createDataFrame([("u", "1", "a", 5), ("u", "2", "b", 5)], s)
    new = spark.createDataFrame([("u", "1", "c", 7), ("u", "3", "d", 1), ("u", "2", "z", 4)], s)
    assert sorted(map(tuple, state.upsert(stored, new, ["url", "ts"], "first_seen", "first_seen").collect())) == [("u", "1", "c", 5), ("u", "2", "b", 4), ("u", "3", "d", 1)]
    con = spark.createDataFrame([("u", "a", 6), ("u", "b", 4), ("u", "b", 5)], "url string, digest string, extractor_version int")
    assert sorted(map(tuple, state.to_fetch(stored.union(new), con, 6).select("digest", "why").collect())) == [("b", "parse"), ("c", "fetch"), ("d", "fetch"), ("z", "fetch")]
    seen = spark.createDataFrame([("u", "2")], "url string, last_ts string")
    assert sorted(r.ts for r in state.since_anchor(stored, seen).collect()) == ["2"]
    assert sorted(r.ts for r in state.since_anchor(stored, spark.createDataFrame([("u", "9")], "url string, last_ts string")).collect()) == ["1", "2"]
    h = spark.createDataFrame([("a", "none"), ("b", "skipped"), ("c", "text"), ("d", None)], "place_id string, source string")
    pl = spark.createDataFrame([(x,) for x in "abcde"], "place_id string")
    assert sorted(r.place_id for r in state.hours_to_fetch(pl, h).collect()) == ["a", "d", "e"]


def test_views(spark):
    rows = spark.createDataFrame([("l", "1", 1, "a", "A"), ("l", "2", 1, "b", "B"), ("l", "2", 2, "c", "C"), ("l", "2", 3, "d", "D")], "list string, ts string, pos int, member string, name string")
    now = views.current_list(rows, spark.createDataFrame([("c",)], "member string")).collect()
    assert sorted((r.position, r.member) for r in now) == [(1, "b"), (2, "d")]
    p = spark.createDataFrame([("2020-01-01 to 2020-02-01; 2021-01-01 to 2021-01-01",), ("x",), (None,)], "p string").select(views.period_array(F.col("p")).alias("p"))
    assert [r[0] for r in p.select(views.shown_between(F.col("p"), "2020-02-01", "2020-03-01")).collect()] == [True, False, False]
    assert [r[0] for r in p.select(views.shown_between(F.col("p"), "2020-02-02", "2020-12-31")).collect()] == [False] * 3
    f = views.facets(F.col("v"), spark.createDataFrame([(["a", "a", "b"],), (["a"],), (None,)], "v array<string>"), ["b", "a", "z"]).collect()
    assert sorted((r.rank, r.facet, r.n) for r in f) == [(0, "b", 1), (1, "a", 2), (2, "z", 0)]
    i = spark.createDataFrame([("n", "1", "3"), ("n", "3", "4"), ("n", "6", "7"), ("n", "2", "2")], "name string, a string, b string")
    assert sorted(map(tuple, presence.merge_touching(i, "name", "a", "b").collect())) == [("n", "1", "4", 3), ("n", "6", "7", 1)]


def test_site_checks(spark):
    p = spark.createDataFrame([("a", "A", "p", 1.0, 2.0), ("a", "A", "p", 1.0, 2.0), ("b", "", "p", 99.0, 2.0), ("c", "C", "p", None, None)], "id string, name string, periods string, lat double, lng double")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    got = sorted(map(tuple, views.site_checks(p, ids("a", "q", None), ids("c")).collect()))
    assert got == [("closed but published", "c"), ("missing field", "b"), ("position out of bounds", "b"), ("repeated id", "a"), ("unknown id", "q")]
