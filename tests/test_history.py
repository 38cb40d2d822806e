import datetime as dt
import json
import random

import numpy as np
import pytest

from palimpsest.operators import versions
from palimpsest.operators.snapshot_diff import items_of, keyed, set_difference, snapshot_changes

LIST = "place_id string, as_of_ts string, source_url string, address string, phone string, website string, fetched_at timestamp_ntz, entity string, idx int"
T0 = dt.datetime(2020, 1, 1)


def history(spark, rows):
    df = spark.createDataFrame(rows, LIST)
    out = versions.attribute_versions(df, "place_id", "source_url", "as_of_ts", "fetched_at", ["address", "phone", "website"])
    return sorted((r.place_id, r.valid_from, r.valid_to, r.address, r.phone, r.website) for r in out.collect())


def day(i):
    return (T0 + dt.timedelta(days=i)).strftime("%Y%m%d000000")


def row(p, i, a="a", ph="1", w=None, src="s", at=0):
    return (p, day(i) if i is not None else None, src, a, ph, w, T0 + dt.timedelta(days=at), "clash", 7)


def test_versions_end_at_changes_and_absences(spark):
    rows = [row("p", 0), row("p", 1, a=" a "), row("p", 2, a="b"), row("p", 4, a="b"), row("q", 3)]
    assert history(spark, rows) == [
        ("p", day(0), day(2), "a", "1", None), ("p", day(2), day(3), "b", "1", None), ("p", day(4), "open", "b", "1", None), ("q", day(3), day(4), "a", "1", None)
    ]


def test_latest_arrival_holds_and_blank_is_null(spark):
    rows = [row("p", 0, a="old", at=1), row("p", 0, a="new", at=2), row("p", 0, a="new", at=2), row("p", 1, a="new", w=" "), row("p", 2, a="", ph=None), row("p", 3, a=None, ph=" ")]
    assert history(spark, rows) == [("p", day(0), day(2), "new", "1", None), ("p", day(2), "open", None, None, None)]


def test_nulls_and_empty(spark):
    assert history(spark, []) == []
    assert history(spark, [row(None, 0), row("p", None)]) == []
    assert history(spark, [row("p", 0, src=None), row("p", 1, src=None)]) == [("p", day(0), "open", "a", "1", None)]


def brute(rows):
    held, snaps = {}, {}
    for p, ts, src, a, ph, w, at, *_ in rows:
        snaps.setdefault(src, set()).add(ts)
        clean = tuple((v or "").strip() or None for v in (a, ph, w))
        k = (at, tuple((v is not None, v or "") for v in clean))
        if (p, ts) not in held or k > held[p, ts][0]:
            held[p, ts] = (k, clean, src)
    out = []
    for p in {k[0] for k in held}:
        src = next(v[2] for k, v in held.items() if k[0] == p)
        order, run = sorted(snaps[src]), None
        for i, ts in enumerate([*order, None]):
            v = held[p, ts][1] if (p, ts) in held else None
            if run and (ts is None or v != run[1]):
                out.append((p, run[0], ts or "open", *run[1]))
                run = None
            if v is not None and run is None:
                run = (ts, v)
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [2, 3, 256])
def test_versions_equal_brute_force_whatever_the_chunk(spark, monkeypatch, chunk):
    monkeypatch.setattr(versions, "CHUNK", chunk)
    rng = random.Random(chunk)
    rows = [row(p, i, a=rng.choice(["a", "a", "a", "b", None, " "]), ph=rng.choice(["1", "1", "2"]), src=f"s{p % 2}", at=rng.randrange(3)) for p in range(4) for i in range(0, 300, 7) for _ in range(rng.choice([0, 1, 1, 1, 2]))]
    rows = [(str(r[0]), *r[1:]) for r in rows]
    assert sorted(history(spark, rows), key=str) == brute(rows)


def test_items_of_broken_payloads():
    assert [items_of(p) for p in (None, "", "{", "[]", '{"items": {}}', '{"items": [NaN]}', '{"items": []}', "null")] == [[]] * 8
    assert keyed([{"slug": "a", "name": " x "}, {"slug": "a", "name": "y"}, {"slug": " "}, {}, 3]) == {"a": "x\x1f\x1f\x1f\x1f"}


def test_set_difference():
    a, b = np.array([5, 1, 3]), np.array([3, 9, 5])
    r, n, c = set_difference(a, np.array([1, 1, 1]), b, np.array([1, 1, 2]))
    assert (r.tolist(), n.tolist(), c.tolist()) == ([1], [9], [5])
    e = np.array([], dtype=np.int64)
    assert [x.tolist() for x in set_difference(e, e, b, b)] == [[], [3, 5, 9], []]


CAP = "url string, ts string, digest string, first_seen timestamp_ntz"
CON = "url string, digest string, fetched_at timestamp_ntz, payload string, slug string"


def changes(spark, caps, cons):
    out = snapshot_changes(spark.createDataFrame(caps, CAP), spark.createDataFrame(cons, CON))
    return sorted(map(tuple, out.collect()))


def payload(**items):
    return json.dumps({"items": [{"slug": s, **v} for s, v in items.items()]})


def test_changes_between_snapshots(spark):
    d = {k: k * 32 for k in "ABCDE"}
    caps = [("u", day(i), d[k], T0) for i, k in enumerate("ABAECD")]
    cons = [
        ("u", d["A"], T0, payload(x={"name": "n", "price": ""}, y={"name": "m"}), "z"),
        ("u", d["B"], T0, payload(old={}), "z"),
        ("u", d["B"], T0 + dt.timedelta(1), payload(x={"name": " n", "tip": "t"}, z={}), "z"),
        ("u", d["C"], T0, payload(x={"name": "other"}, y={"name": "m", "phone": None}), "z"),
        ("u", d["D"], T0, '{"items": [{"slug": ', "z"),
        ("u", None, T0, payload(x={}), "z"),
        (None, d["A"], T0, payload(x={}), "z"),
    ]
    assert changes(spark, caps, cons) == sorted([
        ("u", day(1), "y", "removed"), ("u", day(1), "z", "added"), ("u", day(2), "y", "added"), ("u", day(2), "z", "removed"), ("u", day(4), "x", "changed")
    ])
    assert changes(spark, caps, []) == changes(spark, [], cons) == []


def test_runs_of_contents_equal_runs_of_observations(spark):
    from palimpsest.operators import presence

    rng = random.Random(7)
    contents = {c: rng.sample("abcde", rng.randrange(1, 4)) for c in "PQRS"}
    obs, at = [], {"l": 0, "m": 0}
    for i in range(400):
        li = "lm"[rng.random() < 0.2]
        at[li] = at[li] if rng.random() < 0.7 else rng.randrange(4)
        obs.append((li, f"20{10 + i // 100}{1 + i // 30 % 12:02d}{1 + i % 28:02d}{i:06d}", "PQRS"[at[li]]))
    o = spark.createDataFrame(obs, "list string, ts string, content string")
    c = spark.createDataFrame([(li, k, m) for li in "lm" for k, ms in contents.items() for m in [*ms, ms[0]]] + [("l", "P", None)], "list string, content string, member string")
    block, presence.BLOCK = presence.BLOCK, 8
    try:
        got = sorted(map(tuple, presence.presence_runs_of_contents(o, c).collect()), key=str)
        want = sorted(map(tuple, presence.presence_runs(o.join(c, ["list", "content"]), o).collect()), key=str)
    finally:
        presence.BLOCK = block
    assert got == want and len(got) > 50
    assert presence.presence_runs_of_contents(o.limit(0), c).collect() == []
