import base64
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from palimpsest.operators.captures import moments
from palimpsest.operators.ordered import with_neighbours

SCHEMA = "url string, ts string, status string, mimetype string, digest string, length bigint, first_seen timestamp_ntz"
SHA = bytes(range(20))
B32 = base64.b32encode(SHA).decode()


def row(url="u", ts="20200101000000", digest=B32, seen=dt.datetime(2020, 1, 2)):
    return (url, ts, "200", "text/html", digest, 1, seen)


def found(spark, rows):
    return sorted(map(tuple, moments(spark.createDataFrame(rows, SCHEMA)).collect()))


def test_ways_to_write_a_digest(spark):
    ways = [B32, B32.lower(), f" {B32} ", f"sha1:{B32}", f"urn:sha1:{B32}", f"SHA1:{B32.lower()}", SHA.hex(), SHA.hex().upper(), f"sha1:{SHA.hex()}"]
    rows = [row(ts=f"202001010000{i:02d}", digest=w) for i, w in enumerate(ways)]
    assert {r[2] for r in found(spark, rows)} == {B32}


def test_no_value_and_no_moment(spark):
    rows = [row(digest=d, ts=f"2020010100000{i}") for i, d in enumerate([None, "", " ", "-", " - ", "sha1:"])]
    assert found(spark, [*rows, row(ts=None), row(ts="2020"), row(url=None)]) == []
    assert found(spark, []) == []


def test_latest_row_of_a_moment_holds(spark):
    a, b = dt.datetime(2020, 1, 2), dt.datetime(2020, 1, 3)
    rows = [row(digest="A" * 32, seen=a), row(ts="2020-01-01T00:00:00Z", digest="B" * 32, seen=b), row(digest="C" * 32, seen=None)]
    assert found(spark, rows) == [("u", "20200101000000", "B" * 32)]
    assert found(spark, [*rows, row(digest="-", seen=dt.datetime(2021, 1, 1))]) == []
    assert found(spark, [row(digest="A" * 32), row(digest="B" * 32), row(digest="B" * 32)]) == [("u", "20200101000000", "B" * 32)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.binary(min_size=20, max_size=20), min_size=1, max_size=20))
def test_hexadecimal_is_base32(spark, values):
    rows = [row(ts=f"202001010000{i:02d}", digest=v.hex()) for i, v in enumerate(values)]
    assert [r[2] for r in found(spark, rows)] == [base64.b32encode(v).decode() for v in values]


def test_neighbours_over_months(spark):
    ts = ["20200101000000", "20200131000000", "20200201000000", "20210501000000"]
    df = spark.createDataFrame([("a", t, i) for i, t in enumerate(ts)] + [(None, ts[0], 9)], "e string, ts string, v int")
    got = {(r.e, r.ts): (r.prev.v if r.prev else None, r.next_ts, r.idx) for r in with_neighbours(df, "e", "ts", ["v"]).collect()}
    assert got == {("a", ts[0]): (None, ts[1], 0), ("a", ts[1]): (0, ts[2], 1), ("a", ts[2]): (1, ts[3], 2), ("a", ts[3]): (2, None, 3), (None, ts[0]): (None, None, 0)}
