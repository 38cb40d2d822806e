import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from palimpsest.llm.event_runs import collapse_runs, seconds_between

SCHEMA = "url string, ts string, digest string, entity string, n int"


def runs(spark, rows, parts=4):
    out = collapse_runs(spark.createDataFrame(rows, SCHEMA), "url", "ts", "digest", parts)
    return sorted((r.url, r.digest, r.first_ts, r.last_ts, r.n) for r in out.collect())


def brute(rows):
    out = []
    for u, of in groupby(sorted(r[:3] for r in rows if None not in r[:3]), key=lambda r: r[0]):
        for v, g in groupby(of, key=lambda r: r[2]):
            g = list(g)
            out.append((u, v, g[0][1], g[-1][1], len(g)))
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 3, 7, 40])
def test_runs_equal_brute_force_whatever_the_tasks(spark, parts):
    rng = random.Random(parts)
    rows = [("hot" if rng.random() < 0.5 else f"u{rng.randrange(5)}", f"{20200101000000 + i}", rng.choice(["a", "a", "a", "b"]), "x", 1) for i in range(600)]
    rows += [("one", f"{i:014d}", "same", "x", 1) for i in range(300)]
    rng.shuffle(rows)
    assert runs(spark, rows, parts) == brute(rows)


def test_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = [("u", f"{i:014d}", "abbbbbbbbbbacc"[i % 14], "x", 1) for i in range(100)]
        assert runs(spark, rows, 2) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_nulls_and_empty(spark):
    assert runs(spark, []) == []
    rows = [("u", "1", "a", None, 1), ("u", "2", None, None, 1), ("u", "3", "a", None, 1), (None, "1", "a", None, 1), ("u", None, "a", None, 1)]
    assert runs(spark, rows) == [("u", "a", "1", "3", 2)]


def test_duration(spark):
    df = spark.createDataFrame([("20200101000000", "20200102000001"), ("x", "20200102000001")], "a string, b string")
    assert [r[0] for r in df.select(seconds_between("a", "b")).collect()] == [86401, None]
