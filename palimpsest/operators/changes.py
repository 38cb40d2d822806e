"""Change detection between observations, and the change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from .ordered import with_neighbours


def signature(keys: Column) -> Column:
    """What makes two observations alike: the set of their keys, whatever order and repetition."""
    return F.md5(F.array_join(F.array_sort(F.array_distinct(keys)), "\x1f"))


def change_points(observations: DataFrame, order: str = "ts") -> DataFrame:
    """(list, after_ts, by_ts): consecutive observations (list, ts, sig) with different signatures: every change."""
    d = with_neighbours(observations.select("list", "ts", "sig"), "list", "ts", ["ts", "sig"])
    return d.filter(F.col("prev").isNotNull() & ~F.col("prev.sig").eqNullSafe(F.col("sig"))).select("list", F.col("prev.ts").alias("after_ts"), F.col("ts").alias("by_ts"))


def bisected_changes(observations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Change points found by bisection, and the observations probed: ((list, after_ts, by_ts), (list, ts)).

    Where every probe is a download, an interval whose ends are alike is not looked into, so a change that was taken
    back in between stays unseen; with the contents at hand :func:`change_points` is complete. All intervals of all
    lists are halved at once, so the rounds are the logarithm of the longest list.
    """
    at = checkpoint(with_neighbours(observations.select("list", "ts", "sig"), "list", "ts", ["ts"]).select("list", "ts", "sig", "idx"))
    ends = at.groupBy("list").agg(F.min("idx").alias("lo"), F.max("idx").alias("hi"))
    sig = lambda n: at.select("list", F.col("idx").alias(n), F.col("ts").alias(f"{n}_ts"), F.col("sig").alias(f"{n}_sig"))
    live = checkpoint(ends.join(sig("lo"), ["list", "lo"]).join(sig("hi"), ["list", "hi"]))
    probed = [live.select("list", F.col("lo_ts").alias("ts")), live.select("list", F.col("hi_ts").alias("ts"))]
    found = []
    while True:
        differ = live.filter(~F.col("lo_sig").eqNullSafe(F.col("hi_sig")))
        found.append(differ.filter("hi - lo = 1").select("list", F.col("lo_ts").alias("after_ts"), F.col("hi_ts").alias("by_ts")))
        open_ = differ.filter("hi - lo > 1").withColumn("mid", F.floor((F.col("lo") + F.col("hi")) / 2)).join(sig("mid"), ["list", "mid"])
        open_ = checkpoint(open_)
        if open_.isEmpty():
            break
        probed.append(open_.select("list", F.col("mid_ts").alias("ts")))
        side = lambda a, b: open_.select("list", *[F.col(f"{s}{x}").alias(f"{n}{x}") for s, n in ((a, "lo"), (b, "hi")) for x in ("", "_ts", "_sig")])
        live = side("lo", "mid").unionByName(side("mid", "hi"))
    out, seen = found[0], probed[0]
    for f in found[1:]:
        out = out.unionByName(f)
    for p in probed[1:]:
        seen = seen.unionByName(p)
    return out, seen.distinct()


def change_log(observations: DataFrame, lists: DataFrame) -> DataFrame:
    """(list, after_ts, by_ts, added, removed): members that came and went between consecutive observations.

    observations: (list, ts, content); lists: (list, content, members) with members an array of struct(key, name) in
    the order shown, each key once. added keeps the order of the later observation, removed that of the earlier one.
    Only moments and content ids are ordered; the arrays are joined to the pairs of contents that differ, each pair once.
    """
    d = with_neighbours(observations.select("list", "ts", "content"), "list", "ts", ["ts", "content"])
    steps = d.filter(F.col("prev").isNotNull() & (F.col("prev.content") != F.col("content"))).select("list", F.col("prev.ts").alias("after_ts"), F.col("ts").alias("by_ts"), F.col("prev.content").alias("old"), F.col("content").alias("new"))
    pairs = steps.select("list", "old", "new").distinct()
    m = lambda n: lists.select("list", F.col("content").alias(n), F.col("members").alias(f"{n}_m"))
    both = pairs.join(m("old"), ["list", "old"]).join(m("new"), ["list", "new"])
    keys = lambda c: F.transform(c, lambda x: x["key"])
    both = both.withColumn("gone", F.array_except(keys("old_m"), keys("new_m"))).withColumn("come", F.array_except(keys("new_m"), keys("old_m")))
    # keys by hash; only those few that differ are looked up in the list for its order and names
    only = lambda a, b: F.filter(F.col(a), lambda x: F.array_contains(F.col(b), x["key"]))
    both = both.select("list", "old", "new", only("new_m", "come").alias("added"), only("old_m", "gone").alias("removed")).filter((F.size("added") > 0) | (F.size("removed") > 0))
    return steps.join(both, ["list", "old", "new"]).select("list", "after_ts", "by_ts", "added", "removed")


def unsampled(changes: DataFrame, index: DataFrame) -> DataFrame:
    """Add ``unsampled``: captures of the index (list, ts) strictly between the two moments; null if one is unknown."""
    at = with_neighbours(index.select("list", "ts").distinct(), "list", "ts", ["ts"]).select("list", "ts", "idx")
    d = changes.join(at.select("list", F.col("ts").alias("after_ts"), F.col("idx").alias("_lo")), ["list", "after_ts"], "left")
    d = d.join(at.select("list", F.col("ts").alias("by_ts"), F.col("idx").alias("_hi")), ["list", "by_ts"], "left")
    return d.withColumn("unsampled", F.greatest(F.col("_hi") - F.col("_lo") - 1, F.lit(0).cast("bigint"))).drop("_lo", "_hi")


def without_closed(changes: DataFrame, closed: DataFrame) -> DataFrame:
    """Drop the ids in ``closed`` (id) from added_ids and removed_ids, then changes without any id left; the names stay.

    closed is exploded against, not collected: each id of a change is looked up by an anti join.
    """
    c = changes.withColumn("_row", F.struct("list", "after_ts", "by_ts"))
    ids = c.select("_row", F.posexplode_outer(F.concat(F.transform("added_ids", lambda x: F.struct(F.lit("a").alias("k"), x.alias("id"))), F.transform("removed_ids", lambda x: F.struct(F.lit("r").alias("k"), x.alias("id"))))).alias("p", "x"))
    kept = ids.select("_row", "p", "x.k", "x.id").filter("id is not null").join(closed.select("id").distinct(), "id", "left_anti")
    back = kept.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("p", "k", "id"))).alias("s"))
    of = lambda k: F.transform(F.filter("s", lambda x: x["k"] == k), lambda x: x["id"])
    return c.drop("added_ids", "removed_ids").join(back, "_row").select("*", of("a").alias("added_ids"), of("r").alias("removed_ids")).drop("_row", "s")


def collapsed_versions(observations: DataFrame) -> DataFrame:
    """(list, sig, from_ts, to_ts, n): neighbouring observations (list, ts, sig) with one signature as one version."""
    d = with_neighbours(observations.select("list", "ts", "sig"), "list", "ts", ["sig"])
    starts = d.filter(F.col("prev").isNull() | ~F.col("prev.sig").eqNullSafe(F.col("sig"))).select("list", "ts", "sig", "idx")
    last = d.groupBy("list").agg(F.max("idx").alias("end_idx"))
    s = with_neighbours(starts, "list", "ts", ["idx"]).drop("prev", "idx").join(starts.select("list", "ts", F.col("idx").alias("i")), ["list", "ts"])
    following = starts.select("list", F.col("ts").alias("next_ts"), F.col("idx").alias("k"))
    s = s.join(following, ["list", "next_ts"], "left").join(last, "list").withColumn("j", F.coalesce(F.col("k") - 1, F.col("end_idx")))
    to = d.select("list", F.col("idx").alias("j"), F.col("ts").alias("to_ts"))
    return s.join(to, ["list", "j"]).select("list", "sig", F.col("ts").alias("from_ts"), "to_ts", (F.col("j") - F.col("i") + 1).alias("n"))
