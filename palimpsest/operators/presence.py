"""When a member was on a list: gaps and islands over the list's observations, with brackets around each run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checkpoint
from .ordered import with_neighbours

#: Observations that one window spans at most; runs that touch the end of a block are stitched.
BLOCK = 512


def presence_runs(members: DataFrame, observations: DataFrame) -> DataFrame:
    """(list, member, i, j, from_ts, to_ts, before_ts, after_ts, still_on): the runs of each member.

    observations: (list, ts) of everything observed; members: (list, ts, member). Adjacency is that of observations.
    before_ts and after_ts are the observations around the run, null at the ends of coverage; still_on says that the
    run reaches the last one. Repeated rows count once; rows with a null member, list or moment are left out.
    """
    at = with_neighbours(observations.select("list", "ts").dropna().distinct(), "list", "ts", ["ts"])
    at = at.select("list", "ts", "idx", F.col("prev.ts").alias("prev_ts"), "next_ts")
    rows = members.select("list", "ts", "member").dropna().distinct().join(at, ["list", "ts"])
    rows = rows.withColumn("block", F.floor(F.col("idx") / BLOCK))
    own = ["list", "member", "block"]
    rows = rows.withColumn("g", F.col("idx") - F.row_number().over(Window.partitionBy(*own).orderBy("idx")))
    part = rows.groupBy(*own, "g").agg(
        F.min("idx").alias("i"), F.max("idx").alias("j"), F.min("ts").alias("from_ts"), F.max("ts").alias("to_ts"), F.min_by("prev_ts", "idx").alias("before_ts"), F.max_by("next_ts", "idx").alias("after_ts")
    )
    edge = (F.col("i") % BLOCK == 0) | (F.col("j") % BLOCK == BLOCK - 1)
    part = part.withColumn("at", F.when(edge, F.lit(-1)).otherwise(F.col("block")))
    w = Window.partitionBy("list", "member", "at").orderBy("i")
    part = part.withColumn("new", F.when(F.lag("j").over(w) + 1 == F.col("i"), 0).otherwise(1)).withColumn("run", F.sum("new").over(w))
    whole = part.groupBy("list", "member", "at", "run").agg(
        F.min("i").alias("i"), F.max("j").alias("j"), F.min("from_ts").alias("from_ts"), F.max("to_ts").alias("to_ts"), F.min_by("before_ts", "i").alias("before_ts"), F.max_by("after_ts", "j").alias("after_ts")
    )
    return whole.select("list", "member", "i", "j", "from_ts", "to_ts", "before_ts", "after_ts", F.col("after_ts").isNull().alias("still_on"))


def stretches(observations: DataFrame) -> DataFrame:
    """(list, content, i, j, from_ts, to_ts, before_ts, after_ts): consecutive observations (list, ts, content) of one content.

    i and j count the observations of a list from 0; before_ts and after_ts are the observations around the stretch.
    """
    d = with_neighbours(observations.select("list", "ts", "content").dropna(), "list", "ts", ["ts", "content"])
    d = checkpoint(d.select("list", "ts", "content", F.col("idx").alias("at"), F.col("prev.ts").alias("prev_ts"), F.col("prev.content").alias("prev_content")))
    starts = d.filter(F.col("prev_content").isNull() | (F.col("prev_content") != F.col("content")))
    s = with_neighbours(starts, "list", "ts", ["ts", "content", "at", "prev_ts"])
    # a start closes the stretch before it; the last stretch of a list ends where the list does
    closed = s.filter("prev is not null").select("list", F.col("prev.content").alias("content"), F.col("prev.at").alias("i"), (F.col("at") - 1).alias("j"), F.col("prev.ts").alias("from_ts"), F.col("prev_ts").alias("to_ts"), F.col("prev.prev_ts").alias("before_ts"), F.col("ts").alias("after_ts"))
    ends = d.groupBy("list").agg(F.max("at").alias("j"), F.max("ts").alias("to_ts"))
    last = s.filter("next_ts is null").drop("prev").join(ends, "list").select("list", "content", F.col("at").alias("i"), "j", F.col("ts").alias("from_ts"), "to_ts", F.col("prev_ts").alias("before_ts"), F.lit(None).cast("string").alias("after_ts"))
    return closed.unionByName(last)


def presence_runs_of_contents(observations: DataFrame, contents: DataFrame) -> DataFrame:
    """As :func:`presence_runs`, from observations (list, ts, content) and the members (list, content, member) of contents.

    Observations repeat a content many times running, so members are joined to stretches of it and not to every
    observation. Repeated rows count once; (list, ts) is unique.
    """
    s = stretches(observations)
    rows = s.join(contents.select("list", "content", "member").dropna().distinct(), ["list", "content"])
    block = Window.partitionBy("list", "member", F.floor(F.col("i") / BLOCK)).orderBy("i")
    rows = rows.withColumn("new", F.when(F.lag("j").over(block) + 1 == F.col("i"), 0).otherwise(1)).withColumn("run", F.sum("new").over(block))
    own = ["list", "member", F.floor(F.col("i") / BLOCK).alias("block"), "run"]
    ends = [F.min("i").alias("i"), F.max("j").alias("j"), F.min("from_ts").alias("from_ts"), F.max("to_ts").alias("to_ts"), F.min_by("before_ts", "i").alias("before_ts"), F.max_by("after_ts", "j").alias("after_ts")]
    part = rows.groupBy(*own).agg(*ends)
    # only the first and the last run of a block may go on in another block
    most = F.max("run").over(Window.partitionBy("list", "member", "block"))
    part = part.withColumn("at", F.when((F.col("run") == 1) | (F.col("run") == most), F.lit(-1)).otherwise(F.col("block"))).drop("run", "block")
    w = Window.partitionBy("list", "member", "at").orderBy("i")
    part = part.withColumn("new", F.when(F.lag("j").over(w) + 1 == F.col("i"), 0).otherwise(1)).withColumn("run", F.sum("new").over(w))
    whole = part.groupBy("list", "member", "at", "run").agg(*ends)
    return whole.select("list", "member", "i", "j", "from_ts", "to_ts", "before_ts", "after_ts", F.col("after_ts").isNull().alias("still_on"))


def merge_touching(intervals: DataFrame, by: str, start: str, end: str) -> DataFrame:
    """Join intervals of ``by`` that touch or overlap: (by, start, end, parts).

    The window carries the latest end so far; an interval that starts after it opens a new island.
    """
    w = Window.partitionBy(by).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = intervals.withColumn("_new", F.when(F.col(start) <= reach, 0).otherwise(1)).withColumn("_i", F.sum("_new").over(w))
    return d.groupBy(by, "_i").agg(F.min(start).alias(start), F.max(end).alias(end), F.count(F.lit(1)).alias("parts")).drop("_i")
