"""Alias maps: where a name's key leads, following chains and stopping at cycles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint

ALIASES = "alias string, target string"


def closed_aliases(aliases: DataFrame) -> DataFrame:
    """(alias, target) with every chain followed to its end, for a map (alias, target) with one row per alias.

    A chain is followed while its key is an alias that was not followed before, so it may end on a key it has seen:
    in a cycle every key leads to itself, and a tail into a cycle leads to the key at which it enters. One join a
    round over the aliases that still move, for as many rounds as the longest chain; nothing is collected. Null
    aliases are left out.
    """
    step = aliases.filter("alias is not null and target is not null").dropDuplicates(["alias"])
    hop = step.select(F.col("alias").alias("key"), F.col("target").alias("next"))
    moving = step.select("alias", F.col("target").alias("key"), F.array("alias").alias("seen"))
    done = None
    while True:
        joined = checkpoint(moving.join(hop, "key", "left"))
        stop = F.col("next").isNull() | F.array_contains("seen", F.col("key"))
        ended = joined.filter(stop).select("alias", F.col("key").alias("target"))
        done = ended if done is None else done.unionByName(ended)
        moving = joined.filter(~stop).select("alias", F.col("next").alias("key"), F.array_append("seen", F.col("key")).alias("seen"))
        if moving.isEmpty():
            return done


def alias_frame(spark: SparkSession, mapping: dict[str, str]) -> DataFrame:
    """A map as a DataFrame; entries whose key starts with an underscore are comments."""
    return spark.createDataFrame([(k, v) for k, v in mapping.items() if not k.startswith("_")], ALIASES)


def suggest_aliases(transitions: DataFrame) -> DataFrame:
    """(list, by, removed, added): pairs of one step of a list that may be one entry renamed.

    transitions: (list, by, kind, key) with the keys added and removed at a step. Where a step removes one and adds
    one, containment or two shared words make a pair; otherwise containment with at most 12 letters more does.
    Candidates come from an equi-join on runs of letters, and the single pair of a step from one on the step.
    """
    step = ["list", "by"]
    t = transitions.filter("key <> ''")
    sizes = t.groupBy(*step).agg(F.count_if(F.col("kind") == "removed").alias("r"), F.count_if(F.col("kind") == "added").alias("a"))
    # one name contains another only if the other's first letters are among its runs of as many letters
    at = F.transform(F.sequence(F.lit(1), F.length("key")), lambda i: F.array(*[F.substr(F.col("key"), i, F.lit(n)) for n in (1, 2, 3)]))
    runs = t.withColumn("part", F.explode(F.array_distinct(F.flatten(at))))
    heads = t.withColumn("part", F.substring("key", 1, 3))
    side = lambda d, k: d.filter(F.col("kind") == k).select(*step, "part", F.col("key").alias(k))
    pairs = side(heads, "removed").join(side(runs, "added"), [*step, "part"]).unionByName(side(runs, "removed").join(side(heads, "added"), [*step, "part"]))
    words = lambda c: F.split(c, " ")
    pairs = pairs.select(*step, "removed", "added").distinct()
    single = (
        t.filter("kind = 'removed'").join(sizes.filter("r = 1 and a = 1"), step).select(*step, F.col("key").alias("removed"))
        .join(t.filter("kind = 'added'").select(*step, F.col("key").alias("added")), step)
        .select(*step, "removed", "added")
    )
    both = pairs.unionByName(single).distinct().join(sizes, step).withColumn("shared", F.size(F.array_intersect(words("removed"), words("added"))))
    within = F.contains("removed", F.col("added")) | F.contains("added", F.col("removed"))
    near = F.abs(F.length("removed") - F.length("added")) <= 12
    alone = (F.col("r") == 1) & (F.col("a") == 1)
    return both.filter(F.when(alone, within | (F.col("shared") >= 2)).otherwise(within & near)).select(*step, "removed", "added")
