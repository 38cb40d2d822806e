"""History of changing attributes: every version of an entity's values with the period in which it was shown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import shown
from .ordered import with_neighbours

#: Snapshots of one list that an entity's array spans at most.
CHUNK = 256


def _fold(rows: Column, values: list[str]) -> Column:
    """Fold a sorted array of rows into versions; one is appended only where a value or the sequence breaks."""
    version = "struct<idx_from:bigint,idx_to:bigint,valid_from:string,next_ts:string," + ",".join(f"{v}:string" for v in values) + ">"

    def step(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        fresh = F.struct(
            x["idx"].alias("idx_from"), x["idx"].alias("idx_to"), x["ts"].alias("valid_from"), x["next_ts"].alias("next_ts"), *[x[v].alias(v) for v in values]
        )
        same = (last["idx_to"] + 1 == x["idx"])
        for v in values:
            same = same & last[v].eqNullSafe(x[v])
        grown = F.struct(
            last["idx_from"].alias("idx_from"), x["idx"].alias("idx_to"), last["valid_from"].alias("valid_from"), x["next_ts"].alias("next_ts"), *[last[v].alias(v) for v in values]
        )
        extended = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(grown))
        return F.when(F.size(acc) == 0, F.array(fresh)).when(same, extended).otherwise(F.concat(acc, F.array(fresh)))

    return F.aggregate(rows, F.expr(f"cast(array() as array<{version}>)"), step)


def attribute_versions(snapshots: DataFrame, entity: str, source: str, moment: str, arrived: str, values: list[str]) -> DataFrame:
    """(entity, source, valid_from, valid_to, *values): one row per version.

    Of several rows for an entity and moment the one that arrived last holds (ties: the larger values, then source).
    The snapshots of a source are all its moments. A version is a maximal stretch of consecutive snapshots of the
    source that show the entity with the same values, compared as shown without outer white space; a snapshot without the entity ends
    it. valid_to is the source's next moment after the stretch, or ``open``. Rows without entity or moment are left
    out; a null source is a source of its own; a null arrival is the earliest. Other columns are ignored.

    The rows of an entity are put into sorted arrays of at most :data:`CHUNK` snapshots, folded by a higher-order
    function, and stitched where a version touches the end of its array, so no entity needs one task.
    """
    rows = snapshots.select(
        F.col(entity).alias("_entity"), F.col(source).alias("_source"), F.col(moment).alias("_ts"), F.col(arrived).alias("_at"), *[shown(F.col(v)).alias(v) for v in values]
    ).filter(F.col("_entity").isNotNull() & F.col("_ts").isNotNull())
    moments = with_neighbours(rows.select("_source", "_ts").distinct(), "_source", "_ts", ["_ts"])
    moments = moments.select(F.col("_source").alias("_s"), F.col("_ts").alias("_t"), "idx", F.col("next__ts").alias("next_ts"))
    held = (
        rows.groupBy("_entity", "_ts")
        .agg(F.max(F.struct("_at", *values, "_source")).alias("r"))
        .select("_entity", F.col("r._source").alias("_source"), "_ts", *[F.col(f"r.{v}").alias(v) for v in values])
    )
    placed = held.join(moments, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_ts") == F.col("_t")))
    arrays = (
        placed.withColumn("chunk", F.floor(F.col("idx") / CHUNK))
        .groupBy("_entity", "_source", "chunk")
        .agg(F.sort_array(F.collect_list(F.struct("idx", F.col("_ts").alias("ts"), "next_ts", *values))).alias("rows"))
    )
    folded = arrays.select("_entity", "_source", "chunk", F.explode(_fold(F.col("rows"), values)).alias("v"))
    folded = folded.select("_entity", "_source", "chunk", "v.*")
    edge = (F.col("idx_from") % CHUNK == 0) | (F.col("idx_to") % CHUNK == CHUNK - 1)
    folded = folded.withColumn("_g", F.when(edge, F.lit(-1)).otherwise(F.col("chunk")))
    w = Window.partitionBy("_entity", "_source", "_g").orderBy("idx_from")
    before = F.lag(F.struct("idx_to", *values)).over(w)
    joins = before["idx_to"] + 1 == F.col("idx_from")
    for v in values:
        joins = joins & before[v].eqNullSafe(F.col(v))
    marked = folded.withColumn("_new", F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1))
    marked = marked.withColumn("_v", F.sum("_new").over(w))
    whole = marked.groupBy("_entity", "_source", "_g", "_v").agg(
        F.min("valid_from").alias("valid_from"), F.max_by("next_ts", "idx_to").alias("next_ts"), *[F.first(v).alias(v) for v in values]
    )
    return whole.select(
        F.col("_entity").alias(entity), F.col("_source").alias(source), "valid_from", F.coalesce("next_ts", F.lit("open")).alias("valid_to"), *values
    )
