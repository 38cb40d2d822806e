"""Neighbours and ordinals in the order of an entity, without one task per entity.

A plain window over an entity puts all rows of a hot entity into one task. Here the entity's time is cut into months
(the first six digits of a 14-digit moment), the window runs inside (entity, month), and a second window runs over
one summary row per month. Moments have a resolution of one second, so a month holds at most 2.7 million distinct
ones and an entity at most 1,200 months a century: both windows have a fixed bound, whatever the skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def with_neighbours(df: DataFrame, entity: str, order: str, carry: list[str]) -> DataFrame:
    """Add ``prev`` (struct of ``carry``, null at the start), ``next_<order>`` (null at the end) and ``idx`` (from 0).

    (entity, order) must be unique; entity may be null and is then an entity of its own; order must not be null.
    """
    d = df.withColumn("_m", F.substring(order, 1, 6))
    w = Window.partitionBy(entity, "_m").orderBy(order)
    d = d.withColumns({
        "_prev": F.lag(F.struct(*carry)).over(w),
        "_next": F.lead(order).over(w),
        "_n": F.row_number().over(w),
    })
    months = (
        d.groupBy(entity, "_m")
        .agg(F.max_by(F.struct(*carry), F.col(order)).alias("_last"), F.min(order).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    )
    o = Window.partitionBy(entity).orderBy("_m")
    months = months.select(
        F.col(entity).alias("_e"),
        F.col("_m").alias("_mm"),
        F.lag("_last").over(o).alias("_before"),
        F.lead("_first").over(o).alias("_after"),
        F.coalesce(F.sum("_rows").over(o.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"),
    )
    joined = d.join(months, F.col(entity).eqNullSafe(F.col("_e")) & (F.col("_m") == F.col("_mm")))
    return joined.select(
        *[F.col(c) for c in df.columns],
        F.coalesce("_prev", "_before").alias("prev"),
        F.coalesce("_next", "_after").alias(f"next_{order}"),
        (F.col("_base") + F.col("_n") - 1).alias("idx"),
    )
