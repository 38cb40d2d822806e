"""Collapse runs of equal consecutive events of an entity into one event with its count and duration.

Boundary interval lookup: the events are range-partitioned by (entity, moment), so each task holds one stretch of the
global order, however large an entity is. In a task the positions at which a run starts are gathered into a sorted
array and every event is assigned to its run by binary search; then the runs are aggregated. Only the first and last
run of a task can continue in a neighbour, and only these are stitched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import shuffle_partitions

RUNS = "entity string, value string, first_ts string, last_ts string, n bigint, first boolean, last boolean"
SCHEMA = pa.schema([
    ("entity", pa.string()), ("value", pa.string()), ("first_ts", pa.string()), ("last_ts", pa.string()), ("n", pa.int64()), ("first", pa.bool_()), ("last", pa.bool_())
])


def _differs(c: pa.Array) -> np.ndarray:
    if len(c) < 2:
        return np.zeros(0, bool)
    return pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)


def _batch_runs(b: pa.RecordBatch) -> pa.Table:
    """The runs of a sorted batch: sorted run starts, binary search of every event, aggregation."""
    entity, ts, value = b.column("entity"), b.column("ts"), b.column("value")
    starts = np.flatnonzero(np.concatenate([[True], _differs(entity) | _differs(value)]))
    run = np.searchsorted(starts, np.arange(b.num_rows), side="right") - 1
    n = np.bincount(run, minlength=len(starts))
    ends = starts + n - 1
    return pa.table({
        "entity": entity.take(pa.array(starts)), "value": value.take(pa.array(starts)), "first_ts": ts.take(pa.array(starts)), "last_ts": ts.take(pa.array(ends)), "n": pa.array(n.astype(np.int64))
    })


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of one task; a run that is still open at the end of a batch is carried into the next."""
    held: dict | None = None
    first = True

    def emit(rows: list[dict], table: pa.Table | None, last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal first
        parts = []
        if rows:
            parts.append(pa.Table.from_pylist(rows, schema=pa.schema(list(SCHEMA)[:5])))
        if table is not None and table.num_rows:
            parts.append(table.cast(pa.schema(list(SCHEMA)[:5])))
        if not parts:
            return
        t = pa.concat_tables(parts).combine_chunks()
        is_first, is_last = np.zeros(t.num_rows, bool), np.zeros(t.num_rows, bool)
        is_first[0], is_last[-1] = first, last
        first = False
        t = t.append_column("first", pa.array(is_first)).append_column("last", pa.array(is_last))
        yield from t.to_batches()

    for b in batches:
        if not b.num_rows:
            continue
        t = _batch_runs(b)
        head = t.slice(0, 1).to_pylist()[0]
        rows: list[dict] = []
        if held is not None:
            if (held["entity"], held["value"]) == (head["entity"], head["value"]):
                held["last_ts"], held["n"] = head["last_ts"], held["n"] + head["n"]
                t = t.slice(1)
            if t.num_rows:
                rows = [held]
        if t.num_rows:
            held = t.slice(t.num_rows - 1).to_pylist()[0]
            t = t.slice(0, t.num_rows - 1)
        yield from emit(rows, t, False)
    if held is not None:
        yield from emit([held], None, True)


def collapse_runs(events: DataFrame, entity: str, moment: str, value: str, partitions: int | None = None) -> DataFrame:
    """(entity, value, first_ts, last_ts, n): the maximal runs of equal consecutive values of each entity.

    ``events`` has one row per (entity, moment). Rows in which one of the three columns is null are left out; they
    neither break nor lengthen a run. Moments are strings whose byte order is their order in time. An empty table
    gives no runs; other columns are ignored. ``partitions``: tasks of the range partitioning, by default
    spark.sql.shuffle.partitions; the result does not depend on it.
    """
    n = partitions or shuffle_partitions(events.sparkSession)
    rows = events.select(F.col(entity).alias("entity"), F.col(moment).alias("ts"), F.col(value).alias("value")).dropna()
    ordered = rows.repartitionByRange(n, "entity", "ts").sortWithinPartitions("entity", "ts")
    runs = ordered.mapInArrow(_collapse, RUNS).withColumn("task", F.spark_partition_id())
    # runs inside a task stay with it; those at its ends, two a task, are ordered within their entity
    group = F.when(F.col("first") | F.col("last"), F.lit(-1)).otherwise(F.col("task"))
    w = Window.partitionBy("entity", "g").orderBy("first_ts")
    runs = runs.withColumn("g", group)
    continues = F.col("first") & F.lag("last").over(w) & (F.lag("value").over(w) == F.col("value")) & (F.lag("task").over(w) != F.col("task"))
    runs = runs.withColumn("new", F.when(F.coalesce(continues, F.lit(False)), 0).otherwise(1))
    runs = runs.withColumn("run", F.sum("new").over(w))
    whole = runs.groupBy("entity", "g", "run").agg(
        F.first("value").alias("value"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("n").alias("n")
    )
    return whole.select(F.col("entity").alias(entity), F.col("value").alias(value), "first_ts", "last_ts", "n")


def seconds_between(a: str, b: str) -> Column:
    """Seconds from one 14-digit moment to another; null if one is no date."""
    at = lambda c: F.unix_timestamp(F.try_to_timestamp(F.col(c), F.lit("yyyyMMddHHmmss")))
    return at(b) - at(a)
