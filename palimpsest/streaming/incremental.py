"""Incremental work: files of captures that arrive are upserted batch by batch, each exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.state import upsert
from ..sources.files import CAPTURE


def follow_captures(spark: SparkSession, incoming: str, state: str, checkpoints: str) -> StreamingQuery:
    """Merge the capture files that have arrived in ``incoming`` (parquet) into the table in ``state``, then stop.

    Each batch writes a whole new version ``state/v=<batch>`` and only then is its predecessor of no use, so a batch
    that is repeated after a failure overwrites its own version and nothing else.
    """
    schema = CAPTURE + ", first_seen timestamp_ntz"
    stream = spark.readStream.schema(schema).parquet(incoming)

    def merge(batch: DataFrame, number: int) -> None:
        stored = read_state(batch.sparkSession, state, number - 1)
        merged = batch.dropDuplicates() if stored is None else upsert(stored, batch, ["url", "ts"], "first_seen", "first_seen")
        merged = upsert(merged.limit(0), merged, ["url", "ts"], "first_seen", "first_seen")
        merged.write.mode("overwrite").parquet(f"{state}/v={number}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoints).trigger(availableNow=True).start()


def read_state(spark: SparkSession, state: str, number: int) -> DataFrame | None:
    """A version of the table; the first batch has none before it."""
    return spark.read.parquet(f"{state}/v={number}").drop("v") if number >= 0 else None


def activity(events: DataFrame, late: str = "1 day", width: str = "1 day") -> DataFrame:
    """Captures of each url and day (first_seen), rows later than ``late`` left out: works on a stream and on a table."""
    from pyspark.sql import functions as F

    return events.withWatermark("first_seen", late).groupBy(F.window("first_seen", width).alias("w"), "url").agg(F.count(F.lit(1)).alias("n")).select("url", F.col("w.start").alias("start"), "n")
