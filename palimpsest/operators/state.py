"""State that grows by upserts, and what is still to be fetched or parsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(stored: DataFrame, incoming: DataFrame, key: list[str], arrived: str, first: str | None = None) -> DataFrame:
    """The union with one row per key: that of the latest arrival, an incoming one before a stored one of its time.

    ``first`` names a column that keeps its smallest value instead. Rows with a null in the key are kept as they are
    equal to each other. Both tables have the same columns; repeated rows count once.
    """
    both = stored.withColumn("_n", F.lit(0)).unionByName(incoming.withColumn("_n", F.lit(1)))
    rest = [c for c in stored.columns if c not in key]
    out = both.groupBy(*key).agg(F.max(F.struct(F.col(arrived).alias("_o"), "_n", *rest)).alias("r"), *([F.min(first).alias("_first")] if first else []))
    return out.select(*key, *[F.col("_first").alias(c) if c == first else F.col(f"r.{c}").alias(c) for c in rest]).select(*stored.columns)


def to_fetch(captures: DataFrame, contents: DataFrame, least_version: int) -> DataFrame:
    """(url, digest, ts, why): digests without a content, or with one of an older extractor, with their first moment.

    ``parse`` needs no download, only the raw page at hand.
    """
    need = captures.groupBy("url", "digest").agg(F.min("ts").alias("ts"))
    have = contents.groupBy("url", "digest").agg(F.max("extractor_version").alias("version"))
    d = need.join(have, ["url", "digest"], "left")
    return d.filter(F.col("version").isNull() | (F.col("version") < least_version)).select("url", "digest", "ts", F.when(F.col("version").isNull(), "fetch").otherwise("parse").alias("why"))


def is_page(status: Column, mimetype: Column) -> Column:
    """Whether a capture is a page: answered with 200, and HTML."""
    return (status == "200") & F.lower(mimetype).startswith("text/html")


def rekeyed(contents: DataFrame, captures: DataFrame) -> DataFrame:
    """(url, digest, effective_ts, effective_digest, moved): the digest of the moment that the archive really served.

    A content belongs under that digest; ``moved`` says whether it is another than was asked for. Contents whose
    effective moment the captures (url, ts, digest) do not know are left out.
    """
    served = captures.select("url", F.col("ts").alias("effective_ts"), F.col("digest").alias("effective_digest"))
    return contents.select("url", "digest", "effective_ts").join(served, ["url", "effective_ts"]).select("url", "digest", "effective_ts", "effective_digest", (F.col("digest") != F.col("effective_digest")).alias("moved"))


def decoded_hours(stored: DataFrame) -> DataFrame:
    """Stored opening hours (..., hours as JSON) with ``spans``, an array of (day, opens, closes); empty where it is broken."""
    spans = F.from_json("hours", "array<struct<day:string,opens:string,closes:string>>")
    return stored.withColumn("spans", F.coalesce(spans, F.expr("cast(array() as array<struct<day:string,opens:string,closes:string>>)"))).drop("hours")


def since_anchor(captures: DataFrame, checked: DataFrame) -> DataFrame:
    """Captures (url, ts) from the last checked moment (url, last_ts) on; all of a url whose moment is not indexed.

    Where ``checked`` has a column ``complete``, the moment of a run that was not complete is no anchor.
    """
    checked = checked.filter("complete").drop("complete") if "complete" in checked.columns else checked
    known = checked.join(captures.select("url", F.col("ts").alias("last_ts")), ["url", "last_ts"], "left_semi")
    return captures.join(known, "url", "left").filter(F.col("last_ts").isNull() | (F.col("ts") >= F.col("last_ts"))).drop("last_ts")


def capture_statistics(captures: DataFrame, contents: DataFrame) -> DataFrame:
    """(url, n, first_ts, last_ts, digests, cached, missing) of every url."""
    c = captures.groupBy("url").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.countDistinct("digest").alias("digests"))
    have = contents.groupBy("url").agg(F.countDistinct("digest").alias("cached"))
    d = c.join(have, "url", "left").withColumn("cached", F.coalesce("cached", F.lit(0).cast("bigint")))
    return d.withColumn("missing", F.greatest(F.col("digests") - F.col("cached"), F.lit(0).cast("bigint")))


def hours_to_fetch(places: DataFrame, hours: DataFrame, refresh: bool = False) -> DataFrame:
    """Places (place_id) without a stored answer, or with none found; ``skipped`` stays settled unless refreshed."""
    d = places.join(hours.select("place_id", F.col("source").alias("_s"), F.lit(True).alias("_row")), "place_id", "left")
    return d.filter(F.lit(refresh) | F.col("_row").isNull() | F.col("_s").isNull() | (F.col("_s") == "none")).drop("_s", "_row")
