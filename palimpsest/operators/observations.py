"""Observations: the captures whose content is known, with the members that each of them lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize
from .captures import moments

#: Fields of an item that the engine carries.
ITEM = "position:int,name:string,slug:string,website:string,source_anchor:string,address:string,phone:string,lat:double,lng:double,price:string,tip:string"
PAYLOAD = f"extractor_version int, source string, n int, items array<struct<{ITEM}>>"


def payload_items(payload: Column) -> Column:
    """The items of a payload, null unless it is valid JSON."""
    return F.when(F.try_parse_json(payload).isNotNull(), F.from_json(payload, PAYLOAD)["items"])


def latest_contents(contents: DataFrame) -> DataFrame:
    """The latest row of each (url, digest): fetched_at, then the larger payload."""
    c = contents.filter(F.col("url").isNotNull() & F.col("digest").isNotNull())
    return c.groupBy("url", "digest").agg(F.max(F.struct("fetched_at", "payload", "extractor_version", "effective_ts", "http_status")).alias("r")).select("url", "digest", "r.*")


def listed(contents: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """(url, digest, pos, raw_key, key, name, item): the items of every content with at least one item.

    pos is the place in the payload, from 0. raw_key is the normal name; key is where the alias map leads it (a map
    of :func:`identity.closed_aliases`, of bounded size, broadcast by its measured size only). Items without a key
    stay here; whether a key counts is up to the caller.
    """
    items = latest_contents(contents).select("url", "digest", payload_items(F.col("payload")).alias("items")).filter(F.size("items") > 0)
    rows = items.select("url", "digest", F.posexplode("items").alias("pos", "item"))
    rows = rows.withColumn("name", F.coalesce("item.name", F.lit(""))).withColumn("raw_key", normalize(F.col("name")))
    if aliases is None:
        return rows.withColumn("key", F.col("raw_key"))
    return rows.join(aliases.select(F.col("alias").alias("raw_key"), "target"), "raw_key", "left").withColumn("key", F.coalesce("target", "raw_key")).drop("target")


def first_of(rows: DataFrame, key: str) -> DataFrame:
    """The first row of every key of a content; rows without a key are left out."""
    r = rows.filter(F.col(key) != "")
    return r.groupBy("url", "digest", key).agg(F.min_by(F.struct(*[c for c in r.columns if c not in ("url", "digest", key)]), "pos").alias("r")).select("url", "digest", key, "r.*")


def observed(captures: DataFrame, contents: DataFrame) -> DataFrame:
    """(url, ts, digest): captures with a content that lists something."""
    full = latest_contents(contents).filter(F.size(payload_items(F.col("payload"))) > 0).select("url", "digest")
    return moments(captures).join(full, ["url", "digest"]).select("url", "ts", "digest")
