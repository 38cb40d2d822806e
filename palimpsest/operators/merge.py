"""Latest non-empty attributes, names, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_nonempty(rows: DataFrame, by: list[str], order: str, fields: list[str]) -> DataFrame:
    """For every field on its own the value of the latest row that has one; text that is empty is none, zero is a value.

    One aggregation for all fields; of rows with one order the larger value holds.
    """

    def filled(c: str) -> Column:
        v = F.col(c)
        return F.nullif(v, F.lit("")) if dict(rows.dtypes)[c] == "string" else v

    return rows.groupBy(*by).agg(*[F.max(F.when(filled(c).isNotNull(), F.struct(F.col(order).alias("o"), filled(c).alias("v")))).alias(c) for c in fields]).select(*by, *[F.col(f"{c}.v").alias(c) for c in fields])


def names_of(rows: DataFrame, by: list[str], order: str, name: str) -> DataFrame:
    """The latest name, and all distinct names in order (of one member: as many as it has spellings)."""
    return rows.groupBy(*by).agg(F.max_by(name, F.struct(order, name)).alias("name"), F.sort_array(F.collect_set(name)).alias("names_seen"))


def with_cached_position(places: DataFrame, cache: DataFrame) -> DataFrame:
    """Fill a missing position from a cache (query, c_lat, c_lng) by address; a cached latitude of zero is no answer."""
    c = cache.filter(F.coalesce("c_lat", F.lit(0.0)) != 0).groupBy("query").agg(F.max(F.struct("c_lat", "c_lng")).alias("c"))
    d = places.join(c, (F.col("address") == F.col("query")) & (F.col("address") != "") & F.col("lat").isNull(), "left")
    return d.withColumns({"lat": F.coalesce("lat", "c.c_lat"), "lng": F.when(F.col("lat").isNull(), F.coalesce("c.c_lng", "lng")).otherwise(F.col("lng"))}).drop("c", "query")


def filled_from_donors(primary: DataFrame, donors: DataFrame, page: list[str], fields: list[str]) -> DataFrame:
    """Fill empty fields of items from other sources' items of the page: by slug, else by bare name.

    donors: the same columns and ``source``, in whose order the first donor counts. A slug that has a donor decides.
    """
    from ..functions.text import bare_key

    def one(key: Column, name: str) -> DataFrame:
        d = donors.withColumn(name, key).filter(F.coalesce(F.col(name), F.lit("")) != "")
        return d.groupBy(*page, name).agg(F.min_by(F.struct(*fields), F.struct("source", "position")).alias(f"{name}_donor"))

    p = primary.withColumn("_slug", F.col("slug")).withColumn("_name", bare_key(F.col("name")))
    p = p.join(one(F.col("slug"), "_slug"), [*page, "_slug"], "left").join(one(bare_key(F.col("name")), "_name"), [*page, "_name"], "left")
    donor = F.coalesce("_slug_donor", "_name_donor")
    own = lambda c: F.nullif(F.col(c), F.lit("")) if dict(primary.dtypes)[c] == "string" else F.col(c)
    return p.withColumns({c: F.coalesce(own(c), donor[c], F.col(c)) for c in fields}).select(*primary.columns)
