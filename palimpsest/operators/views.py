"""What a reader of the lists asks for: the current list, periods in a window, searches, facets, checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def current_list(rows: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """(list, position, member, name): the latest observation of each list, without excluded members, renumbered.

    rows: (list, ts, pos, member, name), each member once per observation. A list's latest observation is one
    snapshot, so the window of a list is as long as a snapshot.
    """
    last = rows.groupBy("list").agg(F.max("ts").alias("ts"))
    now = rows.join(last, ["list", "ts"])
    if excluded is not None:
        now = now.join(excluded.select("member").distinct(), "member", "left_anti")
    return now.select("list", F.row_number().over(Window.partitionBy("list").orderBy("pos", "member")).alias("position"), "member", "name")


def period_array(periods: Column) -> Column:
    """``a to b; c to d`` as an array of struct(a, b); text that is not such a period is left out."""
    each = F.filter(F.split(F.coalesce(periods, F.lit("")), r"\s*;\s*"), lambda p: p.rlike(r"^\s*\d{4}-\d\d-\d\d to \d{4}-\d\d-\d\d\s*$"))
    return F.transform(each, lambda p: F.struct(F.split_part(F.trim(p), F.lit(" to "), F.lit(1)).alias("a"), F.split_part(F.trim(p), F.lit(" to "), F.lit(2)).alias("b")))


def shown_between(periods: Column, lo: str, hi: str) -> Column:
    """Whether any period shares a day with [lo, hi]."""
    return F.exists(periods, lambda p: (p["a"] <= hi) & (p["b"] >= lo))


def matches(text: Column, query: str) -> Column:
    """Whether a haystack contains the query, whatever its case; an empty query matches all."""
    q = query.strip().lower()
    return F.lit(True) if not q else F.contains(text, F.lit(q))


def facets(values: Column, rows: DataFrame, order: list[str]) -> DataFrame:
    """(facet, n, rank): rows by each value of an array, in a fixed order, values without rows included as 0."""
    spark = rows.sparkSession
    fixed = spark.createDataFrame([(v, i) for i, v in enumerate(order)], "facet string, rank int")
    n = rows.select(F.explode(F.array_distinct(values)).alias("facet")).groupBy("facet").agg(F.count(F.lit(1)).alias("n"))
    return fixed.join(n, "facet", "left").select("facet", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"), "rank")


def check(name: str, violations: DataFrame, key: Column) -> DataFrame:
    """(check, key) of rows that violate a rule."""
    return violations.select(F.lit(name).alias("check"), key.cast("string").alias("key"))


def all_checks(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def site_checks(places: DataFrame, entries: DataFrame, closed: DataFrame) -> DataFrame:
    """(check, key): violations of a site's data; no row means that all is well.

    places: (id, name, periods, lat, lng); entries: (id) that must resolve; closed: (id) that must not be published.
    """
    p = places
    twice = p.groupBy("id").count().filter("count > 1")
    bare = p.filter(F.col("id").isNull() | (F.coalesce("name", F.lit("")) == "") | (F.coalesce("periods", F.lit("")) == ""))
    off = p.filter(F.col("lat").isNotNull() & F.col("lng").isNotNull() & ((F.abs("lat") > 90) | (F.abs("lng") > 180)))
    lost = entries.select("id").dropna().distinct().join(p.select("id"), "id", "left_anti")
    leak = p.select("id").distinct().join(closed.select("id"), "id", "left_semi")
    c = lambda n, d: check(n, d, F.col("id"))
    return all_checks(c("repeated id", twice), c("missing field", bare), c("position out of bounds", off), c("unknown id", lost), c("closed but published", leak))


def count_checks(places: DataFrame, features: DataFrame) -> DataFrame:
    """(check, key, stated, counted): where a place's stretches are not its periods, and the map's features against the positions.

    places: (id, stretches, periods, lat, lng). The row of the features is always there; the counts agree if all is well.
    """
    n = F.size(F.filter(F.split(F.coalesce("periods", F.lit("")), ";"), lambda x: F.trim(x) != "")).cast("bigint")
    stated = F.col("stretches").cast("bigint")
    wrong = places.filter(~stated.eqNullSafe(n)).select(F.lit("stretches").alias("check"), F.col("id").alias("key"), stated.alias("stated"), n.alias("counted"))
    mapped = places.agg(F.count_if(F.col("lat").isNotNull() & F.col("lng").isNotNull()).alias("stated"))
    drawn = mapped.join(features.agg(F.count(F.lit(1)).alias("counted")))  # two single rows
    return wrong.unionByName(drawn.select(F.lit("features").alias("check"), F.lit("map").alias("key"), "stated", "counted"))


def meals_or_text(places: DataFrame, hours: DataFrame, texts: DataFrame) -> DataFrame:
    """(place_id, by, meals): meals of each place by its opening hours (place_id, spans), else by its text (place_id, text).

    ``by`` says which of the two it was, or none. Hours and texts have a row a place.
    """
    from ..functions.hours import meals_named, meals_of

    d = places.join(hours, "place_id", "left").join(texts, "place_id", "left")
    by = F.when(F.col("spans").isNotNull(), "hours").when(F.col("text").isNotNull(), "text").otherwise("none")
    return d.select("place_id", by.alias("by"), F.when(F.col("spans").isNotNull(), meals_of(F.col("spans"))).otherwise(meals_named(F.col("text"))).alias("meals"))
