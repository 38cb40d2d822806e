"""Decide which address texts denote the same street door.

Each distinct text is read into components. Misspelt towns and streets are attributed to the spelling they stand for, and
missing parts are filled in where the other addresses leave one choice. A text is then expanded into all normal forms
that it plausibly has; the forms' components are hashed, exploded and equi-joined, and links between conflicting house
numbers, streets or towns are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import shown
from ..session import checkpoint, shuffle_partitions
from .linking import attribute_spellings, components, star_links, with_edits
from .parsing import REGIONS, address, deletions, sound

PARTS = ["number", "other", "dir", "street", "suffix", "town", "zip"]


#: Share of all texts that a word must end to be a region, and towns that it must follow.
REGION_SHARE, REGION_TOWNS = 0.002, 2
#: Sides, in degrees, of the cells that two spellings of a town, or of a street, have in common.
TOWN_CELL, STREET_CELL = 0.02, 0.005


def texts(*tables: DataFrame) -> DataFrame:
    """(text, lat, lng): the distinct addresses of all tables, without outer spaces, blank ones left out, and a position.

    The position is one that a row with the text shows, null where none does or the table has no lat and lng.
    """
    out = None
    for t in tables:
        at = [F.col(c).try_cast("double") if {"lat", "lng"} <= set(t.columns) else F.lit(None).cast("double") for c in ("lat", "lng")]
        known = (at[0] != 0) & (at[1] != 0) & (F.abs(at[0]) <= 90) & (F.abs(at[1]) <= 180)
        one = t.select(shown(F.col("address")).alias("text"), F.when(known, F.struct(at[0].alias("lat"), at[1].alias("lng"))).alias("p")).filter("text is not null")
        out = one if out is None else out.unionByName(one)
    return out.groupBy("text").agg(F.min("p").alias("p")).select("text", "p.lat", "p.lng")


def learnt_regions(texts: DataFrame) -> frozenset[str]:
    """Words for states and countries: they end the town part of many texts and may as well be left out.

    A word is a region if it ends a share of :data:`REGION_SHARE` of the texts, after :data:`REGION_TOWNS` different
    beginnings or more, which in at least half of the texts are also seen without it. The list is bounded by 1 / REGION_SHARE.
    A region of two words is not found.
    """

    def towns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([address(t, REGIONS)["town"] for t in b.column("text").to_pylist()], pa.string())], names=["town"])

    seen = checkpoint(texts.select("text").mapInArrow(towns, "town string").groupBy("town").agg(F.count(F.lit(1)).alias("n")))
    n = seen.agg(F.sum("n")).first()[0] or 0
    words = F.split("town", " ")
    ends = seen.select(F.element_at(words, -1).alias("word"), F.array_join(F.slice(words, 1, F.size(words) - 1), " ").alias("head"), "n").filter("head <> ''")
    alone = seen.select(F.col("town").alias("head"), F.lit(1).alias("alone"))
    counts = ends.join(alone, "head", "left").groupBy("word").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("heads"), F.sum(F.when(F.col("alone").isNotNull(), F.col("n")).otherwise(0)).alias("alone"))
    return frozenset(r.word for r in counts.filter((F.col("n") >= max(2.0, REGION_SHARE * n)) & (F.col("heads") >= REGION_TOWNS) & (F.col("alone") * 2 >= F.col("n"))).select("word").collect())


def _read(regions: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [address(t, regions) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array([r[p] for r in rows], pa.string()) for p in PARTS]], names=["text", "lat", "lng", *PARTS])

    return run


def _only(df: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """The value that all rows of a group agree on; a missing part is no group, but no direction is one."""
    for c in by:
        if c != "dir":
            df = df.filter(F.col(c) != "")
    return df.groupBy(*by).agg(F.min(value).alias(name), F.max(value).alias("_x")).filter(F.col(name) == F.col("_x")).drop("_x")


def _filled(d: DataFrame, known: DataFrame, value: str, ladder: list[list[str]]) -> DataFrame:
    """Fill an empty ``value`` with the only one that known rows agree on, by the first set of columns that has one.

    Only rows with a gap are looked up; the keys of a lookup hold one row each.
    """
    gap = d.filter(F.col(value) == "")
    whole = d.filter(F.col(value) != "")
    for by in ladder:
        gap = gap.join(_only(known, by, value, "_v"), by, "left")
        gap = gap.withColumn(value, F.when(F.col(value) == "", F.coalesce("_v", F.lit(""))).otherwise(F.col(value))).drop("_v")
    return whole.unionByName(gap)


def _cells(side: float) -> Column:
    """The cells of a position in two grids, so that near positions share at least one."""
    at = lambda c, i: F.floor(F.col(c) / side + i).cast("string")
    return F.when(F.col("lat").isNotNull(), F.array(*[F.concat_ws(" ", F.lit(str(i)), at("lat", i), at("lng", i)) for i in (0.0, 0.5)]))


def _support(d: DataFrame, scope: Column, word: str, keys: Column) -> DataFrame:
    return d.filter(F.col(word) != "").select(scope.alias("scope"), F.col(word).alias("word"), F.explode(keys).alias("key")).filter("key is not null").distinct()


def resolve(read: DataFrame) -> DataFrame:
    """Attribute misspelt towns and streets and fill in missing towns, suffixes and directions."""
    towns = read.filter("town <> ''").groupBy("town").agg(F.count(F.lit(1)).alias("n"))
    near = _support(read, F.lit(""), "town", F.concat(F.array(F.nullif("zip", F.lit(""))), F.coalesce(_cells(TOWN_CELL), F.array().cast("array<string>"))))
    named = attribute_spellings(towns.select(F.lit("").alias("scope"), F.col("town").alias("word"), "n"), near)
    d = read.join(named.select(F.col("word").alias("town"), "canonical"), "town", "left").withColumn("town", F.coalesce("canonical", "town")).drop("canonical")
    d = checkpoint(d)
    # a zip code belongs to the town that most of its addresses name
    zips = d.filter("zip <> '' and town <> ''").groupBy("zip", "town").agg(F.count(F.lit(1)).alias("n")).groupBy("zip").agg(F.max_by("town", F.struct("n", "town")).alias("_t"))
    d = d.join(zips, "zip", "left").withColumn("town", F.when((F.col("town") == ""), F.coalesce("_t", F.lit(""))).otherwise(F.col("town"))).drop("_t")
    # streets by town; where the town is unknown, by all towns together
    word = (~F.col("street").rlike("^[0-9]+$")) & (F.col("street") != "")
    streets = d.filter(word).groupBy(F.col("town").alias("scope"), F.col("street").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    every = streets.filter("scope <> ''").groupBy("word").agg(F.sum("n").alias("n")).select(F.lit("").alias("scope"), "word", "n")
    near = _support(d.filter(word), F.col("town"), "street", _cells(STREET_CELL))
    near = near.unionByName(near.withColumn("scope", F.lit(""))).distinct()
    named = attribute_spellings(streets.unionByName(every), near)
    d = d.join(named.select(F.col("scope").alias("town"), F.col("word").alias("street"), "canonical"), ["town", "street"], "left")
    d = checkpoint(d.withColumn("street", F.coalesce("canonical", "street")).drop("canonical"))
    full = d.filter("number <> '' and street <> '' and suffix <> '' and town <> ''")
    own = ["number", "dir", "street", "suffix"]
    d = checkpoint(_filled(d, full, "town", [own, ["dir", "street", "suffix"], ["number", "street"], ["street"]]))
    known = d.filter("number <> '' and street <> '' and suffix <> '' and town <> ''").withColumn("way", F.concat_ws("|", "dir", "suffix"))
    # what is missing of direction and suffix is one choice together
    d = d.withColumn("way", F.when(F.col("suffix") == "", F.lit("")).otherwise(F.concat_ws("|", "dir", "suffix")))
    gap = (F.col("dir") != "") & (F.col("suffix") == "")
    at = ["number", "street", "town"]
    sided = d.filter(gap)
    d = _filled(d.filter(~gap), known, "way", [[*at, "zip"], at, ["street", "town", "zip"], ["street", "town"]])
    sided = _filled(sided, known, "way", [[*at, "dir"], ["street", "town", "dir"]])
    d = checkpoint(d.unionByName(sided))
    parts = F.split("way", r"\|")
    filled = (F.col("suffix") == "") & (F.col("way") != "")
    return d.withColumn("dir", F.when(filled, parts[0]).otherwise(F.col("dir"))).withColumn("suffix", F.when(filled, parts[1]).otherwise(F.col("suffix"))).drop("way")


FORMS = "text string, key bigint, number string, dir string, street string, suffix string, town string, zip string, n int"


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All plausible normal forms of a text as hashes: each reading of the number, the street with any letter missing.

    Two combinations of components are hashed: with the town, and with the zip code.
    """
    names = ["text", "key", "number", "dir", "street", "suffix", "town", "zip", "n"]
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 6, pa.int32()]
    for b in batches:
        cols: list[list] = [[] for _ in names]
        for text, number, other, way, street, suffix, town, zip_, n in zip(*(b.column(c).to_pylist() for c in ("text", "number", "other", "dir", "street", "suffix", "town", "zip", "n"))):
            spelt = [street] if street.isdigit() else {*deletions(street), *deletions(sound(street))}
            for no in {number, other} - {""}:
                for s in spelt:
                    for place in {town, zip_ or town}:
                        key = xxhash.xxh64_intdigest("\x1f".join((no, way, s, suffix, place))) - (1 << 63)
                        for c, v in zip(cols, (text, key, no, way, street, suffix, town, zip_, n)):
                            c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)


def same_door(*tables: DataFrame, regions: frozenset[str] | None = None) -> DataFrame:
    """(text, door): each address text with its class; texts of one class denote the same street door.

    ``tables`` have a column ``address`` and may have ``lat`` and ``lng``; other columns are ignored. ``regions`` are the
    words for states and countries, by default those of :func:`learnt_regions`. A short town or street that differs from
    a frequent one by a slip is taken for it only if a zip code or a position agrees. Null and blank addresses are left out, repeated
    ones count once. A text without a readable number and street, or whose town or kind of street stays open, is a
    class of its own. The class is named by its first text in byte order. An empty table gives no rows.
    """
    spark = tables[0].sparkSession
    every = checkpoint(texts(*tables).repartition(shuffle_partitions(spark)))
    known = REGIONS | (learnt_regions(every) if regions is None else regions)
    read = checkpoint(every.mapInArrow(_read(known), "text string, lat double, lng double, " + ", ".join(f"{p} string" for p in PARTS)))
    d = resolve(read).filter("number <> '' and street <> '' and suffix <> '' and town <> ''")
    d = d.withColumn("other", F.when(F.col("street").rlike("^[0-9]+$") & (F.length("other") == 4), F.col("other")).otherwise(F.lit("")))
    door = ["number", "dir", "street", "suffix", "town"]
    # texts with the same components are one form; its smallest text stands for it
    forms = checkpoint(d.groupBy(*door, "other").agg(F.min("text").alias("text"), F.max("zip").alias("zip"), F.count(F.lit(1)).cast("int").alias("n")))
    keyed = forms.mapInArrow(_expand, FORMS)
    links = star_links(keyed, "text", -F.col("n"), ["number", "dir", "street", "suffix", "town", "zip"])
    # towns may be written differently under one zip code, but not be different words
    links = with_edits(links, "town", "top_town", 2, "towns")
    agree = (F.col("town") == F.col("top_town")) | (F.col("towns").isNotNull() & (F.col("zip") != "") & (F.col("zip") == F.col("top_zip")))
    for c in ("number", "dir", "suffix"):
        agree = agree & (F.col(c) == F.col(f"top_{c}"))
    numeric = F.col("street").rlike("^[0-9]+$") | F.col("top_street").rlike("^[0-9]+$")
    agree = agree & F.when(numeric, F.col("street") == F.col("top_street")).otherwise(F.col("off").isNotNull())
    links = checkpoint(with_edits(links, "street", "top_street", 2, "off").filter(agree).select(F.col("text").alias("a"), F.col("top").alias("b")))
    merged = components(links).withColumnRenamed("node", "form")
    members = d.join(forms.select(*door, "other", F.col("text").alias("form")), [*door, "other"]).select("text", "form")
    classes = members.join(merged, "form", "left").select("text", F.coalesce("component", "form").alias("door"))
    return read.select("text").join(classes, "text", "left").withColumn("door", F.coalesce("door", "text"))


def same_address_pairs(*tables: DataFrame, regions: frozenset[str] | None = None) -> DataFrame:
    """(address_a, address_b): all pairs of different texts of a class, the smaller first in byte order."""
    c = same_door(*tables, regions=regions)
    classes = checkpoint(c.select("text", "door"))
    return classes.select("door", F.col("text").alias("address_a")).join(classes.select("door", F.col("text").alias("address_b")), "door").filter("address_a < address_b").select("address_a", "address_b")
