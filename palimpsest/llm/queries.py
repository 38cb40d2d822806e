"""The pN_ queries of the operators in this folder, over the whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.captures import moments
from ..sources.tables import table
from . import addresses, mixing, names, perplexity, repetition
from .encoding import encode_corpus
from .event_runs import collapse_runs, seconds_between


def p1_runs(spark: SparkSession, d: str) -> DataFrame:
    """Every run of captures with one digest value: its number of captures and its duration in seconds."""
    runs = collapse_runs(moments(table(spark, d, "captures")), "url", "ts", "digest")
    return runs.withColumn("seconds", seconds_between("first_ts", "last_ts"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Runs of two or more captures."""
    runs = collapse_runs(moments(table(spark, d, "captures")), "url", "ts", "digest")
    return runs.filter(F.col("n") >= 2).select("url", "first_ts", "last_ts")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of place ids that mean the same restaurant."""
    return names.same_restaurant_pairs(table(spark, d, "current_list"), table(spark, d, "eater38_places"))


def p2_restaurants(spark: SparkSession, d: str) -> DataFrame:
    """The class of every place id that shares its restaurant with another."""
    return names.same_restaurant(table(spark, d, "current_list"), table(spark, d, "eater38_places"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of address texts that denote the same street door."""
    return addresses.same_address_pairs(table(spark, d, "current_list"), table(spark, d, "eater38_places"))


def p4_doors(spark: SparkSession, d: str) -> DataFrame:
    """Every address text with the class of its street door."""
    return addresses.same_door(table(spark, d, "current_list"), table(spark, d, "eater38_places"))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    """Every text as token ids."""
    return encode_corpus(table(spark, d, "documents"))


def p6_chunked(spark: SparkSession, d: str) -> DataFrame:
    """Whether each text gives the same ids when it is cut into overlapping chunks of 200 code points, all but short ones."""
    t = table(spark, d, "documents")
    whole = encode_corpus(t).select("doc_id", F.xxhash64("ids").alias("a"), F.size("ids").alias("n"))
    cut = encode_corpus(t, chunk=200, overlap=100).select("doc_id", F.xxhash64("ids").alias("b"), F.size("ids").alias("m"))
    return whole.join(cut, "doc_id").select("doc_id", ((F.col("a") == F.col("b")) & (F.col("n") == F.col("m"))).alias("same"))


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    """The documents of every mix with the number of their uses."""
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual share of every source in every mix."""
    return mixing.shares(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p7_targets(spark: SparkSession, d: str) -> DataFrame:
    """The report's target shares, limits, and whether a source is used."""
    r = mixing.shares(table(spark, d, "documents"), table(spark, d, "mix_targets")).filter("max_repeats is not null")
    return r.select("mix_id", "source", "target_share", "max_repeats", (F.col("n_tokens") > 0).alias("used"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents of which two fifths or more repeat what they said before."""
    return repetition.found(table(spark, d, "documents"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """The repeated share of every document."""
    return repetition.repeated_share(table(spark, d, "documents"))


def p8_perplexity(spark: SparkSession, d: str) -> DataFrame:
    """Perplexity and band of every document."""
    return perplexity.perplexities(table(spark, d, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_runs": p1_runs,
    "p2_found": p2_found,
    "p2_restaurants": p2_restaurants,
    "p4_found": p4_found,
    "p4_doors": p4_doors,
    "p6_ids": p6_ids,
    "p6_chunked": p6_chunked,
    "p7_mix": p7_mix,
    "p7_shares": p7_shares,
    "p7_targets": p7_targets,
    "p8_found": p8_found,
    "p8_perplexity": p8_perplexity,
    "p8_shares": p8_shares,
}
