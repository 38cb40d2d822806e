"""Archive captures: one row per page and moment, with comparable moments and digest values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the base32 alphabet of RFC 4648.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def moment14(ts: Column) -> Column:
    """A moment as 14 digits, whatever separators it was written with; null if it has not 14 digits."""
    digits = F.regexp_replace(ts, "[^0-9]", "")
    return F.when(F.length(digits) == 14, digits)


def hex_to_base32(h: Column) -> Column:
    """40 hexadecimal digits as 32 base32 characters: every 5 digits (20 bits) give 4 characters."""

    def char(i: Column) -> Column:
        group = F.conv(h.substr((F.floor(i / 4) * 5 + 1).cast("int"), F.lit(5)), 16, 10).cast("int")
        power = F.element_at(F.array(F.lit(32768), F.lit(1024), F.lit(32), F.lit(1)), (i % 4 + 1).cast("int"))
        code = F.floor(group / power).cast("int").bitwiseAND(F.lit(31))
        return F.lit(BASE32).substr(code + 1, F.lit(1))

    return F.concat_ws("", F.transform(F.sequence(F.lit(0), F.lit(31)), char))


def digest_value(digest: Column) -> Column:
    """The SHA-1 value a digest stands for, as upper-case base32; null for null, blank or a lone dash.

    Case, outer spaces and the prefixes ``sha1:`` and ``urn:sha1:`` do not matter, and 40 hexadecimal digits
    are the same value as the 32 base32 characters of those bits. Anything else is kept in upper case.
    """
    bare = F.regexp_replace(F.upper(F.trim(F.regexp_replace(digest, r"\s+", " "))), "^(URN:)?SHA1:", "")
    bare = F.trim(bare)
    value = F.when(bare.rlike("^[0-9A-F]{40}$"), hex_to_base32(bare)).otherwise(bare)
    return F.when(~bare.isin("", "-"), value)


def moments(captures: DataFrame) -> DataFrame:
    """(url, ts, digest): of several rows for a url and moment the one with the latest first_seen holds.

    Ties of first_seen are settled by the larger digest value, so the result does not depend on row order; a null
    first_seen is the earliest. Rows without a url or a readable moment are left out; a row whose digest has no
    value still wins its moment and is then left out. Repeated rows are combined before the shuffle.
    """
    rows = captures.select("url", moment14(F.col("ts")).alias("ts"), digest_value(F.col("digest")).alias("digest"), "first_seen")
    held = (
        rows.filter(F.col("url").isNotNull() & F.col("ts").isNotNull())
        .groupBy("url", "ts")
        .agg(F.max(F.struct("first_seen", "digest")).alias("last"))
    )
    return held.select("url", "ts", F.col("last.digest").alias("digest")).filter(F.col("digest").isNotNull())
