"""Sinks: places, maps, updates and reports as JSON, CSV and Markdown. Spark's committer makes the writes atomic."""

from __future__ import annotations

import gzip
import os
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def site_json(df: DataFrame, path: str, order: list[Column] | None = None) -> None:
    (df.orderBy(*order) if order else df).write.mode("overwrite").json(path)


def by_name(df: DataFrame) -> list[Column]:
    """Names as a reader looks for them, whatever their case and accents; the id decides between equal ones."""
    return [F.collate("name", "UNICODE_CI"), F.col("id")]


def features(places: DataFrame) -> DataFrame:
    """(feature): a GeoJSON feature of every place with a position, as text."""
    own = [c for c in places.columns if c not in ("lat", "lng")]
    feature = F.struct(
        F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array("lng", "lat").alias("coordinates")).alias("geometry"), F.struct(*own).alias("properties")
    )
    return places.filter("lat is not null and lng is not null").select(F.to_json(feature).alias("feature"))


def places_table(places: DataFrame) -> DataFrame:
    """Places for a spreadsheet: periods (array of struct(from_date, to_date)) in one cell, yes and no, no nulls."""
    cell = F.array_join(F.transform("periods", lambda p: F.concat(p["from_date"], F.lit(" to "), p["to_date"])), "; ")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return places.select(F.col("name").alias("place"), F.size("periods").alias("stretches"), cell.alias("periods"), F.when(F.col("on_list_now"), "yes").otherwise("no").alias("on_list_now"), text("lat"), text("lng"), text("address"))


def history_table(runs: DataFrame) -> DataFrame:
    """Runs (name, from_ts, to_ts, before_ts, after_ts, still_on) for a spreadsheet, with the brackets in words."""
    from ..functions.text import day_text

    d = lambda c: day_text(F.col(c))
    return runs.select(
        F.col("name").alias("place"), d("from_ts").alias("on_list_from"), d("to_ts").alias("on_list_through"),
        F.coalesce(F.when(F.col("before_ts").isNotNull(), F.concat_ws(" - ", d("before_ts"), d("from_ts"))), F.lit("before coverage")).alias("added_between"),
        F.coalesce(F.when(F.col("after_ts").isNotNull(), F.concat_ws(" - ", d("to_ts"), d("after_ts"))), F.lit("still on list")).alias("removed_between"),
        F.when(F.col("still_on"), "yes").otherwise("no").alias("still_on_list"),
    )


def change_table(changes: DataFrame) -> DataFrame:
    """Changes for a spreadsheet: names joined by semicolons."""
    from ..functions.text import day_text

    names = lambda c: F.array_join(F.transform(c, lambda x: x["name"]), "; ").alias(c)
    return changes.select(day_text(F.col("after_ts")).alias("change_after"), day_text(F.col("by_ts")).alias("change_by"), "unsampled", names("added"), names("removed"))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def markdown(runs: DataFrame) -> DataFrame:
    """(line): one line of a report per run, of the table of :func:`history_table`."""
    t = history_table(runs)
    start = F.when(F.col("added_between") == "before coverage", "start of coverage").otherwise(F.col("added_between"))
    return t.select(F.concat(F.lit("| "), F.concat_ws(" | ", "place", "on_list_from", "on_list_through", start, "removed_between"), F.lit(" |")).alias("line"))


def status_lines(statistics: DataFrame) -> DataFrame:
    """(line): a line of text for each row of :func:`state.capture_statistics`."""
    from ..functions.text import day_text

    part = lambda c, word: F.concat(F.col(c).cast("string"), F.lit(f" {word}"))
    period = F.concat(F.lit(" from "), day_text(F.col("first_ts")), F.lit(" to "), day_text(F.col("last_ts")))
    return statistics.select(F.concat("url", F.lit(": "), part("n", "captures"), period, F.lit(", "), part("digests", "contents"), F.lit(", "), part("missing", "missing")).alias("line"))


def updates_json(changes: DataFrame, path: str) -> None:
    """Changes (list, after_ts, by_ts, added, removed), the latest first, as JSON."""
    site_json(changes.select("list", "after_ts", "by_ts", "added", "removed"), path, [F.col("by_ts").desc(), F.col("list")])


def raw_pages(pages: DataFrame, folder: str) -> None:
    """Write pages (url, digest, body) gzipped as folder/bucket/digest.html.gz in a folder that all executors share.

    A file is written under another name and then renamed, so a task that is lost or run twice leaves no half of a page.
    Rows with a null are left out.
    """

    def write(rows) -> None:  # noqa: ANN001 - rows of a partition
        for r in rows:
            into = os.path.join(folder, r.bucket)
            os.makedirs(into, exist_ok=True)
            temporary = os.path.join(into, f".{r.digest}.{uuid.uuid4().hex}")
            with open(temporary, "wb") as f:
                f.write(gzip.compress(r.body.encode("utf-8", "surrogatepass"), mtime=0))
            os.replace(temporary, os.path.join(into, f"{r.digest}.html.gz"))

    from ..functions.text import url_bucket

    pages.select(url_bucket(F.col("url")).alias("bucket"), "digest", "body").dropna().foreachPartition(write)


def counts(places: DataFrame, runs: DataFrame, changes: DataFrame) -> DataFrame:
    """(metric, n): what a site's summary says of its places, stretches and changes."""
    one = lambda df, name, what: df.agg(what.cast("bigint").alias("n")).select(F.lit(name).alias("metric"), "n")
    every = F.count(F.lit(1))
    return (
        one(places, "places", every)
        .unionByName(one(places, "on_list_now", F.count_if("on_list_now")))
        .unionByName(one(places, "mapped", F.count_if(F.col("lat").isNotNull() & F.col("lng").isNotNull())))
        .unionByName(one(runs, "stretches", every))
        .unionByName(one(changes, "changes", every))
    )
