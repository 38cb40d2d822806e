"""Sources: index listings, imported payloads, maps, reviewed batches, raw pages, configuration."""

from __future__ import annotations

import gzip
import json
import os
import tomllib
from collections.abc import Callable

import pandas as pd
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

CAPTURE = "url string, ts string, status string, mimetype string, digest string, length bigint"


def index_lines(spark: SparkSession, path: str) -> DataFrame:
    """(ts, url, status, mimetype, digest, length) of a listing in columns: at least five, the sixth a number or null.

    The listing of a file ends at a line that starts with ``<``; a file is read whole, so its lines keep their order.
    """
    files = spark.read.text(path, wholetext=True).select(F.split("value", r"\r?\n").alias("lines"))
    end = F.array_position(F.transform("lines", lambda x: x.startswith("<")), True)
    good = F.slice("lines", F.lit(1), F.when(end > 0, end - 1).otherwise(F.size("lines")).cast("int"))
    f = F.split(F.trim(F.col("line")), r"\s+")
    rows = files.select(F.explode(good).alias("line")).select(f.alias("f")).filter(F.size("f") >= 5)
    return rows.select(*[F.col("f")[i].alias(c) for i, c in enumerate(["ts", "url", "status", "mimetype", "digest"])], F.get("f", F.lit(5)).try_cast("bigint").alias("length"))


def index_json(spark: SparkSession, path: str) -> DataFrame:
    """Captures of JSON index answers: a row of column names, then rows; a length that is no number is 0."""
    rows = spark.read.text(path, wholetext=True).select(F.from_json("value", "array<array<string>>").alias("rows")).filter(F.size("rows") > 1)
    rows = rows.select(F.element_at("rows", 1).alias("names"), F.explode(F.slice("rows", F.lit(2), F.size("rows"))).alias("r"))
    col = lambda c: F.get("r", F.array_position("names", c).cast("int") - 1)
    return rows.select(
        col("original").alias("url"), col("timestamp").alias("ts"), col("statuscode").alias("status"), col("mimetype").alias("mimetype"), col("digest").alias("digest"), F.coalesce(col("length").try_cast("bigint"), F.lit(0).cast("bigint")).alias("length")
    )


def index_or_stored(read: Callable[[], DataFrame], stored: DataFrame) -> tuple[DataFrame, bool]:
    """(index, complete): a fresh index, or the stored one where reading fails, and then the run is not complete.

    The fresh index is looked into, as a source that is away often fails only when rows are asked for.
    """
    try:
        fresh = read()
        fresh.isEmpty()
    except (PySparkException, Py4JError, OSError):
        return stored, False
    return fresh, True


def imported_payloads(spark: SparkSession, path: str, captures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Payloads of JSON lines (ts, items) attributed to the url of their moment, and the rows that have none.

    Broken lines and lines without items are dropped; imported payloads count as version 1.
    """
    rows = spark.read.schema("ts string, digest string, items string").json(path, mode="DROPMALFORMED")
    rows = rows.filter(F.col("ts").isNotNull() & (F.coalesce(F.json_array_length("items"), F.lit(0)) > 0)).withColumn("extractor_version", F.lit(1))
    known = captures.groupBy("ts").agg(F.min("url").alias("url"))
    d = rows.join(known, "ts", "left")
    return d.filter("url is not null"), d.filter("url is null").drop("url")


def alias_file(path: str) -> dict[str, str]:
    """A JSON object of aliases; a missing or broken file is an empty map, names with an underscore are comments."""
    try:
        with open(path, encoding="utf-8") as f:
            raw = json.load(f)
    except (OSError, ValueError):
        return {}
    return {k: v for k, v in raw.items() if not k.startswith("_")} if isinstance(raw, dict) else {}


def json_batches(spark: SparkSession, pattern: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Rows of JSON arrays in many files, the last file's row of an id; and the files that are no array.

    schema has a column ``id``. Of the rows of one id in a file the last holds.
    """
    raw = spark.read.text(pattern, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    parsed = raw.select("file", F.when(F.try_parse_json("value").isNotNull() & F.ltrim("value").startswith("["), F.from_json("value", f"array<struct<{schema}>>")).alias("rows"))
    rows = parsed.filter("rows is not null").select("file", F.posexplode("rows").alias("pos", "r")).filter("r.id is not null and r.id <> ''")
    last = rows.groupBy(F.col("r.id").alias("id")).agg(F.max_by("r", F.struct("file", "pos")).alias("r")).select("r.*")
    return last, parsed.filter("rows is null").select("file")


def json_object(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A site's JSON file, one object or an array of objects."""
    r = spark.read.option("multiLine", True)
    return (r.schema(schema) if schema else r).json(path)


def raw_pages(spark: SparkSession, path: str) -> DataFrame:
    """(path, digest, body) of gzipped pages named by digest; a file that is not gzip gives a null body."""

    @F.pandas_udf(StringType())
    def unzip(content: pd.Series) -> pd.Series:
        def one(b: bytes) -> str | None:
            try:
                return gzip.decompress(b).decode("utf-8", "replace")
            except (OSError, EOFError):
                return None

        return content.map(one)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.html.gz").load(path)
    return files.select("path", F.regexp_extract("path", r"([^/]+)\.html\.gz$", 1).alias("digest"), unzip("content").alias("body"))


def configuration(path: str | None = None) -> dict:
    """A TOML file over the defaults; relative paths count from the file's folder."""
    out: dict = {"paths": {"data": "data", "out": "out"}, "engine": {"extractor_version": 6, "least_items": 5}}
    root = os.getcwd()
    if path:
        root = os.path.dirname(os.path.abspath(path))
        with open(path, "rb") as f:
            for section, values in tomllib.load(f).items():
                if isinstance(values, dict):
                    out.setdefault(section, {}).update(values)
                else:
                    out[section] = values
    out["paths"] = {k: v if os.path.isabs(v) else os.path.join(root, v) for k, v in out["paths"].items()}
    return out


def latest_write(rows: DataFrame, key: str, ordinal: str) -> DataFrame:
    """The last row of a key in order of a number."""
    w = Window.partitionBy(key).orderBy(F.col(ordinal).desc())
    return rows.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")
