"""Perplexity of every document under modified Kneser-Ney trigram models of its language, with rejection bands.

Spark counts the n-grams of each language over all documents; a text that several have passes once, with its number
of copies. The model is stored as rows of sorted n-gram hashes with their log
probabilities, one row per hash bucket, and looked up by binary search while the n-grams of the texts stream past.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint, shuffle_partitions
from .repetition import words

#: n-grams in a row of the model, about; copies of a row, so that the occurrences of a frequent n-gram spread.
ROW, SALTS = 1 << 15, 4
#: The bands: this many scaled median deviations of the log perplexity below and above the language's median.
LOWER, UPPER = 3.0, 3.0


def language(lang: Column) -> Column:
    """The first subtag in lower case, two or three letters; anything else is ``und``.

    So there are at most 26 ** 2 + 26 ** 3 languages, which bounds what is broadcast below.
    """
    base = F.lower(F.regexp_extract(F.coalesce(lang, F.lit("")), r"^\s*([A-Za-z]{2,3})(?![A-Za-z])", 1))
    return F.when(base == "", "und").otherwise(base)


#: Odd 64-bit constants with well spread bits, and one tag for each kind of n-gram.
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_TRI, _CTX, _BI, _MID, _UNI = (np.uint64(i) for i in range(1, 6))
_START = np.uint64(7)


def _mix(a: np.ndarray | np.uint64, b: np.ndarray | np.uint64) -> np.ndarray:
    """A 64-bit hash of two 64-bit hashes, for whole arrays."""
    with np.errstate(over="ignore"):
        h = (a ^ (b * _M1)) * _M2
        h = (h ^ (h >> np.uint64(29))) * _M1
        return h ^ (h >> np.uint64(32))


class _Stream:
    """The word hashes of a batch of texts one after another, two marks before each text."""

    def __init__(self, b: pa.RecordBatch) -> None:
        known: dict[str, int] = {}
        hashes: list[int] = []
        lengths: list[int] = []
        for text in b.column("text").to_pylist():
            w = words(text)
            lengths.append(len(w))
            hashes += (_START, _START)
            for x in w:
                h = known.get(x)
                if h is None:
                    h = known[x] = xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"))
                hashes.append(h)
        n = np.array(lengths, dtype=np.int64)
        at = np.arange(int(n.sum())) + np.repeat(2 * (np.arange(len(n)) + 1), n)
        w = np.array(hashes, dtype=np.uint64)
        codes = b.column("lang").dictionary_encode()
        self.langs = codes.dictionary
        self.doc = np.repeat(np.arange(len(n)), n)
        self.lang = codes.indices.to_numpy()[self.doc]
        tags = np.array([xxhash.xxh64_intdigest(x) for x in self.langs.to_pylist()], dtype=np.uint64)
        self.tag = tags[self.lang]
        self.w1, self.w2, self.w3 = w[at - 2], w[at - 1], w[at]
        self.head = _mix(_mix(_mix(self.tag, _TRI), self.w1), self.w2)
        self.tri = _mix(self.head, self.w3).view(np.int64)


COUNTS = "lang string, n bigint, tri bigint, ctx bigint, bi bigint, mid bigint, uni bigint"


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct trigrams of all texts of a batch with their counts, as hashes of themselves and their parts.

    A text counts as often as its ``copies`` say, once without that column.
    """
    for b in batches:
        s = _Stream(b)
        copies = b.column("copies").to_numpy() if "copies" in b.schema.names else np.ones(b.num_rows, np.int64)
        tri, at, which = np.unique(s.tri, return_index=True, return_inverse=True)
        n = np.zeros(len(tri), np.int64)
        np.add.at(n, which, copies[s.doc])
        tag, w2, w3 = s.tag[at], s.w2[at], s.w3[at]
        parts = [_mix(s.head[at], _CTX), _mix(_mix(_mix(tag, _BI), w2), w3), _mix(_mix(tag, _MID), w2), _mix(_mix(tag, _UNI), w3)]
        yield pa.RecordBatch.from_arrays([s.langs.take(pa.array(s.lang[at])), pa.array(n, pa.int64()), pa.array(tri), *[pa.array(p.view(np.int64)) for p in parts]], names=["lang", "n", "tri", "ctx", "bi", "mid", "uni"])


EVENTS = "k1 bigint, k2 bigint, tri bigint, n bigint, own bigint"


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text its distinct trigrams with counts."""
    for b in batches:
        s = _Stream(b)
        order = np.lexsort((s.tri, s.doc))
        tri, doc = s.tri[order], s.doc[order]
        fresh = np.ones(len(tri), bool)
        fresh[1:] = (tri[1:] != tri[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(fresh)
        n = np.diff(np.append(at, len(tri)))
        take = pa.array(doc[at])
        own = n * b.column("copies").to_numpy()[doc[at]]
        yield pa.RecordBatch.from_arrays([b.column("k1").take(take), b.column("k2").take(take), pa.array(tri[at]), pa.array(n, pa.int64()), pa.array(own, pa.int64())], names=["k1", "k2", "tri", "n", "own"])


#: What an interpolated probability is made of.
PARTS = ["c", "d", "total", "held", "p_lower"]


def left_out(parts: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Log probabilities of trigrams (rows of :data:`PARTS`) without the ``own`` counts of the text that is scored.

    A text thus gains nothing from what it says itself; a context that only it uses gives way to the lower order,
    whose counts of neighbours still hold the text's.
    """
    c, d, total, held, lower = parts
    rest, whole = c - own, total - own
    spare = np.where(rest > 0, held, held - d)
    p = np.where(whole > 0, (np.maximum(rest - d, 0) + np.maximum(spare, 0) * lower) / np.maximum(whole, 1), lower)
    return np.log(np.maximum(p, np.where(whole > 0, lower / (whole + 1), lower)))


def _level(counts: DataFrame, gram: str, context: str, lower: DataFrame, lower_key: str) -> DataFrame:
    """(gram, p): interpolated probabilities of one order, from (lang, gram, context, lower_key, c).

    Discounts are those of modified Kneser-Ney for counts of 1, 2 and 3 or more, from the counts of counts of the
    language and order; where these are too few to tell, 0.5, 1 and 1.5.
    """
    cc = counts.groupBy("lang").agg(*[F.count_if(F.col("c") == i).alias(f"n{i}") for i in range(1, 5)])
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    ds = [F.when((F.col(f"n{i}") > 0) & (F.col(f"n{i + 1}") > 0), F.greatest(F.lit(0.05), F.least(F.lit(i - 0.05), i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}")))).otherwise(F.lit(i * 0.5)).alias(f"d{i}") for i in (1, 2, 3)]
    cc = cc.select("lang", *ds)  # one row a language
    with_d = counts.join(F.broadcast(cc), "lang")
    d = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    with_d = with_d.withColumn("d", d)
    ctx = with_d.groupBy(context).agg(F.sum("c").alias("total"), F.sum("d").alias("held"))
    out = with_d.join(ctx, context).join(lower.toDF(lower_key, "p_lower"), lower_key)
    return out.select(gram, ((F.col("c") - F.col("d") + F.col("held") * F.col("p_lower")) / F.col("total")).alias("p"), *PARTS)


def kneser_ney(grams: DataFrame) -> DataFrame:
    """(tri, logp, c, d, total, held, p_lower): the log probability of every trigram, and what it is made of.

    c is its count, d its discount, total and held the count and the discounts of its context, p_lower the
    probability of its last two words; lower orders count distinct left neighbours.
    """
    tri = grams.groupBy("lang", "tri", "ctx", "bi", "mid", "uni").agg(F.sum("n").alias("c"))
    bi = tri.groupBy("lang", "bi", "mid", "uni").agg(F.count(F.lit(1)).alias("c"))
    uni = bi.groupBy("lang", "uni").agg(F.count(F.lit(1)).alias("c"))
    size = uni.groupBy("lang").agg((1 / F.count(F.lit(1))).alias("p"))
    uni = uni.withColumn("root", F.col("lang"))
    p1 = _level(uni, "uni", "root", size, "root").select("uni", "p")
    p2 = _level(bi, "bi", "mid", p1, "uni").select("bi", "p")
    p3 = _level(tri, "tri", "ctx", p2, "bi")
    return p3.select("tri", F.log("p").alias("logp"), *PARTS)


def _sorted_row(batch: pa.Table) -> pa.Table:
    """A row of the model: its hashes in order and the parts of their probabilities, as bytes (lists are slow to pass on)."""
    at = np.argsort(batch.column("tri").to_numpy())
    parts = np.stack([batch.column(c).to_numpy()[at] for c in PARTS]).astype(np.float32)
    return pa.table({"bucket": batch.column("bucket").slice(0, 1), "hashes": pa.array([batch.column("tri").to_numpy()[at].tobytes()], pa.binary()), "parts": pa.array([parts.tobytes()], pa.binary())})


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket, the model's row first: keep its arrays, look the n-grams of the bucket up."""
    h, p = np.zeros(0, np.int64), np.zeros((len(PARTS), 0))
    for b in batches:
        model = np.flatnonzero(~b.column("hashes").is_null().to_numpy(zero_copy_only=False))
        edges = [0, *model.tolist(), b.num_rows]
        found: list[tuple] = []
        for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
            if i:
                h = np.frombuffer(b.column("hashes")[lo].as_py(), np.int64)
                p = np.frombuffer(b.column("parts")[lo].as_py(), np.float32).reshape(len(PARTS), -1)
                lo += 1
            if lo < hi:
                k1, k2, tri, n, own = (b.column(c).slice(lo, hi - lo).to_numpy(zero_copy_only=False) for c in ("k1", "k2", "tri", "n", "own"))
                found.append((k1, k2, left_out(p[:, np.searchsorted(h, tri)].astype(np.float64), own) * n, n))
        if found:
            t = pa.table(dict(zip(("k1", "k2", "logp", "n"), (np.concatenate(c) for c in zip(*found)))))
            t = t.group_by(["k1", "k2"]).aggregate([("logp", "sum"), ("n", "sum")]).select(["k1", "k2", "logp_sum", "n_sum"]).rename_columns(["k1", "k2", "logp", "n"])
            yield from t.to_batches()


def perplexities(documents: DataFrame) -> DataFrame:
    """(doc_id, lang, n_words, perplexity, low, high, verdict): one row per row of ``documents``.

    ``low`` and ``high`` are the band of the language; verdict is ``repetitive`` below it, ``odd`` above it, ``kept``
    between, and ``empty`` for texts without words, null and empty ones included. Equal texts of a language are
    scored once (they are told apart by 128 bits) and counted as often as they occur; a text is scored without its own
    counts and those of its copies. Other columns are ignored.
    """
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), language(F.col("lang")).alias("lang"), "text")
    text = F.col("text").isNotNull()
    keyed = rows.withColumn("k1", F.when(text, F.xxhash64("lang", "text"))).withColumn("k2", F.when(text, F.xxhash64("text", "lang")))
    texts = checkpoint(keyed.filter("k1 is not null").groupBy("k1", "k2").agg(F.first("lang").alias("lang"), F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")))
    model = checkpoint(kneser_ney(texts.select("lang", "text", "copies").mapInArrow(_counts, COUNTS)))
    buckets = max(1, math.ceil(model.count() / ROW))
    bucket = F.pmod(F.col("tri"), F.lit(buckets))
    stored = model.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(_sorted_row, "bucket bigint, hashes binary, parts binary")
    stored = stored.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    null = lambda t, n: F.lit(None).cast(t).alias(n)
    events = texts.mapInArrow(_events, EVENTS).select(bucket.alias("bucket"), F.pmod("k1", F.lit(SALTS)).cast("int").alias("salt"), null("binary", "hashes"), null("binary", "parts"), "k1", "k2", "tri", "n", "own")
    both = stored.select("bucket", "salt", "hashes", "parts", *[null("bigint", c) for c in ("k1", "k2", "tri", "n", "own")]).unionByName(events)
    parts = max(shuffle_partitions(documents.sparkSession), 1)
    # one number to sort by, so that the sort is a radix sort
    both = both.withColumn("slot", (F.col("bucket") * SALTS + F.col("salt")) * 2 + F.col("hashes").isNull().cast("int"))
    both = both.repartition(parts, "bucket", "salt").sortWithinPartitions("slot")
    scored = both.mapInArrow(_look_up, "k1 bigint, k2 bigint, logp double, n bigint").groupBy("k1", "k2").agg(F.sum("logp").alias("logp"), F.sum("n").alias("n_words"))
    scored = scored.select("k1", "k2", "n_words", (-F.col("logp") / F.col("n_words")).alias("h"))
    scored = checkpoint(keyed.select("doc_id", "lang", "k1", "k2").join(scored, ["k1", "k2"], "left").select("doc_id", "lang", "n_words", "h"))
    mid = scored.groupBy("lang").agg(F.percentile_approx("h", 0.5).alias("mid"))
    dev = scored.join(F.broadcast(mid), "lang").groupBy("lang", "mid").agg((1.4826 * F.percentile_approx(F.abs(F.col("h") - F.col("mid")), 0.5)).alias("dev"))
    banded = scored.join(F.broadcast(dev), "lang", "left").withColumns({"low": F.exp(F.col("mid") - LOWER * F.col("dev")), "high": F.exp(F.col("mid") + UPPER * F.col("dev")), "perplexity": F.exp("h")})
    verdict = F.when(F.col("h").isNull(), "empty").when(F.col("perplexity") < F.col("low"), "repetitive").when(F.col("perplexity") > F.col("high"), "odd").otherwise("kept")
    return banded.select("doc_id", "lang", F.coalesce("n_words", F.lit(0)).alias("n_words"), "perplexity", "low", "high", verdict.alias("verdict"))
