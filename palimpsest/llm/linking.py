"""Shared by the linking operators: spelling attribution, star links in blocks, connected components, pairs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..session import checkpoint
from .parsing import deletions, edits_within, sound

#: Weight of a slip in a typed word, for each edit: a variant must be this much rarer than what it is attributed to.
SLIP = 0.3
#: Letters from which on a word that begins alike is hardly another real word, so that it needs no support.
PLAIN = 7


#: Characters of a word up to which the JVM counts edits; its band costs the square of the length, so longer ones go to Python.
COUNTED = 256


def _long_distances(a: str, b: str, most: int, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = batch.column(out).to_pylist()
            for i, v in enumerate(d):
                if v is not None and v < 0:
                    n = edits_within(batch.column(a)[i].as_py(), batch.column(b)[i].as_py(), most)
                    d[i] = n if n <= most else None
            yield batch.set_column(batch.schema.get_field_index(out), out, pa.array(d, pa.int32()))

    return run


def with_edits(df: DataFrame, a: str, b: str, most: int, out: str) -> DataFrame:
    """Adds ``out``: the edits between two columns if they are at most ``most``, else null, whatever their length."""
    x, y = F.col(a), F.col(b)
    short = (F.length(x) <= COUNTED) & (F.length(y) <= COUNTED)
    near = F.abs(F.length(x) - F.length(y)) <= most
    d = F.when(x == y, 0).when(short, F.nullif(F.levenshtein(x, y, most), F.lit(-1))).when(near, F.lit(-1)).cast("int")
    df = df.withColumn(out, d)
    return df.mapInArrow(_long_distances(a, b, most, out), df.schema)


@F.pandas_udf(ArrayType(StringType()))
def deletion_keys(words):  # noqa: ANN001, ANN201 - pandas Series of strings
    """Words share a key that are within one edit or transposition of each other as written, or as they sound."""
    return words.map(lambda w: [] if w is None else sorted({*deletions(w), *deletions(sound(w))}))


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        d = [min(edits_within(x, y, 2), edits_within(sound(x), sound(y), 2) + 1) for x, y in zip(b.column("word").to_pylist(), b.column("better").to_pylist())]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(d, pa.int32())], names=[*b.schema.names, "d"])


def attribute_spellings(words: DataFrame, support: DataFrame | None = None) -> DataFrame:
    """(scope, word, canonical) for (scope, word, n): every word with the spelling it is attributed to.

    A short word, or one that begins otherwise, may be a word of its own however rare: it is attributed only with
    support, a row (scope, word, key) whose key the better spelling has too.

    Noisy channel: in each block of words of a scope that share a deletion key the most frequent spelling is the
    candidate; over its blocks a word takes the candidate c with the greatest n(c) * SLIP ** edits, if that exceeds
    its own n, else itself. Candidates are more frequent than their variants, so attribution ends after a few steps.
    """
    w = words.groupBy("scope", "word").agg(F.sum("n").alias("n"))
    keyed = w.withColumn("key", F.explode(deletion_keys("word")))
    top = keyed.groupBy("scope", "key").agg(F.max(F.struct("n", "word")).alias("t")).select("scope", "key", F.col("t.word").alias("better"), F.col("t.n").alias("m"))
    candidates = keyed.join(top, ["scope", "key"]).filter((F.col("m") > F.col("n")) & (F.col("m") * SLIP > F.col("n"))).select("scope", "word", "n", "better", "m").distinct()
    scored = candidates.mapInArrow(_distances, "scope string, word string, n bigint, better string, m bigint, d int")
    scored = scored.withColumn("p", F.col("m") * F.pow(F.lit(SLIP), F.col("d"))).filter((F.col("d") <= 2) & (F.col("p") > F.col("n")))
    plain = (F.length("word") >= PLAIN) & (F.left("word", F.lit(1)) == F.left("better", F.lit(1)))
    if support is not None:
        scored = checkpoint(scored)
        other = support.select("scope", F.col("word").alias("better"), "key")
        shared = scored.filter(~plain).join(support, ["scope", "word"]).join(other, ["scope", "better", "key"], "left_semi").select(*scored.columns).distinct()
        scored = scored.filter(plain).unionByName(shared)
    best = scored.groupBy("scope", "word").agg(F.max_by("better", F.struct("p", "better")).alias("canonical"))
    out = w.select("scope", "word").join(best, ["scope", "word"], "left").withColumn("canonical", F.coalesce("canonical", "word"))
    second = out.select("scope", F.col("word").alias("canonical"), F.col("canonical").alias("further"))
    return out.join(second, ["scope", "canonical"]).select("scope", "word", F.col("further").alias("canonical"))


def star_links(keyed: DataFrame, node: str, rank: Column, carry: list[str]) -> DataFrame:
    """(node, top, *carry, *top_carry): each node of a block with the block's first node by ``rank``.

    One link for each node and block instead of all pairs of a block; both steps combine before they shuffle.
    """
    top = keyed.groupBy("key").agg(F.min(F.struct(rank.alias("rank"), node, *carry)).alias("t"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    top = top.select("key", F.col(f"t.{node}").alias("top"), *[F.col(f"t.{c}").alias(f"top_{c}") for c in carry])
    return keyed.join(top, "key").filter(F.col(node) != F.col("top")).select(node, "top", *carry, *[f"top_{c}" for c in carry])


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the nodes in (a, b): the component is its smallest node.

    Each round a node takes the smallest label among its neighbours and itself, then the label of its label, until
    nothing changes, however many rounds that takes. Every round ends in a reliable checkpoint. Links are stars and
    short trees, so a few rounds are enough.
    """
    edges = links.select("a", "b").filter("a is not null and b is not null and a <> b").distinct()
    edges = checkpoint(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = checkpoint(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")))
    changed = True
    while changed:
        near = edges.join(labels, edges.b == labels.node).groupBy("a").agg(F.min("component").alias("m"))
        stepped = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("component").alias("old"), F.least("component", "m").alias("component"))
        of = labels.select(F.col("node").alias("component"), F.col("component").alias("root"))
        new = stepped.join(of, "component", "left").select("node", "old", F.least("component", F.coalesce("root", "component")).alias("component"))
        new = checkpoint(new)
        changed = not new.filter("old <> component").isEmpty()
        labels = new.select("node", "component")
    return labels


def pairs(members: DataFrame, a: str, b: str) -> DataFrame:
    """All pairs of different members (node, component) of a component, the smaller first in byte order."""
    m = members.select("component", "node").distinct()
    other = m.select("component", F.col("node").alias(b))
    return m.join(other, "component").filter(F.col("node") < F.col(b)).select(F.col("node").alias(a), b)
