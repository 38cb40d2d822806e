"""Encode every text of a corpus with a public byte-level BPE tokenizer.

Texts up to ``chunk`` code points are encoded where they lie. Longer ones are cut into overlapping chunks that are
pre-tokenised in parallel. Pre-tokenisation looks only forwards, so two chunks that have one boundary in common in
their overlap agree from there on; the text is cut at such boundaries and the pieces are encoded in parallel. The
tokens of the pieces, put together, are those of the whole text, because BPE never merges over a boundary.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Fixed value: the published pre-tokenisation pattern of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Code points before the end of a chunk in which its boundaries are not trusted: more than a contraction.
MARGIN = 16
#: White space of this length is pre-tokenised by :func:`_pattern`.
LONG_SPACE = 4096
_SPACE = regex.compile(r"\s{%d}" % LONG_SPACE)


@lru_cache(maxsize=4)
def encoder(vocabulary: str) -> tiktoken.Encoding:
    """The tokenizer of a rank file; none of its tokens is special."""
    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def _pattern() -> regex.Pattern:
    return regex.compile(PATTERN)


def encode(text: str | None, vocabulary: str = VOCABULARY) -> list[int]:
    """Token ids of a text. The library's own pre-tokeniser overflows its stack on very long white space, so a text
    with such a run is pre-tokenised here and its pre-tokens are encoded one by one, with the same result."""
    if not text:
        return []
    e = encoder(vocabulary)
    if len(text) > LONG_SPACE and _SPACE.search(text):
        return [i for m in _pattern().finditer(text) for i in e._encode_single_piece(m.group().encode())]
    return e.encode_ordinary(text)


def decode(ids: Iterable[int], vocabulary: str = VOCABULARY) -> bytes:
    """The raw bytes of the ids: those of the whole are the concatenation of those of the parts."""
    return encoder(vocabulary).decode_bytes(list(ids))


def boundaries(text: str) -> list[int]:
    """Ends of the pre-tokens after which a text may be cut: not after white space, which looks at what follows."""
    return [m.end() for m in _pattern().finditer(text) if not text[m.end() - 1].isspace()]


def _pretokenised(chunk: int, overlap: int):
    """Per chunk: trusted boundaries in the zone it shares with the chunk before (head) and after (tail)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            heads, tails = [], []
            for k, n, text in zip(b.column("k").to_pylist(), b.column("chunks").to_pylist(), b.column("part").to_pylist()):
                ends = boundaries(text)
                trusted = len(text) - MARGIN if k + 1 < n else len(text)
                heads.append([k * chunk + e for e in ends if e <= min(overlap, trusted)])
                tails.append([k * chunk + e for e in ends if chunk <= e <= trusted])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))], names=[*b.schema.names, "head", "tail"])

    return run


def _encoded(vocabulary: str, text: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = pa.array([encode(x, vocabulary) for x in b.column(text).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], ids], names=[*keep, "ids"])

    return run


def encode_corpus(documents: DataFrame, vocabulary: str = VOCABULARY, chunk: int = 1 << 16, overlap: int = 1 << 10) -> DataFrame:
    """(doc_id, ids): one row per row of ``documents`` (doc_id bigint, text string; other columns are ignored).

    Null and empty texts give an empty list, strings that look like special tokens are ordinary text, repeated rows
    and null ids are kept. A text in which two neighbouring chunks share no boundary, such as one endless word, is
    encoded in one piece, with the same result. An empty table gives none.
    """
    if overlap * 2 > chunk or overlap <= 2 * MARGIN:
        raise ValueError("overlap must be over 32 and at most half a chunk")
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    long = F.coalesce(F.length("text") > chunk, F.lit(False))
    here = rows.filter(~long).mapInArrow(_encoded(vocabulary, "text", ["doc_id"]), "doc_id bigint, ids array<int>")

    whole = rows.filter(long).groupBy("doc_id", F.sha2("text", 256).alias("sha")).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    whole = whole.withColumn("chunks", F.ceil(F.length("text") / chunk))
    part = lambda k: F.struct(k.alias("k"), F.substring("text", (k * chunk + 1).cast("int"), F.lit(chunk + overlap)).alias("part"))
    parts = whole.select("doc_id", "sha", "copies", "chunks", F.explode(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1), part)).alias("c"))
    parts = parts.select("doc_id", "sha", "copies", "chunks", "c.k", "c.part").repartition("doc_id", "sha", "k")
    fields = "doc_id bigint, sha string, copies bigint, chunks bigint, k bigint, part string"
    cut = parts.mapInArrow(_pretokenised(chunk, overlap), fields + ", head array<bigint>, tail array<bigint>")

    text = Window.partitionBy("doc_id", "sha")
    w = text.orderBy("k")
    cut = cut.withColumn("end", F.array_min(F.array_intersect("tail", F.lead("head").over(w)))).drop("head", "tail")
    cut = cut.withColumn("start", F.lag("end").over(w))
    cut = cut.withColumn("bad", F.max(F.col("end").isNull() & (F.col("k") + 1 < F.col("chunks"))).over(text))
    start = F.coalesce("start", F.lit(0))
    stop = F.coalesce("end", F.col("k") * chunk + F.length("part"))
    piece = F.substring("part", (start - F.col("k") * chunk + 1).cast("int"), (stop - start).cast("int"))
    pieces = cut.filter(~F.col("bad")).select("doc_id", "sha", "copies", "k", piece.alias("piece")).repartition("doc_id", "sha", "k")
    pieces = pieces.mapInArrow(_encoded(vocabulary, "piece", ["doc_id", "sha", "copies", "k"]), "doc_id bigint, sha string, copies bigint, k bigint, ids array<int>")
    joined = pieces.groupBy("doc_id", "sha").agg(F.first("copies").alias("copies"), F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("all"))
    joined = joined.select("doc_id", "copies", F.flatten(F.transform("all", lambda x: x["ids"])).alias("ids"))
    # no common boundary between two chunks: only these texts come here, put together again from their chunks
    rest = cut.filter("bad").groupBy("doc_id", "sha").agg(F.first("copies").alias("copies"), F.sort_array(F.collect_list(F.struct("k", F.substring("part", F.lit(1), F.lit(chunk)).alias("p")))).alias("all"))
    rest = rest.select("doc_id", "copies", F.concat_ws("", F.transform("all", lambda x: x["p"])).alias("text"))
    rest = rest.mapInArrow(_encoded(vocabulary, "text", ["doc_id", "copies"]), "doc_id bigint, copies bigint, ids array<int>")
    again = joined.unionByName(rest).select("doc_id", "ids", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select("doc_id", "ids")
    return here.unionByName(again)
