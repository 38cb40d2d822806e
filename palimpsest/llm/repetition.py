"""The repeated share of each document: words in passages of five or more words that already began earlier in it."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a passage at least.
PASSAGE = 5
_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """Runs of letters and digits, in lower case."""
    return [w.lower() for w in _WORD.findall(text)] if text else []


def covered(w: list, passage: int = PASSAGE) -> int:
    """Words that lie in a passage of at least ``passage`` words which already began earlier.

    Such a passage is made of windows of ``passage`` words each of which began earlier, so it is enough to mark the
    windows that are not the first of their kind. One pass, in memory proportional to the text.
    """
    seen: set = set()
    total = end = 0
    for at, gram in enumerate(zip(*(w[i:] for i in range(passage)))):
        if gram in seen:
            total += at + passage - max(end, at)
            end = at + passage
        else:
            seen.add(gram)
    return total


def _measure(passage: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, k = [], []
            for text in b.column("text").to_pylist():
                w = words(text)
                n.append(len(w))
                k.append(covered(w, passage))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(k, pa.int64())], names=["doc_id", "n_words", "n_repeated"])

    return run


def repeated_share(documents: DataFrame, passage: int = PASSAGE) -> DataFrame:
    """(doc_id, n_words, n_repeated, share): one row per row of ``documents``, without a shuffle.

    Null, empty and wordless texts have the share 0, as have texts under ``passage`` words. Other columns are ignored.
    """
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_measure(passage), "doc_id bigint, n_words bigint, n_repeated bigint")
    return rows.withColumn("share", F.when(F.col("n_words") > 0, F.col("n_repeated") / F.col("n_words")).otherwise(F.lit(0.0)))


def found(documents: DataFrame, percent: int = 40) -> DataFrame:
    """(doc_id): documents of which at least ``percent`` of a hundred words are repeated, compared in whole numbers."""
    rows = repeated_share(documents)
    return rows.filter((F.col("n_words") > 0) & (F.col("n_repeated") * 100 >= F.col("n_words") * percent)).select("doc_id")
