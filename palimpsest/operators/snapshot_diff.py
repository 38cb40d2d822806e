"""What changed between consecutive full snapshots of a page.

A snapshot is reduced to two compact arrays, the hashes of its item keys and of its item rows. Consecutive snapshots
are compared by sorting those arrays in numpy and taking searchsorted set differences; the full values are fetched
again only for the keys that differ, and decide there.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .captures import moments
from .ordered import with_neighbours

#: The fields whose difference makes an item changed.
FIELDS = ("name", "website", "address", "phone", "price")
SEP = "\x1f"


def _reject(x: str) -> None:
    raise ValueError(x)


def items_of(payload: str | None) -> list:
    """The items of a payload; none unless it is valid JSON, an object, with a list of items."""
    if not payload:
        return []
    try:
        doc = json.loads(payload, parse_constant=_reject)
    except (ValueError, RecursionError):
        return []
    items = doc.get("items") if isinstance(doc, dict) else None
    return items if isinstance(items, list) else []


def _text(v: object) -> str:
    if v is None:
        return ""
    return v.strip() if isinstance(v, str) else json.dumps(v, sort_keys=True)


def keyed(items: list) -> dict[str, str]:
    """slug -> compared values; the first item of a slug counts, items without a slug are not known."""
    out: dict[str, str] = {}
    for it in items:
        if isinstance(it, dict):
            slug = it.get("slug")
            slug = slug if isinstance(slug, str) or slug is None else str(slug)
            if slug and slug.strip() and slug not in out:
                out[slug] = SEP.join(_text(it.get(f)) for f in FIELDS)
    return out


def _h(s: str) -> int:
    return xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass")) - (1 << 63)


COMPACT = "url string, digest string, fetched_at timestamp_ntz, tie bigint, n_items int, keys array<bigint>, hashes array<bigint>"


def _compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("url", pa.string()), ("digest", pa.string()), ("fetched_at", pa.timestamp("us")), ("tie", pa.int64()), ("n_items", pa.int32()), ("keys", pa.list_(pa.int64())), ("hashes", pa.list_(pa.int64()))
    ])
    for b in batches:
        n, ks, hs = [], [], []
        for p in b.column("payload").to_pylist():
            items = items_of(p)
            k = keyed(items)
            n.append(len(items))
            ks.append([_h(x) for x in k])
            hs.append([_h(x) for x in k.values()])
        yield pa.RecordBatch.from_arrays(
            [b.column("url"), b.column("digest"), b.column("fetched_at").cast(pa.timestamp("us")), b.column("tie"), pa.array(n, pa.int32()), pa.array(ks, schema.field("keys").type), pa.array(hs, schema.field("hashes").type)],
            schema=schema,
        )


def set_difference(ka: np.ndarray, ha: np.ndarray, kb: np.ndarray, hb: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys removed from a, added in b, and in both with another row hash."""
    oa, ob = np.argsort(ka), np.argsort(kb)
    ka, ha, kb, hb = ka[oa], ha[oa], kb[ob], hb[ob]
    if not len(ka) or not len(kb):
        return ka, kb, ka[:0]
    at = np.searchsorted(ka, kb)
    at[at == len(ka)] = 0
    both = ka[at] == kb
    back = np.searchsorted(kb, ka)
    back[back == len(kb)] = 0
    return ka[kb[back] != ka], kb[~both], kb[both & (ha[at] != hb)]


DIFF = "url string, prev string, digest string, key bigint, kind string"


def _diff(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("url", pa.string()), ("prev", pa.string()), ("digest", pa.string()), ("key", pa.int64()), ("kind", pa.string())])
    for b in batches:
        cols = [b.column(c) for c in ("pk", "ph", "keys", "hashes")]
        offs = [c.offsets.to_numpy() for c in cols]
        vals = [c.values.to_numpy(zero_copy_only=False) for c in cols]
        row, key, kind = [], [], []
        for i in range(b.num_rows):
            parts = [v[o[i] : o[i + 1]] for v, o in zip(vals, offs)]
            for name, ks in zip(("removed", "added", "changed"), set_difference(*parts)):
                if len(ks):
                    row.append(np.full(len(ks), i))
                    key.append(ks)
                    kind.extend([name] * len(ks))
        if row:
            at = pa.array(np.concatenate(row))
            yield pa.RecordBatch.from_arrays(
                [b.column(c).take(at) for c in ("url", "prev", "digest")] + [pa.array(np.concatenate(key), pa.int64()), pa.array(kind, pa.string())], schema=schema
            )


VALUES = "url string, digest string, key bigint, slug string, compared string"


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("url", pa.string()), ("digest", pa.string()), ("key", pa.int64()), ("slug", pa.string()), ("compared", pa.string())])
    for b in batches:
        out: list[list] = [[], [], [], [], []]
        for url, digest, payload, wanted in zip(*(b.column(c).to_pylist() for c in ("url", "digest", "payload", "wanted"))):
            wanted = set(wanted)
            for slug, compared in keyed(items_of(payload)).items():
                if (k := _h(slug)) in wanted:
                    for o, v in zip(out, (url, digest, k, slug, compared)):
                        o.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(o, f.type) for o, f in zip(out, schema)], schema=schema)


def snapshot_changes(captures: DataFrame, contents: DataFrame) -> DataFrame:
    """(url, by_ts, slug, kind): items added, removed or changed between consecutive snapshots of a url.

    Captures count as in :func:`captures.moments`. A snapshot is a capture whose url and digest value have a row in
    contents of which the latest (ties: one fixed row) has a payload with at least one item; other captures are
    passed over. Items are known by slug, the first of a slug counts, items without a slug are not known. ``changed``
    means that name, website, address, phone or price differ without outer spaces; absent, null and blank are alike.
    Null urls or digests, empty tables and further columns are harmless: they give no rows or are ignored.

    Equal pairs of digests of a url are compared once. Only keys shuffle until a pair is known to differ.
    """
    from ..session import checkpoint

    content = contents.filter(F.col("url").isNotNull() & F.col("digest").isNotNull()).select("url", "digest", F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at"), F.xxhash64("payload").alias("tie"), "payload")
    parsed = content.mapInArrow(_compact, COMPACT)
    latest = (
        parsed.groupBy("url", "digest")
        .agg(F.max(F.struct("fetched_at", "tie", "n_items", "keys", "hashes")).alias("r"))
        .select("url", "digest", "r.fetched_at", "r.tie", "r.n_items", "r.keys", "r.hashes")
        .filter(F.col("n_items") > 0)
    )
    latest = checkpoint(latest)  # compact; otherwise the payloads would be parsed once for each use below
    seen = checkpoint(moments(captures).join(latest.select("url", "digest"), ["url", "digest"]))  # used twice below
    steps = with_neighbours(seen, "url", "ts", ["digest"])
    steps = steps.select("url", F.col("ts").alias("by_ts"), F.col("prev.digest").alias("prev"), "digest").filter(F.col("prev") != F.col("digest"))
    steps = checkpoint(steps)
    pairs = steps.select("url", "prev", "digest").distinct()
    old = latest.select("url", F.col("digest").alias("prev"), F.col("keys").alias("pk"), F.col("hashes").alias("ph"))
    both = pairs.join(latest.select("url", "digest", "keys", "hashes"), ["url", "digest"]).join(old, ["url", "prev"])
    differing = checkpoint(both.mapInArrow(_diff, DIFF))
    need = differing.select(
        "url", "key", F.explode(F.expr("case kind when 'added' then array(digest) when 'removed' then array(prev) else array(prev, digest) end")).alias("digest")
    )
    need = need.groupBy("url", "digest").agg(F.collect_set("key").alias("wanted"))
    rows = latest.select(F.col("url").alias("u"), F.col("digest").alias("d"), F.col("fetched_at").alias("f"), F.col("tie").alias("t")).join(need.toDF("u", "d", "wanted"), ["u", "d"])
    same_row = (F.col("url") == F.col("u")) & (F.col("digest") == F.col("d")) & F.col("fetched_at").eqNullSafe(F.col("f")) & (F.col("tie") == F.col("t"))
    full = content.join(rows, same_row).select("url", "digest", "payload", "wanted").mapInArrow(_values, VALUES).distinct()
    now = full.select("url", "digest", "key", F.col("slug").alias("s1"), F.col("compared").alias("c1"))
    then = full.select("url", F.col("digest").alias("prev"), "key", F.col("slug").alias("s0"), F.col("compared").alias("c0"))
    judged = differing.join(now, ["url", "digest", "key"], "left").join(then, ["url", "prev", "key"], "left")
    judged = judged.filter((F.col("kind") != "changed") | ~F.col("c0").eqNullSafe(F.col("c1")))
    judged = judged.select("url", "prev", "digest", F.coalesce("s1", "s0").alias("slug"), "kind")
    return steps.join(judged, ["url", "prev", "digest"]).select("url", "by_ts", "slug", "kind")
