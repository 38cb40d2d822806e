"""Mix the documents of several sources to target shares of all tokens.

Every document is scored by a classifier trained on labelled documents; its membership of the sources is its label,
trusted to :data:`TRUST`, together with the classifier's probabilities, or these alone where it has no label. For each
mix, nonnegative rates of use are fitted to all documents by distributed least squares with projection, so that the
expected tokens of each source meet their target, and then rounded to whole repeats so that each label's tokens do.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checkpoint
from .encoding import VOCABULARY, encode
from .repetition import words

#: Labelled documents that the classifier is fitted on (about so many, chosen by a threshold on their hash), and its hashed features.
TRAINING_ROWS, FEATURES = 8_000, 1 << 13
#: Rows of a dense block of the fit.
BLOCK = 1_000
#: Probability that a document is of the source that it is labelled with; the rest is shared out by the classifier.
TRUST = 0.95
#: Share of a mix that may remain between expected and target tokens; a pass must take this much off what remained.
TOLERANCE, PROGRESS = 1e-6, 0.5
#: Share of a mix that the fit leaves free, so that a source that will be used up has room to move; the rounding fills it.
ROOM = 0.2
#: Sources, named or met, at most: their number bounds what the driver holds.
MAX_SOURCES = 10_000
#: Sources up to which the fit uses all pairs of them (a Newton step), instead of each by itself.
PAIRED = 64
#: Least share by which a document is ordered when rests of rates are given out.
LEAST_REST = 1 / 64


@lru_cache(maxsize=1 << 18)
def _word(w: str) -> int:
    return xxhash.xxh32_intdigest(w.encode("utf-8", "surrogatepass"))


def _features(text: str | None) -> np.ndarray:
    h = np.array([_word(w) for w in words(text)] or [0], dtype=np.uint64)
    both = np.concatenate([h, h[:-1] * np.uint64(1_000_003) + h[1:] * np.uint64(7) + np.uint64(1)])
    return np.unique((both ^ (both >> np.uint64(17))) % np.uint64(FEATURES)).astype(np.int64)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Classifier:
    """Multinomial logistic regression over hashed words and word pairs."""

    def __init__(self, labels: list[str]) -> None:
        self.labels = labels
        self.w = np.zeros((FEATURES, len(labels)), np.float32)
        self.b = np.zeros(len(labels), np.float32)

    def fit(self, texts: list[str], y: np.ndarray, epochs: int = 25, rate: float = 4.0, decay: float = 1e-4) -> Classifier:
        if not texts or len(self.labels) < 2:
            return self
        f = [_features(t) for t in texts]
        blocks = [(range(i, min(i + BLOCK, len(f))), np.repeat(np.arange(min(BLOCK, len(f) - i)), [len(x) for x in f[i : i + BLOCK]]), np.concatenate(f[i : i + BLOCK])) for i in range(0, len(f), BLOCK)]
        self.b = np.log(np.bincount(y, minlength=len(self.labels)) + 1.0).astype(np.float32)
        square = np.full_like(self.w, 1e-6)
        dense = np.zeros((min(BLOCK, len(f)), FEATURES), np.float32)
        for _ in range(epochs):
            gw = decay * self.w / len(f)
            for at, rows, cols in blocks:
                dense[rows, cols] = 1 / np.sqrt(np.bincount(rows)[rows])
                x = dense[: len(at)]
                g = _softmax(x @ self.w + self.b)
                g[np.arange(len(at)), y[at.start : at.stop]] -= 1
                gw += x.T @ (g / np.float32(len(f)))
                dense[rows, cols] = 0
            square += gw * gw
            self.w -= rate * 0.1 * gw / np.sqrt(square)
        return self

    def predict(self, text: str | None) -> np.ndarray:
        f = _features(text)
        return _softmax(self.w[f].sum(axis=0) / np.sqrt(len(f)) + self.b).astype(np.float64)


def train(documents: DataFrame, labels: list[str], rows: int = TRAINING_ROWS) -> Classifier:
    """Fit on about ``rows`` labelled documents: those whose hashed id is under the threshold that lets so many pass.

    The threshold follows from a count, so every partition sends only what is used.
    """
    labelled = documents.filter(F.col("source").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    n = labelled.count()
    share = min(1.0, rows / n) if n else 0.0
    under = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = under.groupBy("doc_id").agg(F.min(F.struct("source", "text")).alias("r")).select("doc_id", "r.*").collect() if n else []
    sample.sort(key=lambda r: r.doc_id)
    at = {s: i for i, s in enumerate(labels)}
    return Classifier(labels).fit([r.text for r in sample], np.array([at[r.source] for r in sample], dtype=np.int64))


def _described(model: Classifier, vocabulary: str, trust: float):
    """Tokens, most probable source and membership of each document."""
    at, k = {s: i for i, s in enumerate(model.labels)}, len(model.labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, which, soft = [], [], []
            for text, source in zip(b.column("text").to_pylist(), b.column("source").to_pylist()):
                n.append(len(encode(text, vocabulary)))
                p = model.predict(text) if k else np.zeros(0)
                if source is not None:
                    p = (1 - trust) * p
                    p[at[source]] += trust
                which.append(at[source] if source is not None else int(np.argmax(p)) if k else -1)
                soft.append(p.tolist())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("source"), pa.array(n, pa.int64()), pa.array(which, pa.int32()), pa.array(soft, pa.list_(pa.float64()))], names=["doc_id", "source", "tokens", "domain", "soft"]
            )

    return run


class Plan:
    """What :func:`fit` found: the described documents, targets, multipliers, and what the fit left over in each mix."""

    def __init__(self, docs: DataFrame, mixes: list[str], sources: list[str]) -> None:
        m, k = len(mixes), len(sources)
        self.docs, self.mixes, self.sources, self.n = docs, mixes, sources, 0
        self.target, self.caps, self.start, self.multipliers, self.want = (np.zeros((m, k)) for _ in range(5))
        self.scale, self.residual, self.passes = np.ones((m, k)), np.zeros(m), 0

    def rates(self, domain: np.ndarray, soft: np.ndarray) -> np.ndarray:
        """Rates (mix, row) of documents: where a start moved along their membership meets the bounds."""
        return np.clip(self.start[:, domain] + self.multipliers @ soft.T, 0, self.caps[:, domain])


def _summed(start: np.ndarray, multipliers: np.ndarray, caps: np.ndarray):
    """For a task's documents: expected tokens by mix and source, their derivatives, and tokens by label."""
    m, k = caps.shape
    paired = k <= PAIRED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, slope, label = np.zeros((m, k)), np.zeros((m, k, k) if paired else (m, k)), np.zeros((m, k))
        for b in batches:
            if not b.num_rows:
                continue
            soft, domain, tokens = b.column("soft").values.to_numpy().reshape(b.num_rows, k), b.column("domain").to_numpy(), b.column("tokens").to_numpy()
            free = start[:, domain] + multipliers @ soft.T
            r = np.clip(free, 0, caps[:, domain])
            total += (r * tokens) @ soft
            inside = ((free >= 0) & (free <= caps[:, domain])) * tokens
            slope += np.einsum("mn,ni,nj->mij", inside, soft, soft, optimize=True) if paired else inside @ (soft * soft)
            known = b.column("known").to_numpy(zero_copy_only=False)
            for i in range(m):
                label[i] += np.bincount(domain[known], (r[i] * tokens)[known], k)
        v = np.concatenate([total.ravel(), label.ravel(), slope.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(v))), pa.array(v)], names=["at", "v"])

    return run


def fit(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY, trust: float = TRUST) -> Plan:
    """Fit the rates of every mix.

    The rates nearest to one rate a source that bring the expected tokens of every source to their target are a start
    moved along the document's membership and projected on 0 and max_repeats; so one multiplier per mix and source is
    all that is fitted. A pass over the documents returns sums per mix and source, a Newton step on them follows. The
    passes end at :data:`TOLERANCE`, or where one takes less than half off what was left (a source is used up);
    ``Plan.residual`` says what was left of each mix.

    The total of a mix is the largest at which every source that has documents can meet its share; the shares of
    sources without documents are spread over the others in proportion. Weights that are null, negative or not
    numbers count as 0, a null max_repeats as 1; of several rows of a mix for a source the largest weight counts.
    More than :data:`MAX_SOURCES` sources raise an error.
    """
    t = targets.filter(F.col("mix_id").isNotNull() & F.col("source").isNotNull()).groupBy("mix_id", "source").agg(F.max(F.struct("weight", "max_repeats")).alias("t")).select("mix_id", "source", "t.*").limit(MAX_SOURCES + 1).collect()
    met = [r.source for r in documents.filter("source is not null").select("source").distinct().limit(MAX_SOURCES + 1).collect()]
    if len(t) > MAX_SOURCES or len(met) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    labels = sorted(met)
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", "text")
    model = train(rows, labels)
    docs = checkpoint(rows.mapInArrow(_described(model, vocabulary, trust), "doc_id bigint, source string, tokens bigint, domain int, soft array<double>"))
    mixes = sorted({r.mix_id for r in t})
    plan = Plan(docs, mixes, labels)
    at, k, m = {s: i for i, s in enumerate(labels)}, len(labels), len(mixes)
    for r in t:
        if r.source in at:
            w = r.weight if r.weight is not None and np.isfinite(r.weight) else 0.0
            plan.target[mixes.index(r.mix_id), at[r.source]] = max(0.0, w)
            plan.caps[mixes.index(r.mix_id), at[r.source]] = max(0, 1 if r.max_repeats is None else r.max_repeats)
    hard = np.zeros(k)
    for r in docs.groupBy(F.when(F.col("source").isNotNull(), F.col("domain")).alias("at")).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n")).collect():
        plan.n += r.n
        if r["at"] is not None:
            hard[r["at"]] = r.tokens
    if not k or not m:
        return plan
    target = np.where((hard > 0) & (plan.caps > 0), plan.target, 0.0)
    sums = target.sum(axis=1, keepdims=True)
    target = plan.target = np.divide(target, sums, out=np.zeros_like(target), where=sums > 0)
    room = np.divide(plan.caps * hard, target, out=np.full_like(target, np.inf), where=target > 0).min(axis=1)
    size = np.where(np.isfinite(room), room, 0)
    want = plan.want = target * size[:, None]
    plan.caps = np.where(target > 0, plan.caps, 0.0)
    aim = want * (1 - ROOM)
    plan.start = np.divide(aim, hard, out=np.zeros_like(want), where=hard > 0)
    used = docs.filter("tokens > 0").select("tokens", "domain", "soft", F.col("source").isNotNull().alias("known"))
    multipliers, best = plan.multipliers, np.full(m, np.inf)
    while True:
        v = np.zeros(2 * m * k + m * k * (k if k <= PAIRED else 1))
        for r in used.mapInArrow(_summed(plan.start, multipliers, plan.caps), "at bigint, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
            v[r["at"]] = r.v
        plan.passes += 1
        total, label, slope = v[: m * k].reshape(m, k), v[m * k : 2 * m * k].reshape(m, k), v[2 * m * k :]
        miss = np.where(target > 0, aim - total, 0.0)
        left = np.abs(miss).sum(axis=1) / np.maximum(size * (1 - ROOM), 1.0)
        better = left < best
        go = left < PROGRESS * best
        plan.multipliers = np.where(better[:, None], multipliers, plan.multipliers)
        plan.scale = np.where(better[:, None], np.divide(want, label, out=np.ones_like(want), where=label > 0), plan.scale)
        best = plan.residual = np.minimum(best, left)
        go &= best > TOLERANCE
        if not go.any():
            return plan
        step = np.zeros((m, k))
        for i in np.flatnonzero(go):
            on = np.flatnonzero(target[i] > 0)
            if k <= PAIRED:
                a = slope.reshape(m, k, k)[i][np.ix_(on, on)]
                step[i, on] = np.linalg.lstsq(a + np.eye(len(on)) * 1e-9 * max(1.0, np.trace(a)), miss[i, on], rcond=None)[0]
            else:
                step[i, on] = miss[i, on] / np.maximum(slope.reshape(m, k)[i, on], 1.0)
        multipliers = plan.multipliers + step


def _rated(plan: Plan):
    """The rates of each document in every mix; those of a label are scaled to bring its own tokens to the target."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                domain = b.column("domain").to_numpy()
                r = plan.rates(domain, b.column("soft").values.to_numpy().reshape(b.num_rows, len(plan.sources)))
                known = np.asarray(b.column("source").is_valid())
                r = np.where(known, np.minimum(r * plan.scale[:, domain], plan.caps[:, domain]), r)
                lists = lambda x: pa.array(list(x.T), pa.list_(pa.float64()))
                names = ["doc_id", "source", "domain", "tokens", "soft", "rates", "caps"]
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names[:5]], lists(r), lists(plan.caps[:, domain])], names=names)

    slim = Plan(None, plan.mixes, plan.sources)  # what a task needs, without the frame
    for c in ("caps", "start", "multipliers", "scale"):
        setattr(slim, c, getattr(plan, c))
    plan = slim
    return run


def _mixed(plan: Plan) -> DataFrame:
    """As :func:`mixed`, with the memberships ``soft``."""
    spark = plan.docs.sparkSession
    out = "mix_id string, doc_id bigint, source string, assigned_source string, tokens bigint, repeats int, soft array<double>"
    if not plan.mixes or not plan.sources:
        return spark.createDataFrame([], out)
    names, sources = (F.array(*[F.lit(x) for x in v]) for v in (plan.mixes, plan.sources))
    kinds = "doc_id bigint, source string, domain int, tokens bigint, soft array<double>, rates array<double>, caps array<double>"
    d = plan.docs.filter("tokens > 0").mapInArrow(_rated(plan), kinds)
    d = d.select("doc_id", "source", "domain", "tokens", "soft", F.posexplode(F.arrays_zip("rates", "caps")).alias("mix", "r")).select("*", "r.rates", "r.caps").drop("r").filter("rates > 0")
    d = d.withColumn("h", (F.pmod(F.xxhash64("mix", "doc_id"), F.lit(1 << 40)) + 0.5) / (1 << 40)).withColumn("whole", F.floor(F.col("rates") + 1e-9)).withColumn("rest", F.greatest(F.lit(0.0), F.col("rates") - F.col("whole")))
    bands = max(1, int(plan.n**0.5 / 8))
    more = d.filter("source is not null").withColumn("key", F.col("h") / F.greatest("rest", F.lit(LEAST_REST))).withColumn("band", F.floor(F.col("key") * bands))
    more = more.withColumn("open", F.when(F.col("whole") < F.col("caps"), F.col("tokens")).otherwise(0))
    own = ["mix", "domain"]
    w = Window.partitionBy(*own, "band").orderBy("key", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    o = Window.partitionBy(*own)
    wanted = spark.createDataFrame([(i, j, float(plan.want[i, j])) for i in range(len(plan.mixes)) for j in range(len(plan.sources)) if plan.want[i, j] > 0], "mix int, domain int, want double")
    sums = more.groupBy(*own, "band").agg(F.sum("open").alias("n"), F.sum(F.col("tokens") * F.col("whole")).alias("w")).join(wanted, own)
    before = F.coalesce(F.sum("n").over(o.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(*own, "band", (F.col("want") - F.sum("w").over(o) - before).alias("need"))
    more = more.withColumn("before", F.coalesce(F.sum("open").over(w), F.lit(0))).join(sums, [*own, "band"])
    once = (F.col("open") > 0) & (F.col("before") + F.col("tokens") / 2 < F.col("need"))
    more = more.withColumn("repeats", (F.col("whole") + once.cast("int")).cast("int"))
    soft = d.filter("source is null").withColumn("repeats", (F.col("whole") + (F.col("h") < F.col("rest")).cast("int")).cast("int"))
    cols = [F.element_at(names, F.col("mix") + 1).alias("mix_id"), "doc_id", "source", F.element_at(sources, F.col("domain") + 1).alias("assigned_source"), "tokens", "repeats", "soft"]
    return more.select(*cols).unionByName(soft.select(*cols)).filter("repeats > 0")


def mixed(plan: Plan) -> DataFrame:
    """(mix_id, doc_id, source, assigned_source, tokens, repeats): the documents of every mix, those used at least once.

    A rate is rounded down; the rests are given out as one more use in a fixed random order in which a document comes
    the earlier the greater its rest, until the source has its tokens, so a source misses them by less than one
    document. Documents without a source are rounded by chance, fixed by their id. Documents without tokens are
    not used. source is null where the document has none; assigned_source is then the most probable one.
    """
    return _mixed(plan).drop("soft")


def mix(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The documents of every mix, see :func:`fit` and :func:`mixed`."""
    return mixed(fit(documents, targets, vocabulary))


def shares(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(mix_id, source, target_share, actual_share, labelled_share, n_documents, n_tokens, max_repeats, residual).

    The report: one row per mix and source, named or used. target_share is the weight's share of the mix. actual_share
    counts each use of a document, one without a source for every source at its membership; labelled_share counts
    documents with a source only. n_documents and n_tokens count each use, one without a source for its most probable
    source. residual is the share of the mix by which the fitted rates miss the expected tokens of its sources.
    """
    plan = fit(documents, targets, vocabulary)
    used = _mixed(plan).withColumn("n", F.col("tokens") * F.col("repeats"))
    by = used.withColumn("at", F.col("assigned_source")).groupBy("mix_id", "at").agg(
        F.sum("repeats").alias("n_documents"), F.sum("n").alias("n_tokens"), F.sum(F.when(F.col("source").isNotNull(), F.col("n")).otherwise(0)).alias("labelled")
    ).withColumnRenamed("at", "source")
    names = F.array(*[F.lit(x) for x in plan.sources]).cast("array<string>")
    parts = used.filter("source is null").select("mix_id", "n", F.posexplode("soft").alias("at", "p"))
    parts = parts.groupBy("mix_id", F.element_at(names, F.col("at") + 1).alias("source")).agg(F.sum(F.col("n") * F.col("p")).alias("expected"))
    w = Window.partitionBy("mix_id")
    named = targets.filter("mix_id is not null and source is not null").groupBy("mix_id", "source").agg(F.max(F.struct("weight", "max_repeats")).alias("t")).select("mix_id", "source", F.greatest(F.coalesce("t.weight", F.lit(0.0)), F.lit(0.0)).alias("weight"), "t.max_repeats")
    both = named.join(by, ["mix_id", "source"], "full").join(parts, ["mix_id", "source"], "full").na.fill(0, ["n_documents", "n_tokens", "labelled"]).na.fill(0.0, ["weight", "expected"])
    both = both.withColumn("actual", F.col("labelled") + F.col("expected"))
    left = F.create_map(*[F.lit(x) for m, r in zip(plan.mixes, plan.residual) for x in (m, float(r))]) if plan.mixes else None
    residual = left[F.col("mix_id")] if left is not None else F.lit(0.0)
    share = lambda c: F.coalesce(F.try_divide(F.col(c), F.sum(c).over(w)), F.lit(0.0))
    return both.select("mix_id", "source", share("weight").alias("target_share"), share("actual").alias("actual_share"), share("labelled").alias("labelled_share"), "n_documents", "n_tokens", "max_repeats", F.coalesce(residual, F.lit(0.0)).alias("residual"))
