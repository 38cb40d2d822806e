import numpy as np
import pytest

from palimpsest.llm import mixing
from palimpsest.llm.encoding import encode

DOCS = "doc_id bigint, text string, source string, domain int, tokens string"
TARGETS = "mix_id string, source string, weight double, max_repeats int"


def docs(spark, n=60, none=10):
    rows = [(i, f"river boat water {i} lake", "wet", 1, "x") for i in range(n)]
    rows += [(1000 + i, f"sand sun heat {i} dune desert", "dry", 1, "x") for i in range(n // 3)]
    rows += [(2000 + i, f"river boat water {i}" if i % 2 else f"sand sun heat {i}", None, 1, "x") for i in range(none)]
    rows += [(3000, None, "wet", 1, "x"), (3001, "", None, 1, "x"), (3002, "", "wet", 1, "x")]
    return spark.createDataFrame(rows, DOCS)


def targets(spark, rows):
    return spark.createDataFrame(rows, TARGETS)


def report(spark, d, t):
    return {(r.mix_id, r.source): r for r in mixing.shares(d, t).collect()}


def test_shares_meet_targets_within_a_document(spark):
    d, t = docs(spark), targets(spark, [("m", "wet", 3.0, 2), ("m", "dry", 1.0, 4), ("m", "absent", 1.0, 9), ("n", "dry", 5.0, 1)])
    got = report(spark, d, t)
    m = got["m", "wet"]
    size = m.n_tokens + got["m", "dry"].n_tokens
    assert abs(m.actual_share - 0.75) < 20 / size + 0.02
    assert got["m", "absent"].actual_share == 0 and got["m", "absent"].target_share == pytest.approx(0.2)
    assert got["n", "dry"].labelled_share == 1


def test_repeats_stay_under_the_cap_and_only_named_sources(spark):
    d, t = docs(spark), targets(spark, [("m", "wet", 1.0, 1), ("m", "dry", 1.0, 3), ("o", "dry", 1.0, 2)])
    used = mixing.mix(d, t).collect()
    cap = {("m", "wet"): 1, ("m", "dry"): 3, ("o", "dry"): 2}
    assert used and all(0 < r.repeats <= cap[r.mix_id, r.assigned_source] for r in used)
    assert not [r for r in used if r.doc_id >= 3000]
    assert all(r.tokens == len(encode(x)) for r in used for x in [f"river boat water {r.doc_id} lake"] if r.doc_id < 60)


def test_empty_tables_and_bad_targets(spark):
    t = targets(spark, [("m", "wet", float("nan"), 1), ("m", "dry", None, None), (None, "wet", 1.0, 1), ("m", None, 1.0, 1), ("z", "wet", -1.0, 2)])
    assert mixing.mix(docs(spark), t).collect() == []
    assert mixing.mix(spark.createDataFrame([], DOCS), targets(spark, [("m", "wet", 1.0, 1)])).collect() == []
    assert mixing.mix(docs(spark), targets(spark, [])).collect() == []
    assert report(spark, spark.createDataFrame([], DOCS), targets(spark, [("m", "wet", 1.0, 1)]))["m", "wet"].actual_share == 0


def test_classifier_on_held_out_texts():
    rng = np.random.default_rng(0)
    make = lambda k: " ".join(rng.choice(["river", "boat", "the", "of"] if k else ["sand", "sun", "the", "of"], 12))
    y = rng.integers(0, 2, 300)
    x = [make(k) for k in y]
    model = mixing.Classifier(["dry", "wet"]).fit(x[:200], y[:200])
    p = np.array([model.predict(t) for t in x[200:]])
    assert (p.argmax(1) == y[200:]).mean() > 0.97
    assert np.allclose(p.sum(1), 1)


def test_fit_meets_its_targets_with_every_document(spark):
    plan = mixing.fit(docs(spark, none=40), targets(spark, [("m", "wet", 1.0, 2), ("m", "dry", 1.0, 3), ("n", "dry", 1.0, 1)]))
    rows = plan.docs.filter("tokens > 0").collect()
    soft, domain, n = np.array([r.soft for r in rows]), np.array([r.domain for r in rows]), np.array([r.tokens for r in rows])
    assert np.allclose(soft.sum(1), 1) and plan.passes <= 8
    rates = plan.rates(domain, soft)
    assert (rates >= 0).all() and (rates <= plan.caps[:, domain]).all()
    got = (rates * n) @ soft
    aim = plan.want * (1 - mixing.ROOM)
    left = np.abs(np.where(plan.target > 0, aim - got, 0)).sum(1) / aim.sum(1)
    assert np.allclose(left, plan.residual, atol=1e-9) and left.max() < mixing.TOLERANCE


def test_fit_ends_at_the_tolerance_where_no_bound_is_met(spark):
    plan = mixing.fit(docs(spark, none=0), targets(spark, [("m", "wet", 3.0, 2), ("m", "dry", 1.0, 50)]))
    assert plan.residual[0] < mixing.TOLERANCE and plan.passes <= 8


def test_training_rows_are_chosen_by_a_threshold(spark):
    d = spark.range(20_000).selectExpr("id as doc_id", "concat('river ', id) as text", "if(id % 2 = 0, 'wet', 'dry') as source")
    seen = []
    fit, mixing.Classifier.fit = mixing.Classifier.fit, lambda self, texts, y: seen.append(len(texts)) or self
    try:
        mixing.train(d, ["dry", "wet"], 1_000)
    finally:
        mixing.Classifier.fit = fit
    assert 850 < seen[0] < 1_150
