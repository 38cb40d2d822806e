import random

from palimpsest.llm.perplexity import perplexities
from palimpsest.llm.repetition import covered, found, repeated_share, words


def brute(w, k=5):
    hit = [False] * len(w)
    for j in range(len(w) - k + 1):
        if any(w[i : i + k] == w[j : j + k] for i in range(j)):
            hit[j : j + k] = [True] * k
    return sum(hit)


def test_covered_equals_brute_force():
    rng = random.Random(0)
    for _ in range(400):
        w = [rng.choice("abc") for _ in range(rng.randrange(60))]
        assert covered(w) == brute(w)


def test_words():
    assert words("It's  CAFÉ_menu 42, ½!") == ["it", "s", "café", "menu", "42", "½"]
    assert words(None) == words("") == words(" .. ") == []


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", 0.5, "k") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, share double, key string")


def test_shares(spark):
    texts = [None, "", "...", "one two three four five", "One, two three four five! one two THREE four five", "a a a a a a", "x " * 200_000]
    got = {r.doc_id: (r.n_words, r.n_repeated) for r in repeated_share(docs(spark, texts)).collect()}
    assert got == {0: (0, 0), 1: (0, 0), 2: (0, 0), 3: (5, 0), 4: (10, 5), 5: (6, 5), 6: (200_000, 199_999)}
    assert sorted(r[0] for r in found(docs(spark, texts)).collect()) == [4, 5, 6]
    assert found(docs(spark, [])).collect() == []


def test_threshold_is_inclusive(spark):
    exact = " ".join("abcdefghijklmno") + " " + " ".join("abcdefghij")  # 10 of 25 words
    below = exact + " z"
    assert [r[0] for r in found(docs(spark, [exact, below])).collect()] == [0]


def test_perplexity_sums_to_one_and_bands(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(30)) for _ in range(60)]
    texts += ["a b c d " * 30, None, "", texts[0]]
    rows = {r.doc_id: r for r in perplexities(docs(spark, texts)).collect()}
    assert len(rows) == len(texts)
    assert rows[61].verdict == rows[62].verdict == "empty" and rows[61].perplexity is None
    assert rows[0].perplexity == rows[63].perplexity and rows[0].perplexity > rows[60].perplexity >= 1
    assert perplexities(docs(spark, [])).collect() == []


def test_copies_of_a_text_count(spark):
    once, copied = (["a b c d", "a c b d"], ["a b c d", "a c b d", "a c b d", "a c b d"])
    a, b = ({r.doc_id: r.perplexity for r in perplexities(docs(spark, t)).collect()} for t in (once, copied))
    assert b[1] == b[3] < a[1] and b[0] > b[1]


def test_model_probabilities(spark):
    from palimpsest.llm.perplexity import COUNTS, _counts, kneser_ney

    df = spark.createDataFrame([("en", "a b a b c"), ("en", "a c b a"), ("fr", "a b"), ("fr", None)], "lang string, text string")
    grams = df.mapInArrow(_counts, COUNTS)
    ctx = grams.select("tri", "ctx").distinct()
    total = ctx.join(kneser_ney(grams), "tri").selectExpr("ctx", "exp(logp) p").groupBy("ctx").sum("p").collect()
    assert total and all(0 < r[1] <= 1 + 1e-9 for r in total)
