import random

import pytest
from tokenizers import Tokenizer

from palimpsest.llm import encoding
from palimpsest.llm.encoding import boundaries, decode, encode, encode_corpus

ALPHABET = ["a", "b", " ", "  ", "\n", "\n\n", "'s", "'ll", "l", "7", "42", "é", "日本", "!", "...", "\t ", "😀", " ", "<|endoftext|>"]


@pytest.fixture(scope="module")
def other():
    t = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


def ids(spark, texts, **kw):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, ids string")
    return {r.doc_id: list(r.ids) for r in encode_corpus(df, **kw).collect()}


def test_equals_the_other_library_and_round_trips(other):
    rng = random.Random(1)
    for _ in range(300):
        s = "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40)))
        assert encode(s) == other(s)
        assert decode(encode(s)).decode() == s


@pytest.mark.parametrize("chunk,overlap", [(80, 33), (100, 50), (500, 40)])
def test_long_texts_in_pieces(spark, chunk, overlap):
    rng = random.Random(chunk)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(chunk * 8))) for _ in range(25)]
    texts += ["a" * chunk * 5, " " * chunk * 4, "x " + "\n" * chunk * 3 + "y" * chunk, "ab " * chunk * 3, "'" * chunk * 3, "a" * chunk, "a" * (chunk + 1)]
    assert ids(spark, texts, chunk=chunk, overlap=overlap) == {i: encode(t) for i, t in enumerate(texts)}


def test_null_empty_repeated(spark):
    assert ids(spark, [None, "", " "]) == {0: [], 1: [], 2: encode(" ")}
    assert ids(spark, []) == {}
    long = "word " * 100
    df = spark.createDataFrame([(1, long), (1, long), (1, "b"), (None, "b"), (None, long)], "doc_id bigint, text string")
    out = sorted((r.doc_id or 0, list(r.ids)) for r in encode_corpus(df, chunk=100, overlap=40).collect())
    assert out == sorted([(1, encode(long)), (1, encode(long)), (1, encode("b")), (0, encode("b")), (0, encode(long))])


def test_very_long_white_space(other):
    for s in (" " * 100_000 + "x", "a" + "\n" * 30_000 + "b"):
        assert encode(s) == other(s)


def test_cuts_never_follow_white_space():
    assert boundaries("a  b\n") == [1, 4]
    with pytest.raises(ValueError):
        encode_corpus(None, chunk=10, overlap=9)
    assert encoding.MARGIN > 4
