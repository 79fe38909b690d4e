import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fallowfunds.llm import bpe

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "a", "b", "aa", "the", "'", "'s", "'ll", "re", " ", "  ", "\n", "\n\n", "\t", "é", "ß", "中", "文字", "🙂", "!", "!!", "#",
    "1", "23", "\x00", "\x1c", "\x85", " ", "　", "²", "ا", "​", "<|endoftext|>", "<|endof", "text|>", "\r\n",
]


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def ids(plain, text):
    return plain.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=60), st.integers(4, 40))
def test_leaf_and_tree_against_the_library(plain, parts, size):
    text = "".join(parts)
    codec = bpe.codec(TOKENIZER)
    want = ids(plain, text)
    assert codec.leaf(text) == want
    assert codec.tree([codec.leaf(t) for t in bpe.leaves(text, size)], 30) == want
    assert codec.decode(want) == plain.decode(want, skip_special_tokens=False) == text


@pytest.mark.parametrize("unit", ["a", "ab", "x!", "中", " ", "\n ", "!", "7", "lorem", "ha", "'", "=-"])
def test_unsplit_runs(plain, unit):
    rng = random.Random(unit)
    codec = bpe.codec(TOKENIZER)
    for size in (5, 64, 1000):
        text = unit * 3000 + rng.choice(["", "x", " x", "\n"])
        assert codec.tree([codec.leaf(t) for t in bpe.leaves(text, size)]) == ids(plain, text)


def test_random_letters_without_a_break(plain):
    rng = random.Random(5)
    codec = bpe.codec(TOKENIZER)
    for _ in range(30):
        text = "".join(rng.choice("abeinorst") for _ in range(4000))
        assert codec.tree([codec.leaf(t) for t in bpe.leaves(text, 130)], 1) == ids(plain, text)


def test_growth_is_needed_and_found(plain, monkeypatch):
    codec = bpe.Codec(TOKENIZER)
    calls = []
    leaf = codec.leaf
    monkeypatch.setattr(codec, "leaf", lambda t: calls.append(len(t)) or leaf(t))
    parts = [leaf("a" * 999), leaf("a" * 1001)]  # the tokens of a run are counted from its beginning
    assert codec.join(*parts, 4) == ids(plain, "a" * 2000)
    assert len(calls) > 1


def test_decode_of_broken_bytes(plain):
    codec = bpe.codec(TOKENIZER)
    rng = random.Random(9)
    for _ in range(200):
        some = [rng.randrange(50257) for _ in range(12)]
        assert codec.decode(some) == plain.decode(some, skip_special_tokens=False)


def test_leaves_are_whole_characters():
    for text in ("", "é" * 9, "🙂" * 9, "a🙂é"):
        for size in (1, 4, 5, 7):
            assert "".join(bpe.leaves(text, size)) == text


def rows(frame):
    return sorted(map(repr, frame.collect()))


def test_operator(spark, documents, plain):
    long = "unbrokenrun" * 300 + " then 'll words <|endoftext|> " * 50
    texts = [None, "", " ", "short one", long, long, long + "é", "x" * 5000, "short one"]
    docs = documents(*[(i, t) for i, t in enumerate(texts)], (4, long), (None, long), (4, long))
    docs = docs.withColumns(
        {"a b": F.lit(1), "a.b": F.lit("q"), "__text": F.lit(2), "__key": F.lit(3), "row": F.lit(4), "ids": F.lit(5),
         "pos": F.create_map(F.lit("m"), F.lit(1)), "key": F.lit(None).cast("string")}
    )
    found = bpe.decode(bpe.encode(docs, TOKENIZER, leaf=257), TOKENIZER)
    assert found.columns == [*[c for c in docs.columns if c != "ids"], "ids", "decoded"]
    assert rows(found.drop("ids", "decoded")) == rows(docs.drop("ids"))
    for row in found.collect():
        assert row["ids"] == ids(plain, row["text"] or "")
        assert row["decoded"] == (row["text"] or "")


def test_empty_table(documents):
    assert bpe.decode(bpe.encode(documents((1, "x")).limit(0), TOKENIZER), TOKENIZER).collect() == []


def test_other_tokenizers_are_refused():
    with pytest.raises(bpe.UnsupportedTokenizer):
        bpe.Codec(public_tokenizers.path("word_bpe_49k.json"))


def test_null_ids_have_no_text(spark):
    frame = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(frame, TOKENIZER).orderBy("ids").collect()] == [None, ""]
