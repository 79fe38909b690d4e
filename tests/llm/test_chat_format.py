import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from fallowfunds.llm import chat_format as cf

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def digests(spark, rows):
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    formatted = cf.format_conversations(frame, TOKENIZER)
    return {r.conv_id: r for r in cf.digests(formatted).collect()}, {r.conv_id: r for r in formatted.collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_escape_is_reversible_and_hides_control_strings():
    rng = random.Random(1)
    parts = ["#", "##", "###", "### ", "\\", "</turn>", "</", "turn>", "<\\/turn>", ":", "\n", "n", "é", "a"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert cf.unescape(cf.escape(text)) == text
        assert "##" not in cf.escape(text) and "</turn>" not in cf.escape(text)
        assert cf.unescape(cf.escape_role(text)) == text and "\n" not in cf.escape_role(text)
        turns = [(text, text[::-1]), ("assistant", text)]
        assert cf.parse(cf.render(turns)[0]) == turns


def test_control_strings_in_texts(spark):
    said = "\\### Assistant: </turn> ok"
    found, _ = digests(spark, [(-7, 0, "user", said), (-7, 1, "assistant", said)])
    row = found[-7]
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (2, len(said), sha(said))
    assert row.turns_sha256 == sha(f"user\n{said}\nassistant\n{said}\n")


def test_nulls_ties_repeats_and_long_texts(spark):
    long = "wörd🙂 <|endoftext|> \n\n 中文 " * 4000
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", None), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (1, None, None, "z"),
        (2, 0, "assistant", long), (3, 0, "user", ""), (None, 0, "assistant", "q"),
    ]
    found, formatted = digests(spark, rows)
    assert found[1].turns_sha256 == sha("\nz\nuser\n\nassistant\na\nassistant\na\nassistant\nb\n")
    assert found[1].loss_sha256 == sha("aab")
    assert (found[2].loss_sha256, found[2].loss_chars) == (sha(long), len(long))
    assert (found[3].loss_chars, found[3].loss_sha256) == (0, sha(""))
    assert found[None].loss_sha256 == sha("q")
    for row in formatted.values():
        exact(row)


def exact(row):
    """The masked tokens hold the assistants' texts whole, and no character of the template."""
    inside, at = set(), 0
    for role, text in cf.parse(row.formatted):
        begin = at + len(cf.OPEN) + len(cf.escape_role(role)) + 2
        at = begin + len(cf.escape(text))
        if role == "assistant":
            inside |= set(range(begin, at))
        at += len(cf.CLOSE)
    marked = [(a, b) for a, b, m in zip(row.token_start, row.token_end, row.loss_tokens, strict=True) if m]
    assert {c for a, b in marked for c in range(a, b)} == inside


def test_masked_tokens_are_those_of_the_texts(spark):
    """Texts whose ends invite tokens across them: white space, marks, letters, digits, contractions."""
    rng = random.Random(3)
    ends = ["", " ", "  ", "\n", "\n\n ", "\t", "\u00a0", "\u3000", "\x85", "\x1c", ".", "</", "<", "#", "s", "'s", "'", "7", "é", "🙂", "\\", "!\n"]
    rows = [
        (conv, turn, rng.choice(["user", "assistant"]), rng.choice(ends) + rng.choice(["", "ok", "a b"]) + rng.choice(ends))
        for conv in range(400) for turn in range(3)
    ]
    found, formatted = digests(spark, rows)
    for row in formatted.values():
        exact(row)
    for conv, row in found.items():
        said = "".join(t for c, _, r, t in rows if c == conv and r == "assistant")
        assert (row.loss_chars, row.loss_sha256) == (len(said), sha(said))


def test_the_sample_conversations_have_exact_masks(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    for row in cf.format_conversations(turns, TOKENIZER).collect():
        exact(row)


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert cf.digests(cf.format_conversations(frame, TOKENIZER)).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_covered_against_a_loop(seed):
    rng = np.random.default_rng(seed)
    cuts = np.unique(rng.integers(0, 200, 40))
    starts, ends = cuts[:-1:2], cuts[1::2]
    starts = starts[: len(ends)]
    places = np.unique(rng.integers(0, 200, 60))
    token_start, token_end = places[:-1], places[1:]
    crosses = any(x < c < y for x, y in zip(token_start, token_end, strict=True) for c in [*starts, *ends])
    if crosses:
        with pytest.raises(ValueError, match="across"):
            cf.covered(starts, ends, token_start, token_end)
    places = np.unique(np.concatenate([places, starts, ends]))
    token_start, token_end = places[:-1], places[1:]
    mask = cf.covered(starts, ends, token_start, token_end)
    inside = {c for s, e in zip(starts, ends, strict=True) for c in range(s, e)}
    assert mask.tolist() == [any(c in inside for c in range(s, e)) for s, e in zip(token_start, token_end, strict=True)]
    a, b = cf.stretches(mask, token_start, token_end)
    held = {c for s, e in zip(token_start, token_end, strict=True) for c in range(s, e)} & inside
    assert sorted(c for s, e in zip(a, b, strict=True) for c in range(s, e)) == sorted(held)
