import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.orc as orc
import pytest
from pyspark.sql import functions as F

from fallowfunds.llm import token_files as tf

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def want(rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(TOKENIZER)
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def texts(n=400):
    rng = random.Random(3)
    alphabet = [" ", "  ", "\n", "\n\n", "\t", "'", "'s", "'ll", "a", "b", "é", "×", "ç", "É", "1", "23", "!", "##", ".", " ", " ", "　",
                "中", "文", "—", "<|endoftext|>", "\x00", "\x1c", "\x85", "ª", "²", "\r\n", "I'm", "🙂", "ا", "​"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_pieces_against_whole_texts():
    rows = texts(5000)
    encoder = tf.PieceEncoder(TOKENIZER)
    found = []
    for _, _, ids, size in encoder.stretches(pa.array([*rows, None]), 2):
        found += [p.tolist() for p in np.split(ids, np.cumsum(size)[:-1])]
    plain = encoder.tokenizer.encode_batch([*rows, ""], add_special_tokens=False)
    assert found == [[*e.ids, 2] for e in plain]


def test_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(tf, "CACHED", 20)
    encoder = tf.PieceEncoder(TOKENIZER)
    for words in (["one two three"] * 3, [" ".join(f"w{i}" for i in range(30))], ["one two"]):
        for _, _, ids, size in encoder.stretches(pa.array(words), 2):
            first = ids[: size[0] - 1].tolist()
            assert first == encoder.tokenizer.encode(words[0], add_special_tokens=False).ids


def test_distinct_pieces_in_order_with_their_first_places():
    values = np.random.default_rng(5).integers(0, 2**64, 300, np.uint64)[np.random.default_rng(6).integers(0, 300, 5000)]
    for some in (values, values[:1], values[:0]):
        want = np.unique(some, return_index=True, return_inverse=True)
        assert all(np.array_equal(a, b) for a, b in zip(tf.distinct(some), want, strict=True))


def test_round_trip(spark, documents, tmp_path):
    rows = [(i * 3 % 401, t) for i, t in enumerate(texts())]
    rows += [(1000, "lång " * 30_000), (5000, None), (5001, ""), (None, "no id"), (7, "again"), (7, "again")]
    docs = documents(*rows).withColumns({"ids": F.lit(1), "shard": F.lit(2), "n_tokens": F.lit(3)})
    path = str(tmp_path / "orc")
    tf.write(tf.encode(docs.repartition(5), TOKENIZER, 2), path)
    files = tf.read(spark, path)
    found = [tuple(r) for r in tf.checksums(tf.with_starts(files)).orderBy("start").collect()]
    assert found == want(rows)
    (one,) = files.filter("doc_id = 1000").select("n_tokens").collect()
    assert one.n_tokens > 30_000
    part = next((tmp_path / "orc").glob("*.orc"))
    assert orc.ORCFile(str(part)).compression.lower() == "zstd"


def test_empty_table(spark, documents, tmp_path):
    path = str(tmp_path / "none")
    tf.write(tf.encode(documents((1, "x")).limit(0), TOKENIZER, 2), path)
    assert tf.checksums(tf.with_starts(tf.read(spark, path))).collect() == []


@pytest.mark.parametrize("text", ["a b", "a  b", "don't", "x.\nY", "é, a", "a b", "!a", "'a", "a1 2b"])
def test_cuts_are_piece_starts(text):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(TOKENIZER)
    data = np.frombuffer(text.encode(), np.uint8)
    at = [*tf.cuts(data, np.array([0, len(data)])).tolist(), len(data)]
    parts = [bytes(data[a:b]).decode() for a, b in zip(at, at[1:], strict=False)]
    assert sum((tok.encode(p).ids for p in parts), []) == tok.encode(text).ids
