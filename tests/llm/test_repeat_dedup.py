import hashlib
import random

import numpy as np
import pytest

from fallowfunds.llm import repeat_dedup as rd


def brute(rows, length=200):
    texts = [(i, (t or "").encode()) for i, t in rows]
    places = {}
    for k, (_, raw) in enumerate(texts):
        for s in range(len(raw) - length + 1):
            places.setdefault(raw[s : s + length], []).append((k, s))
    out = [np.zeros(len(raw) + 1, int) for _, raw in texts]
    for where in places.values():
        if len(where) > 1:
            for k, s in where:
                out[k][s] += 1
                out[k][s + length] -= 1
    result = []
    for (i, raw), marks in zip(texts, out, strict=True):
        gone = np.cumsum(marks)[:-1] > 0
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        result.append((i if i is not None else -1, len(raw), int(gone.sum()), spans, bytes(np.frombuffer(raw, np.uint8)[~gone])))
    return sorted(result)


def found(docs):
    rows = rd.remove_repeats(docs).collect()
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(rng.randint(20, 120))) for _ in range(12)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            passage = rng.choice(passages)
            a = rng.randrange(len(passage))
            part = passage[a // 3 :][: rng.choice([150, 199, 200, 201, 260, 700])]
            if rng.random() < 0.3:  # an edit in the middle
                part = part[: len(part) // 2] + "X" + part[len(part) // 2 :]
            parts += [word(), part, "".join(word() for _ in range(rng.randint(0, 6)))]
        rows.append((i, "".join(parts)))
    rows += [(100, "ab" * 300), (101, "z" * 199), (102, "z" * 200), (103, "q" * 201), (104, None), (105, ""), (None, passages[0] * 2)]
    return [*rows, rows[3], (106, "\U0001f600" * 60), (107, "b" + "\U0001f600" * 60)]


@pytest.mark.parametrize("crowd", [20_000, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(documents, monkeypatch, seed, crowd):
    monkeypatch.setattr(rd, "CROWD", crowd)
    rows = corpus(seed)
    assert found(documents(*rows)) == brute(rows)


def test_blocks_cross_batches(spark, documents, monkeypatch):
    monkeypatch.setattr(rd, "BLOCK_ROWS", 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    rows = corpus(3)
    assert found(documents(*rows)) == brute(rows)


def test_empty_table_and_clashing_names(documents):
    docs = documents((1, "x" * 300), (2, "y")).selectExpr("*", "1 AS key", "2 AS kept", "3 AS anchor", "4 AS core")
    rows = rd.remove_repeats(docs).select("doc_id", "key", "kept", "n_removed").collect()
    assert sorted((r.doc_id, r.key, bytes(r.kept), r.n_removed) for r in rows) == [(1, 1, b"", 300), (2, 1, b"y", 0)]
    assert rd.remove_repeats(docs.limit(0)).collect() == []


def test_merge_orders_suffixes_of_runs():
    rng = np.random.default_rng(4)
    text = rng.integers(97, 99, 4000).astype(np.uint8)
    place = rng.permutation(3000)[:500]
    core = rng.integers(0, 3, 500)
    end = np.minimum(place + 200, len(text))
    order, common = rd.merge(core, text, place, end)
    keys = [(core[i], text[place[i] : end[i]].tobytes().ljust(200, b"\0")) for i in order]
    assert keys == sorted(keys)
    for a, b, n in zip(keys, keys[1:], common[1:], strict=False):
        same = next((k for k in range(200) if a[1][k] != b[1][k]), 200) if a[0] == b[0] else 0
        assert n == same


def test_hash_of_kept_bytes(documents):
    (row,) = rd.remove_repeats(documents((1, "né"))).collect()
    assert hashlib.sha256(bytes(row.kept)).hexdigest() == hashlib.sha256("né".encode()).hexdigest()
