import random
import re

import numpy as np
import pytest

from fallowfunds.llm import near_dedup as nd
from fallowfunds.llm.components import components


def brute(rows, percent):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    top = {i: i for i in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                top[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.5:  # edits of former texts: chains around the threshold
            words = rng.choice(rows)[1].split(" ")
            for _ in range(rng.randint(0, 8)):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 3, 4, 5, 6, 30, 120, 400]))]
        text = " ".join(words)
        rows.append((i * 7 % 1000 + 5, text.upper() if kind < 0.1 else text))
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_against_all_pairs(documents, percent):
    rows = corpus(percent)
    found = nd.near_duplicates(documents(*rows), percent).collect()
    want = brute(rows, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert all(r.kept == (r.component_id == r.doc_id) for r in found)


def test_large_groups_are_resolved(documents):
    """A block of texts that share most of their words, so buckets are large and hold many groups."""
    rng = random.Random(5)
    base = [f"b{k}" for k in range(100)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4])):
            words[rng.randrange(100)] = f"x{i}-{rng.randrange(9)}"
        rows.append((1000 - i, " ".join(words)))
    found = nd.near_duplicates(documents(*rows), 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows, 80)


def test_nulls_empty_repeats_and_clashing_names(spark, documents):
    text = " ".join(f"w{k}" for k in range(50))
    docs = documents((3, text), (9, text), (9, text), (4, None), (5, ""), (6, " \n"), (None, text), (7, "one two"), (8, "ONE  two"))
    docs = docs.selectExpr("*", "'x' AS kept", "1 AS id", "2 AS rep", "3 AS comp", "4 AS n")
    found = nd.near_duplicates(docs)
    assert found.columns == [c for c in docs.columns if c != "kept"] + ["n_shingles", "component_id", "kept"]
    rows = sorted((r.doc_id or -1, r.n_shingles, r.component_id, r.kept) for r in found.collect())
    assert rows == [
        (-1, None, None, True), (3, 46, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 1, 7, True), (8, 1, 7, False),
        (9, 46, 3, False), (9, 46, 3, False),
    ]
    assert nd.near_duplicates(docs.limit(0)).collect() == []


def test_least_text_stands_for_a_repeated_id(documents):
    found = nd.near_duplicates(documents((1, "a b"), (2, "c d"), (2, "a b")))
    assert sorted((r.doc_id, r.component_id) for r in found.collect()) == [(1, 1), (2, 1), (2, 1)]


def test_every_text_of_a_repeated_id_is_compared(documents):
    found = nd.near_duplicates(documents((1, "c d"), (2, "a b"), (2, "c d e"), (2, "c d"), (3, "c d e"), (2, None)))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()) == [
        (1, 1, 1), (2, 0, 1), (2, 1, 1), (2, 1, 1), (2, 1, 1), (3, 1, 1)
    ]


def test_one_row_of_each_group_is_left(spark, documents):
    """Rows without an id, of a repeated id, and repeated as a whole, as the pipeline takes them."""
    import corpus_pipeline as cp

    text, other = (" ".join(f"{c}{k}" for k in range(50)) for c in "wv")
    docs = documents(
        (3, text), (3, text, "b"), (9, text + " more"), (None, text), (4, "own"), (4, other), (5, other.upper()), (5, other.upper()),
        (None, "alone"), (None, "alone"), (None, "ALONE"), (6, None), (6, ""), (7, ""),
    )
    left = cp.drop_near_duplicates(spark, docs, "")
    assert left.columns == docs.columns
    rows = sorted(((r.doc_id or -1, (r.text or "")[:5].lower(), r.source) for r in left.collect()))
    assert rows == [(-1, "alone", "a"), (3, "w0 w1", "a"), (4, "own", "a"), (4, "v0 v1", "a"), (6, "", "a"), (7, "", "a")]
    assert cp.drop_near_duplicates(spark, docs.limit(0), "").collect() == []


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(0)
    a = rng.integers(1, 2**63, 3000, dtype=np.uint64)
    b = np.concatenate([a[:2400], rng.integers(1, 2**63, 600, dtype=np.uint64)])
    off = np.array([0, 3000, 6000, 6000 + 3600])
    table = nd.registers(np.concatenate([a, b, np.union1d(a, b)]), off, 960)
    assert (np.maximum(table[0], table[1]) == table[2]).mean() > 0.999
    near = nd.estimate(table[:1], table[1:2], np.array([3000.0]), np.array([3000.0]))[0]
    assert abs(near - 2400 / 3600) < 0.06


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101)], "a long, b long")
    found = {r.id: r.comp for r in components(links).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100}
