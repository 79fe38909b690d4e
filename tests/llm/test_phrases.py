import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fallowfunds.llm import bloom, phrases
from fallowfunds.llm.flat import buffers

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER))]


def brute(rows, least, top, percent=80):
    """Counts of all contiguous stretches, then the rules as they stand."""
    count, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            total[lang] += len(words)
            for i in range(len(words)):
                for size in range(1, 5):
                    if i + size <= len(words):
                        count[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in count.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in found.items():
            inside = any(
                len(q) > len(p) and 100 * b >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, b in found.items()
            )
            if not inside:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, text, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, text.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def texts(n, seed):
    rng = random.Random(seed)
    words = ["New", "york", "the", "of", "État", "x", "city", "Big", "apple", "中文", "A", "b-c", "\x0e", "\x1c", " ", "'"]
    gaps = [" ", "  ", "\t", ". ", ",", "\n", "! ", " ;", "\x0b", " "] + [" "] * 20
    out = []
    for _ in range(n):
        body = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 60)))
        out.append((rng.choice(["en", "de", None, "und", ""]), body + rng.choice(["", "in New York city", "a big  Apple of the"])))
    return [*out, ("en", None), ("en", ""), (None, " .. "), ("solo", "one two")]


@pytest.mark.parametrize("trigger", [1, 2, 5, 1000])
def test_every_phrase_is_counted_once(trigger):
    rng = random.Random(trigger)
    rows = [t for _, t in texts(200, trigger)] + [" ".join(rng.choice("abc") for _ in range(500))]
    column = pa.array(rows)
    found = Counter()
    row, chunk, own = phrases.parse(*buffers(column), trigger)
    for text, n in zip(chunk.to_pylist(), own.tolist(), strict=True):
        words = text.split(" ")
        for i in range(n):
            for size in range(1, 5):
                if i + size <= len(words):
                    found[tuple(words[i : i + size])] += 1
    want = Counter()
    for text in rows:
        for words in pieces(text):
            want.update(tuple(words[i : i + s]) for i in range(len(words)) for s in range(1, 5) if i + s <= len(words))
    assert found == want


@pytest.mark.parametrize("least,top", [(3, 2000), (8, 5)])
def test_against_brute_force(spark, least, top):
    rows = texts(300, least)
    docs = spark.createDataFrame([(i, t, g) for i, (g, t) in enumerate(rows)], "doc_id long, text string, lang string")
    docs = docs.withColumns({"phrase": F.lit(1), "a.b": F.lit(2), "n": F.lit(3), "__text": F.lit(4)}).repartition(3)
    found = phrases.collocations(docs, least=least, top=top, trigger=3)
    assert sorted(map(tuple, found.collect())) == brute(rows, least, top)


def test_full_filters_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "FILTER_BYTES", 1)  # one block: nearly every probe is a false positive
    rows = texts(120, 2)
    docs = spark.createDataFrame([(i, t, g) for i, (g, t) in enumerate(rows)], "doc_id long, text string, lang string")
    assert sorted(map(tuple, phrases.collocations(docs, least=4).collect())) == brute(rows, 4, 2000)


def test_one_very_long_text_and_copies(spark):
    rng = random.Random(1)
    long = " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(30_000))
    rows = [("en", long), ("en", "alpha beta"), *[("en", "copy of copy of this")] * 40]
    docs = spark.createDataFrame([(1, t, g) for g, t in rows], "doc_id long, text string, lang string")
    assert sorted(map(tuple, phrases.collocations(docs).collect())) == brute(rows, 30, 2000)


def test_counts_beyond_64_bits(spark):
    big = 6_000_000_000_000_000_000
    rows = [("en", "a b", 2, big), ("en", "a", 1, big), ("en", "b", 1, big + 7)]
    table = spark.createDataFrame(rows, "lang string, phrase string, size int, f long")
    (row,) = phrases.scored(table).collect()
    assert row.score == 2_000_000 * big // (2 * big + 7)
    assert phrases.contained(table, 80).collect() == []


def test_empty_table(documents):
    assert phrases.collocations(documents((1, "x")).limit(0)).collect() == []


def test_filter_holds_all(spark):
    rng = np.random.default_rng(1)
    hashes = rng.integers(-(2**63), 2**63 - 1, 5000)
    frame = spark.createDataFrame([(int(i % 3), int(h)) for i, h in enumerate(hashes)], "shard int, hash long")
    filters = bloom.broadcast(frame, 1 << 20).value
    for s in range(3):
        assert bloom.holds(filters[s], hashes[s::3].astype(np.uint64)).all()
        others = rng.integers(0, 2**64 - 1, 20_000, dtype=np.uint64)
        assert bloom.holds(filters[s], others).mean() < 0.02
    assert sum(w.nbytes for w in bloom.broadcast(frame, 1 << 10).value.values()) <= 1 << 10
