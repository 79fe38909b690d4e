import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fallowfunds.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, letters=5, least=3):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= letters and n >= least}
    table = {}
    for w, n in words.items():
        close = [(-m, v) for v, m in words.items() if near(w, v)]
        form = min(close)[1] if close and -min(close)[0] >= 2 * n else None
        table[w] = (form, len(close))
    out = []
    for w, (form, n_near) in table.items():
        root = w
        while table[root][0]:
            root = table[root][0]
        out.append((w, form, root, words[w], n_near, words[form] if form else None))
    return sorted(out, key=repr)


def texts(n, seed):
    rng = random.Random(seed)
    base = ["letter", "latter", "later", "éclair", "Éclair", "eclair", "straße", "aaaaa", "ÿÿÿÿÿÿ", "×÷×÷×", "lorem", "Ipsum"]
    out = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 40)):
            w = rng.choice(base[: rng.randint(1, len(base))])
            for _ in range(rng.choice([0, 0, 0, 1, 2])):
                at = rng.randrange(len(w) + 1)
                w = w[:at] + rng.choice(["", "a", "e", "ÿ", "À"]) + w[at + rng.choice([0, 1]) :]
            words.append(w)
        out.append((rng.choice([i, i, None, 5]), rng.choice([" ", "-", "1", " Ā "]).join(words)))
    return [*out, (1, None), (2, ""), (3, "中文 лето"), *[(4, "again again")] * 9]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, documents, seed):
    rows = texts(500, seed)
    docs = documents(*rows).withColumns({"word": F.lit("x"), "n": F.lit(1), "a.b": F.lit(2), "__text": F.lit(3)}).repartition(3)
    found = spelling.variants(docs).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows)
    assert any(r.form and r.root != r.form for r in found)


def test_full_filters_lose_nothing(documents, monkeypatch):
    monkeypatch.setattr(spelling, "FILTER_BYTES", 1)
    monkeypatch.setattr(spelling, "SYMBOLS", 40)
    rows = texts(60, 3)
    assert sorted(map(tuple, spelling.variants(documents(*rows)).collect()), key=repr) == brute(rows)


def test_very_long_words(documents):
    long = "ab" * 3000
    rows = [(i, f"{long} {long}x {long[:70]} {long[:69]} {long[1:70]}") for i in range(3)]
    assert sorted(map(tuple, spelling.variants(documents(*rows)).collect()), key=repr) == brute(rows)


def test_long_chains(spark):
    rows = [(f"w{i}", f"w{i + 1}") for i in range(50)]
    found = spelling.roots(spark.createDataFrame(rows, "word string, form string")).collect()
    assert {r.root for r in found} == {"w50"} and len(found) == 50


def test_empty_table(documents):
    assert spelling.variants(documents((1, "x")).limit(0)).collect() == []
