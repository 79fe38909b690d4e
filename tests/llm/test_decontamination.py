import random
import re

import pytest
from pyspark.sql import functions as F

from fallowfunds.llm import decontamination as dc

UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(len(w), 10)
        for s in range(len(w) - size + 1) if w else ():
            windows.setdefault(tuple(w[s : s + size]), set()).add("" if item is None else str(item))
    out = []
    for i, text in docs:
        w = words(text)
        hit, found = set(), set()
        for window, names in windows.items():
            for s in range(len(w) - len(window) + 1):
                if tuple(w[s : s + len(window)]) == window:
                    hit |= set(range(s, s + len(window)))
                    found |= names
        out.append((i if i is not None else -1, len(w), len(hit), sorted(found), bool(hit)))
    return sorted(out)


def found(docs, bench):
    rows = dc.contamination(docs, bench).collect()
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in rows)


@pytest.mark.parametrize("short", [False, True])
def test_against_brute_force(spark, documents, short):
    rng = random.Random(3)
    word = lambda: rng.choice(["the", "a", "ünd", "x1", "Of", "zz", "q"])
    items = [(k, " ".join(word() for _ in range(rng.choice([10, 11, 14, 40])))) for k in range(12)]
    items += [(12, items[0][1]), (13, None), (14, "--- !!"), (None, items[3][1])]
    if short:
        items += [(20, "zz Of q"), (21, "ünd"), (22, " ".join(["q"] * 9))]
    rows = []
    for i in range(50):
        parts = []
        for _ in range(rng.randint(0, 4)):
            w = words(rng.choice(items)[1]) or ["none"]
            a, b = sorted((rng.randint(0, len(w)), rng.randint(0, len(w))))
            parts += [word(), *w[a:b], word().upper()]
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(parts)))
    rows += [(90, None), (91, ""), (None, items[1][1]), (92, items[1][1]), (92, items[1][1]), (93, ("the " * 3000) + items[2][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert found(documents(*rows), bench) == brute(rows, items)


def test_every_window_shares_a_fingerprint(spark):
    rng = random.Random(8)
    rows = [(i, [rng.choice("abcdefgh") for _ in range(10)]) for i in range(300)]
    inside = [(i, [*(rng.choice("xyz") for _ in range(6)), *w, *(rng.choice("xyz") for _ in range(6))]) for i, w in rows]
    prints = lambda r: {x.i: set(x.prints) for x in dc.fingerprints(dc.gram_hashes(spark.createDataFrame(r, "i int, words array<string>"))).collect()}
    alone, among = prints(rows), prints(inside)
    assert all(len(alone[i]) == 1 and alone[i] <= among[i] for i in alone)


def test_empty_tables_and_clashing_names(spark, documents):
    docs = documents((1, "a b c")).withColumns({"items": F.lit(1), "start": F.lit(2), "window": F.lit(3), "words": F.lit(4)})
    none = spark.createDataFrame([], "item_id long, text string")
    (row,) = dc.contamination(docs, none).collect()
    assert (row.n_words, row.n_hit, row["items"], row.window, row.words) == (3, 0, [], 3, 4)
    assert dc.contamination(docs.limit(0), none).collect() == []
