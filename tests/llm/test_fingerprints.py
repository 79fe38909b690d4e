import hashlib
import math
import random
import re
import struct
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from fallowfunds.llm import fingerprints as fp


def corpus(n=300):
    rng = random.Random(2)
    common = ["the", "of", "and"]
    return [(i * 37, " ".join(rng.choice(common) if rng.random() < 0.4 else f"w{rng.randrange(900)}" for _ in range(rng.randint(3, 200)))) for i in range(n)]


def test_edits_and_neighbours(documents):
    rows = [*corpus(), (5_000_000, None), (5_000_001, ""), (5_000_002, "né🙂"), (None, "last one here"), (-3, "below zero")]
    found = {r.doc_id: r for r in fp.compare_edits(documents(*rows)).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        row = found[i]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        assert (row.near_edited == 1) == (row.fingerprint == row.edited_fingerprint)
    apart = sum(r.near_edited > r.near_next for i, r in found.items() if r.n_chars > 40)
    assert apart > 0.97 * sum(r.n_chars > 40 for r in found.values())


def test_equal_texts_have_equal_fingerprints(documents):
    rows = corpus(80)
    rows += [(10_000 + i, t) for i, t in rows[:40]] + [(1, "the the the"), (2, "the the the"), (3, None), (4, ""), (5, "")]
    docs = documents(*rows).withColumns({"kept": F.lit(1), "class": F.lit(2)})
    marks = {}
    for r in fp.fingerprint(docs).collect():
        marks.setdefault(r.text or "", set()).add(r.fingerprint)
    assert all(len(m) == 1 for m in marks.values())
    assert len({next(iter(m)) for m in marks.values()}) >= len(marks) - 1


def test_lexicon_against_counts(documents):
    rows = corpus(120)
    docs = documents(*rows)
    (words,) = fp.lexicon(docs, low=0.02, high=0.1).first()
    held = {}
    for r in docs.select(F.explode(fp.term_classes("text")).alias("c")).groupBy("c").count().collect():
        held[r.c] = r["count"]
    kept = {c for c, n in held.items() if max(2, -(-0.02 * 120 // 1)) <= n <= 12}
    assert {c for c in held if words[c >> 6] >> (c & 63) & 1} == kept
    assert sum(bin(w & (2**64 - 1)).count("1") for w in words) == len(kept)


def test_empty_and_single(documents):
    docs = documents((1, "only one"))
    assert fp.compare_edits(docs.limit(0)).collect() == []
    (row,) = fp.compare_edits(docs).collect()
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"only oon").hexdigest()
    assert fp.fingerprint(docs.limit(0)).collect() == []


def test_repeated_ids_are_ordered_by_text(documents):
    found = fp.compare_edits(documents((7, "bbb"), (7, "aaa"), (1, "ccc"))).collect()
    edited = {hashlib.sha256(t.encode()).hexdigest() for t in ("aab", "bbc", "cca")}
    assert {r.edited_sha256 for r in found} == edited


def folded(numbers, seed=42):
    """The 64-bit hash of a list of integers, each hash the seed of the next."""
    for number in numbers:
        seed = xxhash.xxh64_intdigest(struct.pack("<i", number), seed)
    return seed


def top_half(h):
    return struct.unpack("<i", struct.pack("<I", h >> 32))[0]


def test_fingerprints_against_brute_force(spark, documents):
    rows = [*corpus(150), (900_001, None), (900_002, "  "), (900_003, "unheard ünheard"), (900_004, "The THE the")]
    low, high = 0.02, 0.2
    terms = {i: {w for w in re.split(r"[^0-9a-z\u0080-\U0010FFFF]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w} for i, t in rows}
    classes = {i: sorted({xxhash.xxh64_intdigest(w.encode(), 42) >> (64 - fp.CLASS_BITS) for w in ws}) for i, ws in terms.items()}
    seen = Counter(k for ks in classes.values() for k in ks)
    n = len(rows)
    lexicon = {k for k, m in seen.items() if max(2, math.ceil(low * n)) <= m <= max(2, math.floor(high * n))}
    known = spark.createDataFrame([(k,) for k in seen], "c int").select("c", F.hash("c", F.lit("subset")).alias("h"))
    spot = {r.c: r.h for r in known.collect()}
    found = {r.doc_id: r.fingerprint for r in fp.fingerprint(documents(*rows), low=low, high=high).collect()}
    for i, ks in classes.items():
        kept = [k for k in ks if k in lexicon]
        expected = [top_half(folded(kept) if kept else folded(ks, xxhash.xxh64_intdigest(b"none", 42)))]
        for place, (cut, used) in enumerate(fp.SUBSETS):
            for part in range(used):
                hashes = [spot[k] for k in kept if ((spot[k] & 0xFFFFFFFF) >> (7 * place)) & (cut - 1) == part]
                expected.append((top_half(folded(hashes)) or 1) if hashes else 0)
        assert found[i] == "".join(f"{p & 0xFFFFFFFF:08x}".upper() for p in expected)


def test_neighbours_of_any_ids(documents):
    """Dense, far apart, repeated and missing ids, in cells of a few rows and in one cell."""
    rng = random.Random(5)
    rows = [(i, f"dense {i}") for i in range(150)] + [(rng.randrange(-(2**63), 2**63), f"far {i}") for i in range(150)]
    rows += [(2**63 - 1, "greatest"), (-(2**63), "least")]
    rows += [(77_777, f"{rng.random()}") for _ in range(80)] + [(None, f"{rng.random()} ü\U0001F642") for _ in range(120)]
    rows += [(None, None), (None, ""), (5, 'quo"te\\  '), (5, "\x00"), (5, "dense 5"), (5, "dense 5")]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    expected = Counter((i, t or "", order[(k + 1) % len(order)][1] or "") for k, (i, t) in enumerate(order))
    docs = documents(*rows).repartition(5)
    for cell in (4, 64, 10**6):
        found = fp.with_next(docs, "doc_id", "text", cell).collect()
        assert Counter((r.id, r.text, r.head if r.next_text is None else r.next_text) for r in found) == expected
        sizes = Counter(r.group for r in found)
        if cell == 4:
            assert len(sizes) > 60 and max(sizes.values()) < 40
    assert len(sizes) == 1
