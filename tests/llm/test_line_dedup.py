import random
from collections import Counter

import pytest

from fallowfunds.llm.line_dedup import drop_shared_lines

UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_docs, min_chars):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(UPPER)
    held = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    shared = {k for k, n in held.items() if n >= min_docs and len(k) >= min_chars}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in shared]
        out.append((i if i is not None else -1, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def found(docs, **options):
    rows = drop_shared_lines(docs, **options).collect()
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in rows)


@pytest.mark.parametrize("min_docs,min_chars", [(3, 1), (2, 3), (10, 1)])
def test_against_brute_force(documents, min_docs, min_chars):
    rng = random.Random(min_docs)
    lines = ["", " ", "A", "a", " a\t", "\x0b", " a", "É", "é", "line one", "LINE one ", "x\r", "rare"]
    rows = [(i, "\n".join(rng.choice([*lines, f"own {i}"]) for _ in range(rng.randint(0, 9)))) for i in range(40)]
    rows += [(100, None), (101, ""), (None, "A\nq"), (None, "A\nq"), (102, "A\n" * 5000 + "end")]
    assert found(documents(*rows), min_docs=min_docs, min_chars=min_chars) == brute(rows, min_docs, min_chars)


def test_empty_table_and_clashing_names(documents):
    docs = documents((1, "x\ny"), (2, "x")).selectExpr("*", "7 AS n_lines", "8 AS pos", "9 AS key", "1 AS a", "2 AS line")
    result = drop_shared_lines(docs, min_docs=2)
    assert result.columns == [c for c in docs.columns if c != "n_lines"] + ["kept_text", "n_lines", "n_dropped"]
    rows = sorted((r.doc_id, r.kept_text, r.n_lines, r.pos, r.key) for r in result.collect())
    assert rows == [(1, "y", 2, 8, 9), (2, "", 1, 8, 9)]
    assert drop_shared_lines(docs.limit(0)).collect() == []
