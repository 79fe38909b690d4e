import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fallowfunds.llm import source_mixing as sm


def corpus(seed=1):
    rng = random.Random(seed)
    sizes = {"big": 200, "mid": 60, "small": 20, "tiny": 3}
    rows = []
    for source, n in sizes.items():
        rows += [(len(rows) + k, " ".join("w" for _ in range(rng.randint(1, 30))), source) for k in range(n)]
    return rows


def counted(docs, **options):
    return sm.mix(docs, **options).collect()


def tokens(text):
    return len(re.findall(r"[^ \t\n\x0B\f\r]+", text or ""))


@pytest.mark.parametrize("repeat", [1.0, 1.5, 4.0, 100.0])
def test_repetition_limit(documents, repeat):
    rows = corpus()
    found = counted(documents(*rows), repeat=repeat)
    total = Counter()
    for _, text, source in rows:
        total[source] += tokens(text)
    weight = {r.source: r.weight for r in found}
    assert math.isclose(sum(weight.values()), 1, abs_tol=1e-6)
    # The exponent solved by hand: the least source is read `repeat` times as often as the largest.
    spread = max(total.values()) / min(total.values())
    alpha = max(0.0, 1 - math.log(repeat) / math.log(spread))
    z = sum((t / sum(total.values())) ** alpha for t in total.values())
    for source, t in total.items():
        assert math.isclose(weight[source], (t / sum(total.values())) ** alpha / z, rel_tol=1e-4)
    copies = Counter((r.doc_id, r.source) for r in found)
    assert set(copies) == {(i, s) for i, _, s in rows}  # every document at least once
    read = Counter()
    for r in found:
        read[r.source] += r.n_tokens
    longest = max(tokens(t) for _, t, _ in rows)
    for source, t in total.items():
        budget = t * (t / max(total.values())) ** (alpha - 1)
        assert budget - longest - 2 <= read[source] <= budget + 2
        mine = [copies[i, s] for i, _, s in rows if s == source]
        assert max(mine) - min(mine) <= 1


def test_entropy_target_and_budget(documents):
    rows = corpus()
    target = 1.2
    found = counted(documents(*rows), entropy=target, budget=2000)
    weight = {r.source: r.weight for r in found}
    have = -sum(w * math.log(w) for w in weight.values())
    assert target <= have + 1e-5 and have < target + 1e-3
    read = Counter()
    for r in found:
        read[r.source] += r.n_tokens
    for source, w in weight.items():
        assert w * 2000 - 32 <= read[source] <= w * 2000 + 1
    assert counted(documents(*rows), entropy=5.0)[0].weight == pytest.approx(0.25)


def test_epochs_are_permutations_of_blocks(documents):
    rows = corpus()
    found = counted(documents(*rows), repeat=4.0)
    epochs = defaultdict(list)
    for r in sorted(found, key=lambda r: (r.source, r.epoch, r.order_key)):
        epochs[r.source, r.epoch].append((r.block, r.doc_id))
    for (source, epoch), order in epochs.items():
        assert len(set(order)) == len(order)
        seen = [b for k, (b, _) in enumerate(order) if k == 0 or order[k - 1][0] != b]
        assert len(seen) == len(set(seen))  # a block's documents stay together
        if (source, epoch + 1) in epochs and len(epochs[source, epoch + 1]) == len(order) > 10:
            assert order != epochs[source, epoch + 1]


def test_nulls_repeats_empty_and_clashing_names(documents):
    docs = documents((1, "a b", None), (None, "c", None), (2, "d e f", "x"), (2, "d e f", "x"), (3, None, "silent"), (4, "", "silent"))
    docs = docs.withColumns({"epoch": F.lit("old"), "tokens": F.lit(1), "passes": F.lit(2), "rest": F.lit(3), "n": F.lit(4)})
    result = sm.mix(docs)
    assert result.columns == [c for c in docs.columns if c != "epoch"] + ["epoch", "n_tokens", "weight", "block", "order_key"]
    rows = Counter((r.doc_id, r.source, r.n_tokens) for r in result.collect())
    assert set(rows) == {(1, None, 2), (None, None, 1), (2, "x", 3), (3, "silent", 0), (4, "silent", 0)}
    assert rows[3, "silent", 0] == rows[4, "silent", 0] == 1 and rows[2, "x", 3] == 2
    assert sm.mix(docs.limit(0)).collect() == []
    silent = sm.mix(documents((1, "", "a"), (2, None, "b"))).collect()
    assert len(silent) == 2
