import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fallowfunds.llm import quality, toxicity
from fallowfunds.llm.common import held_out

INSULTS = ["scum", "clown", "trash", "moron"]


def corpus(n=900):
    """Invented prose; some holds insults, some is a mix of shouted and repeated passages."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("aeiourstnlm") for _ in range(rng.randint(2, 9)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 300))]
        toxic, good = rng.random() < 0.15, rng.random() > 0.25
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = rng.sample(INSULTS, 3)
        if not good:
            half = len(words) // 2
            words[half:] = [w.upper() + "!!" for w in words[half:]] if rng.random() < 0.5 else [words[half]] * (len(words) - half)
        rows.append((i, " ".join(words)))
        labels.append((i, int(good), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), dict((a, (b, c)) for a, b, c in labels)


def test_held_out_rows(spark):
    ids = spark.createDataFrame([(i,) for i in (0, 1, 2, 77, -5, 10**12)], "doc_id long")
    for r in ids.select("doc_id", held_out().alias("h")).collect():
        assert r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


@pytest.mark.parametrize("operator,place", [(toxicity, 1), (quality, 0)])
def test_held_out_accuracy(tables, operator, place):
    docs, labels, truth = tables
    found = [r for r in operator.classify(docs, labels).collect() if r.held_out]
    assert len(found) > 150 and all(0 <= r.score <= 1 for r in found)
    assert np.mean([r.predicted == truth[r.doc_id][place] for r in found]) > 0.97


@pytest.mark.parametrize("operator,label", [(toxicity, "toxic"), (quality, "quality")])
def test_scores_depend_on_texts_alone(tables, operator, label):
    """Held-out labels, ids of scored rows, order and other columns change no score."""
    docs, labels, _ = tables
    other = labels.withColumn(label, F.when(held_out(), 1 - F.col(label)).otherwise(F.col(label)))
    extra = docs.withColumns({"best": F.lit(1), "score": F.lit("x"), "lang": F.lit("en")})
    a = {r.doc_id: r.score for r in operator.classify(docs, labels).collect()}
    b = {r.doc_id: r.score for r in operator.classify(extra, other).collect()}
    assert all(abs(a[i] - b[i]) < 1e-6 for i in a)


@pytest.mark.parametrize("operator,label", [(toxicity, "toxic"), (quality, "quality")])
def test_nulls_repeats_and_empty_tables(spark, tables, operator, label):
    docs, labels, _ = tables
    odd = docs.unionByName(spark.createDataFrame([(5000, None), (5001, ""), (None, "x"), (5002, " \n"), (0, "again"), (5003, "w " * 60_000)], docs.schema))
    known = labels.unionByName(spark.createDataFrame([(None, 1, 1), (7000, None, None), (0, 1, 1), (0, 0, 0)], labels.schema))
    rows = operator.classify(odd, known).collect()
    assert len(rows) == docs.count() + 6 and all(r.score is not None and r.predicted in (0, 1) for r in rows)
    assert operator.classify(docs.limit(0), known).collect() == []
    blank = operator.classify(docs.limit(5), labels.limit(0)).collect()
    assert [r.score for r in blank] == [0.5] * 5


def brute_segments(values):
    """All maximal segments by their definition, by repeated search of the best one."""
    found = []

    def search(a, b):
        best = max(((sum(values[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
        if best is None or best[0] <= 0:
            return
        found.append((best[3], best[4] - 1))
        search(a, best[3])
        search(best[4], b)

    search(0, len(values))
    return sorted(found)


def test_segments_against_brute_force():
    rng = random.Random(9)
    for _ in range(200):
        n = rng.randint(1, 14)
        values = [-0.25] * n
        place = sorted(rng.sample(range(n), rng.randint(0, n)))
        for p in place:
            values[p] = rng.randint(1, 400) / 100 + 0.003 * p
        score = [values[p] for p in place]
        found = toxicity.segments(place, score, 0.25)
        assert sorted((a, b) for _, a, b in found) == brute_segments(values)
        for s, a, b in found:
            assert abs(s - sum(values[a : b + 1])) < 1e-9


def insult_model():
    """A model that knows the insults as whole words, worth 2 nats each."""
    texts = np.frombuffer(" ".join(INSULTS).encode(), np.uint8)
    keys = toxicity._units(texts, np.array([0, len(texts)]))[1][0]
    return toxicity.Model(np.sort(keys), np.full(len(keys), 2.0), 1.0)


@pytest.mark.parametrize("text,places", [
    # each word once early, more than 2 / COST words apart, then all of them together
    ([*[w for i in INSULTS for w in [i, *["calm"] * 30]], *INSULTS, *INSULTS], [(0, 0), (31, 31), (62, 62), (93, 93), (124, 131)]),
    # two equal passages far from each other
    ([*INSULTS, *["calm"] * 200, *INSULTS], [(0, 3), (204, 207)]),
])
def test_every_passage_is_found(documents, text, places):
    (row,) = toxicity.passages(documents((1, " ".join(text))).select("doc_id", "text"), insult_model()).collect()
    assert [(s.first_word, s.last_word) for s in row.found] == places
    assert all(abs(s.score - 2.0 * (s.last_word - s.first_word + 1)) < 1e-9 for s in row.found)
    assert abs(row.best - max(2.0 * (b - a + 1) for a, b in places)) < 1e-9


def test_segments_take_linear_time():
    """Words too far apart to join are not walked over again for each one that follows."""
    n = 200_000
    assert len(toxicity.segments(list(range(0, 50 * n, 50)), [1.0] * n, 0.1)) == n


def test_attention_gradients():
    """The hand-written gradient lowers the loss and finds the passage that tells."""
    rng = np.random.default_rng(0)
    bags = rng.integers(1, 6, 300)
    y = (rng.random(300) < 0.5).astype(np.float32)
    x = rng.normal(size=(bags.sum(), quality.FEATURES)).astype(np.float32)
    first = np.cumsum(bags) - bags
    mark = first + rng.integers(0, 100, 300) % bags
    x[:, 0] = 0
    x[mark, 0] = np.where(y > 0, 4, -4)
    model = quality.fit(x, bags, y)
    *_, weight, _, p = quality.forward(model, x, bags)
    assert ((p > 0.5) == (y > 0.5)).mean() > 0.98
    assert np.isclose(np.add.reduceat(weight, first), 1, atol=1e-4).all()
    several = bags > 1
    assert weight[mark][several].mean() > 1.2 * (1 / bags[several]).mean()


def test_decay_solves_its_equation():
    counted, odds = [(0.0, 5000), (2.0, 7), (3.5, 2)], np.array([2.0, 3.5, 3.5])
    found = toxicity.decay(counted, odds)
    words = [(-toxicity.COST, 5000.0), (2.0, 7.5), (3.5, 3.0)]
    assert abs(sum(n * np.exp(found * v) for v, n in words) / sum(n for _, n in words) - 1) < 1e-9


def test_every_word_is_counted_for_the_decay(documents):
    docs = documents((1, "calm scum calm"), (2, None), (3, "scum " * 500 + "x, y"), (4, ""), (4, "trash"))
    assert dict(toxicity.word_values(docs, insult_model())) == {0.0: 4, 2.0: 502}


def test_an_id_teaches_once_however_often_it_is_repeated(tables):
    docs, labels, _ = tables
    copies = docs.filter("doc_id < 40")
    for _ in range(3):
        copies = copies.unionByName(copies)
    a = {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
    b = quality.classify(docs.unionByName(copies), labels).collect()
    assert len(b) == len(a) + 8 * 40 and all(abs(a[r.doc_id] - r.score) < 1e-6 for r in b)


def test_passages_that_teach_are_bounded_by_whole_documents(spark, documents, monkeypatch):
    rows = [("a", "w " * 320, True), ("b", "w " * 320, False), ("c", "z " * 32, True), ("d", "", False)]
    labelled = spark.createDataFrame(rows, "key string, text string, good boolean")
    held = []
    monkeypatch.setattr(quality, "fit", lambda x, bags, y: held.append((len(x), sorted(bags.tolist()))) or {})
    assert quality.learn(labelled, most=22) == {} and held.pop() == (22, [1, 1, 10, 10])
    quality.learn(labelled, most=12)
    assert all(n <= 12 and n == sum(bags) for n, bags in held)
    assert quality.learn(labelled, most=0) is None


def test_texts_go_to_python_once_and_workers_give_memory_back(spark, documents, monkeypatch):
    docs = documents((1, "a b c"), (2, None), (3, ""))
    sent, real = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: sent.append((self.columns, run.__qualname__)) or real(self, run, schema))
    assert sorted((r.doc_id, r.text, r.n_passages) for r in quality.score(docs, None).collect()) == [(1, "a b c", 1), (2, None, 1), (3, "", 1)]
    quality.learn(docs.selectExpr("doc_id AS key", "text", "doc_id > 1 AS good"))
    assert [columns for columns, _ in sent] == [["row"], ["key", "text", "good"]]
    assert all(run.startswith("released") for _, run in sent)
