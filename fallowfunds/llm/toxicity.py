"""Toxicity by maximum-scoring segments of token log-odds, judged by extreme-value statistics.

Log-odds of each unit (a word, or its first 4 to 8 bytes, for inflected words) between toxic and other documents are
shrunk by a Dirichlet prior in proportion to the unit's overall frequency. Words without evidence
cost a little, so a text's maximal segments are its toxic passages. The best one is weighed against
the best that chance gives in a text of that length (a Gumbel law), and that is fitted to labels.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from fallowfunds.llm.common import held_out, packed, passed, stored, unpacked, whole
from fallowfunds.llm.flat import Hasher, chunks, runs

PRIOR = 500.0  # pseudo-documents the prior is worth
LEAST_Z, LEAST_DOCS = 4.0, 4  # evidence a unit needs
LEAST_ODDS = 1.0  # what such a unit adds at least; weaker ones would add up to noise
CAUTION = 1.0  # standard deviations taken off a unit's log-odds
UNITS = 50_000  # units a model holds at most (a documented bound of what is sent to every task): the strongest
SAMPLE = 200_000  # labelled rows a model learns from at most
COST = 0.1  # of a word without evidence, in nats
PREFIXES = (4, 5, 6, 7, 8)  # bytes

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass(frozen=True)
class Model:
    """Units' hashes in order, their log-odds, and the laws fitted to labels."""

    keys: np.ndarray
    odds: np.ndarray
    decay: float  # lambda of the Gumbel law
    scale: float = 1.0  # its K
    offset: float = 0.0
    slope: float = 1.0


def _units(data: np.ndarray, offsets: np.ndarray):
    """(row of each word, [hash of the whole word, of its first 4 to 8 bytes])."""
    start, end, row = runs(_WORD[data], offsets)
    hashed = Hasher(data, lower=True)
    units = [hashed(start, end)]
    for i, size in enumerate(PREFIXES):
        cut = np.minimum(start + size, end)
        units.append(hashed(start, cut) ^ np.uint64(0x5DEECE66D * (i + 1)))
    return row, units


def _values(data: np.ndarray, offsets: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(row of each word, its log-odds: those of its most telling unit, 0 without evidence)."""
    row, units = _units(data, offsets)
    value = np.zeros(len(row))
    if len(model.keys):
        for unit in units:
            at = np.minimum(np.searchsorted(model.keys, unit), len(model.keys) - 1)
            np.maximum(value, np.where(model.keys[at] == unit, model.odds[at], 0.0), out=value)
    return row, value


def unit_counts(labelled: DataFrame) -> DataFrame:
    """(unit, toxic, other): documents of either label that hold a unit."""

    def run(batches):
        for batch in batches:
            label = np.array(batch.column(1).to_pylist(), bool)
            for first, last, data, offsets in chunks(batch.column(0)):
                row, units = _units(data, offsets)
                if not len(row):
                    continue
                key = np.concatenate(units)
                rows = np.tile(row, len(units))
                order = np.lexsort((rows, key))
                key, rows = key[order], rows[order]
                new = np.append(True, (key[1:] != key[:-1]) | (rows[1:] != rows[:-1]))
                key, toxic = key[new], label[first:last][rows[new]]
                at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                n, bad = np.diff(np.append(at, len(key))), np.add.reduceat(toxic.astype(np.int64), at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[at].view(np.int64)), pa.array(bad), pa.array(n - bad)], ["unit", "toxic", "other"]
                )

    counts = labelled.select("text", "toxic").mapInArrow(run, "unit long, toxic long, other long")
    return counts.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def learn(labelled: DataFrame) -> Model:
    """The units of a model, from ``labelled`` (text, toxic) as a whole."""
    n1, n0 = labelled.agg(
        F.coalesce(F.sum(F.col("toxic").cast("long")), F.lit(0)), F.coalesce(F.sum((~F.col("toxic")).cast("long")), F.lit(0))
    ).first()
    none = Model(np.zeros(0, np.uint64), np.zeros(0), 1.0)
    if not n1 or not n0:
        return none
    prior = F.lit(PRIOR / (n1 + n0)) * (F.col("toxic") + F.col("other"))
    bad, good = F.col("toxic") + prior * F.lit(n1 / (n1 + n0)), F.col("other") + prior * F.lit(n0 / (n1 + n0))
    all_bad, all_good = n1 * (1 + PRIOR / (n1 + n0)), n0 * (1 + PRIOR / (n1 + n0))
    odds = F.log(bad / (F.lit(all_bad) - bad)) - F.log(good / (F.lit(all_good) - good))
    found = (
        unit_counts(labelled)
        .filter(F.col("toxic") >= LEAST_DOCS)
        .select("unit", "other", odds.alias("mean"), F.sqrt(1 / bad + 1 / good).alias("deviation"))
        .withColumn("z", F.col("mean") / F.col("deviation"))
        .filter(F.col("z") >= LEAST_Z)
        .withColumn("odds", F.col("mean") - CAUTION * F.col("deviation"))
        .filter(F.col("odds") >= LEAST_ODDS)
        .orderBy(F.desc("z"), "unit")
        .limit(UNITS)
        .collect()
    )
    if not found:
        return none
    keys = np.array([r.unit for r in found], np.int64).view(np.uint64)
    order = np.argsort(keys)
    value = np.array([r.odds for r in found])
    return Model(keys[order], value[order], 1.0)


def word_values(clean: DataFrame, model: Model) -> list[tuple[float, int]]:
    """(log-odds of words to a hundredth, number of words with them) over all texts of ``clean``."""

    def run(batches):
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                _, value = _values(data, offsets, model)
                cents, n = np.unique(np.rint(value * 100).astype(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cents), pa.array(n.astype(np.int64))], ["cents", "n"])

    counted = clean.select("text").mapInArrow(run, "cents long, n long").groupBy("cents").agg(F.sum("n").alias("n"))
    return [(r.cents / 100, r.n) for r in counted.collect()]  # log-odds have a bounded range


def decay(counted: list[tuple[float, int]], odds: np.ndarray) -> float:
    """Lambda of the Gumbel law: the mean of exp(lambda * score) over words of clean documents is 1.

    Every unit counts as half a word more than was seen, as the next text may hold it.
    """
    value = np.array([v for v, _ in counted] + odds.tolist())
    weight = np.array([float(n) for _, n in counted] + [0.5] * len(odds))
    value, weight = np.where(value > 0, value, -COST), weight / weight.sum()
    low, high = 0.0, 5.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if float((weight * np.exp(mid * value)).sum()) < 1 else (low, mid)
    return max(low, 0.01)


def segments(place: list[int], score: list[float], cost: float) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first word, last word), in linear time.

    Only words with evidence are given; those between them cost ``cost`` each.
    """
    # (sum before, sum after, first, last, place of the nearest one before it with a lesser sum before)
    kept: list[tuple[float, float, int, int, int]] = []
    total, last = 0.0, None
    for at, value in zip(place, score, strict=True):
        total -= cost * (at - last - 1 if last is not None else 0)
        left, right, first = total, total + value, at
        total, last = right, at
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][0] >= left:
                j = kept[j][4]
            if j < 0 or kept[j][1] >= right:
                break
            left, _, first, _, before = kept[j]
            del kept[j:]
            j = before
        kept.append((left, right, first, at, j))
    return [(right - left, first, last) for left, right, first, last, _ in kept]


def passages(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``best`` (the best segment's score, 0 without one) and ``found``."""
    new = ("n_words", "best", "found")
    rows = packed(docs, text=whole(text))
    segment = StructType([StructField("score", DoubleType()), StructField("first_word", LongType()), StructField("last_word", LongType())])
    schema = StructType(
        [rows.schema["row"], StructField("n_words", LongType()), StructField("best", DoubleType()), StructField("found", ArrayType(segment))]
    )

    def run(batches):
        for batch in batches:
            n_words, best, found = [], [], []
            for first, last, data, offsets in chunks(batch.column(1)):
                row, value = _values(data, offsets, model)
                count = np.bincount(row, minlength=last - first)
                n_words.append(count)
                hit = np.flatnonzero(value > 0)
                begin = np.cumsum(count) - count
                limits = np.searchsorted(hit, np.append(begin, len(row)))
                for i in range(last - first):
                    at = hit[limits[i] : limits[i + 1]]
                    if not len(at):
                        best.append(0.0)
                        found.append([])
                        continue
                    some = segments((at - begin[i]).tolist(), value[at].tolist(), COST)
                    best.append(max(s[0] for s in some))
                    found.append([{"score": s, "first_word": a, "last_word": b} for s, a, b in some])
            kind = pa.list_(pa.struct([("score", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64())]))
            counts = pa.array(np.concatenate([*n_words, np.zeros(0, np.int64)]).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), counts, pa.array(best, pa.float64()), pa.array(found, kind)], ["row", *new]
            )

    return rows.mapInArrow(run, schema).select(*unpacked(docs, *new), *new)


def evidence(model: Model):
    """Minus the logarithm of the chance that a clean text of this length has so good a segment."""
    x = F.lit(model.scale) * F.greatest(F.col("n_words"), F.lit(1)) * F.exp(-F.lit(model.decay) * F.col("best"))
    chance = F.when(x < 1e-6, x).otherwise(1 - F.exp(-x))
    return F.least(-F.log(F.greatest(chance, F.lit(1e-40))), F.lit(60.0))


def calibrate(scored: DataFrame, model: Model) -> Model:
    """The model with both laws fitted to ``scored`` (toxic, n_words, best); sums only leave Spark."""
    clean = scored.filter(~F.col("toxic")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.greatest("n_words", F.lit(1)) * F.exp(-F.lit(model.decay) * F.col("best"))).alias("s")
    ).first()
    scale = clean.n / clean.s if clean.n and clean.s else 1.0
    model = Model(model.keys, model.odds, model.decay, scale)
    bins = (
        scored.groupBy(F.round(evidence(model), 1).alias("x"), "toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    )  # at most 601 values of evidence
    if len({b.toxic for b in bins}) < 2:
        return model
    x = np.array([[1.0, b.x] for b in bins])
    y, n = np.array([float(b.toxic) for b in bins]), np.array([float(b.n) for b in bins])
    w = np.array([0.0, 0.0])
    for _ in range(50):  # Newton's method with a little ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - y)) + 0.01 * w
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return Model(model.keys, model.odds, model.decay, scale, float(w[0]), float(max(w[1], 0.0)))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with ``held_out``, ``score``, ``predicted``, ``n_words`` and ``found`` (toxic passages).

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic; rows of labels without either are left
    out. Labelled rows that are not held out teach the model, ``sample`` of them at most, by the order
    of a hash; so many ids can be sent to every task and texts need not be moved to meet them. NULL
    and empty texts are scored as texts without words. Without labels of both kinds every score is 0.5.
    A model holds the ``UNITS`` most telling units at most. Input columns that bear the name of a new one
    are replaced; others may have any name.
    """
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("__id"), (F.col("toxic") == 1).alias("toxic")
    ).filter(~held_out("__id"))
    # A label given twice teaches once; if labels differ, toxic wins.
    known = known.groupBy("__id").agg(F.max("toxic").alias("toxic"))
    known = F.broadcast(stored(known.orderBy(F.xxhash64("__id"), "__id").limit(sample), "toxic-labels"))
    texts = docs.select("doc_id", whole("text").alias("text"))
    # Copies of a text teach once, or the chance words of one that is copied often would tell.
    single = texts.join(known, F.col("doc_id") == F.col("__id")).groupBy(F.xxhash64("text")).agg(
        F.min("__id").alias("__id"), F.max("toxic").alias("toxic")
    )
    known = F.broadcast(stored(single.select("__id", "toxic"), "toxic-texts"))
    taught = texts.join(known, F.col("doc_id") == F.col("__id"))
    model = learn(taught.select("text", "toxic"))
    if len(model.keys):
        model = replace(model, decay=decay(word_values(taught.filter("NOT toxic"), model), model.odds))
    judged = stored(passages(taught.select("toxic", "text"), model).select("toxic", "n_words", "best"), "toxic-judged")
    if len(model.keys):
        model = calibrate(judged, model)
        score = 1 / (1 + F.exp(-(F.lit(model.offset) + F.lit(model.slope) * evidence(model))))
    else:
        score = F.lit(0.5)
    new = ("held_out", "score", "predicted", "n_words", "found", "best")
    return passages(docs.select(*passed(docs, *new)), model).select(
        *passed(docs, *new),
        held_out("doc_id").alias("held_out"),
        score.alias("score"),
        (score >= threshold).cast("int").alias("predicted"),
        "n_words", "best", "found",
    )
