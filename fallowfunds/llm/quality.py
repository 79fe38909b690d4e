"""Quality by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded, gated attention learned from document
labels weighs the passages, and the weighted representation gives the score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, LongType, StructField, StructType

from fallowfunds.llm.common import held_out, packed, passed, released, stored, unpacked, whole
from fallowfunds.llm.flat import Hasher, chunks, mix, words

PASSAGE = 32  # words
SAMPLE = 12_000  # labelled documents the model is fitted on at most, by the order of a hash
PASSAGES = 1_000_000  # passages that they have at most; their features are fitted on the driver (124 bytes each)
HIDDEN, ATTENTION, STEPS, RATE = 24, 12, 250, 0.02

# Classes of bytes whose shares describe a passage.
_CLASSES = [
    range(65, 91), range(97, 123), range(48, 58), range(128, 256), [10], [32], [33, 63], [44, 46, 58, 59],
    [35], [36], [37], [38], [42], [124], [60, 62, 47, 92], [64, 95, 61, 43], [34, 39, 40, 41, 91, 93, 123, 125], range(32),
]
FEATURES = len(_CLASSES) + 13
_MASKS = np.zeros((len(_CLASSES), 256), bool)
for _i, _members in enumerate(_CLASSES):
    _MASKS[_i, list(_members)] = True


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of the passages, passages of each row); a row without words is one empty passage."""
    n_rows = len(offsets) - 1
    start, end, row = words(data, offsets)
    count = np.bincount(row, minlength=n_rows) if len(row) else np.zeros(n_rows, np.int64)
    bags = np.maximum(-(-count // PASSAGE), 1)
    out = np.zeros((int(bags.sum()), FEATURES), np.float32)
    if not len(row):
        return out, bags
    at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    passage = (np.cumsum(bags) - bags)[row] + at // PASSAGE
    first = np.flatnonzero(at % PASSAGE == 0)
    last = np.append(first[1:], len(row)) - 1
    which = passage[first]
    size = (last - first + 1).astype(np.float64)
    span = np.maximum(end[last] - start[first], 1).astype(np.float64)
    for i, mask in enumerate(_MASKS):
        sums = np.concatenate([[0], np.cumsum(mask[data], dtype=np.int64)])
        out[which, i] = (sums[end[last]] - sums[start[first]]) / span
    length = (end - start).astype(np.float64)
    hashed = Hasher(data, lower=True)(start, end)
    k = len(_CLASSES)
    total = lambda x: np.add.reduceat(x.astype(np.float64), first)
    mean = total(length) / size
    out[which, k] = mean / 10
    out[which, k + 1] = np.sqrt(np.maximum(total(length**2) / size - mean**2, 0)) / 10
    out[which, k + 2] = np.maximum.reduceat(length, first) / 40
    out[which, k + 3] = size / PASSAGE

    def fresh(key):
        """True where a word's key comes for the first time."""
        mask = np.zeros(len(key), bool)
        mask[np.unique(key, return_index=True)[1]] = True
        return mask

    out[which, k + 4] = total(fresh(mix(hashed ^ mix(passage.astype(np.uint64))))) / size
    out[which, k + 5] = total(fresh(mix(hashed ^ mix(row.astype(np.uint64) + np.uint64(1 << 40))))) / size
    for j, back in enumerate((1, 2)):
        again = np.zeros(len(row), bool)
        again[back:] = (hashed[back:] == hashed[:-back]) & (row[back:] == row[:-back])
        out[which, k + 6 + j] = total(again) / size
    tail, head = data[end - 1], data[start]
    marked = _MASKS[6] | _MASKS[8] | _MASKS[9] | _MASKS[10] | _MASKS[11] | _MASKS[12]
    out[which, k + 8] = total(marked[tail]) / size
    out[which, k + 9] = total(_MASKS[0][head]) / size
    out[which, k + 10] = total(_MASKS[7][tail]) / size
    out[which, k + 11] = total(length <= 2) / size
    out[which, k + 12] = total(length >= 14) / size
    return out, bags


def _sums(values: np.ndarray, bags: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, np.cumsum(bags) - bags, axis=0)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(m: dict, x: np.ndarray, bags: np.ndarray):
    h = np.tanh(((x - m["mean"]) / m["dev"]).astype(np.float32) @ m["W"] + m["b"])
    a, g = np.tanh(h @ m["V"] + m["v"]), _sigmoid(h @ m["U"] + m["u"])
    e = (a * g) @ m["w"]
    top = np.maximum.reduceat(e, np.cumsum(bags) - bags)
    e = np.exp(e - np.repeat(top, bags))
    weight = e / np.repeat(_sums(e, bags), bags)
    z = _sums(weight[:, None] * h, bags)
    return h, a, g, weight, z, _sigmoid(z @ m["c"] + m["c0"])


def fit(x: np.ndarray, bags: np.ndarray, y: np.ndarray, seed: int = 11) -> dict:
    """Gated attention and its encoder, by Adam on the mean log-loss."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    m = {
        "W": draw(FEATURES, HIDDEN), "b": np.zeros(HIDDEN, np.float32), "V": draw(HIDDEN, ATTENTION), "v": np.zeros(ATTENTION, np.float32),
        "U": draw(HIDDEN, ATTENTION), "u": np.zeros(ATTENTION, np.float32), "w": draw(ATTENTION), "c": draw(HIDDEN),
        "c0": np.float32(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))),
    }
    names = list(m)
    m |= {"mean": x.mean(axis=0), "dev": x.std(axis=0) + 1e-3}
    scaled = ((x - m["mean"]) / m["dev"]).astype(np.float32)
    moment, second = {k: 0.0 for k in names}, {k: 0.0 for k in names}
    for step in range(1, STEPS + 1):
        h, a, g, weight, z, p = forward(m, x, bags)
        d = ((p - y) / len(y)).astype(np.float32)
        dz = np.repeat(d[:, None] * m["c"], bags, axis=0)
        da = (dz * h).sum(axis=1)
        de = weight * (da - np.repeat(_sums(weight * da, bags), bags))
        both = de[:, None] * m["w"]
        dv, du = both * g * (1 - a * a), both * a * g * (1 - g)
        dh = (weight[:, None] * dz + dv @ m["V"].T + du @ m["U"].T) * (1 - h * h)
        grad = {
            "W": scaled.T @ dh, "b": dh.sum(axis=0), "V": h.T @ dv, "v": dv.sum(axis=0), "U": h.T @ du, "u": du.sum(axis=0),
            "w": (a * g).T @ de, "c": z.T @ d, "c0": d.sum(),
        }
        for k in names:
            slope = grad[k] + 1e-5 * m[k]
            moment[k] = 0.9 * moment[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope**2
            m[k] = (m[k] - RATE * (moment[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return m


def learn(labelled: DataFrame, most: int = PASSAGES) -> dict | None:
    """A model from ``labelled`` (key, text, good), a sample with one row for each key.

    Its passages' features come to the driver: those of whole documents, in the order of a hash of their
    keys, as long as they have ``most`` passages together.
    """

    def run(batches):
        for batch in batches:
            for first, last, data, offsets in chunks(batch.column(1)):
                x, bags = encode(data, offsets)
                ends = np.cumsum(bags)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        batch.column(2).slice(first, last - first),
                        pa.array(bags.astype(np.int64)),
                        pa.array([x[b - n : b].tobytes() for b, n in zip(ends, bags, strict=True)], pa.binary()),
                    ],
                    ["key", "good", "n", "x"],
                )

    schema = StructType([labelled.schema["key"], labelled.schema["good"]]).add("n", "long").add("x", "binary")
    found = stored(labelled.select("key", "text", "good").mapInArrow(released(run), schema), "quality-features")
    order = Window.orderBy(F.xxhash64("key"), "key")  # over the sample, a number for each document
    held = found.select("key", F.sum("n").over(order).alias("upto")).filter(F.col("upto") <= most).select("key")
    rows = found.join(F.broadcast(held), "key").collect()  # bounded by ``most``
    rows.sort(key=lambda r: r.key)  # so that a fit can be repeated
    y = np.array([r.good for r in rows], np.float32)
    if not len(y) or y.min() == y.max():
        return None
    parts = [np.frombuffer(r.x, np.float32).reshape(-1, FEATURES) for r in rows]
    return fit(np.concatenate(parts), np.array([len(p) for p in parts]), y)


def score(docs: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``n_passages`` and ``attention`` (each passage's weight)."""
    new = ("score", "n_passages", "attention")
    # The text goes to Python once, inside the row.
    rows, at = packed(docs), [c.lower() for c in docs.columns].index(text.lower())
    schema = StructType(
        [rows.schema["row"], StructField("score", DoubleType()), StructField("n_passages", LongType()), StructField("attention", ArrayType(FloatType()))]
    )

    def run(batches):
        for batch in batches:
            scores, counts, weights = [], [], []
            for _, _, data, offsets in chunks(batch.column(0).field(at)):
                x, bags = encode(data, offsets)
                if model is None:
                    p, weight = np.full(len(bags), 0.5), np.repeat(1.0 / bags, bags)
                else:
                    *_, weight, _, p = forward(model, x, bags)
                scores.append(np.asarray(p, np.float64))
                counts.append(bags.astype(np.int64))
                weights.append(np.asarray(weight, np.float32))
            none = np.zeros(0)
            count = np.concatenate([*counts, none.astype(np.int64)])
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(count)).astype(np.int32)), pa.array(np.concatenate([*weights, none.astype(np.float32)]))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate([*scores, none])), pa.array(count), lists], ["row", *new]
            )

    return rows.mapInArrow(released(run), schema).select(*unpacked(docs, *new), *new)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with ``held_out``, ``score``, ``predicted``, ``n_passages`` and ``attention``.

    ``docs`` has doc_id and text, ``labels`` doc_id and quality; rows of labels without either are left out. The model is
    fitted on at most ``sample`` labelled rows that are not held out, with ``PASSAGES`` passages at most; a label given twice
    counts once, and if labels differ the lower holds; an id given twice teaches with the greatest of its texts. Input columns
    that bear the name of a new one are replaced; others may have any name. Every whole text is scored; NULL and empty ones as one empty passage. Without labels of both kinds
    every score is 0.5.
    """
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").select(F.col("doc_id").alias("key"), (F.col("quality") == 1).alias("good"))
    known = known.filter(~held_out("key")).groupBy("key").agg(F.min("good").alias("good"))
    # The sample is drawn on ids alone; so few can be sent to every task, and texts are not moved.
    known = F.broadcast(stored(known.orderBy(F.xxhash64("key"), "key").limit(sample), "quality-labels"))
    said = docs.select("doc_id", whole("text").alias("text")).join(known, F.col("doc_id") == F.col("key"))
    # An id teaches once, however many rows repeat it, with the greatest of their texts.
    taught = said.groupBy("key", "good").agg(F.max("text").alias("text"))
    found = score(docs.select(*passed(docs, "held_out", "score", "predicted", "n_passages", "attention")), learn(taught))
    return found.select(
        *passed(docs, "held_out", "score", "predicted", "n_passages", "attention"),
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "n_passages", "attention",
    )
