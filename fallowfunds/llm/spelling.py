"""Groups of spelling variants: words one edit apart, found through Bloom filters.

Every word generates the words one deletion or replacement away (an insertion is a deletion seen from
the other word, and of two words that differ by a replacement only one generates the other). These
are looked up as rolling hashes in Bloom filters of the vocabulary, one for each length, that every
task holds. Only what the filters let through becomes text and is joined with the vocabulary, which
removes what they let through wrongly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fallowfunds.llm import bloom
from fallowfunds.llm.common import lower_ascii, stored
from fallowfunds.llm.flat import BASE, mix

FILTER_BYTES = 32 << 20  # of all filters together
LENGTHS = 64  # words of this length and longer share a filter
SYMBOLS = 1 << 22  # places of words tried at once, unless one word has more

# Fixed values of the query contract: letters of words, and the share of runs that lose one.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
ALPHABET = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], np.int64)
LOSE_OF = 97

_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def occurrences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", letters: int = 1) -> DataFrame:
    """(word) for every run of at least ``letters`` letters: lower-cased, and one code point shorter
    where its hash with the document's id says so."""
    runs = docs.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(lower_ascii(F.col(f"`{text}`")), F.lit(RUN), F.lit(0))).alias("run"),
    ).filter(F.length("run") >= letters)
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.select(F.when(h % LOSE_OF == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", letters: int = 5, least: int = 3) -> DataFrame:
    """(word, n): words of at least ``letters`` code points that occur at least ``least`` times."""
    words = occurrences(docs, doc_id, text, letters).filter(F.length("word") >= letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n + 1, BASE, np.uint64), np.uint64(pow(BASE, -1, 1 << 64))
    up[0] = 1
    return np.cumprod(up, dtype=np.uint64), down


def _by_length(words: list[bytes], most: int = SYMBOLS):
    """(places of words, their letters as a matrix) of words of one length, a bounded number at once."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(size).tolist():
        own = np.flatnonzero(size == length)
        step = max(1, most // max(length, 1))
        for i in range(0, len(own), step):
            rows = own[i : i + step]
            yield rows, np.frombuffer(b"".join([words[r] for r in rows]), np.uint8).reshape(len(rows), length)


def _sums(letters: np.ndarray) -> np.ndarray:
    """The hash sums of words, before spreading."""
    up, _ = _powers(letters.shape[1])
    return (_VALUES[letters] * up[:-1]).sum(axis=1, dtype=np.uint64)


def _hash(sums: np.ndarray, length: int) -> np.ndarray:
    return mix(sums + np.uint64(length))


def edits(letters: np.ndarray, filters: dict[int, np.ndarray]):
    """(row, place, letter) of the edits of words that the filters hold; letter -1 is a deletion."""
    n, length = letters.shape
    up, down = _powers(length)
    values = _VALUES[letters] * up[:-1]
    total = values.sum(axis=1, dtype=np.uint64)
    before = np.cumsum(values, axis=1, dtype=np.uint64) - values
    none = np.zeros(0, np.uint64)
    if length > 1:
        # Of equal letters in a row the first alone is deleted: the others give the same word.
        row, place = np.nonzero(np.concatenate([np.ones((n, 1), bool), letters[:, 1:] != letters[:, :-1]], axis=1))
        head = before[row, place]
        sums = head + (total[row] - head - values[row, place]) * down
        found = bloom.holds(filters.get(min(length - 1, LENGTHS), none), _hash(sums, length - 1))
        yield row[found], place[found], np.full(found.sum(), -1)
    for letter in ALPHABET.tolist():
        row, place = np.nonzero(letters < letter)
        sums = total[row] + _VALUES[letter] * up[place] - values[row, place]
        found = bloom.holds(filters.get(min(length, LENGTHS), none), _hash(sums, length))
        yield row[found], place[found], np.full(found.sum(), letter)


def _filters(words: DataFrame):
    def run(batches):
        for batch in batches:
            rows = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
            for _, letters in _by_length(rows):
                length = letters.shape[1]
                hashes = _hash(_sums(letters), length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(hashes), min(length, LENGTHS), np.int32)), pa.array(hashes.view(np.int64))],
                    ["shard", "hash"],
                )

    return bloom.broadcast(words.select("word").mapInArrow(run, "shard int, hash long"), FILTER_BYTES)


def links(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n), both ways: the words of ``words(word, n)`` that differ by exactly one
    inserted, deleted or replaced code point."""
    known = _filters(words)

    def run(batches):
        for batch in batches:
            rows = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
            for own, letters in _by_length(rows):
                for row, place, letter in edits(letters, known.value):
                    if len(row):
                        at = own[row]
                        near = [
                            (rows[w][:i] + (bytes([c]) if c >= 0 else b"") + rows[w][i + 1 :]).decode("latin-1")
                            for w, i, c in zip(at.tolist(), place.tolist(), letter.tolist(), strict=True)
                        ]
                        where = pa.array(at)
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(where), batch.column(1).take(where), pa.array(near, pa.string())],
                            ["word", "n", "near"],
                        )

    tried = words.select("word", "n").mapInArrow(run, "word string, n long, near string")
    there = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    one = stored(tried.join(there, "near").select("word", "n", "near", "near_n"), "links")
    other = one.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return one.unionByName(other)


def _best(n: str, near: str) -> Column:
    """The near word of largest count, of equal ones the first."""
    return F.min(F.struct((-F.col(n)).alias("less"), F.col(near).alias("form")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain of ``forms(word, form)``. Counts at least double from
    a word to its form, so chains are short and never closed; each step halves what is left of them."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = stored(step, "roots")
        now = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return now


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", letters: int = 5, least: int = 3, times: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary.

    ``form`` is the near word of largest count (ties: the first in code-point order) if that is at
    least ``times`` the word's own, else NULL; ``root`` ends the chain of forms. NULL texts have no
    words, a NULL id counts as an empty one in the hash. Rows that repeat count each time; other
    columns are not read. Words of any length are compared as a whole.
    """
    words = stored(vocabulary(docs, doc_id, text, letters, least), "words")
    near = links(words).groupBy("word").agg(F.first("n").alias("n"), F.count("*").alias("n_near"), _best("near_n", "near").alias("best"))
    form_n = -F.col("best.less")
    near = stored(
        near.select("word", "n_near", F.when(form_n >= F.col("n") * times, F.col("best.form")).alias("form"),
                    F.when(form_n >= F.col("n") * times, form_n).alias("form_n")),
        "near",
    )
    ends = roots(near.filter("form IS NOT NULL").select("word", "form"))
    return (
        words.join(near, "word", "left").join(ends, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
    )
