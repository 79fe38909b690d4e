"""Phrases of two to four words that occur together, from a prefix-free parse of the texts.

Pieces of texts are cut into chunks where the hash of the next three words says so. A chunk goes on
to the end of those three words, which also begin the next one, so every phrase lies whole in a
chunk; the chunk in which it begins before those three words counts it, and no other. Equal chunks
are one entry of a dictionary with the number of times they occur, and all counts are sums over
distinct chunks times that number.

Counts are made by length, and a longer phrase is counted only if every part of two words (or every
word) may occur often enough. Those parts are looked up in Bloom filters of fixed size; what these let
through wrongly is counted too, and drops out by its count.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fallowfunds.llm import bloom
from fallowfunds.llm.common import stored
from fallowfunds.llm.flat import BASE, Hasher, buffers, chunks, mix, runs

LONGEST = 4  # words of a phrase
OVERLAP = LONGEST - 1  # words that a chunk shares with the next
TRIGGER = 16  # one of so many places begins a chunk
FILTER_BYTES = 16 << 20  # of each Bloom filter sent to tasks
SALTS = 64  # parts of a language ranked on their own first
UNKNOWN = "und"

# Fixed values of the query contract.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_ENDS, _BLANKS = np.zeros(256, bool), np.zeros(256, bool)
_ENDS[list(ENDS)] = True
_BLANKS[list(BLANKS)] = True
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32


def gather(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Stretches of bytes as a column of text."""
    size = end - start
    ends = np.concatenate([[0], np.cumsum(size)])
    take = np.arange(ends[-1]) - np.repeat(ends[:-1] - start, size)
    return pa.LargeStringArray.from_buffers(
        len(start), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[take]))
    ).cast(pa.string())


def spaced(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, end) of the words with one blank after each."""
    size = end - start + 1
    after = np.cumsum(size)
    first = after - size
    take = np.arange(int(after[-1]) if len(after) else 0) - np.repeat(first - start, size)
    out = data[np.minimum(take, len(data) - 1)] if len(take) else np.zeros(0, np.uint8)
    out[after - 1] = 32
    return out, first, after - 1


def parse(data: np.ndarray, offsets: np.ndarray, trigger: int = TRIGGER):
    """(row, text, words that begin phrases here) of the chunks of texts."""
    ends = _ENDS[data]
    start, end, row = runs(~(ends | _BLANKS[data]), offsets)
    data, total = _SMALL[data], len(start)
    if not total:
        return row, pa.array([], pa.string()), row
    piece = np.cumsum(ends)[start]
    new = np.append(True, (piece[1:] != piece[:-1]) | (row[1:] != row[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], total)  # where each word's piece ends
    until = np.repeat(last, last - first)
    word = Hasher(data)(start, end)
    window = word.copy()
    for i in range(1, OVERLAP):
        window[:-i] += word[i:] * np.uint64(pow(BASE, 2 * i + 1, 1 << 64))
    begins = new | ((np.arange(total) + OVERLAP <= until) & (mix(window) % np.uint64(trigger) == 0))
    at = np.flatnonzero(begins)
    stop = until[at]
    ends_piece = np.append(new[at[1:]], True)
    after = np.append(at[1:], total)
    stop = np.where(ends_piece, stop, after + OVERLAP)
    own = np.where(ends_piece, stop, after) - at
    data, start, end = spaced(data, start, end)
    return row[at], gather(data, start[at], end[stop - 1]), own


def dictionary(docs: DataFrame, text: str = "text", lang: str = "lang", trigger: int = TRIGGER) -> DataFrame:
    """(lang, chunk, own, n): the distinct chunks, the words in each that begin phrases counted in it,
    and how often it occurs."""

    def run(batches):
        for batch in batches:
            for first, last, data, offsets in chunks(batch.column(1)):
                row, chunk, own = parse(data, offsets, trigger)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first).take(pa.array(row)), chunk, pa.array(own.astype(np.int32))],
                    ["lang", "chunk", "own"],
                )

    rows = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text}`").cast("string").alias("text")
    )
    cut = rows.mapInArrow(run, "lang string, chunk string, own int")
    return cut.groupBy("lang", "chunk", "own").agg(F.count("*").alias("n"))


def _hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, lang: np.ndarray) -> np.ndarray:
    return mix(Hasher(data)(start, end) ^ lang)


def _column_hash(column: pa.Array) -> np.ndarray:
    data, offsets = buffers(column)
    return Hasher(data)(offsets[:-1], offsets[1:])


def _filter(phrases: DataFrame) -> Broadcast:
    """A Bloom filter of (lang, phrase)."""

    def run(batches):
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            hashes = _hash(data, offsets[:-1], offsets[1:], _column_hash(batch.column(0)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(hashes), np.int32)), pa.array(hashes.view(np.int64))], ["shard", "hash"]
            )

    return bloom.broadcast(phrases.select("lang", "phrase").mapInArrow(run, "shard int, hash long"), FILTER_BYTES)


def counted(chunk_table: DataFrame, lengths: tuple[int, ...], least: int, part: int = 0, known: Broadcast | None = None) -> DataFrame:
    """(lang, phrase, size, f) of the phrases of these lengths that occur at least ``least`` times.

    ``known`` holds the phrases of ``part`` words that do; others that have a part beyond it are left
    out before they are counted.
    """

    def run(batches):
        for batch in batches:
            for first, last, data, offsets in chunks(batch.column(1)):
                start, end, row = runs(data != 32, offsets)
                lang = _column_hash(batch.column(0).slice(first, last - first))
                own = batch.column(2).slice(first, last - first).to_numpy()
                begin = np.searchsorted(row, np.arange(last - first))  # a row's first word
                place = np.arange(len(row)) - begin[row]
                total = np.bincount(row, minlength=last - first)[row]
                if known is not None:
                    good = np.zeros(len(row), bool)
                    fits = np.flatnonzero(place + part <= total)
                    words = known.value.get(0, np.zeros(0, np.uint64))
                    good[fits] = bloom.holds(words, _hash(data, start[fits], end[fits + part - 1], lang[row[fits]]))
                for size in lengths:
                    take = (place < own[row]) & (place + size <= total)
                    if known is not None:
                        for i in range(size - part + 1):
                            take[: len(take) - i] &= good[i:]
                    at = np.flatnonzero(take)
                    where = pa.array(row[at] + first)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(where), gather(data, start[at], end[at + size - 1]),
                         pa.array(np.full(len(at), size, np.int32)), batch.column(3).take(where)],
                        ["lang", "phrase", "size", "n"],
                    )

    rows = chunk_table.select("lang", "chunk", "own", "n").mapInArrow(run, "lang string, phrase string, size int, n long")
    sums = rows.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("f"))
    return sums.filter(F.col("f") >= least)


def frequent(chunk_table: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, size, f) of all phrases of up to LONGEST words that occur at least ``least`` times."""
    levels, part, known = [], 0, None
    for sizes in ((1,), (2,), (3, 4)):
        levels.append(stored(counted(chunk_table, sizes, least, part, known), "phrases"))
        if sizes != (3, 4):
            part, known = sizes[0], _filter(levels[-1])
    return reduce(DataFrame.unionByName, levels)


def _words(first: str, count: str) -> F.Column:
    return F.expr(f"array_join(slice(words, {first}, {count}), ' ')")


def scored(phrases: DataFrame, scale: int = 2_000_000) -> DataFrame:
    """(lang, phrase, size, a, l, r, score) of the phrases of two words and more, cut where they hold
    together least; all their parts are in ``phrases``."""
    long = phrases.filter("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    cut = long.withColumn("k", F.explode(F.expr("sequence(1, size - 1)"))).select(
        "lang", "phrase", "size", "a", "k", _words("1", "k").alias("first"), _words("k + 1", "size - k").alias("rest")
    )
    parts = phrases.select("lang", "phrase", "f")
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    both = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    # Whole numbers of 38 digits; the quotient is at most half the scale, as no part is rarer than a.
    exact = F.expr(f"CAST(a AS DECIMAL(20, 0)) * {scale} div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    least = both.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct(exact.cast("long").alias("score"), "k", "l", "r")).alias("cut"))
    return least.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")


def contained(phrases: DataFrame, percent: int) -> DataFrame:
    """(lang, phrase) of phrases that lie in a longer one of ``percent`` or more of their count."""
    longer = phrases.filter("size > 2").select("size", "lang", F.split("phrase", " ").alias("words"), F.col("f").alias("around"))
    inside = (
        longer.withColumn("count", F.explode(F.expr("sequence(2, size - 1)")))
        .withColumn("first", F.explode(F.expr("sequence(1, size - count + 1)")))
        .groupBy("lang", _words("first", "count").alias("phrase"))
        .agg(F.max("around").alias("around"))
    )
    own = phrases.filter("size > 1").select("lang", "phrase", "f")
    exact = F.expr(f"CAST(around AS DECIMAL(20, 0)) * 100 >= CAST(f AS DECIMAL(20, 0)) * {percent}")
    return own.join(inside, ["lang", "phrase"]).filter(exact).select("lang", "phrase")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, top: int = 2000, percent: int = 80,
    trigger: int = TRIGGER,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases.

    NULL texts are empty, a NULL language is ``und``; a language without such phrases has no row. Rows
    that repeat count each time; other columns are not read, whatever their names. Ties are in the
    order of counts, then of the bytes of the phrase. A language's rows are ranked in parts first, so
    the last ranking sees at most ``top`` rows of each part.
    """
    table = stored(dictionary(docs, text, lang, trigger), "chunks")
    phrases = stored(frequent(table, least), "phrases")
    kept = scored(phrases).join(contained(phrases, percent), ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = kept.withColumn("salt", F.expr(f"pmod(xxhash64(phrase), {SALTS})"))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    totals = table.groupBy(F.col("lang").alias("of")).agg(F.sum(F.col("own") * F.col("n")).alias("n"))
    return best.join(totals, best["lang"] == totals["of"]).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
