"""Benchmark decontamination by winnowing. Native: DataFrame functions only.

Of every six neighbouring five-word hashes of a text the least is kept. Two texts that share ten
words in a row share such a fingerprint, whatever surrounds it. Documents with a fingerprint of the
benchmark are looked at again: the ten-word windows around each hit are compared as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fallowfunds.llm.common import lower_ascii, packed, quoted, unpacked, whole

WINDOW = 10  # words that count as contamination
# explode_outer keeps the optimizer from pushing a filter on the array's size below the arrays it is
# made of, where they would all be worked out again.
GRAM = 5  # words of a hash
SPAN = WINDOW - GRAM + 1  # neighbouring hashes of which the least is kept
# Fixed by the query contract: words are runs of digits, letters a-z and all beyond ASCII.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ROW = "__row"


def words(text: str | Column) -> Column:
    return F.array_remove(F.split(lower_ascii(whole(text)), NO_WORD, -1), "")


def _pairs(a: Column, b: Column, n: Column, function) -> Column:
    """``function`` of the first ``n`` elements of two arrays; empty where ``n`` is not positive."""
    size = F.greatest(n, F.lit(0))
    return F.zip_with(F.slice(a, 1, size), F.slice(b, 1, size), function)


def _after(a: Column, skip: int) -> Column:
    return F.slice(a, skip + 1, F.greatest(F.size(a) - skip, F.lit(0)))


def gram_hashes(frame: DataFrame, column: str = "words") -> DataFrame:
    """``grams``: the hash of each five neighbouring words, by place."""
    one, two, four = F.col("__one"), F.col("__two"), F.col("__four")
    pair = lambda x, y: F.xxhash64(x, y)
    return (
        frame.withColumn("__one", F.transform(column, lambda w: F.xxhash64(w)))
        .withColumn("__two", _pairs(one, _after(one, 1), F.size(one) - 1, pair))
        .withColumn("__four", _pairs(two, _after(two, 2), F.size(two) - 2, pair))
        .withColumn("grams", _pairs(four, _after(one, 4), F.size(four) - 1, pair))
        .drop("__one", "__two", "__four")
    )


def fingerprints(frame: DataFrame) -> DataFrame:
    """``prints``: the distinct least hashes of all windows of ``grams``."""
    least = lambda x, y: F.least(x, y)
    grams, two, four = F.col("grams"), F.col("__min2"), F.col("__min4")
    return (
        frame.withColumn("__min2", _pairs(grams, _after(grams, 1), F.size(grams) - 1, least))
        .withColumn("__min4", _pairs(two, _after(two, 2), F.size(two) - 2, least))
        .withColumn("prints", F.array_distinct(_pairs(four, _after(four, 2), F.size(four) - 2, least)))
        .drop("__min2", "__min4")
    )


def _window(words_: Column, start: Column, length) -> Column:
    return F.array_join(F.slice(words_, start + 1, length), " ")


def _starts(n: Column, length) -> Column:
    return F.when(n >= length, F.sequence(F.lit(0), n - length)).otherwise(F.array().cast("array<int>"))


def item_windows(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """(length, window, items): each distinct window and the sorted ids of its items, as text."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), words(text).alias("words")).filter(
        F.size("words") > 0
    )
    length = F.least(F.size("words"), F.lit(WINDOW))
    return (
        items.select("item", "words", length.alias("length"))
        .select("item", "length", "words", F.explode_outer(_starts(F.size("words"), F.col("length"))).alias("start"))
        .select("item", "length", _window(F.col("words"), F.col("start"), F.col("length")).alias("window"))
        .groupBy("length", "window")
        .agg(F.collect_set(F.coalesce("item", F.lit(""))).alias("items"))
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items`` (sorted), ``n_items`` and ``contaminated``.

    Words are compared after lowering A-Z. An item's windows are its ten neighbouring words, or the
    whole of an item with fewer; a document's word inside an occurrence of one is hit. Every row is a
    document; NULL and empty texts have no words and no hits, items without words match nothing,
    items without an id count as ''. Input columns that bear the name of a new one are replaced.
    """
    rows = packed(docs, text=quoted(text)).withColumn(ROW, F.monotonically_increasing_id())
    bench = item_windows(benchmark, item_id, item_text)
    item_prints = (
        fingerprints(gram_hashes(benchmark.select(words(item_text).alias("words"))))
        .select(F.explode_outer("prints").alias("print"))
        .filter("print IS NOT NULL")
        .distinct()
    )
    doc_words = rows.select(ROW, words("text").alias("words"))
    hits = (
        fingerprints(gram_hashes(doc_words))
        .select(ROW, F.explode_outer("prints").alias("print"))
        .join(item_prints, "print", "left_semi")
        .groupBy(ROW)
        .agg(F.collect_list("print").alias("found"))
    )
    near = gram_hashes(rows.select(ROW, "text").join(hits, ROW).select(ROW, "found", words("text").alias("words")))
    last = F.size("words") - WINDOW
    places = F.filter(
        F.sequence(F.lit(0), F.size("grams") - 1),
        lambda at: F.array_contains("found", F.element_at("grams", at + 1)),
    )
    around = F.transform(
        places, lambda at: F.sequence(F.greatest(at - SPAN + 1, F.lit(0)), F.greatest(F.least(at, last), F.lit(0)))
    )
    candidates = (
        near.filter(last >= 0)
        .select(ROW, "words", F.explode_outer(F.array_distinct(F.flatten(around))).alias("start"))
        .select(ROW, "start", F.lit(WINDOW).alias("length"), _window(F.col("words"), F.col("start"), WINDOW).alias("window"))
    )
    # Items shorter than a window have no fingerprints to rely on; there are nine lengths at most.
    for (length,) in bench.filter(F.col("length") < WINDOW).select("length").distinct().collect():
        short = doc_words.select(ROW, "words", F.explode_outer(_starts(F.size("words"), length)).alias("start"))
        candidates = candidates.unionByName(
            short.select(ROW, "start", F.lit(length).alias("length"), _window(F.col("words"), F.col("start"), length).alias("window"))
        )
    found = (
        candidates.join(bench, ["length", "window"])
        .groupBy(ROW)
        .agg(
            F.collect_list(F.struct("start", "length")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("__items"),
        )
        .select(
            ROW,
            "__items",
            F.size(
                F.array_distinct(
                    F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))
                )
            ).alias("__hit"),
        )
    )
    none = F.array().cast("array<string>")
    counted = rows.withColumn("__words", F.regexp_count(lower_ascii(whole("text")), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")))
    return counted.join(found, ROW, "left").select(
        *unpacked(docs, "n_words", "n_hit", "items", "n_items", "contaminated"),
        F.col("__words").cast("long").alias("n_words"),
        F.coalesce("__hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("__items", none).alias("items"),
        F.when(F.col("__items").isNull(), 0).otherwise(F.size("__items")).cast("long").alias("n_items"),
        F.coalesce(F.col("__hit") > 0, F.lit(False)).alias("contaminated"),
    )
