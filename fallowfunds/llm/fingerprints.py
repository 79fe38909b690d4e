"""Document fingerprints by I-Match with many lexicons. Native: DataFrame functions only.

Terms are kept whose document frequency lies in a band, so neither function words nor chance
spellings count. Each fingerprint part hashes the sorted distinct kept terms that fall into one
random subset of the lexicon. Subsets of four sizes serve short and long documents alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fallowfunds.llm.common import lower_ascii, packed, unpacked, whole

# Terms are counted in this many classes of their hash, so what every task holds of the lexicon has a
# fixed size. Rare terms add about (distinct terms of a document) / 2**20 of all documents to a class. Below
# some 500 distinct terms a document that is less than the band's lower end; with longer documents rare
# terms come into the lexicon by their classes, and only its upper end still tells terms apart.
CLASS_BITS = 20
WORD_BITS = 6
LOW, HIGH = 0.0005, 0.2  # the band: shares of documents a term occurs in
# (lexicon cut into this many random parts, parts used)
SUBSETS = ((16, 8), (64, 16), (256, 24), (1024, 24))
# Documents are ordered in cells of about this many, in this many cells at most: beyond that cells grow.
# Their bounds are keys of a sample of so many a cell, as in a sort by ranges; results do not depend on them.
CELL, CELLS, SAMPLED = 256, 1 << 14, 8
STEP = 128  # bounds looked at together
TIE = 32  # code points of a text that bounds tell apart where ids are equal or missing
KEY_TYPE = "struct<missing:boolean,down:bigint,tie:string>"
NO_TERM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def term_classes(text: str | Column) -> Column:
    """The sorted distinct classes of the lower-cased words of a text."""
    terms = F.array_distinct(F.array_remove(F.split(lower_ascii(whole(text)), NO_TERM, -1), ""))
    return F.array_sort(
        F.array_distinct(F.transform(terms, lambda t: F.shiftrightunsigned(F.xxhash64(t), 64 - CLASS_BITS).cast("int")))
    )


def lexicon(docs: DataFrame, text: str = "text", low: float = LOW, high: float = HIGH) -> DataFrame:
    """One row, one column: a bit for each class, set if its document frequency is in the band.

    Counts cover all rows and are summed before they are shuffled; the result has 2**20 bits.
    """
    total = docs.agg(F.count(F.lit(1)).alias("docs"))
    counted = (
        docs.select(F.explode(term_classes(text)).alias("class")).groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    )
    kept = counted.filter(
        (F.col("n") >= F.greatest(F.lit(2), F.ceil(F.lit(low) * total.scalar())))
        & (F.col("n") <= F.greatest(F.lit(2), F.floor(F.lit(high) * total.scalar())))
    )
    bits = kept.groupBy(F.shiftright("class", WORD_BITS).alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, class & {(1 << WORD_BITS) - 1})")).alias("bits")
    )
    every = docs.sparkSession.range(1 << (CLASS_BITS - WORD_BITS)).select(F.col("id").cast("int").alias("at"))
    words = every.join(bits, "at", "left").select("at", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return words.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "bits"))), lambda w: w["bits"]).alias("words"))


def _bits(lexicon_: DataFrame) -> Column:
    """The lexicon as a constant: 2**14 numbers, whatever the size of the corpus."""
    (words,) = lexicon_.first()
    return F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")


def _kept(classes: Column, words: Column) -> Column:
    word = lambda c: F.element_at(words, F.shiftright(c, WORD_BITS) + 1)
    return F.filter(classes, lambda c: F.getbit(word(c), c.bitwiseAND((1 << WORD_BITS) - 1)) == 1)


def parts(frame: DataFrame, classes: str, words: Column, out: str) -> DataFrame:
    """``out``: the fingerprint as an array of 32-bit parts; 0 where a subset has no term.

    The first part is of the text's whole kept lexicon, or of all its terms if none is kept.
    """
    kept, hashed = f"__kept_{out}", f"__hashed_{out}"
    frame = frame.withColumn(kept, _kept(F.col(classes), words))
    one = F.when(F.size(kept) > 0, F.xxhash64(kept)).otherwise(F.xxhash64(F.lit("none"), F.col(classes)))
    # Subsets go by bits of a second hash; a level's sorting out comes before its parts are looked at.
    frame = frame.withColumn(hashed, F.transform(kept, lambda c: F.hash(c, F.lit("subset"))))
    all_parts, names = [F.array(F.shiftright(one, 32).cast("int"))], []
    for place, (cut, used) in enumerate(SUBSETS):
        level = f"__level{cut}_{out}"
        names.append(level)
        in_level, level_parts = _level(cut, used, 7 * place)
        frame = frame.withColumn(level, in_level(F.col(hashed)))
        all_parts.append(level_parts(F.col(level)))
    return frame.withColumn(out, F.concat(*all_parts)).drop(kept, hashed, *names)


def _level(cut: int, used: int, shift: int):
    """(terms of the used parts of a lexicon cut into ``cut``, the hashes of those parts)."""

    def spot(h: Column) -> Column:
        return F.shiftrightunsigned(h, shift).bitwiseAND(cut - 1)

    def level_parts(terms: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(used - 1)), lambda k: _part(F.filter(terms, lambda h: spot(h) == k))
        )

    return lambda hashed: F.filter(hashed, lambda h: spot(h) < used), level_parts


def _part(terms: Column) -> Column:
    value = F.shiftright(F.xxhash64(terms), 32).cast("int")
    return F.when(F.size(terms) == 0, F.lit(0)).otherwise(F.when(value == 0, F.lit(1)).otherwise(value))


def likeness(a: str, b: str) -> Column:
    """Share of equal parts among those that are not empty in both."""
    both = F.zip_with(a, b, lambda x, y: F.when((x == 0) & (y == 0), 0).when(x == y, 1).otherwise(2))
    alike, counted = F.size(F.filter(both, lambda x: x == 1)), F.size(F.filter(both, lambda x: x > 0))
    return F.when(counted > 0, alike / counted).otherwise(1.0)


def text_of(parts_: str) -> Column:
    return F.array_join(F.transform(parts_, lambda p: F.lpad(F.hex(p.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0")), "")


def _key(doc_id: Column, text: Column) -> Column:
    """Ascending where ids descend, NULL ids come last and equal ids go by their texts."""
    down = F.coalesce(F.bitwise_not(doc_id), F.lit(0).cast("long"))
    return F.struct(doc_id.isNull().alias("missing"), down.alias("down"), F.substring(text, 1, TIE).alias("tie"))


def _cell(rows: DataFrame, cell: int = CELL) -> Column:
    """The cell of a row's key: how many bounds are not above it."""
    key = _key(F.col("id"), F.col("text"))
    n = rows.count()
    cells = max(1, min(CELLS, n // cell))
    drawn = (
        rows.select(key.alias("key"))
        .filter(F.pmod(F.xxhash64("key"), F.lit(max(n, 1))) < SAMPLED * cells)
        .distinct().orderBy("key").select(F.to_json("key").alias("key"))
    )
    keys = [r["key"] for r in drawn.collect()]
    step = max(1, len(keys) // cells)
    bounds = keys[step::step]
    runs = [bounds[i : i + STEP] for i in range(0, len(bounds), STEP)] or [[]]
    listed = ",".join(f"[{','.join(run)}]" for run in runs)
    every = F.from_json(F.lit(f"[{listed}]"), f"array<array<{KEY_TYPE}>>")
    firsts = F.from_json(F.lit(f"[{','.join(run[0] for run in runs if run)}]"), f"array<{KEY_TYPE}>")
    not_above = lambda found: F.size(F.filter(found, lambda b: b <= key))
    run = F.greatest(not_above(firsts), F.lit(1))
    return (run - 1) * STEP + not_above(F.element_at(every, run))


def with_next(docs: DataFrame, doc_id: str, text: str, cell: int = CELL) -> DataFrame:
    """(group, id, text, next_text, place, head): each row with the next one's text, by descending id.

    Rows are ordered in cells of neighbouring keys, whatever ids there are, never all in one task. A
    cell's last row has no ``next_text``: ``head``, the first text of the cell that follows, is its next.
    Rows of one id are ordered by their texts; those without an id come last, in as many cells as their
    texts' beginnings tell apart. The last row's next is the first.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), whole(text).alias("text"))
    inside = Window.partitionBy("group").orderBy(F.col("id").desc_nulls_last(), "text")
    rows = rows.withColumn("group", _cell(rows, cell)).withColumns(
        {"next_text": F.lead("text").over(inside), "place": F.row_number().over(inside)}
    )
    # One row for each cell from here on.
    along = Window.orderBy(F.col("group").desc())
    everything = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = rows.filter("place = 1").select(F.col("group").alias("of"), F.col("text").alias("head"))
    before = firsts.select(F.col("of").alias("group")).select(
        F.coalesce(F.lead("group").over(along), F.first("group").over(everything)).alias("group"), F.col("group").alias("of")
    )
    return rows.join(before.join(firsts, "of").select("group", "head"), "group", "left")


def fingerprint(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", low: float = LOW, high: float = HIGH
) -> DataFrame:
    """``docs`` with ``fingerprint``, a string of 8 hexadecimal digits for each part.

    Equal texts have equal fingerprints. NULL and empty texts have one without terms. A table too
    small for the band (no term in two documents) falls back to all terms of a text.
    """
    words = _bits(lexicon(docs, text, low, high))
    found = parts(packed(docs, classes=term_classes(text)), "classes", words, "parts")
    return found.select(*unpacked(docs, "fingerprint"), text_of("parts").alias("fingerprint"))


def compare_edits(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", low: float = LOW, high: float = HIGH
) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text is the text whose last third of code points is replaced by as many, or all, from
    the beginning of the next document by descending id. Every row is a document.
    """
    words = _bits(lexicon(docs, text, low, high))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    rows = with_next(docs, doc_id, text).withColumn("n_chars", F.char_length("text"))
    following = F.coalesce("next_text", "head", "text")
    rows = rows.withColumn(
        "edited",
        F.concat(F.expr("substring(text, 1, n_chars - cast(floor(n_chars / 3) AS int))"), F.substring(following, F.lit(1), third)),
    ).select(
        "group", "id", "place", "n_chars", "text", F.sha2("edited", 256).alias("edited_sha256"),
        term_classes("text").alias("own"), term_classes("edited").alias("changed"),
        F.when(F.col("next_text").isNull(), term_classes(F.coalesce("head", "text"))).alias("after"),
    ).drop("text")
    for column, out in (("own", "a"), ("changed", "b"), ("after", "c")):
        rows = parts(rows, column, words, out)
    inside = Window.partitionBy("group").orderBy("place")
    rows = rows.withColumn("n", F.coalesce(F.lead("a").over(inside), F.col("c")))
    return rows.select(
        F.col("id").alias("doc_id"),
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        text_of("a").alias("fingerprint"),
        text_of("b").alias("edited_fingerprint"),
        likeness("a", "b").cast("double").alias("near_edited"),
        likeness("a", "n").cast("double").alias("near_next"),
    )
