"""Line dedup: lines that many documents share go, the others stay in their order.

Native: DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fallowfunds.llm.common import SPACES, field, lower_ascii, packed, stored, unpacked, whole

SENT = 500_000  # shared lines that are sent to every task at most (16 bytes each); more are joined by a shuffle


def _fingerprint(key):
    """128 bits of a normalised line."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit("line"), key).alias("b"))


def shared_keys(docs: DataFrame, text: str, min_docs: int, min_chars: int) -> DataFrame:
    """(a, b): fingerprints of the normalised lines found in at least ``min_docs`` rows.

    A row offers each of its lines once, and counts are summed before they are shuffled, so a line
    that every document holds costs one row for each task.
    """
    key = lambda line: lower_ascii(F.btrim(line, F.lit(SPACES)))
    keys = F.array_distinct(F.transform(F.split(whole(text), "\n", -1), key))
    return (
        docs.select(F.explode(keys).alias("key"))
        .filter(F.char_length("key") >= min_chars)
        .select(_fingerprint(F.col("key")).alias("f"))
        .groupBy(F.col("f.a").alias("a"), F.col("f.b").alias("b"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_docs)
        .select("a", "b")
    )


def drop_shared_lines(
    docs: DataFrame, text: str = "text", min_docs: int = 10, min_chars: int = 1
) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped``.

    A text is split at line feeds. A line's key is the line without white space at its ends and with
    A-Z in lower case. Keys of ``min_chars`` code points or more that ``min_docs`` rows hold lose all
    their lines; the rest is joined again by position.

    Every row is a document of its own, also where an id is repeated or NULL. A NULL text is one
    empty line. All other columns are passed through, except such as bear the name of a new one; an
    empty table gives an empty one. A document left without lines has the empty text.
    """
    rows = packed(docs).withColumn("at", F.monotonically_increasing_id())
    said = whole(field(docs, text))
    key = lambda line: lower_ascii(F.btrim(line, F.lit(SPACES)))
    lines = rows.select("at", F.posexplode(F.split(said, "\n", -1)).alias("pos", "line"))
    placed = lines.select("at", "pos", key(F.col("line")).alias("key")).select(
        "at", "pos", _fingerprint(F.col("key")).alias("f")
    ).select("at", "pos", F.col("f.a").alias("a"), F.col("f.b").alias("b"))
    shared = stored(shared_keys(docs, text, min_docs, min_chars), "shared-lines")
    if shared.count() <= SENT:  # so the many copies of one line need not meet in a task
        shared = F.broadcast(shared)
    gone = placed.join(shared, ["a", "b"], "left_semi").groupBy("at").agg(F.collect_list("pos").alias("gone"))
    found = rows.join(gone, "at", "left")
    all_lines = F.split(said, "\n", -1)
    kept = F.when(F.col("gone").isNull(), said).otherwise(
        F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("gone")),
                lambda at: F.element_at(all_lines, at + 1),
            ),
            "\n",
        )
    )
    # In two steps: inside a lambda a name would be looked for among the caller's columns as well.
    return found.select(
        "row",
        kept.alias("kept_text"),
        F.size(all_lines).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
    ).select(*unpacked(docs, "kept_text", "n_lines", "n_dropped"), "kept_text", "n_lines", "n_dropped")
