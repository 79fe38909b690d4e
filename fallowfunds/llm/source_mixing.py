"""Mixing sources to target weights by temperature. Native: DataFrame functions only.

Shares of tokens are raised to an exponent between 0 (all sources alike) and 1 (as they are) and
made to sum to 1. Each source then gets its weight's part of a token budget: whole passes over its
documents, and of one last pass as much as the budget holds.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fallowfunds.llm.common import packed, stored, unpacked, whole

GRID = 1 << 20  # exponents are multiples of 1 / GRID
SPLIT = 16  # parts an interval of exponents is cut into by one job: four bisections at once
REPEAT = 2.0  # production: no document is read more than about twice
SENT = 100_000  # sources whose plan is sent to every task at most; more are joined by a shuffle
SOURCE, TOKENS, ID = "__source", "__tokens", "__id"


def token_count(text):
    """Words between white space, the measure of a document's share."""
    return F.regexp_count(whole(text), F.lit(r"[^ \t\n\x0B\f\r]+")).cast("long")


def _measures(sizes: DataFrame, steps: list[int]) -> dict[int, dict[str, float]]:
    """For each exponent: entropy of the weights, and the most and fewest passes over a source."""
    total = sizes.agg(F.sum("tokens")).first()[0]
    p, a = F.col("tokens") / F.lit(total), F.col("step") / F.lit(GRID)
    rows = (
        sizes.select("tokens", F.explode(F.array(*[F.lit(s) for s in steps])).alias("step"))
        .groupBy("step")
        .agg(
            F.sum(F.pow(p, a)).alias("z"),
            F.sum(F.pow(p, a) * F.log(p)).alias("s"),
            F.max(F.pow(p, a - 1)).alias("most"),
            F.min(F.pow(p, a - 1)).alias("least"),
        )
        .collect()  # one row for each exponent tried
    )
    return {
        r.step: {"entropy": math.log(r.z) - r.step / GRID * r.s / r.z, "z": r.z, "most": r.most, "least": r.least}
        for r in rows
    }


def exponent(sizes: DataFrame, budget: int | None, repeat: float | None, entropy: float | None) -> float:
    """The exponent that meets the target.

    ``repeat``: the smallest at which no source is read more often than this. ``entropy`` (nats): the
    largest at which the weights have at least this much. Both measures fall as the exponent grows.
    """
    total = sizes.agg(F.sum("tokens")).first()[0]

    def flat_enough(m) -> bool:
        """True below the wanted exponent."""
        if entropy is not None:
            return m["entropy"] >= entropy
        passes = m["most"] / m["least"] if budget is None else m["most"] / m["z"] * budget / total
        return passes > repeat * (1 + 1e-12)

    low, high = 0, GRID
    ends = _measures(sizes, [low, high])
    if not flat_enough(ends[low]):
        return 0.0
    if flat_enough(ends[high]):
        return 1.0
    while high - low > 1:  # true at low, false at high
        steps = sorted({low + (high - low) * i // SPLIT for i in range(1, SPLIT)} - {low, high})
        found = _measures(sizes, steps)
        low = max([low, *(s for s in steps if flat_enough(found[s]))])
        high = min([high, *(s for s in steps if not flat_enough(found[s]))])
    return (low if entropy is not None else high) / GRID


def _key(seed: int, *parts):
    """A pseudo-random order: equal on every engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]).cast("binary"))


def _block(id_, blocks, seed: int):
    return F.conv(F.substring(_key(seed, F.lit("block"), id_), 1, 8), 16, 10).cast("long") % blocks


def _before(order, block, at_order, at_block):
    return (order < at_order) | ((order == at_order) & (block < at_block))


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    budget: int | None = None,
    repeat: float | None = REPEAT,
    entropy: float | None = None,
    seed: int = 7,
) -> DataFrame:
    """``docs`` with each row as often as its source's budget says, and ``epoch``, ``n_tokens``,
    ``weight`` (of its source), ``block`` and ``order_key`` (the order inside an epoch).

    ``budget`` counts tokens; without one it is the smallest at which every source is read in full
    at least once, so that no document goes. Passes over a source are permutations of about
    sqrt(documents) blocks and of the documents inside each; the last pass ends before the document
    that would exceed the budget, so at most that one document's tokens are left over. Only sums for
    blocks and one block of each source are ever ordered, never a whole source.

    NULL sources and ids count as ''; rows with the same id are taken together. Sources without a
    token are read once. Input columns that bear the name of a new one are replaced; an empty table
    gives an empty one.
    """
    src, key = F.coalesce(F.col(source).cast("string"), F.lit("")), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    rows = packed(docs, **{SOURCE: src, ID: key, TOKENS: token_count(text)})
    narrow = stored(rows.select(SOURCE, ID, TOKENS), "mixing")
    sizes = stored(
        narrow.groupBy(SOURCE).agg(F.sum(TOKENS).alias("tokens"), F.count(F.lit(1)).alias("docs")), "sources"
    )
    few = sizes.count() <= SENT  # then the rows of a large source need not meet in a task
    full = sizes.filter("tokens > 0")
    if full.isEmpty():
        plan = sizes.select(
            SOURCE, F.lit(0.0).alias("weight"), F.lit(1).alias("passes"), F.lit(1).cast("long").alias("blocks"),
            *[F.lit(None).cast("string").alias(c) for c in ("at_order", "at_key")], F.lit(None).cast("long").alias("at_block"),
        )
    else:
        plan = _plan(narrow, sizes, full, exponent(full, budget, repeat, entropy), budget, seed, few)
    plan = plan.select(SOURCE, *[F.col(c).alias(f"__{c}") for c in plan.columns if c != SOURCE])
    chosen = rows.join(F.broadcast(plan) if few else plan, SOURCE).withColumns(
        {"__block": _block(F.col(ID), F.col("__blocks"), seed)}
    ).withColumns(
        {
            "__order": _key(seed, F.lit("order"), F.col("__passes"), F.col(SOURCE), F.col("__block")),
            "__key": _key(seed, F.lit("doc"), F.col("__passes"), F.col(ID)),
        }
    )
    last = F.coalesce(
        _before(F.col("__order"), F.col("__block"), F.col("__at_order"), F.col("__at_block"))
        | ((F.col("__block") == F.col("__at_block")) & (F.col("__key") <= F.col("__at_key"))),
        F.lit(False),
    )
    copies = F.col("__passes") + last.cast("int")
    epochs = F.when(copies > 0, F.sequence(F.lit(0), copies - 1))
    return (
        chosen.withColumn("__epoch", F.explode(epochs))
        .select(
            *unpacked(docs, "epoch", "n_tokens", "weight", "block", "order_key"),
            F.col("__epoch").alias("epoch"),
            F.col(TOKENS).alias("n_tokens"),
            F.round("__weight", 9).alias("weight"),
            F.col("__block").alias("block"),
            F.concat(
                _key(seed, F.lit("order"), F.col("__epoch"), F.col(SOURCE), F.col("__block")),
                _key(seed, F.lit("doc"), F.col("__epoch"), F.col(ID)),
            ).alias("order_key"),
        )
    )


def _plan(narrow: DataFrame, sizes: DataFrame, full: DataFrame, alpha: float, budget: int | None, seed: int, few: bool) -> DataFrame:
    """For each source: weight, whole passes, blocks, and where its last pass ends."""
    m = _measures(full, [round(alpha * GRID)])[round(alpha * GRID)]
    total = full.agg(F.sum("tokens")).first()[0]
    tokens = total * m["z"] / m["least"] if budget is None else float(budget)
    share = F.col("tokens") / F.lit(total)
    weight = F.when(F.col("tokens") > 0, F.pow(share, F.lit(alpha)) / F.lit(m["z"])).otherwise(0.0)
    given = F.round(weight * F.lit(tokens)).cast("long")
    passes = F.when(F.col("tokens") > 0, F.floor(given / F.col("tokens"))).otherwise(1)
    budgets = sizes.select(
        SOURCE, "tokens", weight.alias("weight"), passes.cast("int").alias("passes"), given.alias("given"),
        F.ceil(F.sqrt(F.col("docs"))).cast("long").alias("blocks"),
    ).withColumn("rest", F.when(F.col("tokens") > 0, F.col("given") - F.col("passes") * F.col("tokens")).otherwise(0))
    given_to = budgets.select(SOURCE, "passes", "blocks", "rest")
    placed = narrow.join(F.broadcast(given_to) if few else given_to, SOURCE).withColumn(
        "block", _block(F.col(ID), F.col("blocks"), seed)
    )
    order = Window.partitionBy(SOURCE).orderBy("order", "block")
    ends = (
        placed.groupBy(SOURCE, "block", "passes", "rest")
        .agg(F.sum(TOKENS).alias("n"))
        .withColumn("order", _key(seed, F.lit("order"), F.col("passes"), F.col(SOURCE), F.col("block")))
        .withColumn("upto", F.sum("n").over(order))
        .filter((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") <= F.col("rest")))
        .groupBy(SOURCE)
        .agg(F.min_by(F.struct("block", "order", (F.col("rest") - F.col("upto") + F.col("n")).alias("left")), F.col("upto")).alias("at"))
        .select(SOURCE, "at.*")
    )
    # Rows of one id are peers of the running sum, so all or none of them are taken.
    inside = Window.partitionBy(SOURCE).orderBy("key")
    cut = (
        placed.join(ends, [SOURCE, "block"])
        .withColumn("key", _key(seed, F.lit("doc"), F.col("passes"), F.col(ID)))
        .withColumn("upto", F.sum(TOKENS).over(inside))
        .filter(F.col("upto") <= F.col("left"))
        .groupBy(SOURCE)
        .agg(F.max("key").alias("at_key"))
    )
    return (
        budgets.select(SOURCE, "weight", "passes", "blocks")
        .join(ends.select(SOURCE, F.col("order").alias("at_order"), F.col("block").alias("at_block")), SOURCE, "left")
        .join(cut, SOURCE, "left")
    )
