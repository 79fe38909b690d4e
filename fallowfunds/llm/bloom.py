"""Blocked Bloom filters over 64-bit hashes, built in tasks and sent to every task.

A filter never has more than ``most`` bytes, whatever goes into it: a fuller one lets more false
positives through, which its users remove by an exact join or count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fallowfunds.llm.flat import mix

BITS_EACH = 16  # bits for each hash, as long as the bound allows
PROBES = 4  # bits set in one block
BLOCK = 512  # bits of a block: one line of a CPU's cache


def places(hashes: np.ndarray, blocks: int) -> list[np.ndarray]:
    """The places of the bits of each hash, all in one block."""
    spread = mix(hashes)
    base = ((spread >> np.uint64(36)) % np.uint64(blocks)) * np.uint64(BLOCK)
    return [base + ((spread >> np.uint64(9 * i)) & np.uint64(BLOCK - 1)) for i in range(PROBES)]


def holds(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """True for all hashes that are in the filter, and for a few others."""
    blocks = len(words) * 64 // BLOCK
    if not blocks:
        return np.zeros(len(hashes), bool)
    found = np.ones(len(hashes), bool)
    for at in places(hashes, blocks):
        found &= (words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return found


def broadcast(hashed: DataFrame, most: int) -> Broadcast:
    """{shard: words of its filter} of ``hashed(shard int, hash long)``, at most ``most`` bytes in all.

    Bits are set in tasks and united by a grouped OR; the driver gets no hashes, only the filters.
    """
    spark = hashed.sparkSession
    counts = {r["shard"]: r["n"] for r in hashed.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    share = min(1.0, most * 8 / max(1, sum(max(n * BITS_EACH, BLOCK) for n in counts.values())))
    blocks = {s: max(1, int(max(n * BITS_EACH, BLOCK) * share) // BLOCK) for s, n in counts.items()}

    def bits(batches):
        for batch in batches:
            shards, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.uint64)
            for shard in np.unique(shards).tolist():
                at = np.unique(np.concatenate(places(hashes[shards == shard], blocks[shard])))
                word, first = np.unique(at >> np.uint64(6), return_index=True)
                masks = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(word), shard, np.int32)), pa.array(word.astype(np.int64)), pa.array(masks.view(np.int64))],
                    ["shard", "word", "mask"],
                )

    united = (
        hashed.select("shard", "hash").mapInArrow(bits, "shard int, word long, mask long")
        .groupBy("shard", "word").agg(F.bit_or("mask").alias("mask"))
    )
    table = united.toArrow() if counts else None
    filters = {s: np.zeros(n * BLOCK // 64, np.uint64) for s, n in blocks.items()}
    if table is not None:
        shard, word, mask = (table.column(i).to_numpy() for i in range(3))
        for s, words in filters.items():
            own = shard == s
            words[word[own]] = mask[own].view(np.uint64)
    return spark.sparkContext.broadcast(filters)


def may_hold(hashes: Column, filters: Broadcast, shard: int = 0) -> Column:
    """Whether a filter holds a column of 64-bit hashes. Only the hashes go to Python."""

    @F.arrow_udf("boolean")
    def found(column: pa.Array) -> pa.Array:
        words = filters.value.get(shard, np.zeros(0, np.uint64))
        return pa.array(holds(words, column.to_numpy(zero_copy_only=False).astype(np.uint64)))

    return found(hashes)
