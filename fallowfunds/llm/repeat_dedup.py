"""Removal of long byte strings that occur more than once.

A sparse suffix order takes the place of a full one: of each stretch of SPREAD places in a text the
one with the least hash of its next bytes is an anchor, so equal strings of LENGTH bytes hold the
same anchor at the same place. Only suffixes that begin at anchors are ordered:

1.  Anchors whose next CORE bytes occur once in the corpus are alone in their block of the suffix
    order and drop out; counts of 64-bit hashes tell.
2.  Anchors all of whose strings lie in a longer repeated string are settled by one more count; one
    of them goes on in the place of all.
3.  What is left lies at the borders of repeats. Every shard sends these suffixes in its own order,
    each with the bytes before it (the Burrows-Wheeler column, as far back as a string reaches). The
    runs of the shards are merged by interleave refinement: blocks of equal prefixes are split by the
    next eight bytes, in one stable pass of all rows still in company, until all are alone or LENGTH
    is reached. The pass that splits two neighbours gives their common prefix. Intervals of common
    prefix LENGTH - d whose rows agree in the d bytes before the anchor are repeated strings.

So every string of LENGTH bytes is judged, on the input, without ordering all suffixes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from fallowfunds.llm.common import packed, quoted, stored, unpacked, whole
from fallowfunds.llm.flat import Hasher, buffers, chunks, mix

LENGTH = 200  # bytes of a string that must not occur twice
SPREAD = 128  # places of which one is an anchor: a power of two
GRAM = 12  # bytes whose hash chooses anchors
CROWD = 20_000  # suffixes of one block beyond which its strings are counted one by one
BLOCK_ROWS = 8192  # suffixes merged at once, unless one block has more



def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """(row, anchor, first start, last start) of the strings of ``length`` bytes, by anchor.

    Places count from the row's first byte. All strings that begin between the two starts hold the
    anchor as the place of least hash among their first SPREAD.
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none
    begin = np.arange(n - GRAM + 1)
    bits = np.uint64(max(int(n).bit_length(), 1))
    least = (Hasher(data)(begin, begin + GRAM) >> bits << bits) | begin.astype(np.uint64)
    width = 1
    while width < SPREAD:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    size = np.diff(offsets)
    count = np.maximum(size - length + 1, 0)
    start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(offsets[:-1], count)
    if not len(start):
        return none, none, none, none
    anchor = (least[start] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    row = np.repeat(np.arange(len(size)), count)
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    row = row[first]
    return row, anchor[first] - offsets[row], start[first] - offsets[row], start[last] - offsets[row]


def suffixes(docs: DataFrame, length: int) -> DataFrame:
    """(core, hull, key, anchor, first, last) of every anchor of (key, text).

    ``core`` hashes the bytes all its strings share after the anchor, ``hull`` those of all of them.
    """

    def run(batches):
        for batch in batches:
            for at, to, data, offsets in chunks(batch.column(1)):
                row, anchor, first, last = anchors(data, offsets, length)
                if not len(row):
                    continue
                base, hashed = offsets[row], Hasher(data)
                core = hashed(base + anchor, base + anchor + length - SPREAD + 1)
                hull = hashed(base + first, base + last + length)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(core.view(np.int64)), pa.array(hull.view(np.int64)),
                        batch.column(0).slice(at, to - at).take(pa.array(row)),
                        *(pa.array(x.astype(np.int32)) for x in (anchor, first, last)),
                    ],
                    ["core", "hull", "key", "anchor", "first", "last"],
                )

    return docs.mapInArrow(run, "core long, hull long, key long, anchor int, first int, last int")


def _right(data: np.ndarray, place: np.ndarray, end: np.ndarray, skip: int) -> np.ndarray:
    """Eight bytes from ``place + skip`` as one number, first byte highest; zeros beyond ``end``."""
    out = np.zeros(len(place), np.uint64)
    for i in range(8):
        at = place + skip + i
        byte = data[np.minimum(at, len(data) - 1)].astype(np.uint64)
        out = (out << np.uint64(8)) | np.where(at < end, byte, np.uint64(0))
    return out


def contexts(docs: DataFrame, length: int) -> DataFrame:
    """Suffixes in the order of their shard, with the bytes around them.

    ``docs`` has (key, text, hard), ``hard`` the anchors to send. Those in a crowd are sent as the
    hashes of their strings instead (``alone``), a row for each.
    """
    schema = "core long, shard long, rank int, key long, anchor int, first int, last int, bytes binary, alone boolean"

    def run(batches):
        shard = TaskContext.get().partitionId() << 32
        for batch in batches:
            keys, lists = batch.column(0).to_numpy(), batch.column(2)
            for at, to, data, offsets in chunks(batch.column(1)):
                shard += 1
                part = lists.slice(at, to - at)
                hard = part.flatten()
                core, anchor, first, last = (hard.field(f).to_numpy().astype(np.int64) for f in ("core", "anchor", "first", "last"))
                crowd = hard.field("crowd").to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(to - at), part.value_lengths().to_numpy())
                base = offsets[row]
                few = np.flatnonzero(~crowd)
                end = base + last + length
                order = few[np.lexsort([_right(data, (base + anchor)[few], end[few], 8 * i) for i in (2, 1, 0)] + [core[few]])]
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(core[order]), pa.array(np.full(len(order), shard)), pa.array(np.arange(len(order), dtype=np.int32)),
                        pa.array(keys[at:to][row[order]]), *(pa.array(x[order].astype(np.int32)) for x in (anchor, first, last)),
                        pa.array([raw[a:b] for a, b in zip((base + first)[order], end[order], strict=True)], pa.binary()),
                        pa.array(np.zeros(len(order), bool)),
                    ],
                    schema_names,
                )
                many = np.flatnonzero(crowd)
                if len(many):
                    count = (last - first + 1)[many]
                    which = np.repeat(many, count)
                    start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[which]
                    hashed = Hasher(data)(base[which] + start, base[which] + start + length)
                    zero = np.zeros(len(which), np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(hashed.view(np.int64)), pa.array(zero.astype(np.int64)), pa.array(zero), pa.array(keys[at:to][row[which]]),
                            pa.array(zero), *[pa.array(start.astype(np.int32))] * 2, pa.nulls(len(which), pa.binary()), pa.array(np.ones(len(which), bool)),
                        ],
                        schema_names,
                    )

    schema_names = [c.split()[0] for c in schema.split(", ")]
    return docs.mapInArrow(run, schema)


def merge(core: np.ndarray, data: np.ndarray, anchor: np.ndarray, end: np.ndarray, length: int = LENGTH):
    """(order, common): the merged order of suffixes and each one's common prefix with the one before.

    Rows come as runs, each in order, block by block. Blocks are refined by eight bytes at a time;
    rows alone in a block are in place and take no further part.
    """
    n = len(core)
    order = np.argsort(core, kind="stable")  # the runs of a block one after the other
    common = np.zeros(n, np.int64)
    fresh = np.append(True, core[order][1:] != core[order][:-1])  # a block begins here
    active = np.arange(n)
    for depth in range(0, length, 8):
        begins = fresh[active]
        # alone: begins a block, and the next place begins one or does not follow it
        follows = np.append(active[1:] == active[:-1] + 1, False)
        ends = ~follows | np.append(begins[1:], True)
        active = active[~(begins & ends)]
        if not len(active):
            break
        rows = order[active]
        block = np.cumsum(fresh[active])
        symbol = _right(data, anchor[rows], end[rows], depth)
        inside = np.lexsort((symbol, block))
        order[active], symbol = rows[inside], symbol[inside]
        split = np.append(False, (symbol[1:] != symbol[:-1]) & (block[1:] == block[:-1]))
        differ = (symbol[1:] ^ symbol[:-1])[split[1:]]
        same = np.zeros(len(differ), np.int64)
        for i in range(1, 8):  # whole equal bytes from the top
            same += (differ >> np.uint64(64 - 8 * i)) == 0
        common[active[split]] = depth + same
        fresh[active[split]] = True
    together = ~fresh
    common[together] = length
    return order, common


def repeated(core: np.ndarray, data: np.ndarray, at: np.ndarray, anchor: np.ndarray, first: np.ndarray, last: np.ndarray, length: int = LENGTH):
    """(least, greatest) distance from an anchor back to a repeated string's start; (1, 0) if none.

    Suffix i has the bytes from ``at[i]`` on, which stand for the text from ``first[i]`` on.
    """
    place = at[:-1] + anchor - first
    order, common = merge(core, data, place, at[1:], length)
    place, near, far = place[order], (anchor - last)[order], (anchor - first)[order]
    low, high = np.ones(len(core), np.int64), np.zeros(len(core), np.int64)
    seen = np.zeros(len(core), bool)
    before = np.zeros(len(core), np.uint64)  # hash of the bytes before the anchor
    for d in range(int(far.max()) + 1 if len(far) else 0):
        if d:
            reach = far >= d
            before[reach] = mix(before[reach] * np.uint64(0x100000001B3) + data[place[reach] - d] + np.uint64(1))
        here = np.flatnonzero((near <= d) & (d <= far))
        if len(here) < 2:
            continue
        interval = np.cumsum(common < length - d)[here].astype(np.uint64)
        key = mix(interval + np.uint64(0x9E3779B97F4A7C15)) ^ before[here]
        by = np.argsort(key)
        twin = np.append(False, key[by][1:] == key[by][:-1])
        hit = here[by[twin | np.append(twin[1:], False)]]
        low[hit[~seen[hit]]] = d
        seen[hit] = True
        high[hit] = d
    out_low, out_high = np.ones_like(low), np.zeros_like(high)
    out_low[order], out_high[order] = low, high
    return out_low, out_high


def merged_spans(rows: DataFrame, length: int) -> DataFrame:
    """(key, start, end) of repeated strings, from suffixes sorted by core, shard and rank."""
    columns = ["core", "key", "anchor", "first", "last", "bytes"]

    def settle(table):
        table = table.combine_chunks()
        core, key, anchor, first, last = (table.column(c).to_numpy().astype(np.int64) for c in columns[:-1])
        data, at = buffers(table.column("bytes").combine_chunks())
        low, high = repeated(core, data, at, anchor, first, last, length)
        found = high >= low
        return pa.RecordBatch.from_arrays(
            [pa.array(key[found]), *(pa.array(x[found].astype(np.int32)) for x in (anchor - high, anchor - low + length))],
            ["key", "start", "end"],
        )

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size < BLOCK_ROWS:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            core = table.column("core").to_numpy()
            cut = int(np.searchsorted(core, core[-1]))  # the last block may go on in the next batch
            if cut:
                yield settle(table.slice(0, cut))
                held, size = table.slice(cut).to_batches(), len(core) - cut
            else:
                held = table.to_batches()
        if held:
            yield settle(pa.Table.from_batches(held))

    return rows.select(*columns).mapInArrow(run, "key long, start int, end int")


def cut_out(docs: DataFrame) -> DataFrame:
    """``docs`` (row, text, spans) with ``kept`` (bytes), ``n_bytes``, ``n_removed`` and ``n_spans`` for text and spans."""
    results = ("kept", "n_bytes", "n_removed", "n_spans")
    schema = StructType([docs.schema["row"], StructField("kept", BinaryType()), *[StructField(c, LongType()) for c in results[1:]]])

    def run(batches):
        for batch in batches:
            raws, lists = batch.column(1).to_pylist(), batch.column(2)
            kept, sizes, removed, counts = [], [], [], []
            for raw, found in zip(raws, lists, strict=True):
                raw = (raw or "").encode()
                sizes.append(len(raw))
                if not found.is_valid or not len(found):
                    kept.append(raw)
                    removed.append(0)
                    counts.append(0)
                    continue
                start, end = (found.values.field(f).to_numpy() for f in ("start", "end"))
                order = np.argsort(start, kind="stable")
                start, reach = start[order], np.maximum.accumulate(end[order])
                new = np.append(True, start[1:] > reach[:-1])
                a, b = start[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]
                kept.append(b"".join(raw[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(raw)], strict=True)))
                removed.append(int((b - a).sum()))
                counts.append(len(a))
            numbers = [pa.array(x, pa.int64()) for x in (sizes, removed, counts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()), *numbers], ["row", *results])

    return docs.select("row", "text", "spans").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """``docs`` without ``text``'s repeated strings: ``kept`` (bytes), ``n_bytes``, ``n_removed``, ``n_spans``.

    Each byte that a string of ``length`` bytes covers goes if the string also starts anywhere else,
    in any row or the same one; strings are judged on the input and do not cross rows. Every row is a
    document: rows repeated as a whole repeat their strings. NULL texts are empty. Input columns that
    bear the name of a new one are replaced. ``kept`` is bytes, as a cut can part a character.
    ``length`` must be more than SPREAD + GRAM.
    """
    # A row's key comes from its content: two scans, or a scan after a lost executor, agree on it.
    keyed = packed(docs, key=F.xxhash64(quoted(doc_id).cast("string"), whole(text)), text=whole(text))
    all_suffixes = suffixes(keyed.select("key", "text"), length)
    cores = all_suffixes.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    company = stored(all_suffixes.join(cores, "core"), "suffixes")
    place = F.struct("key", "anchor")
    hulls = company.groupBy("hull").agg(F.count(F.lit(1)).alias("h"), F.min(place).alias("one")).filter("h > 1")
    judged = stored(
        company.join(hulls, "hull", "left").select(
            "core", "n", "key", "anchor", "first", "last", F.col("h").isNotNull().alias("within"),
            # One suffix of a settled hull stands for it where its block has others.
            (F.col("h").isNull() | ((F.col("n") > F.col("h")) & (place == F.col("one")))).alias("open"),
        ),
        "judged",
    )
    settled = judged.filter("within").select("key", F.col("first").alias("start"), (F.col("last") + length).alias("end"))
    hard = (
        judged.filter("open")
        .groupBy("key")
        .agg(F.collect_set(F.struct("core", "anchor", "first", "last", (F.col("n") > CROWD).alias("crowd"))).alias("hard"))
    )
    sent = keyed.select("key", "text").join(hard, "key")
    around = stored(contexts(sent.select("key", "text", "hard"), length), "contexts")
    runs_ = around.filter("NOT alone").repartition("core").sortWithinPartitions("core", "shard", "rank")
    close = merged_spans(runs_, length)
    single = around.filter("alone").select(F.col("core").alias("string"), "key", F.col("first").alias("start"))
    twice = single.groupBy("string").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("string")
    crowded = single.join(twice, "string", "left_semi").select("key", "start", (F.col("start") + length).cast("int").alias("end"))
    spans = (
        settled.select("key", "start", F.col("end").cast("int").alias("end")).unionByName(close).unionByName(crowded)
        .groupBy("key")
        .agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    )
    new = ("kept", "n_bytes", "n_removed", "n_spans")
    return cut_out(keyed.join(spans, "key", "left")).select(*unpacked(docs, *new), *new)
