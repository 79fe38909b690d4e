"""Token ids in ORC: integer run-length encoding, row indexes, Bloom filters on document ids.

Python is used for the tokenizer and checksums; Spark sorts, writes, prunes and reads.
"""

from __future__ import annotations

import os
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fallowfunds.llm.common import released, whole
from fallowfunds.llm.flat import Hasher, chunks

FILE_SCHEMA = "doc_id long, shard int, local_start long, n_tokens long, ids array<int>"
BLOOM_FALSE_POSITIVES = 0.01
STRIPE = 16 << 20  # bytes of a stripe, the unit of parallel reads; a writer holds one in memory
ROWS_PER_INDEX = 1000  # rows between two entries of a stripe's row index
CACHED = 800_000  # pieces a worker remembers before it forgets the rarer ones
AT_ONCE = 4_000  # pieces given to the tokenizer in one call

# Classes of bytes for cutting a text where the tokenizer's pattern cuts it in any case.
OTHER, BLANK, BREAK, LETTER, MARK, QUOTE = range(6)
_CLASS = np.zeros(256, np.uint8)
_CLASS[33:127] = MARK
_CLASS[[*range(48, 58)]] = OTHER
_CLASS[[*range(65, 91), *range(97, 123)]] = LETTER
_CLASS[39] = QUOTE
_CLASS[32] = BLANK
_CLASS[10] = BREAK


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where every byte-level pattern of the GPT-2 kind begins a new piece; sorted.

    These are: before a lone blank and around a lone line feed between visible characters; between
    a letter and an ASCII mark, in this order, and between a mark other than a quote and an ASCII
    letter. Visible is decided on ASCII and two-byte letters alone; elsewhere nothing is cut, which
    only makes pieces longer.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    kind = _CLASS[data]
    # Letters of two bytes that begin with C3 (Latin-1 letters, without its two signs).
    lead = data == 0xC3
    tail = np.zeros(n, bool)
    tail[1:] = lead[:-1] & (data[1:] != 0x97) & (data[1:] != 0xB7)
    starts = np.zeros(n, bool)
    starts[:-1] = tail[1:]
    begins = (kind == LETTER) | starts  # a letter begins here
    ends = (kind == LETTER) | tail  # a letter ends here
    mark = (kind == MARK) | (kind == QUOTE)
    digit = (data >= 48) & (data <= 57)
    seen_after, seen_before = begins | mark | digit, ends | mark | digit
    cut = np.zeros(n + 1, bool)
    gap = np.zeros(n, bool)
    gap[1:-1] = seen_before[:-2] & seen_after[2:]
    cut[:n] |= gap & ((kind == BLANK) | (kind == BREAK))
    cut[1:][gap & (kind == BREAK)] = True
    cut[1:n] |= ends[:-1] & mark[1:]
    cut[1:n] |= (kind[:-1] == MARK) & begins[1:]
    cut[offsets] = True
    cut[n] = False
    return np.flatnonzero(cut)


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``np.unique`` returns with index and inverse. Values are hashed, and only the distinct ones are sorted."""
    found = pa.array(values).dictionary_encode()
    place = found.indices.to_numpy()
    order = np.argsort(found.dictionary.to_numpy())
    first = np.empty(len(order), np.int64)
    first[place[::-1]] = np.arange(len(values) - 1, -1, -1)  # of equal places the last one written stays
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return found.dictionary.to_numpy()[order], first[order], rank[place]


class PieceEncoder:
    """Encodes each distinct piece once with the tokenizer and puts documents together from pieces.

    A text that holds a special token of the tokenizer is encoded as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)  # a byte-level token's letters are its bytes
        self.bytes[list(vocabulary.values())] = list(map(len, vocabulary))
        self.keys = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)
        self.first = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.seen = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def _forget(self) -> None:
        """Keep the half of the pieces that came up most often; those seen once go in any case."""
        seen = self.seen[self.slot]
        kept = np.sort(np.argsort(-seen, kind="stable")[: CACHED // 2])
        kept = kept[seen[kept] > 1]
        slot = self.slot[kept]
        size, first = self.size[slot], self.first[slot]
        begin = np.cumsum(size) - size
        self.pool = self.pool[np.arange(int(size.sum())) + np.repeat(first - begin, size)]
        self.keys, self.slot = self.keys[kept], np.arange(len(kept))
        self.first, self.size, self.seen = begin, size, np.ones(len(kept), np.int64)

    def _tokens(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of them each piece has) of distinct pieces.

        Pieces that begin with a blank and a visible character and end visibly are encoded in a row:
        between two of them every pattern begins anew. Other pieces are encoded one by one.
        """
        kind, lead = _CLASS[data], data == 0xC3
        visible = (kind == LETTER) | (kind == MARK) | (kind == QUOTE) | ((data >= 48) & (data <= 57))
        tail = np.append(False, lead[:-1]) & (data != 0x97) & (data != 0xB7)
        second = np.minimum(start + 1, len(data) - 1)
        after = np.minimum(start + 2, len(data) - 1)
        begins = visible[second] | (lead[second] & tail[after] & (end > start + 2))
        plain = (kind[start] == BLANK) & (end > start + 1) & begins & (visible | tail)[end - 1]
        size = np.zeros(len(start), np.int64)
        flats, order = [], []
        raw = data.tobytes()
        own = np.flatnonzero(plain)
        for i in range(0, len(own), AT_ONCE):
            some = own[i : i + AT_ONCE]
            text = b"".join([raw[a:b] for a, b in zip(start[some].tolist(), end[some].tolist(), strict=True)])
            (found,) = self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)
            ids = np.array(found.ids, np.int32)
            upto = np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum(end[some] - start[some])) + 1
            size[some] = np.diff(upto, prepend=0)
            flats.append(ids)
            order.append(some)
        own = np.flatnonzero(~plain)
        for i in range(0, len(own), AT_ONCE):  # an encoding takes far more memory than its ids
            some = own[i : i + AT_ONCE]
            pieces = [raw[a:b].decode() for a, b in zip(start[some].tolist(), end[some].tolist(), strict=True)]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
            size[some] = list(map(len, found))
            flats.append(np.fromiter(chain.from_iterable(found), np.int32, int(size[some].sum())))
            order.append(some)
        # Back into the order of the pieces.
        order, flat = np.concatenate(order), np.concatenate(flats)
        begin = np.empty(len(start), np.int64)
        begin[order] = np.cumsum(size[order]) - size[order]
        total = np.cumsum(size)
        return flat[np.arange(total[-1]) + np.repeat(begin - (total - size), size)], size

    def _learn(self, keys: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        ids, size = self._tokens(data, start, end)
        first = len(self.pool) + np.cumsum(size) - size
        slot = np.arange(len(self.first), len(self.first) + len(keys))
        self.pool = np.concatenate([self.pool, ids])
        self.first, self.size = np.concatenate([self.first, first]), np.concatenate([self.size, size])
        self.seen = np.concatenate([self.seen, np.zeros(len(keys), np.int64)])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.slot = np.insert(self.keys, at, keys), np.insert(self.slot, at, slot)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of the rows in them)."""
        start = cuts(data, offsets)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        end = np.append(start[1:], len(data))
        keys, where, which = distinct(Hasher(data)(start, end))
        if len(self.keys) + len(keys) > CACHED:
            self._forget()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        if len(self.keys):
            new = self.keys[np.minimum(at, len(self.keys) - 1)] != keys
        if new.any():
            self._learn(keys[new], data, start[where[new]], end[where[new]])
        found = self.slot[np.searchsorted(self.keys, keys)]
        self.seen[found] += 1
        slot = found[which]
        size, first = self.size[slot], self.first[slot]
        total = np.concatenate([[0], np.cumsum(size)])
        take = np.arange(total[-1]) + np.repeat(first - total[:-1], size)
        return self.pool[take], total[np.searchsorted(start, offsets)]

    def stretches(self, column: pa.Array, end_id: int):
        """(first row, last row, ids, sizes) of stretches of rows; each row ends with ``end_id``."""
        for first, last, data, offsets in chunks(column):
            ids, at = self.encode(data, offsets)
            raw = data.tobytes()
            if any(s in raw for s in self.special):
                rows = []
                for i in range(last - first):
                    text = raw[offsets[i] : offsets[i + 1]]
                    row = ids[at[i] : at[i + 1]]
                    if any(s in text for s in self.special):
                        row = np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, np.int32)
                    rows.append(row)
                ids, at = np.concatenate(rows), np.cumsum([0, *map(len, rows)])
            yield first, last, np.insert(ids, at[1:], np.int32(end_id)), np.diff(at) + 1


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        # A task has one core, and the library's threads would each keep memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def encode(docs: DataFrame, tokenizer: str, end_id: int, text: str = "text") -> DataFrame:
    """``FILE_SCHEMA`` rows: the ids of each whole text and ``end_id``, in the order of ``doc_id``.

    ``shard`` is the place of the row's range of ids; ``local_start`` counts the tokens before the
    row in its shard. NULL texts are empty. Rows without or with repeated ids are kept, rows without
    one first; ties are in the order of their texts.
    """

    def run(batches):
        shard, before = TaskContext.get().partitionId(), 0
        tok = encoder(tokenizer)
        for batch in batches:
            for first, last, ids, size in tok.stretches(batch.column(1), end_id):
                ends = np.cumsum(size)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids))
                columns = [
                    batch.column(0).slice(first, last - first), pa.array(np.full(len(size), shard, np.int32)),
                    pa.array(before + ends - size), pa.array(size), lists,
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "shard", "local_start", "n_tokens", "ids"])
                before += int(ends[-1])

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(text).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return ordered.mapInArrow(released(run), FILE_SCHEMA)


def write(tokens: DataFrame, path: str) -> None:
    """The rows as ORC. Files are in the order of ids, so a range of ids is in few of their stripes."""
    (
        tokens.write.mode("overwrite")
        .option("compression", "zstd")
        .option("orc.stripe.size", STRIPE)
        .option("orc.row.index.stride", ROWS_PER_INDEX)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", BLOOM_FALSE_POSITIVES)
        .orc(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """The files. A filter on ``doc_id`` is pushed to statistics, row indexes and Bloom filters."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def with_starts(tokens: DataFrame) -> DataFrame:
    """``start``: tokens of all rows before. Tokens are not moved: the sums that every task gets are
    one row for each shard, so no more than the job that wrote the files had tasks."""
    totals = tokens.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    return tokens.join(F.broadcast(bases), "shard").withColumn("start", F.col("base") + F.col("local_start"))


def checksums(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): CRC-32 of the ids as little-endian unsigned 32-bit."""

    def run(batches):
        for batch in batches:
            ids = batch.column(3)
            offsets = ids.offsets.to_numpy()
            data = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
            sums = [zlib.crc32(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        released(run), "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
