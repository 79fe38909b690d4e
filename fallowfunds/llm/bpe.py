"""Byte-level BPE: exact encoding by tree concatenation, and decoding.

A text of more than LEAF bytes is cut blindly into leaves that tasks encode on their own, wherever
its words or runs end. Encodings are then put together in a tree. At each join a window of tokens on
both sides is encoded anew and grows until both sides agree:

* an edge of the window lies where no piece of the tokenizer's pattern can go on, or
* the window's outermost token there is the token that the side has in its place.

Byte pair encoding merges by rank, so a row of tokens is the encoding of its bytes if every two
neighbours are the encoding of theirs. An edge that agrees has neighbours that one side already had,
so the joined tokens are those of the whole text, also inside a run without any break.

Python is used for the tokenizer; Spark deals out leaves and gathers them by text.
"""

from __future__ import annotations

import json
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fallowfunds.llm.common import passed, quoted

LEAF = 1 << 16  # bytes of a text that one task encodes in one go
WINDOW = 64  # bytes on each side of a join that are encoded anew at first

# Fixed values of byte-level vocabularies: the bytes that stand for themselves. The others are
# written as the characters from U+0100 on, in order.
VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
# Fixed value: the pattern that byte-level tokenizer files name by ``use_regex``.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class UnsupportedTokenizer(ValueError):
    """The file is not a byte-level BPE that merges in the order of its ids."""


def _spelled() -> dict[str, int]:
    hidden = sorted(set(range(256)) - set(VISIBLE))
    return {chr(b): b for b in VISIBLE} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def _ranks(file: dict) -> tuple[dict[bytes, int], dict[str, int]]:
    """(id of each token's bytes, ids of special texts) of a tokenizer file; raises unless its result
    follows from ids, the byte-level pattern and special texts alone."""
    model, before = file["model"], file.get("pre_tokenizer") or {}
    added = file.get("added_tokens") or []
    plain = not any(
        model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    )
    bare = not any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
    level = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    if model.get("type") != "BPE" or not (plain and bare and level) or file.get("normalizer"):
        raise UnsupportedTokenizer("only byte-level BPE files without normalizer and prefix are encoded")
    special = {t["content"]: t["id"] for t in added}
    byte = _spelled()
    ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [model["vocab"].get("".join(m)) for m in merges]
    if None in made or made != sorted(made) or len(set(made)) != len(made) or any(bytes([b]) not in ranks for b in range(256)):
        raise UnsupportedTokenizer("ids do not follow the order of merges")
    return ranks, special


class Codec:
    """Encodes and decodes as the tokenizer file says, without adding special tokens."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import pre_tokenizers

        with open(path, encoding="utf-8") as file:
            ranks, special = _ranks(json.load(file))
        self.core = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special = set(special)
        self.bytes = [b""] * (max([*ranks.values(), *special.values()]) + 1)
        for token, i in [*ranks.items(), *((s.encode(), i) for s, i in special.items())]:
            self.bytes[i] = token
        self.window = max([WINDOW, *(2 * len(s.encode()) for s in special)])
        self.pieces = lru_cache(1 << 16)(pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str)

    def leaf(self, text: str) -> list[int]:
        """The ids of a text, in one go."""
        return self.core.encode(text, allowed_special=self.special, disallowed_special=())

    def decode(self, ids: list[int]) -> str:
        """The text of any ids. Bytes that are no UTF-8 become U+FFFD, as whole wrong sequences."""
        token = self.bytes
        return b"".join([token[i] for i in ids]).decode("utf-8", "replace")

    def _text(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes[i] for i in ids])

    def _left_edge(self, ids: list[int], width: int) -> int:
        """The place of a token, at least ``width`` bytes before the end, where a window may begin."""
        at, size = len(ids), 0
        while at:
            at -= 1
            size += len(self.bytes[ids[at]])
            if size >= width and at and _whole(self.bytes[ids[at]]):
                near = self._text(ids[max(at - 3, 0) : at + 1])
                cut = len(near) - len(self.bytes[ids[at]])
                if b"'" not in near[max(cut - 3, 0) : cut + 1]:
                    break
        return at

    def _right_edge(self, ids: list[int], width: int) -> tuple[int, bool]:
        """(tokens from the beginning up to where a window may end, whether a piece ends there)."""
        at, size = 0, 0
        while at < len(ids):
            size += len(self.bytes[ids[at]])
            at += 1
            if size < width or at == len(ids) or not _whole(self.bytes[ids[at]]):
                continue
            before = self._text(ids[max(at - 8, 0) : at])[-8:].decode("utf-8", "ignore")
            after = self._text(ids[at : at + 4]).decode("utf-8", "ignore")[:1]
            # A blank's piece depends on what follows, and an apostrophe may begin a piece of its own.
            if not after or before[-1].isspace() or "'" in before[-3:] + after:
                continue
            return at, len(self.pieces(before[-1] + after)) > 1
        return at, True

    def join(self, left: list[int], right: list[int], width: int | None = None) -> list[int]:
        """The ids of a text from those of its two parts."""
        if not left or not right:
            return left or right
        width = width or self.window
        while True:
            a = self._left_edge(left, width)
            b, ended = self._right_edge(right, width)
            middle = self.leaf((self._text(left[a:]) + self._text(right[:b])).decode())
            if (a == 0 or middle[0] == left[a]) and (ended or middle[-1] == right[b - 1]):
                return left[:a] + middle + right[b:]
            width *= 2

    def tree(self, parts: list[list[int]], width: int | None = None) -> list[int]:
        """The ids of a text from those of its parts, joined two by two."""
        while len(parts) > 1:
            parts = [self.join(*pair, width) if len(pair := parts[i : i + 2]) == 2 else pair[0] for i in range(0, len(parts), 2)]
        return parts[0] if parts else []


def _whole(token: bytes) -> bool:
    """Whether a token begins where a character begins."""
    return bool(token) and not 0x80 <= token[0] < 0xC0


def leaves(text: str, size: int = LEAF) -> list[str]:
    """The text in parts of at most ``size`` bytes, cut between characters only."""
    data = text.encode()
    size, out, at = max(size, 4), [], 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and 0x80 <= data[end] < 0xC0:
            end -= 1
        out.append(data[at:end].decode())
        at = end
    return out


@lru_cache(4)
def codec(path: str) -> Codec:
    """A worker's codec of a file."""
    return Codec(path)


def _lists(rows: list[list[int]]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)])
    flat = np.fromiter(chain.from_iterable(rows), np.int32, int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))


def _encoded(text: Column, tokenizer: str) -> Column:
    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        encode = codec(tokenizer).leaf
        return _lists([encode(t) if t else [] for t in texts.to_pylist()])

    return ids(text)


def _cut(text: Column, size: int) -> Column:
    @F.arrow_udf("array<string>")
    def parts(texts: pa.Array) -> pa.Array:
        return pa.array([leaves(t, size) for t in texts.to_pylist()], pa.list_(pa.string()))

    return parts(text)


def _joined(parts: Column, tokenizer: str) -> Column:
    @F.arrow_udf("array<int>")
    def ids(nested: pa.Array) -> pa.Array:
        return _lists([codec(tokenizer).tree(row) for row in nested.to_pylist()])

    return ids(parts)


def encode(docs: DataFrame, tokenizer: str, text: str = "text", leaf: int = LEAF) -> DataFrame:
    """The rows of ``docs`` with ``ids array<int>``: the whole text as the tokenizer file encodes it.

    NULL and empty texts have no ids. Special texts of the file count as special wherever they stand.
    Rows that repeat stay, whatever their other columns are called or hold; a column called ``ids``
    gives way to the result. Texts beyond ``leaf`` bytes are cut, dealt out, encoded and joined; their
    order among the rows is not kept.
    """
    size = F.octet_length(quoted(text))
    kept = passed(docs, "ids")
    short = docs.filter(size.isNull() | (size <= leaf)).select(*kept, _encoded(quoted(text), tokenizer).alias("ids"))

    names = [c for c in docs.columns if c.lower() != "ids"]
    others = [quoted(c).alias(f"c{i}") for i, c in enumerate(names) if c != text]
    # Equal rows are one row with a count; the key spreads copies of one text that differ elsewhere.
    row = F.struct(*others, F.lit(0).alias("end"))
    micros = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    long = docs.filter(size > leaf).select(row.alias("row"), quoted(text).alias("text"))
    cut = long.select(
        "row",
        F.sha2(F.concat_ws("\n", F.to_json("row", micros), "text"), 256).alias("key"),
        F.posexplode(_cut(F.col("text"), leaf)).alias("pos", "leaf"),
    )
    dealt = cut.groupBy("key", "pos").agg(
        F.any_value("leaf").alias("leaf"),
        F.any_value(F.when(F.col("pos") == 0, F.col("row"))).alias("row"),
        F.count("*").alias("n"),
    )
    parts = dealt.select("key", F.struct("pos", "leaf", _encoded(F.col("leaf"), tokenizer).alias("ids"), "row", "n").alias("part"))
    # Rows of one key are one text, which the result holds in one row in any case.
    gathered = parts.groupBy("key").agg(
        F.array_sort(F.collect_list("part"), lambda a, b: a["pos"] - b["pos"]).alias("parts")
    )
    first = F.col("parts")[0]
    whole = gathered.select(
        first["row"].alias("row"),
        F.array_join(F.col("parts")["leaf"], "").alias("text"),
        _joined(F.col("parts")["ids"], tokenizer).alias("ids"),
        F.explode(F.sequence(F.lit(1).cast("long"), first["n"])).alias("copy"),
    ).select(
        *[F.col("text").alias(c) if c == text else F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(names)], "ids"
    )
    return short.union(whole)


def decode(tokens: DataFrame, tokenizer: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows with the text of ``ids`` in column ``out``, special tokens included; NULL ids have
    no text. Ids that the file does not have are an error."""

    @F.arrow_udf("string")
    def texts(lists: pa.Array) -> pa.Array:
        back = codec(tokenizer).decode
        ends = lists.offsets.to_numpy()
        flat = lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]].tolist()
        ends = (ends - ends[0]).tolist()
        rows = [back(flat[a:b]) for a, b in zip(ends, ends[1:])]
        return pa.array(rows, pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))

    return tokens.select(*passed(tokens, out), texts(quoted(ids)).alias(out))
