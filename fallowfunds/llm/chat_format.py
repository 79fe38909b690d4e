"""Chat formatting: whole conversations, encoded once, with loss masks aligned by offsets.

Template of a turn: ``### role:``, a line feed, the text, a line feed, ``</turn>`` and a line feed.
A text never begins with white space in it (a backslash comes before), so the line feeds around a text
are pieces of their own for tokenizers that part white space from what follows, and every text begins
and ends where a token does.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, ESCAPE = "### ", "\n</turn>\n", "\\"
OUT = (
    "conv_id long, formatted string, ids array<int>, token_start array<int>, token_end array<int>, "
    "loss_tokens array<boolean>"
)


def _hidden(text: str) -> str:
    text = text.replace(ESCAPE, ESCAPE * 2).replace("</turn>", "<\\/turn>")
    return text.replace("##", "#\\#").replace("##", "#\\#")


def escape(text: str) -> str:
    """A text in which neither ``##`` nor ``</turn>`` occurs, nor white space at the beginning; :func:`unescape` reverses it."""
    return (ESCAPE if text[:1].isspace() else "") + _hidden(text)


def escape_role(role: str) -> str:
    """A role without ``##`` and ``</turn>``, in one line."""
    return _hidden(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    if ESCAPE not in text:
        return text
    out, at = [], 0
    while (hit := text.find(ESCAPE, at)) >= 0:
        out += (text[at:hit], "\n" if text[hit + 1] == "n" else text[hit + 1])
        at = hit + 2
    return "".join([*out, text[at:]])


def render(turns: list[tuple[str, str]]) -> tuple[str, list[int], list[int]]:
    """(formatted text, starts, ends of the turns' texts in it)."""
    parts, starts, ends, at = [], [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape_role(role)}:\n", escape(text)
        starts.append(at + len(head))
        ends.append(starts[-1] + len(body))
        parts += (head, body, CLOSE)
        at = ends[-1] + len(CLOSE)
    return "".join(parts), starts, ends


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        head = formatted.index(":\n", at)
        end = formatted.index(CLOSE, head + 2)
        turns.append((unescape(formatted[at + len(OPEN) : head]), unescape(formatted[head + 2 : end])))
        at = end + len(CLOSE)
    return turns


def covered(starts, ends, token_start: np.ndarray, token_end: np.ndarray) -> np.ndarray:
    """Mask of the tokens that share characters with a span.

    Spans and tokens are sorted; the spans a token meets are found by binary search. A token that holds
    characters of a span and others is an error: its loss could not be that of the span alone.
    """
    starts, ends = np.asarray(starts, np.int64), np.asarray(ends, np.int64)
    real = ends > starts
    starts, ends = starts[real], ends[real]
    if not len(starts) or not len(token_start):
        return np.zeros(len(token_start), bool)
    first = np.searchsorted(ends, token_start, "right")  # the first span that ends after the token begins
    last = np.searchsorted(starts, token_end, "left")  # the first that begins at its end or later
    mask = (last > first) & (token_end > token_start)
    span = first[mask]
    if ((token_start[mask] < starts[span]) | (token_end[mask] > ends[span])).any():
        raise ValueError("the tokenizer makes tokens across the ends of turns, so a mask of tokens cannot be exact")
    return mask


def stretches(mask: np.ndarray, token_start: np.ndarray, token_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the characters of masked tokens. Tokens of one character of several bytes have the
    same offsets, so they and tokens that follow each other merge."""
    a, b = token_start[mask], token_end[mask]
    if not len(a):
        return a, b
    reach = np.maximum.accumulate(b)
    fresh = np.append(True, a[1:] > reach[:-1])
    return a[fresh], reach[np.append(np.flatnonzero(fresh)[1:] - 1, len(a) - 1)]


_TOKENIZERS: dict = {}


def _tokenizer(path: str):
    if path not in _TOKENIZERS:
        from tokenizers import Tokenizer

        _TOKENIZERS[path] = Tokenizer.from_file(path)
        _TOKENIZERS[path].encode_special_tokens = True  # their strings in a text are ordinary text
    return _TOKENIZERS[path]


def format_conversations(
    turns: DataFrame, tokenizer: str, loss_roles: tuple[str, ...] = ("assistant",)
) -> DataFrame:
    """One row for each ``conv_id``: formatted text, ids, token offsets and the loss mask.

    Turns are ordered by ``turn``, then role and text, so that ties have one order; repeated rows
    stay. NULL roles and texts are empty, NULL turns come first, rows without ``conv_id`` are one
    conversation. Other columns are not read, whatever their names; an empty table gives an empty one.
    ``loss_tokens`` marks the tokens of the texts of ``loss_roles``, and no token of the template; a
    tokenizer that makes tokens across a turn's ends is refused (see :func:`covered`).
    A conversation is rendered and encoded as a whole, so one task must hold one conversation.
    """

    def run(batches):
        tok = _tokenizer(tokenizer)
        for batch in batches:
            texts, ids, places, masks = [], [], [], []
            for said in batch.column(1).to_pylist():
                text, starts, ends = render([(t["role"], t["text"]) for t in said])
                held = [i for i, t in enumerate(said) if t["role"] in loss_roles]
                found = tok.encode(text, add_special_tokens=False)
                at = np.array(found.offsets, np.int32).reshape(-1, 2)
                texts.append(text)
                ids.append(np.array(found.ids, np.int32))
                places.append(at)
                masks.append(covered([starts[i] for i in held], [ends[i] for i in held], at[:, 0], at[:, 1]))
            offsets = pa.array(np.cumsum([0, *map(len, ids)]).astype(np.int32))
            at = np.concatenate([*places, np.zeros((0, 2), np.int32)])
            flat = [np.concatenate([*ids, np.zeros(0, np.int32)]), at[:, 0].copy(), at[:, 1].copy(), np.concatenate([*masks, np.zeros(0, bool)])]
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in flat]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), *lists],
                ["conv_id", "formatted", "ids", "token_start", "token_end", "loss_tokens"],
            )

    empty = F.lit("")
    said = F.struct("turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    whole = (
        turns.select(F.col("conv_id").cast("long").alias("conv_id"), said.alias("said"))
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("said")).alias("said"))
    )
    return whole.mapInArrow(run, OUT)


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from the output: turns from the text, loss text from the masked tokens' offsets."""

    def run(batches):
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for batch in batches:
            rows = []
            limits = batch.column(4).offsets.to_numpy()
            start, end, mask = (batch.column(i).values.to_numpy(zero_copy_only=False) for i in (2, 3, 4))
            for i, (conv_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                own = slice(limits[i], limits[i + 1])
                a, b = stretches(mask[own], start[own], end[own])
                turns = parse(text)
                loss = "".join(unescape(text[x:y]) for x, y in zip(a.tolist(), b.tolist(), strict=True))
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                rows.append((conv_id, len(turns), sha(said), len(loss), sha(loss), len(text)))
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names
            )

    return formatted.select("conv_id", "formatted", "token_start", "token_end", "loss_tokens").mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long",
    )
