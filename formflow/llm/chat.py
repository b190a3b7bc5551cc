"""Chat formatting with offset-aligned loss masks.

Conversations are rendered whole, encoded once with offsets, and the sorted spans of the turns' texts meet the sorted spans
of the tokens by binary search. The template's control strings are single tokens, so no token crosses a turn's border.

Control strings inside roles and texts are escaped by one more backslash after their first character (``</s>`` becomes
``<\\/s>``, and that becomes ``<\\\\/s>``), which reading back takes away again: every text survives.

Rows are sorted by (conversation, turn, role, text) within partitions and streamed; a conversation is emitted in parts of
about ``PART_CHARS`` characters cut between turns, so memory does not grow with a conversation's length.

Edge cases: null roles and texts are empty; null turns come first; rows with the same turn are ordered by role and text and
repeated rows stay repeated turns; rows with a null id form one conversation without id; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Strings that mean something to a chat template or to the tokenizer.
CONTROL = (START, SEPARATOR, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
PART_CHARS = 1 << 20

_ANY = "|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in CONTROL)
_ESCAPED = "|".join(re.escape(c[0]) + r"\\+" + re.escape(c[1:]) for c in CONTROL)
_TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(SEPARATOR) + "(.*?)" + re.escape(END), re.DOTALL)
FORMATTED = "conv_id long, part int, n_turns long, formatted string, token_ids array<int>, token_starts array<int>, token_ends array<int>, loss_mask array<boolean>"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    return re.sub(_ANY, lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(_ESCAPED, lambda m: m[0][0] + m[0][2:], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[str, int, int]]]:
    """The formatted text, and per turn its role and the span of its escaped text."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = START + escape(role) + SEPARATOR, escape(text)
        spans.append((role, at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at = spans[-1][2] + len(END)
    return "".join(out), spans


@lru_cache(maxsize=1)
def tokenizer_for(path: str):
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens([AddedToken(c, special=True, normalized=False) for c in (START, SEPARATOR, END)])
    return tokenizer


def loss_mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Per token, whether it lies in one of the sorted spans: the last span that starts at or before it must reach its end."""
    if not len(offsets) or not spans:
        return np.zeros(len(offsets), dtype=bool)
    borders = np.array(spans, dtype=np.int64)
    near = np.searchsorted(borders[:, 0], offsets[:, 0], side="right") - 1
    return (near >= 0) & (offsets[:, 1] > offsets[:, 0]) & (offsets[:, 1] <= borders[np.maximum(near, 0), 1])


def _format(path: str, learn: str):
    def emit(conv, part: int, turns: list[tuple[str, str]]) -> pa.RecordBatch:
        text, spans = render(turns)
        encoding = tokenizer_for(path).encode(text, add_special_tokens=False)
        offsets = np.array(encoding.offsets, dtype=np.int32).reshape(-1, 2)
        mask = loss_mask(offsets, [(a, b) for role, a, b in spans if role == learn and b > a])
        one = lambda x, kind: pa.array([x], kind)
        ints = pa.list_(pa.int32())
        return pa.RecordBatch.from_arrays(
            [one(conv, pa.int64()), one(part, pa.int32()), one(len(turns), pa.int64()), one(text, pa.string()), one(encoding.ids, ints),
             one(offsets[:, 0], ints), one(offsets[:, 1], ints), one(mask, pa.list_(pa.bool_()))],
            ["conv_id", "part", "n_turns", "formatted", "token_ids", "token_starts", "token_ends", "loss_mask"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, part, turns, held = None, 0, [], 0
        for batch in batches:
            for c, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "role", "text"))):
                if turns and (c != conv or held >= PART_CHARS):
                    yield emit(conv, part, turns)
                    part, turns, held = (part + 1 if c == conv else 0), [], 0
                conv, held = c, held + len(text)
                turns.append((role, text))
        if turns:
            yield emit(conv, part, turns)

    return run


def format_conversations(conversations: DataFrame, tokenizer: str, learn: str = "assistant") -> DataFrame:
    """One row per conversation, more for very long ones (``part`` counts them): text, tokens, their offsets, the loss mask.

    The rows of a conversation follow each other in one partition.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", empty("role"), empty("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_format(tokenizer, learn), FORMATTED)


def masked_text(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> list[str]:
    """The unescaped texts of the maximal runs of characters under the mask."""
    starts, ends = starts[mask], ends[mask]
    if not len(starts):
        return []
    reach = np.maximum.accumulate(ends)
    new = np.r_[True, starts[1:] > reach[:-1]]
    return [unescape(formatted[a:b]) for a, b in zip(starts[new], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(reach) - 1]])]


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, n, turns, loss, chars, size, begun = None, 0, hashlib.sha256(), hashlib.sha256(), 0, 0, False

    def row() -> pa.RecordBatch:
        values = [(conv, pa.int64()), (n, pa.int64()), (turns.hexdigest(), pa.string()), (chars, pa.int64()), (loss.hexdigest(), pa.string()), (size, pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in values], [x.split()[0] for x in DIGESTS.split(", ")])

    for batch in batches:
        for i in range(batch.num_rows):
            part = batch.column("part")[i].as_py()
            if part == 0:
                if begun:
                    yield row()
                conv, n, turns, loss, chars, size, begun = batch.column("conv_id")[i].as_py(), 0, hashlib.sha256(), hashlib.sha256(), 0, 0, True
            text = batch.column("formatted")[i].as_py()
            for role, said in _TURN.findall(text):
                turns.update(f"{unescape(role)}\n{unescape(said)}\n".encode())
                n += 1
            spans = [np.array(batch.column(c)[i].as_py(), dtype=kind) for c, kind in (("token_starts", int), ("token_ends", int), ("loss_mask", bool))]
            for said in masked_text(text, *spans):
                loss.update(said.encode())
                chars += len(said)
            size += len(text)
    if begun:
        yield row()


def digests(formatted: DataFrame) -> DataFrame:
    """What the output of ``format_conversations`` says when it is read back: one row per conversation."""
    return formatted.mapInArrow(_read_back, DIGESTS)
