"""Packing of tokenised documents into full sequences of about equal attention cost.

A piece of n tokens costs ``Cost.linear * n + Cost.quadratic * n * n``: every token passes the dense layers, every pair of tokens of
a piece the attention (pieces of one sequence do not see each other). Documents are assigned in descending order, each to the
lowest-cost sequence whose remaining capacity takes it.

1. Tokens. Documents are encoded once; pieces of at most the capacity are written with their ids, the task they came from and
   their number among the task's pieces of the same length. Prefix sums over tasks give each piece its rank within its length.
2. Sequences. Their number is fixed beforehand, and their capacities add up to the tokens: full sequences, and for the rest of
   under one sequence a few whose capacities are powers of two. So nothing is padded, given that documents may be cut.
3. Assignment. Pieces of one length are interchangeable, and so are sequences of equal cost and free capacity, so both sides are
   runs. A heap of sequence runs by cost serves the piece runs by falling length. A run of pieces that fits nowhere is cut: its
   head fills the largest free capacity, its tail goes on among the shorter ones. Each length splits one sequence run at most
   and each cut closes one, so the runs are bounded by the capacity, not by the corpus; the driver sees runs only.
4. Placement. The assignment's rules (length, place in the piece, interval of ranks; then sequence and offset) are applied to all
   pieces in parallel by binary search, and each part's checksum is taken from the piece's ids.

Edge cases: a null or empty text is one piece of only the end token; repeated rows are packed as often as they occur; a null id
is kept; ties in length go by task and place; very long documents give pieces of the full capacity, which fill a sequence each;
an empty table gives no pieces; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formflow.llm.batches import slices, texts_of
from formflow.llm.packing import encoder_for
from formflow.session import materialise


@dataclass(frozen=True)
class Cost:
    """Whole-number weights: exact sums, the same plan everywhere. The default stands for a model 1024 wide, whose layers do
    24 * 1024^2 operations for a token and 4 * 1024 for a pair of tokens: 6144 to 1."""

    linear: int = 6144
    quadratic: int = 1

    def of(self, tokens):
        return self.linear * tokens + self.quadratic * tokens * tokens


#: A rule: length of the piece, place in it, first rank, number of ranks, length of the part, first sequence, offset there.
Rule = tuple[int, int, int, int, int, int, int]


def plan(counts: dict[int, int], capacity: int, cost: Cost = Cost()) -> list[Rule]:
    """Assign ``counts`` (pieces per length) to sequences."""
    rules: list[Rule] = []
    total = sum(n * length for length, n in counts.items() if length < capacity)
    number, rest = divmod(total, capacity)
    waiting: dict[int, list] = defaultdict(list)  # by free capacity: sequence runs too full for the present length
    heap = [(0, capacity, 0, number, 0)] if number else []  # cost, free, first sequence, how many, tokens so far
    for bit in range(rest.bit_length()):
        if rest >> bit & 1:
            heap.append((0, 1 << bit, number, 1, 0))
            number += 1
    heapify(heap)
    if counts.get(capacity):
        rules.append((capacity, 0, 0, counts[capacity], capacity, number, 0))
    pool: dict[int, list] = defaultdict(list)  # by length: runs of pieces or tails (length of the piece, place, first rank, how many)
    for length, n in counts.items():
        if length < capacity:
            pool[length].append((length, 0, 0, n))
    for length in range(capacity - 1, 0, -1):
        for run in waiting.pop(length, ()):
            heappush(heap, run)
        for piece, at, rank, left in pool.pop(length, ()):
            while left:
                if heap:
                    spent, free, first, held, used = heappop(heap)
                    if free < length:
                        waiting[free].append((spent, free, first, held, used))
                        continue
                    part = length
                else:
                    part = max(waiting)
                    runs = waiting[part]
                    spent, free, first, held, used = runs.pop(runs.index(min(runs)))
                    if not runs:
                        del waiting[part]
                took = min(held, left)
                rules.append((piece, at, rank, took, part, first, used))
                if held > took:
                    same = (spent, free, first + took, held - took, used)
                    heappush(heap, same) if part == length else waiting[free].append(same)
                if free > part:
                    heappush(heap, (spent + cost.of(part), free - part, first, took, used + part))
                if part < length:
                    pool[length - part].append((piece, at + part, rank, took))
                rank, left = rank + took, left - took
    return rules


def _pieces(path: str, capacity: int, end_id: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, task = encoder_for(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for whole in batches:
            for batch in slices(whole, "text"):
                ids, counts = encoder.encode(texts_of(batch))
                tokens = counts + 1
                ends = np.cumsum(tokens)
                flat = np.full(ends[-1], end_id, dtype=kind)
                inside = np.ones(len(flat), dtype=bool)
                inside[ends - 1] = False
                flat[inside] = ids
                number = -(-tokens // capacity)
                doc = np.repeat(np.arange(len(tokens)), number)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
                start = nth * capacity
                length = np.minimum(tokens[doc] - start, capacity)
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                place = np.empty(len(order), dtype=np.int64)
                place[order] = np.arange(len(order)) - np.searchsorted(ordered, ordered) + seen[ordered]
                seen += np.bincount(length, minlength=capacity + 1)
                borders = np.r_[0, np.cumsum(length)] * flat.itemsize
                held = pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(borders.astype(np.int32)), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(tokens[doc]), held,
                     pa.array(np.full(len(doc), task)), pa.array(place)],
                    ["doc_id", "start", "length", "doc_tokens", "ids", "task", "place"])

    return run


def _parts(rules: list[Rule], cost: Cost, capacity: int, kind: str, with_ids: bool):
    """Where every piece goes: found by its length, the place reached in it, and its rank."""
    table = np.array(rules or np.zeros((0, 7)), dtype=np.int64)
    bits = capacity.bit_length()
    key = lambda piece, at, rank: (piece << bits | at) << (63 - 2 * bits) | rank
    keys = key(table[:, 0], table[:, 1], table[:, 2])
    table, keys = table[np.argsort(keys)], np.sort(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            piece, rank, start = (np.asarray(batch.column(c), dtype=np.int64) for c in ("length", "rank", "start"))
            open_, at, found = np.arange(len(piece)), np.zeros(len(piece), dtype=np.int64), []
            while len(open_):
                rule = table[np.searchsorted(keys, key(piece[open_], at, rank[open_]), side="right") - 1]
                found.append(np.stack([open_, at, rule[:, 4], rule[:, 5] + rank[open_] - rule[:, 2], rule[:, 6]]))
                more = at + rule[:, 4] < piece[open_]
                open_, at = open_[more], (at + rule[:, 4])[more]
            row, at, length, sequence, offset = np.concatenate(found, axis=1)
            ids = batch.column("ids")
            borders = np.frombuffer(ids.buffers()[1], dtype=np.int32)[ids.offset : ids.offset + len(ids) + 1].astype(np.int64)
            flat = np.frombuffer(ids.buffers()[2], dtype=np.uint8)[borders[0] : borders[-1]].view(kind).astype("<u4")
            first = (borders[row] - borders[0]) // np.dtype(kind).itemsize + at
            view = memoryview(flat).cast("B")
            crc = [zlib.crc32(view[a:b]) for a, b in zip((4 * first).tolist(), (4 * (first + length)).tolist())]
            take = pa.array(row)
            columns = [batch.column("doc_id").take(take), pa.array(start[row] + at), pa.array(length), pa.array(crc, pa.int64()),
                       batch.column("doc_tokens").take(take), pa.array(sequence), pa.array(offset), pa.array(cost.of(length))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "cost"]
            if with_ids:
                kept = [flat[a : a + n].astype(np.int32) for a, n in zip(first, length)]
                columns, names = [*columns, pa.array(kept, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def pack_balanced(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, cost: Cost = Cost(), with_ids: bool = False) -> DataFrame:
    """One row per part: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, cost and, if wanted, its ``ids``.

    Sequences are full, or their tokens are a power of two.
    """
    from tokenizers import Tokenizer

    kind = "<u2" if max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
    key_type = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"doc_id {key_type}, start long, length long, doc_tokens long, ids binary, task long, place long"
    pieces = materialise(source.mapInArrow(_pieces(tokenizer, capacity, end_id, kind), schema), "balanced-pieces")

    per_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    per_task = materialise(per_task.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "balanced-runs")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    if max(counts.values(), default=0) >> (63 - 2 * capacity.bit_length()):
        raise ValueError(f"too many pieces of one length for sequences of {capacity} tokens")
    rules = plan(counts, capacity, cost)
    ranked = pieces.join(per_task.drop("n"), ["task", "length"]).select(
        "doc_id", "start", "length", "doc_tokens", "ids", (F.col("before") + F.col("place")).alias("rank"))
    schema = f"doc_id {key_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cost long"
    return ranked.mapInArrow(_parts(rules, cost, capacity, kind, with_ids), schema + (", ids array<int>" if with_ids else ""))


def sequence_costs(parts: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id, tokens, documents' parts, cost."""
    return parts.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), F.count("*").alias("parts"), F.sum("cost").alias("cost"))
