"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Tokens come from a public tokenizer. It never joins characters across white space, so each distinct white-space separated
chunk is encoded once per worker and looked up afterwards; the ids are those of the whole text.

Packing is bulk-synchronous best-fit decreasing:

1. Range sort. Pieces are range-sorted by length (ids break ties, so one hot length spreads over many tasks) and written
   once with their partition and place. One aggregate gives the runs of equal length per partition, and prefix sums over
   the runs give every piece its rank among the pieces of its length.
2. Supersteps. Pieces of one length are interchangeable, and so are gaps of one size, hence both sides are runs, at most
   one per length and a few per gap size: their number is bounded by the capacity, not by the corpus. A superstep places
   all pieces of the longest length left: a successor sweep over the sorted gap runs finds the smallest gap that fits,
   ranks say which piece gets which gap, the gaps are updated, and the next length follows. Sequences are opened only
   if no gap fits.
3. Placement. The supersteps' rules (length, interval of ranks, first sequence, offset) are applied to all pieces in
   parallel by binary search on the rank.

Edge cases: a null or empty text is one piece of only the end token; repeated rows are packed as often as they occur; a
null id is kept; only documents longer than the capacity are cut; an empty table gives no pieces; further columns are
ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formflow.llm.batches import slices, texts_of
from formflow.session import materialise

#: Chunks that a worker keeps. Beyond, further chunks are encoded where they occur, and the store starts over if most are new.
KEPT_CHUNKS = 1_500_000


class ChunkEncoder:
    """Ids of texts from a tokenizer file whose pre-tokenizer splits at white space and drops it."""

    #: These count as white space for str.split, but not for the tokenizer.
    _SEPARATORS = re.compile("[\x1c-\x1f]")
    _CHUNKS = re.compile("[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, int] = {}
        self.ids, self.starts, self.lengths = array("i"), array("i"), array("i")

    def _split(self, text: str) -> list[str]:
        return self._CHUNKS.findall(text) if self._SEPARATORS.search(text) else text.split()

    def _forget(self, chunks: list[str], n_ids: int) -> None:
        for chunk in chunks:
            del self.known[chunk]
        del self.ids[n_ids:], self.starts[len(self.known):], self.lengths[len(self.known):]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and the number of ids of each text."""
        counts, chunks = [], []
        for text in texts:
            own = self._split(text)
            counts.append(len(own))
            chunks += own
        distinct = set(chunks)
        new, before = list(distinct.difference(self.known)), len(self.ids)
        for chunk, encoding in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            self.known[chunk] = len(self.starts)
            self.starts.append(len(self.ids))
            ids = encoding.ids
            self.lengths.append(len(ids))
            self.ids.extend(ids)
        which = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        view = lambda x: np.frombuffer(x, dtype=np.int32) if len(x) else np.zeros(0, np.int32)
        size = view(self.lengths)[which]
        ends = np.cumsum(size, dtype=np.int64)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(view(self.starts)[which] - (ends - size), size)
        out = view(self.ids)[at]
        if len(self.known) > KEPT_CHUNKS:
            self._forget(list(self.known) if 2 * len(new) > len(distinct) else new, 0 if 2 * len(new) > len(distinct) else before)
        text_of = np.repeat(np.arange(len(texts)), counts)
        return out, np.bincount(text_of, weights=size, minlength=len(texts)).astype(np.int64)


@lru_cache(maxsize=1)
def encoder_for(path: str) -> ChunkEncoder:
    """One encoder per worker process, kept from task to task."""
    return ChunkEncoder(path)


def _pieces(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(path)
        for whole in batches:
            for batch in slices(whole, "text"):
                ids, counts = encoder.encode(texts_of(batch))
                doc, piece, start, length, crc, kept = [], [], [], [], [], []
                ends = np.cumsum(counts)
                for i, (a, b) in enumerate(zip(ends - counts, ends)):
                    own = np.append(ids[a:b], end_id).astype("<u4")
                    for k, s in enumerate(range(0, len(own), capacity)):
                        part = own[s : s + capacity]
                        doc.append(i)
                        piece.append(k)
                        start.append(s)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                        if with_ids:
                            kept.append(part.astype(np.int32))
                columns = [batch.column("doc_id").take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()),
                           *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(kept, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def tokenise(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: doc_id, piece, start, length, ids_crc32 and, if wanted, ``ids``."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return source.mapInArrow(_pieces(tokenizer, capacity, end_id, with_ids), schema + (", ids array<int>" if with_ids else ""))


def plan_runs(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Supersteps over runs. ``counts``: pieces per length. Gives rules (length, first rank, number, each, sequence, offset):
    the pieces of a length with the ranks from ``first rank`` on go, ``each`` to a sequence, to the sequences from
    ``sequence`` on, side by side from ``offset`` on.
    """
    rules: list[tuple[int, int, int, int, int, int]] = []
    gaps: list[tuple[int, int, int]] = []  # free, first sequence, number of sequences; sorted
    opened = 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(gaps, (length,))
            if at < len(gaps):
                free, first, number = gaps.pop(at)
            else:
                free, first, number = capacity, opened, -(-left // (capacity // length))
                opened += number
            each = free // length
            full, rest = (number, 0) if left >= number * each else divmod(left, each)
            placed = full * each + rest
            rules.append((length, rank, placed, each, first, capacity - free))
            changed = [(free - each * length, first, full), (free - rest * length, first + full, 1 if rest else 0),
                       (free, first + full + (1 if rest else 0), number - full - (1 if rest else 0))]
            for gap in changed:
                if gap[0] and gap[2]:
                    insort(gaps, gap)
            rank, left = rank + placed, left - placed
    return rules


def _placed(rules: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((rules[:, 1], rules[:, 0]))
        mine = rules[order]
        span = np.int64(1) << 48  # ranks stay below; lengths are small
        keys = mine[:, 0] * span + mine[:, 1]
        for batch in batches:
            length, rank = (np.asarray(batch.column(c), dtype=np.int64) for c in ("length", "rank"))
            rule = mine[np.searchsorted(keys, length * span + rank, side="right") - 1]
            nth = rank - rule[:, 1]
            out = [batch.column(c) for c in batch.schema.names if c != "rank"]
            names = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*out, pa.array(rule[:, 4] + nth // rule[:, 3]), pa.array(rule[:, 5] + nth % rule[:, 3] * length)], [*names, "sequence_id", "offset"])

    return run


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with ``sequence_id`` and ``offset``.

    ``pieces`` is a written table: range sorting reads it twice, once for the bounds.
    """
    own = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ordered = pieces.select(*own).repartitionByRange(F.col("length").desc(), "ids_crc32", "doc_id", "piece").sortWithinPartitions(F.col("length").desc())
    ordered = materialise(ordered.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}), "packing-pieces")
    runs = ordered.groupBy("__part", "length").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = materialise(runs.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))), "packing-runs")
    counts = {r["length"]: r["n"] for r in runs.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    rules = np.array(plan_runs(counts, capacity) or np.zeros((1, 6)), dtype=np.int64)
    ranked = ordered.join(runs, ["__part", "length"]).select(*own, (F.col("__before") + F.col("__at") - F.col("__first")).alias("rank"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.select(*own).schema) + ", sequence_id long, offset long"
    return ranked.mapInArrow(_placed(rules), schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(materialise(tokenise(docs, tokenizer, capacity, end_id, with_ids=False), "packing-lengths"), capacity)


def sequences(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """The packed ids themselves: one row (sequence_id, ids, doc_ids) per sequence, at most ``capacity`` ids each.

    Pieces meet their places by id, piece and checksum; repeated rows have equal ids and are numbered to stay apart.
    """
    pieces = materialise(tokenise(docs, tokenizer, capacity, end_id), "packing-ids")
    key = ["doc_id", "piece", "length", "ids_crc32"]
    nth = F.row_number().over(Window.partitionBy(*key).orderBy("start")).alias("__nth")
    places = pack(pieces, capacity).select(*[F.col(k).alias(f"__{k}") for k in key], "sequence_id", "offset", nth_of(key))
    texts = pieces.select(*key, "ids", nth)
    meet = [texts[k].eqNullSafe(places[f"__{k}"]) for k in key] + [texts["__nth"] == places["__nth2"]]
    placed = texts.join(places, meet).groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("s"))
    return placed.select("sequence_id", F.flatten(F.transform("s", lambda x: x["ids"])).alias("ids"), F.transform("s", lambda x: x["doc_id"]).alias("doc_ids"))


def nth_of(key: list[str]):
    return F.row_number().over(Window.partitionBy(*key).orderBy("sequence_id", "offset")).alias("__nth2")
