"""Bitmaps of hashes with a bounded size, to drop rows in map tasks that cannot find a partner in a join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 8 MB at most. With very many hashes a bitmap fills up and drops less; the join behind it decides in any case.
MIN_BITS, MAX_BITS = 20, 26


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array([np.stack([np.asarray(c, dtype=np.int64) for c in batch.columns]).tobytes()])], ["block"])


def collected(rows: DataFrame) -> np.ndarray:
    """The integer columns of a table with a bounded number of rows, one array row each. Rows travel as blocks of bytes."""
    blocks = [np.frombuffer(r["block"], dtype=np.int64).reshape(len(rows.columns), -1) for r in rows.mapInArrow(_packed, "block binary").collect()]
    return np.concatenate(blocks, axis=1) if blocks else np.zeros((len(rows.columns), 0), dtype=np.int64)


def bitmap_of(rows: DataFrame, column: str) -> tuple[int, np.ndarray]:
    """A bitmap with two bits for each 64-bit hash in ``column``, from its upper and its lower half.

    Its size follows their number: 128 bits a hash (one of some 4000 others passes), between the two bounds.
    """
    bits = min(MAX_BITS, max(MIN_BITS, int(128 * rows.count()).bit_length()))
    both = F.array(F.shiftrightunsigned(column, 64 - bits), F.shiftrightunsigned(F.shiftleft(column, 32), 64 - bits))
    words = rows.select(F.explode(both).alias("s")).distinct().select(
        F.shiftrightunsigned("s", 6).alias("w"), F.expr("shiftleft(1L, cast(s & 63L as int))").alias("b"))
    bitmap = np.zeros(1 << (bits - 6), dtype=np.int64)
    slots, ones = collected(words.groupBy("w").agg(F.bit_or("b").alias("b")))
    bitmap[slots] = ones
    return bits, bitmap.view(np.uint64)


def held(hashes: np.ndarray, bits: int, bitmap: np.ndarray) -> np.ndarray:
    """Which of the unsigned hashes the bitmap may hold."""
    found = np.ones(len(hashes), dtype=bool)
    for half in (hashes, hashes << np.uint64(32)):
        slot = half >> np.uint64(64 - bits)
        found &= (bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
    return found


def holding(rows: DataFrame, hashed: Column, bits: int, bitmap: np.ndarray) -> DataFrame:
    """The rows whose 64-bit hash ``hashed`` the bitmap may hold."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keep = held(np.asarray(batch.column("__hash"), dtype=np.int64).view(np.uint64), bits, bitmap)
                yield batch.select(names).filter(pa.array(keep))

    return rows.withColumn("__hash", hashed).mapInArrow(run, rows.schema)
