"""Helpers for functions that run over Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` of about ``limit`` bytes of the text column, one row at least: bounds a step's memory."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    group = (np.cumsum(sizes) - sizes) // limit
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    for a, b in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(int(a), int(b - a))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]
