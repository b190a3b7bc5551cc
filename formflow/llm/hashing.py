"""Hashes of words and of runs of words over Arrow string columns, vectorised over the UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_TABLES: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_TABLES.get("up", ())) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _TABLES[name] = np.multiply.accumulate(table)
    return _TABLES["up"][:n], _TABLES["down"][:n]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (null: empty) and the borders between texts."""
    column = column.fill_null("") if column.null_count else column
    if pa.types.is_large_string(column.type):
        kind = np.int64
    elif pa.types.is_string(column.type):
        kind = np.int32
    else:
        raise TypeError(f"a string column is needed, not {column.type}")
    _, borders, data = column.buffers()
    borders = np.frombuffer(borders, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[borders[0] : borders[-1]] if data is not None and borders[-1] > borders[0] else np.zeros(0, np.uint8)
    return raw, borders - borders[0]


def _classes(letters_only: bool) -> tuple[np.ndarray, np.ndarray]:
    byte = np.arange(256)
    lower = np.where((byte >= 65) & (byte <= 90), byte + 32, byte).astype(np.uint64) + np.uint64(1)
    if letters_only:
        inside = (byte >= 128) | ((byte >= 48) & (byte <= 57)) | ((byte >= 65) & (byte <= 90)) | ((byte >= 97) & (byte <= 122))
    else:
        inside = ~((byte == 32) | ((byte >= 9) & (byte <= 13)))
    return lower, inside


def word_hashes(column: pa.Array, letters_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, A-Z lower-cased, and the number of the text it stands in.

    A word is a run without space, tab, line feed, vertical tab, form feed and carriage return; with ``letters_only`` it
    is a run of ASCII letters, digits and non-ASCII characters.
    """
    raw, borders = bytes_of(column)
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lower, inside = _classes(letters_only)
    word = inside[raw]
    cut = np.zeros(len(raw) + 1, dtype=bool)
    cut[borders] = True
    starts = np.flatnonzero(word & np.r_[True, ~word[:-1] | cut[1:-1]])
    ends = np.flatnonzero(word & np.r_[~word[1:] | cut[1:-1], True])
    up, down = _powers(len(raw))
    total = np.cumsum(lower[raw] * up, dtype=np.uint64)
    value = (total[ends] - np.where(starts > 0, total[starts - 1], np.uint64(0))) * down[starts]
    return mix(value ^ (ends - starts).astype(np.uint64)), np.searchsorted(borders, starts, side="right") - 1


def run_hashes(words: np.ndarray, owner: np.ndarray, places: tuple[int, ...], salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words at the given places after each position, and the positions, runs within one text only."""
    n = len(words) - max(places)
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.full(n, np.uint64(salt + 1), dtype=np.uint64)
    for place in places:
        out = (out ^ words[place : place + n]) * _STEP
        out ^= out >> np.uint64(32)
    at = np.flatnonzero(owner[:n] == owner[max(places) : max(places) + n])
    return mix(out[at]), at
