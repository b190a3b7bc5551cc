"""Tables of bits that keep rows without a partner from moving to a join.

A table has a fixed number of 64-bit words, whatever the number of keys; a key sets two bits of one word. Rows meet it by the
number of the word in a broadcast join, whose size that number bounds. A table with more keys than it has room for fills up
and lets more rows pass; the join behind it decides in any case, so the results never depend on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Words of a table: at most so many rows of two longs are broadcast. A million keys let one of some twenty strangers pass.
WORDS = 1 << 17


def _address(on: Sequence[str], words: int) -> tuple[Column, Column]:
    """Number of the word, and the two bits in it. A hash of all key columns; NULL keys have one too."""
    h = F.xxhash64(*[F.col(c) for c in on])
    bit = lambda shift: F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(63)).cast("int"))
    return h.bitwiseAND(F.lit(words - 1)), bit(32).bitwiseOR(bit(40))


def bit_table(keys: DataFrame, on: Sequence[str], words: int = WORDS) -> DataFrame:
    """(_word, _bits), at most ``words`` rows: added up on the map side, so no task sends more than that."""
    if words < 1 or words & (words - 1):
        raise ValueError("the number of words must be a power of two")
    word, mask = _address(on, words)
    return keys.select(word.alias("_word"), mask.alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_bits"))


def _probe(rows: DataFrame, keys: DataFrame, on: Sequence[str], words: int, how: str) -> DataFrame:
    kinds, others = dict(rows.dtypes), dict(keys.dtypes)
    for c in on:
        if kinds[c] != others[c] or kinds[c] in ("float", "double"):
            raise ValueError(f"{c}: keys must have the same type on both sides, and not a floating one")
    word, mask = _address(on, words)
    table = F.broadcast(bit_table(keys, on, words))
    probed = rows.withColumns({"_at": word, "_mask": mask})
    held = (F.col("_at") == F.col("_word")) & (F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"))
    return probed.join(table, held, how).select(*rows.columns)


def possible(rows: DataFrame, keys: DataFrame, on: Sequence[str], words: int = WORDS) -> DataFrame:
    """All rows that have their key among ``keys``, and a few that have not."""
    return _probe(rows, keys, on, words, "left_semi")


def impossible(rows: DataFrame, keys: DataFrame, on: Sequence[str], words: int = WORDS) -> DataFrame:
    """The other rows: none of them has its key among ``keys``."""
    return _probe(rows, keys, on, words, "left_anti")
