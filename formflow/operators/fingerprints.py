"""Order-independent fingerprints of row sets, and what they save: equal parts of two tables are never moved.

The fingerprint of a set of rows is their number and two exact sums of 64-bit row hashes. It can be added up in any order, so
each task sums its own rows and only one row per task and bucket is shuffled. Sums, not exclusive-ors: repeated rows count.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from formflow.session import materialise

#: Seeds of the two row hashes and of the tree's bucket hash.
_SEEDS, _TREE_SEED = (0x5BD1E995, 0x27D4EB2F), 0x165667B1
FANOUT = 1024
#: One in so many buckets of the first level is split at once.
_PROBED = 128


def row_hash(columns: Sequence[str], seed: int) -> Column:
    """64-bit hash in which a NULL counts: a hash over several columns skips it otherwise."""
    parts = [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return F.xxhash64(F.lit(seed), *parts)


def with_hashes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``_h0`` and ``_h1``; decimals, so that sums are exact whatever the number of rows."""
    return df.withColumns({f"_h{i}": row_hash(columns, s).cast("decimal(20,0)") for i, s in enumerate(_SEEDS)})


def fingerprints(df: DataFrame, columns: Sequence[str], *by: Column) -> DataFrame:
    """(the columns of ``by``, n, s0, s1): one row per bucket."""
    rows = with_hashes(df, columns)
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum("_h0").alias("s0"), F.sum("_h1").alias("s1"))


@dataclass(frozen=True)
class Comparison:
    """``figures``: (left_rows, right_rows, only_left, only_right, equal), as ``quality.compare`` gives them;
    ``differing``: the rows that one side has more often, with ``left_surplus`` (negative: the right has more)."""

    figures: DataFrame
    differing: DataFrame


def compare_tree(left: DataFrame, right: DataFrame, keys: Sequence[str] | None = None, fanout: int = FANOUT) -> Comparison:
    """Bag equality of two results of the same columns by a hash tree.

    Buckets are ranges of a hash of ``keys`` (by default all columns). The first level has ``fanout`` buckets, and the buckets
    that differ are split into ``fanout`` more; only rows of buckets that differ at both levels are shuffled, and compared
    exactly. Some buckets are split at once: if most of their rows lie in parts that differ, a second level would keep few rows
    in place and is left out. Equal inputs move fingerprints only. The inputs are read once per level: write expensive ones to a
    table first.
    """
    columns = left.columns
    signed = left.withColumn("_sign", F.lit(1)).unionByName(right.withColumn("_sign", F.lit(-1)))
    at = row_hash(keys or columns, _TREE_SEED)
    level = lambda shift: F.pmod(F.shiftright(at, shift), F.lit(fanout)).cast("int")
    rows = signed.withColumns({"_b1": level(0), "_b2": level(20)})

    def unequal(df: DataFrame, second: Column) -> DataFrame:
        sign, sums = F.col("_sign"), {}
        hashed = df.select("_b1", second.alias("_b2"), "_sign", *[row_hash(columns, s).alias(f"_h{i}") for i, s in enumerate(_SEEDS)])
        # Exact sums of 64-bit hashes by parts of 22 bits: longs, which are summed in place, for up to 2^41 rows a bucket.
        for i in range(len(_SEEDS)):
            for shift in (0, 22, 44):
                sums[f"d{i}_{shift}"] = F.sum(F.shiftrightunsigned(f"_h{i}", shift).bitwiseAND(F.lit((1 << 22) - 1)) * sign)
        found = hashed.groupBy("_b1", "_b2").agg(
            F.count_if(sign > 0).alias("left_rows"), F.count_if(sign < 0).alias("right_rows"), *[c.alias(n) for n, c in sums.items()])
        same = F.col("left_rows") == F.col("right_rows")
        for n in sums:
            same = same & (F.col(n) == 0)
        return found.select("_b1", "_b2", "left_rows", "right_rows", (~same).alias("unequal"))

    probed = max(1, fanout // _PROBED)
    first = materialise(unequal(rows, F.when(F.col("_b1") < probed, F.col("_b2"))), "hash-tree")
    # At most ``fanout`` rows of one number.
    suspects = rows.join(F.broadcast(first.where("unequal").select("_b1").distinct()), "_b1", "left_semi")
    in_rows = F.col("left_rows") + F.col("right_rows")
    probe = first.where("_b2 is not null").agg(F.sum(in_rows).alias("n"), F.sum(F.when(F.col("unequal"), in_rows)).alias("differ")).first()
    if probe["n"] and 2 * (probe["differ"] or 0) > probe["n"]:
        met = suspects
    else:
        second = materialise(unequal(suspects, F.col("_b2")).where("unequal").select("_b1", "_b2"), "hash-tree")
        met = suspects.join(second, ["_b1", "_b2"], "left_semi")
    leaves = met.groupBy(*columns).agg(F.sum("_sign").alias("left_surplus"))
    differing = materialise(leaves.where("left_surplus <> 0"), "hash-tree-rows")
    zero = F.lit(0).cast("bigint")
    both = differing.agg(*[F.coalesce(F.sum(F.greatest(F.col("left_surplus") * s, zero)), zero).alias(c) for c, s in (("only_left", 1), ("only_right", -1))])
    totals = first.agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in ("left_rows", "right_rows")])
    figures = totals.crossJoin(both).withColumn("equal", ((F.col("only_left") == 0) & (F.col("only_right") == 0)).cast("int"))  # one row each
    return Comparison(figures, differing)
