"""Order-dependent columns without a one-task window.

Row numbers, running counts and fill-down depend on the order of all rows. A
window without PARTITION BY (or over one hot key) would run in a single task, so
the rows are cut into blocks of consecutive order values: an ordinary window
works inside each block, and a summary of at most one row per block and key
carries the state from one block to the next.

Blocks are of equal depth, not of equal width: the rows are range-partitioned by
the sequence, whose bounds Spark takes from a sample of its values, and written
once with the number of their partition. A sequence in which nearly all rows lie
in a small part of its range (a bulk load among daily entries) gives blocks of
the same size, and the input is read once for all steps.

``order_col`` is an integer ingest sequence without ties.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from formflow.session import materialise


def with_block(df: DataFrame, order_col: str, blocks: int | None = None) -> DataFrame:
    """Written copy of the rows with ``_block``, rising with the sequence: ``blocks`` of them, by default as many as
    the session has shuffle partitions, small ones put together."""
    number = [] if blocks is None else [blocks]
    dealt = df.repartitionByRange(*number, F.col(order_col).cast("bigint").asc_nulls_first())
    return materialise(dealt.withColumn("_block", F.spark_partition_id().cast("bigint")), "ordered-blocks")


def _attach(blocked: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    if not keys:
        return blocked.join(carry, "_block")
    on = blocked["_block"] == carry["_block"]
    for k in keys:
        on = on & blocked[k].eqNullSafe(carry[k])
    return blocked.join(carry, on).drop(carry["_block"], *[carry[k] for k in keys])


def _before(keys: Sequence[str]):
    return W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)


def ordered_columns(
    df: DataFrame, order_col: str, *, fills: Mapping[str, Column] | None = None, counts: Mapping[str, Column] | None = None,
    keys: Sequence[str] = (), blocks: int | None = None,
) -> DataFrame:
    """Several order-dependent columns over one blocking of the rows.

    fills   {output: value}      last non-NULL value up to and including this row
    counts  {output: condition}  number of rows so far for which the condition holds

    The rows are written once per call: ask for all columns in one.
    """
    fills, counts = fills or {}, counts or {}
    rows = df.withColumns({
        **{f"_v_{c}": v for c, v in fills.items()},
        **{f"_n_{c}": F.when(cond, 1).otherwise(0) for c, cond in counts.items()},
    })
    blocked = with_block(rows, order_col, blocks)
    summary = blocked.groupBy(*keys, "_block").agg(
        *[F.max_by(f"_v_{c}", F.when(F.col(f"_v_{c}").isNotNull(), F.col(order_col))).alias(f"_v_{c}") for c in fills],
        *[F.sum(f"_n_{c}").alias(f"_n_{c}") for c in counts],
    )
    before = _before(keys)
    carry = summary.select(
        *keys, "_block",
        *[F.last(f"_v_{c}", ignorenulls=True).over(before).alias(f"_c_{c}") for c in fills],
        *[F.coalesce(F.sum(f"_n_{c}").over(before), F.lit(0)).alias(f"_c_{c}") for c in counts],
    )
    inside = W.partitionBy(*keys, "_block").orderBy(order_col).rowsBetween(W.unboundedPreceding, 0)
    out = _attach(blocked, carry, keys).withColumns({
        **{c: F.coalesce(F.last(f"_v_{c}", ignorenulls=True).over(inside), F.col(f"_c_{c}")) for c in fills},
        **{c: (F.col(f"_c_{c}") + F.sum(f"_n_{c}").over(inside)).cast("bigint") for c in counts},
    })
    names = [*fills, *counts]
    return out.drop("_block", *[f"_v_{c}" for c in fills], *[f"_n_{c}" for c in counts], *[f"_c_{c}" for c in names])


def row_number(df: DataFrame, order_col: str, out: str = "sequence_id", blocks: int | None = None) -> DataFrame:
    """Dense number 1..n in sequence order."""
    return ordered_columns(df, order_col, counts={out: F.lit(True)}, blocks=blocks)


def running_count(df: DataFrame, order_col: str, condition: Column, out: str, blocks: int | None = None) -> DataFrame:
    """Number of rows up to and including this one for which ``condition`` holds."""
    return ordered_columns(df, order_col, counts={out: condition}, blocks=blocks)


def fill_down(
    df: DataFrame, order_col: str, value: Column, out: str, keys: Sequence[str] = (), blocks: int | None = None,
) -> DataFrame:
    """Last non-NULL ``value`` up to and including this row, per key."""
    return ordered_columns(df, order_col, fills={out: value}, keys=keys, blocks=blocks)
