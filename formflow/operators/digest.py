"""Accumulating warning digest and the error digest over log events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from formflow.schemas import DIGEST_STATE

NOTIFY_INTERVAL_DAYS = 7  # fixed value
LOG_WINDOW_HOURS = 2  # fixed value
LOG_SHOWN = 20  # fixed value


def merge_warnings(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Warnings of both lists, report counts added per (site, id)."""
    cols = ["site_id", "case_id", "report_count"]
    return (
        existing.select(*cols).unionByName(new.select(*cols))
        .groupBy("site_id", "case_id")
        .agg(F.sum("report_count").cast("bigint").alias("report_count"))
    )


def digest_due(last_notified: Column, today: Column, interval_days: int = NOTIFY_INTERVAL_DAYS) -> Column:
    """Due when never sent, or sent at least ``interval_days`` ago."""
    return last_notified.isNull() | (F.datediff(today, last_notified) >= interval_days)


def weekly_digest(state: DataFrame, last_notified: Column, new: DataFrame, today: Column) -> DataFrame:
    """Merged warnings with ``due``; empty when this run has no warnings.

    Rows with due = 1 are the digest to send, after which the state starts
    empty; rows with due = 0 are the state to keep.
    """
    any_new = new.agg(F.count(F.lit(1)).alias("n")).scalar() > 0
    merged = merge_warnings(state, new).filter(any_new)
    return merged.withColumn("due", digest_due(last_notified, today).cast("int"))


def next_state(digest: DataFrame) -> DataFrame:
    """Warnings to carry to the next run."""
    return digest.filter(F.col("due") == 0).drop("due")


def parse_state(text: Column) -> Column:
    return F.from_json(text, DIGEST_STATE)


def state_warnings(lines: DataFrame, column: str = "value") -> DataFrame:
    """Warnings held in stored state documents, one row per warning."""
    return lines.select(parse_state(F.col(column)).alias("state")).select(F.inline("state.warnings"))


def error_digest(
    events: DataFrame, run_ts: Column, levels: list[str], hours: int = LOG_WINDOW_HOURS, shown: int = LOG_SHOWN,
) -> DataFrame:
    """First ``shown`` error events of the last hours, each with the total and how many are not shown.

    ``events`` has level, ts, event_id, message. The level and time filters
    reach the scan; the total is a scalar aggregate, never a list on the driver.
    """
    recent = events.filter(
        F.col("level").isin(levels)
        & (F.col("ts") >= run_ts - F.expr(f"interval {hours} hours"))
        & (F.col("ts") <= run_ts)
    )
    total = recent.agg(F.count(F.lit(1)).alias("n")).scalar()
    first = recent.orderBy("ts", "event_id").limit(shown)
    return first.select(
        "event_id", "level", "message", total.alias("total_errors"),
        F.greatest(total - F.lit(shown), F.lit(0).cast("bigint")).alias("not_shown"),
    )
