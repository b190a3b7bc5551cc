"""Batch jobs: land -> stage -> mart -> upsert -> digest, with written tables between the steps.

Projects are independent: one that fails or has no input does not keep the others
from running; failures are raised together at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from formflow.functions import IdRule, matches_pattern, row_id
from formflow.operators import digest, enrich, quality, upsert
from formflow.operators.upsert import MergeSpec
from formflow.session import intermediates, materialise
from formflow.sinks import Snapshot, overwrite_staging, overwrite_staging_counted


@dataclass(frozen=True)
class StagedProject:
    """What loading one project left behind."""

    staging: DataFrame | None
    warnings: DataFrame | None
    counts: Row | None


def stage_case_project(
    eav: DataFrame, path: str, table: str, case_field: str = "case_id", catchment_prefix: str = "catchment_id",
    rule: IdRule = matches_pattern(),
) -> StagedProject:
    """Enrich, validate, exclude and overwrite the staging table; an empty export is a no-op."""
    offered = eav.count()
    if not offered:
        return StagedProject(None, None, None)
    load = enrich.load_case_rows(eav, case_field, catchment_prefix, rule)
    keys = ["site_id", "catchment_id", "report_id", "case_id", "field_name", "field_value"]
    staged, loaded = overwrite_staging_counted(load.rows.withColumn("id", row_id(*keys)), path)
    counts = Row(table_name=table, source_rows=offered, loaded_rows=loaded, filtered_rows=offered - loaded, skipped=int(loaded == 0))
    return StagedProject(staged, load.warnings, counts)


def stage_repeat_project(eav: DataFrame, path: str, run_ts: datetime) -> DataFrame | None:
    """Repeating forms: the record is the case; one row per key, staged with its creation time.

    An empty export is a no-op, here and in the loaders below: the staging table stays, and None is returned.
    """
    if eav.isEmpty():
        return None
    keys = ["case_id", "repeat_instrument", "repeat_instance", "field_name", "field_value"]
    rows = eav.select(
        F.col("record").alias("case_id"), "repeat_instrument", "repeat_instance", "field_name", F.col("value").alias("field_value"),
    ).distinct()
    return overwrite_staging(rows.withColumns({"id": row_id(*keys), "created_on": F.lit(run_ts)}), path)


def stage_packet_project(eav: DataFrame, path: str, case_field: str, run_ts: datetime) -> DataFrame | None:
    """Packets: case id of the whole packet, rows with an id of the wrong length left out."""
    if eav.isEmpty():
        return None
    rows = quality.keep_valid_length(enrich.packet_map(eav, case_field), "case_id").select(
        F.col("record").alias("packet_id"), "case_id", "repeat_instrument", "repeat_instance", "field_name",
        F.col("value").alias("field_value"), F.lit(run_ts).alias("created_on"),
    )
    return overwrite_staging(rows, path)


def stage_abstraction_project(eav: DataFrame, path: str, site_field: str, run_ts: datetime) -> DataFrame | None:
    """Abstraction forms: the record is the case, the site is the value of one field."""
    if eav.isEmpty():
        return None
    rows = enrich.left_lookup(eav, site_field, "site_id").select(
        "site_id", F.col("record").alias("case_id"), "field_name", F.col("value").alias("field_value")
    ).distinct()
    keys = ["site_id", "case_id", "field_name", "field_value"]
    return overwrite_staging(rows.withColumns({"id": row_id(*keys), "created_on": F.lit(run_ts)}), path)


def refresh_snapshot(
    snapshot: Snapshot, staging: DataFrame, keys: Sequence[str], run_ts: datetime, blank_is_null: Sequence[str] = (),
    allow_empty: bool = False,
) -> dict[str, int]:
    """Bring a soft-delete mart up to its staging table; returns rows per action.

    An empty staging table would mark every row deleted: it is refused unless ``allow_empty`` says that this is meant.
    """
    spark = staging.sparkSession
    if not allow_empty and staging.isEmpty():
        raise ValueError("the staging table is empty; pass allow_empty=True to mark all rows deleted")
    current = snapshot.current(spark)
    if current is None:
        first = upsert.snapshot_initial(staging, F.lit(run_ts)).withColumn("_action", F.lit(upsert.INSERT))
        return snapshot.publish_counted(first, run_ts, upsert.ACTIONS)
    return snapshot.publish_counted(upsert.snapshot_merge(current, staging, keys, F.lit(run_ts), blank_is_null), run_ts, upsert.ACTIONS)


def run_upsert(
    snapshot: Snapshot, source: DataFrame, schema: StructType, spec: MergeSpec, run_ts: datetime, *,
    missing_keys: Sequence[str], scope: str, duplicate_keys: Sequence[str] | None = None,
    duplicate_order: Sequence[str] = (), stamps: Mapping[str, str] | None = None, written: bool = False,
) -> Row:
    """One upsert of an operational table as a new version; returns the affected-row counts.

    ``written`` says that the source is a written table, which several upserts may share.

    Any failure leaves the current version in place and is raised.
    """
    spark = source.sparkSession
    target = snapshot.current(spark)
    if target is None:
        target = spark.createDataFrame([], schema)
    with intermediates(spark):  # the steps' tables go once the version is published
        new = upsert.apply_upsert(
            target, source, spec, missing_keys=missing_keys, scope=scope, duplicate_keys=duplicate_keys,
            duplicate_order=duplicate_order, stamps=stamps, written=written,
        )
        return upsert.counts_row(snapshot.publish_counted(new, run_ts, upsert.ACTIONS))


def run_digest(root: str, warnings: DataFrame, today: date) -> DataFrame | None:
    """Add this run's warnings to the state; the digest to send when it is due, else None.

    Without warnings nothing happens. After a digest the state starts empty. The day of the digest is recorded before the
    state is emptied: a crash in between keeps the warnings for the next digest.
    """
    spark = warnings.sparkSession
    warnings = materialise(warnings, "digest-warnings")  # read several times below
    if warnings.isEmpty():
        return None
    state, notified = Snapshot(f"{root}/warnings"), Snapshot(f"{root}/notified")
    kept = state.current(spark)
    if kept is None:
        kept = warnings.limit(0)
    last = notified.current(spark)
    last_day = last.first()["last_notified"] if last is not None else None
    merged = digest.weekly_digest(kept, F.lit(last_day).cast("date"), warnings, F.lit(today))
    stamp = datetime(today.year, today.month, today.day)
    due = last_day is None or (today - last_day).days >= digest.NOTIFY_INTERVAL_DAYS
    v = state.publish(merged, stamp)
    if not due:
        return None
    to_send = state.at(spark, v).orderBy("site_id", "case_id")
    notified.publish(spark.range(1).select(F.lit(today).alias("last_notified")), stamp)
    state.publish(digest.next_state(to_send), stamp)
    return to_send


def run_projects(projects: Mapping[str, Callable[[SparkSession], object]], spark: SparkSession) -> dict[str, object]:
    """Run every project; raise one error naming those that failed after all had their turn."""
    results, failed = {}, {}
    for name, job in projects.items():
        try:
            results[name] = job(spark)
        except Exception as e:  # noqa: BLE001 - reported below, never swallowed
            failed[name] = e
    if failed:
        raise ExceptionGroup(f"projects failed: {', '.join(failed)}", list(failed.values()))
    return results
