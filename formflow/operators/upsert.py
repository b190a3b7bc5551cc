"""Keyed upsert, duplicate deactivation, missing-row deactivation, snapshot merge.

Parquet tables have no row-level MERGE, so each step reads the current version
and describes the next one as a DataFrame with an ``_action`` column; the caller
writes it as a new version (``sinks.publish``) and counts actions on the written
rows.

Shape of every step: rows outside its scope pass through without a shuffle; rows
in scope are left-joined to a side that holds one row per key. That keeps a key
with very many rows on the streamed side, which AQE can split - a full outer
join it cannot. Keys are single struct columns: NULL-safe, and the uniqueness
check, the join and the anti join all cluster on the same column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, functions as F

from formflow.functions import null_safe_key, reshuffled
from formflow.session import materialise

KEEP, UPDATE, INSERT = "keep", "update", "insert"
DUPLICATE, MISSING, DELETE = "duplicate", "missing", "delete"
ACTIONS = (KEEP, UPDATE, INSERT, DUPLICATE, MISSING, DELETE)

# States of the active flag.
ACTIVE, INACTIVE_DUPLICATE, INACTIVE_MISSING = 1, 0, 2


@dataclass(frozen=True)
class MergeSpec:
    """One upsert. ``updates`` and ``inserts`` are SQL expressions over ``s`` (source) and ``t`` (target).

    keys           join keys, same names on both sides
    updates        {target column: expression} for matched rows
    inserts        {target column: expression} for new rows; other columns become NULL
    target_filter  SQL condition a target row must meet to be matched at all
    update_when    SQL condition over ``s`` and ``t``; NULL counts as false
    null_safe      NULL keys match NULL keys; False gives plain ``=``
    """

    keys: Sequence[str]
    updates: Mapping[str, str]
    inserts: Mapping[str, str]
    target_filter: str | None = None
    update_when: str | None = None
    null_safe: bool = True
    blank_is_null: Sequence[str] = field(default=())


def _key(spec: MergeSpec) -> Column:
    return null_safe_key(*spec.keys, blank_is_null=spec.blank_is_null)


def _all_set(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def split(df: DataFrame, condition: Column | str | None) -> tuple[DataFrame, DataFrame | None]:
    """Rows that meet the condition, and the others (NULL counts as not met)."""
    if condition is None:
        return df, None
    cond = F.coalesce(F.expr(condition) if isinstance(condition, str) else condition, F.lit(False))
    return df.filter(cond), df.filter(~cond)


def unique_source(source: DataFrame, key: Column, alias: str = "_key") -> DataFrame:
    """One row per key with the source row in ``s``; two rows for one key fail the job.

    The check stands around the key. That hides the aggregate's partitioning, so the
    join shuffles this side again, one row per key, and AQE can split a hot key.
    """
    grouped = source.select(key.alias(alias), F.struct("*").alias("s")).groupBy(alias).agg(
        F.count(F.lit(1)).alias("_n"), F.any_value("s").alias("s")
    )
    message = F.concat(F.lit("more than one source row for key "), F.to_json(F.col(alias)))
    return grouped.select(
        F.when(F.col("_n") == 1, F.col(alias)).otherwise(F.raise_error(message).cast(grouped.schema[alias].dataType)).alias(alias),
        "s",
    )


def merge(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """Next version of ``target`` with ``_action`` in keep / update / insert.

    An updated row that already holds the new values still counts as updated,
    as a MERGE statement counts it.
    """
    columns = target.columns
    live, rest = split(target, spec.target_filter)
    src, unmatched_src = (source, None) if spec.null_safe else split(source, _all_set(spec.keys))
    if not spec.null_safe:
        live, live_null = split(live, _all_set(spec.keys))
        rest = live_null if rest is None else rest.unionByName(live_null)
    key = _key(spec)
    one = unique_source(src, key)

    t = live.withColumn("_key", key).alias("t")
    joined = t.join(one.withColumnRenamed("_key", "_skey"), F.col("t._key") == F.col("_skey"), "left")
    hit = F.col("_skey").isNotNull()
    if spec.update_when:
        hit = hit & F.coalesce(F.expr(spec.update_when), F.lit(False))
    changed = {
        c: F.when(hit, F.expr(spec.updates[c])).otherwise(F.col(f"t.{c}")) if c in spec.updates else F.col(f"t.{c}")
        for c in columns
    }
    matched = joined.select(
        *[v.cast(target.schema[c].dataType).alias(c) for c, v in changed.items()],
        F.when(hit, UPDATE).otherwise(KEEP).alias("_action"),
    )

    target_keys = live.select(key.alias("_key")).distinct()
    new = one.join(target_keys, "_key", "left_anti").select("s")
    if unmatched_src is not None:
        new = new.unionByName(unmatched_src.select(F.struct("*").alias("s")))
    inserted = new.select(
        *[F.expr(spec.inserts.get(c, "null")).cast(target.schema[c].dataType).alias(c) for c in columns],
        F.lit(INSERT).alias("_action"),
    )
    out = matched.unionByName(inserted)
    return out if rest is None else out.unionByName(rest.withColumn("_action", F.lit(KEEP)))


def latest_flag(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "is_latest") -> DataFrame:
    """Mark the last row per key by ``order`` (the last order column must be unique: it breaks ties).

    Equal to ``row_number() over (partition by keys order by ... desc) = 1``, but
    as an aggregate joined back: the group never has to fit one task.
    """
    key = null_safe_key(*keys)
    rank = F.struct(*order)
    latest = df.groupBy(key.alias("_key")).agg(F.max(rank).alias("_latest"))
    joined = df.withColumn("_k", key).join(reshuffled(latest, "_key"), F.col("_k") == F.col("_key"))
    return joined.withColumn(out, rank == F.col("_latest")).drop("_k", "_key", "_latest")


def older_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows that are not the last of their key."""
    return latest_flag(df, keys, order).filter(~F.col("is_latest")).drop("is_latest")


def deactivate_duplicates(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], scope: str, active_col: str = "active",
) -> DataFrame:
    """Set the active flag of older duplicates within ``scope`` to 0; adds or updates ``_action``."""
    df = _with_action(df)
    inside, outside = split(df, scope)
    flagged = latest_flag(inside, keys, order)
    older = ~F.col("is_latest")
    done = flagged.select(
        *[_set(older, INACTIVE_DUPLICATE, c, df) if c == active_col else F.col(c) for c in df.columns if c != "_action"],
        F.when(older, DUPLICATE).otherwise(F.col("_action")).alias("_action"),
    )
    return done if outside is None else done.unionByName(outside)


def deactivate_missing(
    df: DataFrame, source: DataFrame, keys: Sequence[str], scope: str,
    stamps: Mapping[str, str] | None = None, active_col: str = "active", null_safe: bool = True,
) -> DataFrame:
    """Set the active flag of in-scope rows whose key is not in the source to 2.

    ``stamps`` are further columns to set on those rows (SQL expressions).
    """
    df = _with_action(df)
    inside, outside = split(df, scope)
    key = null_safe_key(*keys)
    if not null_safe:
        source = source.filter(_all_set(keys))
    present = reshuffled(source.select(key.alias("_key")).distinct(), "_key")
    joined = inside.withColumn("_k", key).join(present, F.col("_k") == F.col("_key"), "left")
    gone = F.col("_key").isNull()
    values = {active_col: F.lit(INACTIVE_MISSING), **{c: F.expr(e) for c, e in (stamps or {}).items()}}
    done = joined.select(
        *[
            F.when(gone, values[c]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c) if c in values else F.col(c)
            for c in df.columns if c != "_action"
        ],
        F.when(gone, MISSING).otherwise(F.col("_action")).alias("_action"),
    )
    return done if outside is None else done.unionByName(outside)


def missing_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows with no source row of the same key (NULL-safe anti join)."""
    key = null_safe_key(*keys)
    present = reshuffled(source.select(key.alias("_key")).distinct(), "_key")
    return target.withColumn("_key", key).join(present, "_key", "left_anti").drop("_key")


def action_counts(versioned: DataFrame) -> DataFrame:
    """One row of affected-row counts; read it from the written version, where it scans one column."""
    a = F.col("_action")
    return versioned.agg(
        F.count_if(a.isin(UPDATE, INSERT)).alias("merged"),
        F.count_if(a == INSERT).alias("inserted"),
        F.count_if(a == UPDATE).alias("updated"),
        F.count_if(a == DUPLICATE).alias("deactivated_duplicates"),
        F.count_if(a == MISSING).alias("deactivated_missing"),
    )


def counts_row(per_action: Mapping[str, int]) -> Row:
    """The figures of ``action_counts`` from rows per action that were counted while writing."""
    n = lambda a: per_action.get(a, 0)
    return Row(merged=n(UPDATE) + n(INSERT), inserted=n(INSERT), updated=n(UPDATE), deactivated_duplicates=n(DUPLICATE), deactivated_missing=n(MISSING))


def apply_upsert(
    target: DataFrame, source: DataFrame, spec: MergeSpec, *, missing_keys: Sequence[str], scope: str,
    duplicate_keys: Sequence[str] | None = None, duplicate_order: Sequence[str] = (), stamps: Mapping[str, str] | None = None,
    written: bool = False,
) -> DataFrame:
    """Merge, then deactivate older duplicates, then rows missing from the source.

    ``missing_keys`` may differ from the merge keys. The source is written once
    and read by every step (``written``: it is a written table already, as when
    two targets share it); so is the result of each step, because the next one
    reads it more than once.
    """
    source = source if written else materialise(source, "upsert-source")
    out = materialise(merge(target, source, spec), "merged")
    if duplicate_keys:
        out = materialise(deactivate_duplicates(out, duplicate_keys, duplicate_order, scope), "deduplicated")
    return deactivate_missing(out, source, missing_keys, scope, stamps)


def _with_action(df: DataFrame) -> DataFrame:
    return df if "_action" in df.columns else df.withColumn("_action", F.lit(KEEP))


def _set(cond: Column, value: int, c: str, df: DataFrame) -> Column:
    return F.when(cond, F.lit(value)).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c)


# --- snapshot marts -------------------------------------------------------------------------


def snapshot_initial(source: DataFrame, run_ts: Column) -> DataFrame:
    """First load of a snapshot mart: every source row live, nothing deleted."""
    return source.withColumns({"last_updated": run_ts, "is_deleted": F.lit(0)})


def snapshot_deleted(target: DataFrame, source: DataFrame, keys: Sequence[str], blank_is_null: Sequence[str] = ()) -> DataFrame:
    """Live target rows that no longer exist in the source."""
    key = null_safe_key(*keys, blank_is_null=blank_is_null)
    present = reshuffled(source.select(key.alias("_key")).distinct(), "_key")
    live = target.filter(F.col("is_deleted") == 0)
    return live.withColumn("_key", key).join(present, "_key", "left_anti").drop("_key")


def snapshot_merge(
    target: DataFrame, source: DataFrame, keys: Sequence[str], run_ts: Column,
    blank_is_null: Sequence[str] = (), id_col: str = "id",
) -> DataFrame:
    """Next version of a snapshot mart, with ``_action``.

    Source rows are live: new ones are inserted, known ones get the new id and
    stamp, and a deleted one that returns is revived. Live target rows absent
    from the source are marked deleted. Rows deleted earlier stay as they are.
    Other columns of known rows (created_on) keep their first value.
    """
    key = null_safe_key(*keys, blank_is_null=blank_is_null)
    one = unique_source(source, key, "_skey")
    joined = target.withColumn("_key", key).join(one, F.col("_key") == F.col("_skey"), "left")
    present = F.col("_skey").isNotNull()
    deleted = ~present & (F.col("is_deleted") == 0)
    new_value = {
        id_col: F.when(present, F.col(f"s.{id_col}")).otherwise(F.col(id_col)),
        "last_updated": F.when(present | deleted, run_ts).otherwise(F.col("last_updated")),
        "is_deleted": F.when(present, 0).when(deleted, 1).otherwise(F.col("is_deleted")),
    }
    known = joined.select(
        *[new_value.get(c, F.col(c)).cast(target.schema[c].dataType).alias(c) for c in target.columns],
        F.when(present, UPDATE).when(deleted, DELETE).otherwise(KEEP).alias("_action"),
    )
    target_keys = target.select(key.alias("_skey")).distinct()
    new = snapshot_initial(one.join(target_keys, "_skey", "left_anti").select("s.*"), run_ts)
    inserted = new.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in target.columns], F.lit(INSERT).alias("_action"))
    return known.unionByName(inserted)
