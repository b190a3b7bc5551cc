"""Upsert, deactivation and snapshot queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from formflow.operators import upsert
from formflow.operators.upsert import MergeSpec
from formflow.plans.catalog import inputs
from formflow.plans.fixtures import RUN_TS, fixture, oracle
from formflow.plans.registry import query
from formflow.session import materialise, work_dir
from formflow.sinks.buckets import BucketedMart

KEYS = ("case_id", "kind", "site")
INSERTS = {
    "id": "s.id", "case_id": "s.case_id", "kind": "s.kind", "site": "s.site", "seg": "s.seg", "event_date": "s.event_date",
    "status_text": "'Pending'", "active": "1", "created_on": f"'{RUN_TS}'", "modified_on": f"'{RUN_TS}'",
}
UPDATES = {"seg": "s.seg", "event_date": "s.event_date", "modified_on": f"'{RUN_TS}'"}

ALWAYS = MergeSpec(KEYS, UPDATES, INSERTS, target_filter="active = 1")
HASH = "md5(upper(concat_ws(chr(1), coalesce({p}.case_id, ''), coalesce({p}.kind, ''), coalesce({p}.seg, ''))))"
HASH_DIFF = MergeSpec(KEYS, UPDATES, INSERTS, update_when=f"{HASH.format(p='t')} <> {HASH.format(p='s')}")
COLUMN_DIFF = MergeSpec(KEYS, {"event_date": "s.event_date", "modified_on": f"'{RUN_TS}'"}, INSERTS, target_filter="active = 1", update_when="t.event_date <> s.event_date")
NO_ACTIVE = MergeSpec(("case_id", "kind"), {**UPDATES, "site": "s.site"}, INSERTS)
STATE_GATE = MergeSpec(("case_id", "kind"), {"seg": "s.seg", "modified_on": f"'{RUN_TS}'"}, INSERTS, update_when="t.status_text = 'Pending'")
PLAIN_KEYS = MergeSpec(KEYS, UPDATES, INSERTS, target_filter="active = 1", null_safe=False)

_SET = {"seg": "s.seg", "event_date": "s.event_date", "modified_on": f"'{RUN_TS}'"}


def _oracle(on: str, sets: dict[str, str], when: str = "true", target_filter: str = "true", action: bool = True) -> str:
    """Expected next version: matched rows, untouched rows, inserted rows."""
    cols = ["id", "case_id", "kind", "site", "seg", "event_date", "status_text", "active", "created_on", "modified_on"]
    matched = f"s.id is not null and ({target_filter}) and coalesce({when}, false)"
    picks = ", ".join(f"case when {matched} then {sets[c]} else t.{c} end as {c}" if c in sets else f"t.{c}" for c in cols)
    new = {
        "id": "s.id", "status_text": "'Pending'", "active": "1", "created_on": f"'{RUN_TS}'", "modified_on": f"'{RUN_TS}'",
    }
    inserts = ", ".join(new.get(c, f"s.{c}") + f" as {c}" for c in cols)
    added = ", 'insert' as _action" if action else ""
    tail = f", case when {matched} then 'update' else 'keep' end as _action" if action else ""
    return (
        f"select {picks}{tail} from fx_target t left join fx_source s on {on} and ({target_filter}) "
        f"union all select {inserts}{added} from fx_source s "
        f"where not exists (select 1 from fx_target t where {on} and ({target_filter}))"
    )


ON = "t.case_id = s.case_id and t.kind = s.kind and t.site is not distinct from s.site"
ON_PLAIN = "t.case_id = s.case_id and t.kind = s.kind and t.site = s.site"
ON_CASE = "t.case_id = s.case_id and t.kind = s.kind"


def _merge(spark, d, spec):
    return upsert.merge(fixture(spark, d, "fx_target"), fixture(spark, d, "fx_source"), spec)


@query("upsert_always", oracle(_oracle(ON, _SET, target_filter="t.active = 1")))
def upsert_always(spark, d):
    return _merge(spark, d, ALWAYS)


@query("upsert_plain_keys", oracle(_oracle(ON_PLAIN, _SET, target_filter="t.active = 1")))
def upsert_plain_keys(spark, d):
    return _merge(spark, d, PLAIN_KEYS)


@query("upsert_hash_diff", oracle(_oracle(
    ON, _SET, "md5(upper(concat_ws(chr(1), t.case_id, t.kind, t.seg))) <> md5(upper(concat_ws(chr(1), s.case_id, s.kind, s.seg)))")))
def upsert_hash_diff(spark, d):
    return _merge(spark, d, HASH_DIFF)


@query("upsert_column_diff", oracle(_oracle(
    ON, {"event_date": "s.event_date", "modified_on": f"'{RUN_TS}'"}, "t.event_date <> s.event_date", "t.active = 1")))
def upsert_column_diff(spark, d):
    return _merge(spark, d, COLUMN_DIFF)


@query("upsert_no_active", oracle(_oracle(ON_CASE, {**_SET, "site": "s.site"})))
def upsert_no_active(spark, d):
    return _merge(spark, d, NO_ACTIVE)


@query("upsert_state_gate", oracle(_oracle(ON_CASE, {"seg": "s.seg", "modified_on": f"'{RUN_TS}'"}, "t.status_text = 'Pending'")))
def upsert_state_gate(spark, d):
    return _merge(spark, d, STATE_GATE)


@query("dedup_deactivate", oracle("""
select seq, id, case_id, kind, created_on, case when rn > 1 then 0 else active end as active,
       case when rn > 1 then 'duplicate' else 'keep' end as _action
from (select *, case when active = 1 then row_number() over (partition by case_id, kind, active order by created_on desc, id desc) end as rn from fx_visits)"""))
def dedup_deactivate(spark, d):
    rows = fixture(spark, d, "fx_visits").drop("amount")
    return upsert.deactivate_duplicates(rows, ["case_id", "kind"], ["created_on", "id"], "active = 1")


@query("deactivate_missing", oracle(f"""
select t.* exclude (active, modified_on, gone), case when gone then 2 else active end as active,
       case when gone then '{RUN_TS}' else modified_on end as modified_on, case when gone then 'missing' else 'keep' end as _action
from (select t.*, t.active = 1 and not exists (select 1 from fx_source s where s.case_id = t.case_id and s.kind = t.kind) as gone from fx_target t) t"""))
def deactivate_missing(spark, d):
    return upsert.deactivate_missing(
        fixture(spark, d, "fx_target"), fixture(spark, d, "fx_source"), ["case_id", "kind"], "active = 1",
        stamps={"modified_on": f"'{RUN_TS}'"},
    )


@query("upsert_metrics", oracle(f"""
select count(*) filter (_action in ('update', 'insert') ) as merged, count(*) filter (_action = 'insert') as inserted,
       count(*) filter (_action = 'update') as updated, cast(0 as bigint) as deactivated_duplicates,
       cast(0 as bigint) as deactivated_missing
from ({_oracle(ON, _SET, target_filter="t.active = 1")})"""))
def upsert_metrics(spark, d):
    return upsert.action_counts(_merge(spark, d, ALWAYS))


@query("upsert_full_step", oracle(f"""
select * exclude (was, rn, active_now), case when active_now = 1 and rn > 1 then 0
  when active_now = 1 and not exists (select 1 from fx_source s where s.case_id = x.case_id and s.kind = x.kind) then 2 else active_now end as active
from (select m.* exclude (active, _action), active as active_now, _action as was,
             case when active = 1 then row_number() over (partition by case_id, active order by created_on desc, id desc) end as rn
      from ({_oracle(ON, _SET, target_filter="t.active = 1")}) m) x"""))
def upsert_full_step(spark, d):
    # Merge, then older duplicates per case, then rows missing from the source.
    done = upsert.apply_upsert(
        fixture(spark, d, "fx_target"), fixture(spark, d, "fx_source"), ALWAYS, missing_keys=["case_id", "kind"],
        scope="active = 1", duplicate_keys=["case_id"], duplicate_order=["created_on", "id"],
    )
    return done.drop("_action")


# The upserts of procedures, specimens and the two widget tables: their source is a view of finished cases.
FINISHED = "kind = 'F'"
PROCEDURE = MergeSpec(("case_id", "kind"), _SET, INSERTS, target_filter="active = 1")
SPECIMEN = MergeSpec(("case_id", "site"), {**_SET, "kind": "s.kind"}, INSERTS, target_filter="active = 1")
WIDGET = MergeSpec(("case_id", "site"), {"seg": "s.seg"}, INSERTS)
WIDGET_DETAIL = MergeSpec(("case_id", "kind", "site"), {"seg": "s.seg", "status_text": "'Closed'"}, INSERTS, update_when="t.status_text = 'Pending'")
ON_SITE = "t.case_id = s.case_id and t.site is not distinct from s.site"


def _step(merged: str, missing: str, duplicates: str | None = None) -> str:
    """Expected table after the merge: older duplicates get 0, then rows without a source row 2."""
    rank = f"case when active = 1 then row_number() over (partition by {duplicates}, active order by created_on desc, id desc) end" if duplicates else "null"
    return (
        f"select * exclude (active, rn, _action), case when active = 1 and rn > 1 then 0 when active = 1 and not exists "
        f"(select 1 from fx_source s where s.{FINISHED} and {missing}) then 2 else active end as active from (select m.*, {rank} as rn from ({merged}) m) x"
    )


def _finished(sql: str) -> str:
    return sql.replace("fx_source s", f"(select * from fx_source where {FINISHED}) s")


@query("upsert_procedure", oracle(_step(_finished(_oracle(ON_CASE, _SET, target_filter="t.active = 1")), "s.case_id = x.case_id", "case_id")))
def upsert_procedure(spark, d):
    """Merge by case and kind; older active rows of a case and cases without a finished source row are deactivated."""
    return upsert.apply_upsert(
        fixture(spark, d, "fx_target"), fixture(spark, d, "fx_source").where(FINISHED), PROCEDURE, missing_keys=["case_id"],
        scope="active = 1", duplicate_keys=["case_id"], duplicate_order=["created_on", "id"]).drop("_action")


@query("upsert_specimen", oracle(_step(_finished(_oracle(ON_SITE, {**_SET, "kind": "s.kind"}, target_filter="t.active = 1")), "s.case_id = x.case_id")))
def upsert_specimen(spark, d):
    """Two key lists: matched by case and site, deactivated by case alone."""
    return upsert.apply_upsert(
        fixture(spark, d, "fx_target"), fixture(spark, d, "fx_source").where(FINISHED), SPECIMEN, missing_keys=["case_id"],
        scope="active = 1").drop("_action")


_PAIR = (("widget", WIDGET, ["case_id", "site"]), ("detail", WIDGET_DETAIL, ["case_id", "kind", "site"]))
_PAIR_SQL = {
    "widget": (_finished(_oracle(ON_SITE, {"seg": "s.seg"})), "s.case_id = m.case_id and s.site is not distinct from m.site"),
    "detail": (_finished(_oracle(ON, {"seg": "s.seg", "status_text": "'Closed'"}, "t.status_text = 'Pending'")),
               "s.case_id = m.case_id and s.kind = m.kind and s.site is not distinct from m.site"),
}


@query("upsert_widget_pair", oracle(" union all ".join(f"""
select '{name}' as target, count(*) filter (state in ('update', 'insert')) as merged, count(*) filter (state = 'insert') as inserted,
       count(*) filter (state = 'update') as updated, cast(0 as bigint) as deactivated_duplicates, count(*) filter (state = 'missing') as deactivated_missing
from (select case when active = 1 and not exists (select 1 from fx_source s where s.{FINISHED} and {found}) then 'missing' else _action end as state from ({sql}) m)"""
    for name, (sql, found) in _PAIR_SQL.items())))
def upsert_widget_pair(spark, d):
    """Affected-row counts of two upserts that share one written source."""
    source = materialise(fixture(spark, d, "fx_source").where(FINISHED), "widget-source")
    out = None
    for name, spec, keys in _PAIR:
        done = upsert.apply_upsert(fixture(spark, d, "fx_target"), source, spec, missing_keys=keys, scope="active = 1", written=True)
        counts = upsert.action_counts(done).select(F.lit(name).alias("target"), "*")
        out = counts if out is None else out.unionByName(counts)
    return out


SNAP_KEYS = ["site_id", "case_id", "field_name", "field_value"]
_SNAP_ON = """coalesce(s.site_id, '') = coalesce(t.site_id, '') and s.case_id = t.case_id and s.field_name = t.field_name
 and s.field_value = t.field_value"""


@query("snapshot_initial", oracle(f"select *, '{RUN_TS}' as last_updated, 0 as is_deleted from fx_snapshot_source"))
def snapshot_initial(spark, d):
    return upsert.snapshot_initial(fixture(spark, d, "fx_snapshot_source"), inputs.run_ts())


@query("snapshot_deleted", oracle(f"""
select t.* from fx_snapshot_target t where t.is_deleted = 0 and not exists (select 1 from fx_snapshot_source s where {_SNAP_ON})"""))
def snapshot_deleted(spark, d):
    return upsert.snapshot_deleted(
        fixture(spark, d, "fx_snapshot_target"), fixture(spark, d, "fx_snapshot_source"), SNAP_KEYS, ["site_id"]
    )


@query("snapshot_soft_delete", oracle(f"""
select coalesce(s.id, t.id) as id, t.site_id, t.case_id, t.field_name, t.field_value, t.created_on,
       case when s.id is not null or t.is_deleted = 0 then '{RUN_TS}' else t.last_updated end as last_updated,
       case when s.id is not null then 0 else 1 end as is_deleted,
       case when s.id is not null then 'update' when t.is_deleted = 0 then 'delete' else 'keep' end as _action
from fx_snapshot_target t left join fx_snapshot_source s on {_SNAP_ON}
union all
select s.id, s.site_id, s.case_id, s.field_name, s.field_value, s.created_on, '{RUN_TS}', 0, 'insert'
from fx_snapshot_source s where not exists (select 1 from fx_snapshot_target t where {_SNAP_ON})"""))
def snapshot_soft_delete(spark, d):
    return upsert.snapshot_merge(
        fixture(spark, d, "fx_snapshot_target"), fixture(spark, d, "fx_snapshot_source"), SNAP_KEYS, inputs.run_ts(), ["site_id"]
    )


# Record numbers, in stretches of which every seventh changes between the two runs: some leave, some come.
_NUMBER = "cast(substring(case_id, 5, 5) as bigint)"
_MOVED = f"mod(cast(floor({_NUMBER} / 1000) as bigint), 7) = 0 and mod({_NUMBER}, 10)"


@query("snapshot_buckets", oracle(f"""
select id, site_id, case_id, field_name, field_value, created_on, '{RUN_TS}' as last_updated,
       case when {_MOVED} = 0 then 1 else 0 end as is_deleted
from fx_snapshot_source"""))
def snapshot_buckets(spark, d):
    """Two runs of a mart kept in buckets of 1,000 record numbers; the second rewrites the changed ones only."""
    rows = materialise(fixture(spark, d, "fx_snapshot_source"), "snapshot-source")
    mart = BucketedMart(work_dir(spark, "bucketed-mart"), SNAP_KEYS, buckets=100, bucket_of=f"floor({_NUMBER} / 1000)", blank_is_null=["site_id"])
    mart.refresh(rows.where(f"not ({_MOVED} = 9)"), "2024-01-01 00:00:00")
    mart.refresh(rows.where(f"not ({_MOVED} = 0)"), RUN_TS)
    return mart.read(spark)
