"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from formflow.operators import digest, fingerprints, quality, reshape
from formflow.plans.catalog import inputs
from formflow.plans.fixtures import RUN_DATE, RUN_TS, fixture, oracle, table
from formflow.plans.registry import ORACLES, query
from formflow.session import materialise

REPEAT_COLS = ["case_id", "repeat_instrument", "repeat_instance", "field_name", "field_value", "created_on", "is_deleted"]


@query("dq_soft_delete_pct", oracle("""
select deleted_records, total_records, deleted_records * 100.0::double / total_records as deleted_percentage,
       case when deleted_records * 100.0 / total_records > 5 then 1 else 0 end as failed
from (select count(*) as total_records, count(*) filter (is_deleted = 1) as deleted_records from fx_repeat_mart)"""))
def dq_soft_delete_pct(spark, d):
    return quality.soft_delete_percentage(inputs.repeat_mart(spark, d), 5)


@query("dq_length_rule", oracle("""
select case_id, count(*) as row_count from ox_staging where length(trim(case_id)) <> 9 group by case_id"""))
def dq_length_rule(spark, d):
    return quality.length_failures(inputs.staging(spark, d), "case_id")


@query("dq_length_keep", oracle("select * from ox_staging where length(trim(case_id)) = 9"))
def dq_length_keep(spark, d):
    return quality.keep_valid_length(inputs.staging(spark, d), "case_id")


@query("dq_min_rows", oracle("select count(*) as row_count, cast(100 as bigint) as min_rows, cast(count(*) >= 100 as integer) as passed from ox_mart"))
def dq_min_rows(spark, d):
    return quality.min_rows(inputs.mart(spark, d), 100)


@query("dq_not_null_sample", oracle("""
select record, site_id, case_id, status from fx_flat where case_id is null and status <> 'F' order by record limit 100"""))
def dq_not_null_sample(spark, d):
    rows = fixture(spark, d, "fx_flat").select("record", "site_id", "case_id", "status")
    return quality.not_null_sample(rows, "case_id", ["record"], "status <> 'F'")


@query("dq_not_null_failures", oracle("select case_id, field_name, field_value from fx_repeat_mart where repeat_instance is null"))
def dq_not_null_failures(spark, d):
    rows = inputs.repeat_mart(spark, d).select("case_id", "repeat_instance", "field_name", "field_value")
    return quality.not_null_failures(rows, "repeat_instance").drop("repeat_instance")


@query("dq_id_format", oracle("""
select record, case_id from fx_flat where case_id is not null and (length(case_id) <> 9
  or not regexp_full_match(substr(case_id, 1, 4), '[A-Z]{4}') or not regexp_full_match(substr(case_id, 5, 5), '[0-9]{5}'))"""))
def dq_id_format(spark, d):
    return quality.id_format_failures(fixture(spark, d, "fx_flat").select("record", "case_id"), "case_id")


@query("dq_date_not_future", "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as order_day from orders where o_orderdate > timestamp '2000-06-30 00:00:00'")
def dq_date_not_future(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    late = quality.future_dates(rows, "o_orderdate", F.lit("2000-06-30 00:00:00").cast("timestamp_ntz"))
    return late.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"))


@query("dq_null_profile", oracle("""
select c as column_name, n as row_count, k as null_count from (select count(*) as n,
 count(*) filter (case_id is null) as a, count(*) filter (repeat_instance is null) as b, count(*) filter (created_on is null) as e from fx_repeat_mart) t,
 lateral (values ('case_id', a), ('repeat_instance', b), ('created_on', e)) u(c, k)"""))
def dq_null_profile(spark, d):
    return quality.null_profile(inputs.repeat_mart(spark, d), ["case_id", "repeat_instance", "created_on"])


_CHANGED = "case when field_name = 'priority' then upper(value) || '!' else value end as value"


@query("dq_equivalence", oracle(f"""
select (select count(*) from ox_eav) as left_rows, (select count(*) from ox_eav) as right_rows,
       (select count(*) from (select record, site_id, field_name, value from ox_eav
                              except all select record, site_id, field_name, {_CHANGED} from ox_eav)) as only_left,
       (select count(*) from (select record, site_id, field_name, {_CHANGED} from ox_eav
                              except all select record, site_id, field_name, value from ox_eav)) as only_right,
       0 as equal"""))
def dq_equivalence(spark, d):
    a = inputs.eav(spark, d)
    changed = F.when(F.col("field_name") == "priority", F.concat(F.upper("value"), F.lit("!"))).otherwise(F.col("value"))
    return quality.compare(a, a.withColumn("value", changed))


@query("dq_equivalence_tree", ORACLES["dq_equivalence"])
def dq_equivalence_tree(spark, d):
    """The same figures by a hash tree: rows move only from buckets that differ."""
    a = materialise(inputs.eav(spark, d), "compared")
    return fingerprints.compare_tree(a, a.withColumn("value", F.expr(_CHANGED.removesuffix(" as value"))), ["record", "field_name"]).figures


@query("dq_differing_rows", oracle(f"""
select record, site_id, field_name, value, cast(sum(n) as bigint) as left_surplus from (
  select record, site_id, field_name, value, 1 as n from ox_eav
  union all select record, site_id, field_name, {_CHANGED}, -1 from ox_eav)
group by record, site_id, field_name, value having sum(n) <> 0"""))
def dq_differing_rows(spark, d):
    a = materialise(inputs.eav(spark, d), "compared")
    return fingerprints.compare_tree(a, a.withColumn("value", F.expr(_CHANGED.removesuffix(" as value")))).differing


@query("dq_equivalence_rewrite", oracle("""
select count(*) as left_rows, count(*) as right_rows, cast(0 as bigint) as only_left, cast(0 as bigint) as only_right, 1 as equal from ox_eav"""))
def dq_equivalence_rewrite(spark, d):
    # The fused un-pivot against un-pivot followed by decode.
    flat = fixture(spark, d, "fx_flat")
    return quality.compare(reshape.decode_multiselect(reshape.unpivot_eav(flat)), reshape.wide_to_eav(flat))


@query("dq_equivalence_tree_equal", ORACLES["dq_equivalence_rewrite"])
def dq_equivalence_tree_equal(spark, d):
    """Two forms of one query, equal: fingerprints only."""
    flat = fixture(spark, d, "fx_flat")
    return fingerprints.compare_tree(reshape.decode_multiselect(reshape.unpivot_eav(flat)), reshape.wide_to_eav(flat)).figures


_WIDTHS = {"case_id": 9, "repeat_instance": 3, "field_value": 8}


@query("dq_overlong_values", oracle(" union all ".join(
    f"select '{c}' as column_name, {n} as width, count(*) filter (length({c}) > {n}) as overlong, "
    f"cast(coalesce(max(length({c})), 0) as integer) as longest from fx_repeat_mart" for c, n in _WIDTHS.items())))
def dq_overlong_values(spark, d):
    return quality.overlong_values(inputs.repeat_mart(spark, d), _WIDTHS)


@query("dq_profile_equivalence", oracle("""
select c as column_name, n as left_rows, k as left_nulls, m as right_rows, j as right_nulls, cast(n = m and k = j as integer) as passed
from (select count(*) as n, count(*) filter (case_id is null) as a, count(*) filter (repeat_instance is null) as b from fx_repeat_mart) l,
     (select count(*) as m, count(*) filter (case_id is null) as a2, count(*) filter (repeat_instance is null) as b2 from fx_repeat_mart where is_deleted = 0) r,
     lateral (values ('case_id', l.a, r.a2), ('repeat_instance', l.b, r.b2)) u(c, k, j)"""))
def dq_profile_equivalence(spark, d):
    rows = inputs.repeat_mart(spark, d)
    cols = ["case_id", "repeat_instance"]
    return quality.compare_profiles(rows.select(*cols), rows.filter("is_deleted = 0").select(*cols))


@query("dq_merge_warnings", oracle("""
select site_id, case_id, cast(sum(report_count) as bigint) as report_count from (
 select site_id, case_id, count(distinct report_id) as report_count from ox_staging
 where not regexp_full_match(case_id, '[A-Za-z]{4}[0-9]{5}') group by all
 union all select site as site_id, case_id, count(*) from fx_target group by all) group by site_id, case_id"""))
def dq_merge_warnings(spark, d):
    return digest.merge_warnings(_state(spark, d), _warnings(spark, d))


def _warnings(spark, d):
    from formflow.operators.enrich import load_case_rows

    return load_case_rows(inputs.eav(spark, d)).warnings


def _state(spark, d):
    return fixture(spark, d, "fx_target").groupBy(F.col("site").alias("site_id"), "case_id").agg(F.count(F.lit(1)).alias("report_count"))


@query("dq_weekly_digest", oracle(f"""
select site_id, case_id, cast(sum(report_count) as bigint) as report_count, 1 as due from (
 select site_id, case_id, count(distinct report_id) as report_count from ox_staging
 where not regexp_full_match(case_id, '[A-Za-z]{{4}}[0-9]{{5}}') group by all
 union all select site as site_id, case_id, count(*) from fx_target group by all)
where exists (select 1 from ox_staging where not regexp_full_match(case_id, '[A-Za-z]{{4}}[0-9]{{5}}'))
  and datediff('day', date '2024-01-25', date '{RUN_DATE}') >= 7
group by site_id, case_id"""))
def dq_weekly_digest(spark, d):
    return digest.weekly_digest(
        _state(spark, d), F.to_date(F.lit("2024-01-25")), _warnings(spark, d), F.to_date(F.lit(RUN_DATE))
    )


@query("log_error_digest", oracle("""
select event_id, level, message, total_errors, greatest(total_errors - 20, 0) as not_shown
from (select *, count(*) over () as total_errors, row_number() over (order by ts, event_id) as rn from fx_log
      where level in ('ERROR', 'WARNING') and ts >= timestamp '2024-01-15 12:00:00' - interval 48 hours
        and ts <= timestamp '2024-01-15 12:00:00')
where rn <= 20"""))
def log_error_digest(spark, d):
    run = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    return digest.error_digest(fixture(spark, d, "fx_log"), run, ["ERROR", "WARNING"], hours=48)


@query("dq_preflight", oracle("""
select (select count(*) from fx_source) as source_rows,
       (select count(*) from (select case_id, kind from fx_source group by all having count(*) > 1)) as source_duplicate_keys,
       (select count(*) from fx_target) as target_rows, (select count(*) from fx_target where active = 1) as target_active_rows"""))
def dq_preflight(spark, d):
    return quality.preflight(fixture(spark, d, "fx_source"), fixture(spark, d, "fx_target"), ["case_id", "kind"], "active = 1")


@query("dq_run_checks", oracle("""
select 'case_id_format' as check_name, count(*) as failures, cast(count(*) = 0 as integer) as passed from fx_flat
 where case_id is not null and not regexp_full_match(case_id, '[A-Z]{4}[0-9]{5}')
union all select 'record_not_null', count(*), cast(count(*) = 0 as integer) from fx_flat where record is null
union all select 'unique_key', count(*), cast(count(*) = 0 as integer) from (select record from fx_flat group by record having count(*) > 1)"""))
def dq_run_checks(spark, d):
    flat = fixture(spark, d, "fx_flat")
    return quality.run_checks({
        "case_id_format": quality.id_format_failures(flat, "case_id"),
        "record_not_null": quality.not_null_failures(flat, "record"),
        "unique_key": quality.duplicate_keys(flat, ["record"]),
    })


@query("dq_digest_state", oracle("select site as site_id, case_id, count(*) as report_count from fx_target group by all"))
def dq_digest_state(spark, d):
    # State documents as stored: one JSON text per site, read back as warning rows.
    docs = _state(spark, d).select(
        F.to_json(F.struct(F.lit("2024-01-25").alias("last_notified"), F.array(F.struct("site_id", "case_id", "report_count")).alias("warnings"))).alias("value")
    )
    return digest.state_warnings(docs)


MART_TESTS = [
    quality.Declared("case id is set", "case_id is null"),
    quality.Declared("case id has nine characters", "length(trim(case_id)) <> 9"),
    quality.Declared("catchment is set", "catchment_id = ''", error_after=None),
    quality.Declared("value is set", "field_value is null or trim(field_value) = ''", error_after=100),
    quality.Declared("few rows are deleted", "is_deleted = 1", warn_after=100, error_after=10**9),
]


_TALLY = """(select count(*) filter (case_id is null) as a, count(*) filter (length(trim(case_id)) <> 9) as b, count(*) filter (catchment_id = '') as c,
 count(*) filter (field_value is null or trim(field_value) = '') as d, count(*) filter (is_deleted = 1) as e from ox_mart) n"""


@query("dq_mart_tests", oracle(f"""
select 'case id is set' as test, a as failures, case when a > 0 then 'error' else 'pass' end as status from {_TALLY}
union all select 'case id has nine characters', b, case when b > 0 then 'error' else 'pass' end from {_TALLY}
union all select 'catchment is set', c, case when c > 0 then 'warn' else 'pass' end from {_TALLY}
union all select 'value is set', d, case when d > 100 then 'error' when d > 0 then 'warn' else 'pass' end from {_TALLY}
union all select 'few rows are deleted', e, case when e > 1000000000 then 'error' when e > 100 then 'warn' else 'pass' end from {_TALLY}
union all select 'one row per field', count(*), case when count(*) > 0 then 'error' else 'pass' end
from (select 1 from ox_mart group by site_id, report_id, field_name having count(*) > 1)"""))
def dq_mart_tests(spark, d):
    """The declared tests of the case mart with their severity; the multi-select field repeats by design, so its uniqueness fails."""
    return quality.declared_tests(inputs.mart(spark, d), MART_TESTS, {"one row per field": ["site_id", "report_id", "field_name"]})
