"""Aggregation and order-dependent queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from formflow.functions import matches_pattern
from formflow.operators import decode, enrich, ordered, quality, reshape, rollup, upsert
from formflow.plans.catalog import inputs
from formflow.plans.catalog.joins import LAB_GROUPS
from formflow.plans.fixtures import fixture, oracle
from formflow.plans.registry import query


@query("agg_two_level_pivot", oracle("""
select case_id, site_guid, max(case when field_name = 'reason' then field_value end) as reason,
       max(case when field_name = 'consent_dt' then field_value end) as consent_dt
from (select d.case_id, d.field_name, max(d.field_value) as field_value, max(s.id) as site_guid
      from ox_decoded d join fx_site s on s.site_id = d.site_id
      where d.form_name = 'form_b' and d.field_name in ('reason', 'consent_dt') group by d.case_id, d.field_name)
group by case_id, site_guid"""))
def agg_two_level_pivot(spark, d):
    rows = inputs.decoded(spark, d).filter((F.col("form_name") == "form_b") & F.col("field_name").isin("reason", "consent_dt"))
    per_field = decode.join_site(rows, fixture(spark, d, "fx_site")).groupBy("case_id", "field_name").agg(
        F.max("field_value").alias("field_value"), F.max("site_guid").alias("site_guid")
    )
    return reshape.pivot_fields(per_field, ["case_id", "site_guid"], ["reason", "consent_dt"])


@query("agg_conditional_max", oracle("""
select case_id, strftime(max(case when form_name = 'specimen_form' then try_cast(created_on as date) end), '%Y-%m-%d') as specimen_on,
       strftime(max(case when form_name = 'culture_form' then try_cast(created_on as date) end), '%Y-%m-%d') as culture_on,
       strftime(max(try_cast(created_on as date)), '%Y-%m-%d') as any_lab_on
from ox_registered group by case_id"""))
def agg_conditional_max(spark, d):
    out = rollup.conditional_max(inputs.registered(spark, d), "case_id", LAB_GROUPS)
    return out.select("case_id", *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in LAB_GROUPS])


@query("agg_last_date", oracle("""
select case_id, strftime(max(try_cast(created_on as date)), '%Y-%m-%d') as last_on from fx_repeat_mart group by case_id"""))
def agg_last_date(spark, d):
    out = rollup.last_date(inputs.repeat_mart(spark, d), "case_id", "last_on")
    return out.withColumn("last_on", F.date_format("last_on", "yyyy-MM-dd"))


@query("agg_distinct_forms", oracle("select distinct case_id, form_name from ox_registered"))
def agg_distinct_forms(spark, d):
    return decode.forms_of(inputs.registered(spark, d))


@query("dq_invalid_digest", oracle("""
select site_id, case_id, count(distinct report_id) as report_count from ox_staging
where not regexp_full_match(case_id, '[A-Za-z]{4}[0-9]{5}') group by site_id, case_id"""))
def dq_invalid_digest(spark, d):
    return enrich.invalid_digest(inputs.staging(spark, d), matches_pattern())


@query("dq_load_warnings", oracle("""
select site_id, case_id, count(distinct report_id) as report_count from ox_staging
where not regexp_full_match(case_id, '[A-Za-z]{4}[0-9]{5}') group by site_id, case_id"""))
def dq_load_warnings(spark, d):
    # The loader's own digest, taken from the per-record keys.
    return enrich.load_case_rows(inputs.eav(spark, d)).warnings


@query("dq_missing_key_counts", oracle("""
select site_id, report_id, count(*) as missing_rows from ox_staging where catchment_id = '' group by site_id, report_id"""))
def dq_missing_key_counts(spark, d):
    return enrich.missing_key_counts(inputs.staging(spark, d))


@query("enrich_dropped_counts", oracle("""
select count(*) as records, cast(coalesce(sum(n), 0) as bigint) as rows from (
 select e.record, e.site_id, count(*) as n from ox_eav e
 where not exists (select 1 from ox_keys k where k.record = e.record and k.site_id = e.site_id) group by e.record, e.site_id)"""))
def enrich_dropped_counts(spark, d):
    return enrich.count_unkeyed(inputs.eav(spark, d))


@query("dq_duplicate_keys", oracle("""
select case_id, repeat_instrument, repeat_instance, field_name, field_value, count(*) as row_count
from fx_repeat_mart group by all having count(*) > 1"""))
def dq_duplicate_keys(spark, d):
    keys = ["case_id", "repeat_instrument", "repeat_instance", "field_name", "field_value"]
    return quality.duplicate_keys(inputs.repeat_mart(spark, d), keys)


@query("dq_top_duplicates", oracle("""
select case_id, field_name, count(*) as row_count from fx_repeat_mart group by all having count(*) > 1
order by row_count desc, case_id, field_name limit 5"""))
def dq_top_duplicates(spark, d):
    return quality.top_duplicates(inputs.repeat_mart(spark, d), ["case_id", "field_name"])


@query("agg_flag_counts", oracle("select is_deleted, count(*) as row_count from fx_repeat_mart group by is_deleted"))
def agg_flag_counts(spark, d):
    return quality.flag_counts(inputs.repeat_mart(spark, d))


@query("agg_ordered_listagg", oracle("""
select form_name, string_agg(field_value_label, ', ' order by field_value_label) as answers
from (select distinct form_name, field_value_label from ox_decoded where field_type in ('radio', 'dropdown', 'checkbox'))
group by form_name"""))
def agg_ordered_listagg(spark, d):
    choices = inputs.decoded(spark, d).filter(F.col("field_type").isin("radio", "dropdown", "checkbox"))
    return quality.ordered_list(choices, "form_name", "field_value_label", "answers")


@query("agg_ordered_list_ranges", oracle("""
select form_name, string_agg(field_value_label, ', ' order by field_value_label) as answers
from (select distinct form_name, field_value_label from ox_decoded) group by form_name"""))
def agg_ordered_list_ranges(spark, d):
    return quality.ordered_list_by_range(inputs.decoded(spark, d), "form_name", "field_value_label", "answers")


@query("dedup_latest", oracle("""
select id, case_id, kind, created_on from (
 select *, row_number() over (partition by case_id order by created_on desc, id desc) as rn from fx_visits where active = 1)
where rn > 1"""))
def dedup_latest(spark, d):
    rows = fixture(spark, d, "fx_visits").filter("active = 1").select("id", "case_id", "kind", "created_on")
    return upsert.older_duplicates(rows, ["case_id"], ["created_on", "id"])


@query("dedup_latest_multi", oracle("""
select id, case_id, kind, active, created_on from (
 select *, row_number() over (partition by case_id, kind, active order by created_on desc, id desc) as rn from fx_visits)
where rn > 1"""))
def dedup_latest_multi(spark, d):
    rows = fixture(spark, d, "fx_visits").select("id", "case_id", "kind", "active", "created_on")
    return upsert.older_duplicates(rows, ["case_id", "kind", "active"], ["created_on", "id"])


@query("win_ffill", oracle("""
select seq, case_id, amount, last_value(case when kind = 'purchase' then amount end ignore nulls) over (
 partition by case_id order by seq rows between unbounded preceding and current row) as filled from fx_visits"""))
def win_ffill(spark, d):
    rows = fixture(spark, d, "fx_visits").select("seq", "case_id", "kind", "amount")
    known = F.when(F.col("kind") == "purchase", F.col("amount"))
    return ordered.fill_down(rows, "seq", known, "filled", keys=["case_id"]).drop("kind")
