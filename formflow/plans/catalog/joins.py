"""Enrichment, decode and roll-up queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from formflow.functions import LETTERS4_DIGITS5, bits, matches_pattern
from formflow.operators import decode, enrich, rollup, upsert
from formflow.plans import views
from formflow.plans.catalog import inputs
from formflow.plans.fixtures import RUN_DATE, STUDY, fixture, oracle, table
from formflow.plans.registry import query



@query("enrich_keys", oracle("""
select e.record, e.site_id, e.field_name, e.value, k.case_id, k.catchment_id
from ox_eav e join ox_keys k on e.record = k.record and e.site_id = k.site_id"""))
def enrich_keys(spark, d):
    return enrich.enrich_keys(inputs.eav(spark, d))


@query("enrich_left_lookup", oracle("""
select e.record, e.field_name, e.value, l.value as segment
from ox_eav e left join (select record, value from ox_eav where field_name = 'segment' and value <> '') l on e.record = l.record"""))
def enrich_left_lookup(spark, d):
    out = enrich.left_lookup(inputs.eav(spark, d), "segment", "segment")
    return out.select("record", "field_name", "value", "segment")


@query("enrich_packet_map", oracle("""
select e.record, e.field_name, e.value, trim(coalesce(m.case_id, '')) as case_id
from ox_eav e left join (select record, max(value) as case_id from ox_eav where field_name = 'case_id' group by record) m
  on e.record = m.record"""))
def enrich_packet_map(spark, d):
    return enrich.packet_map(inputs.eav(spark, d)).select("record", "field_name", "value", "case_id")


@query("exclude_invalid_reports", oracle("""
select * from ox_staging where not exists (select 1 from ox_bad b where b.report_id = ox_staging.report_id)"""))
def exclude_invalid_reports(spark, d):
    return enrich.exclude_invalid_reports(inputs.staging(spark, d), matches_pattern(LETTERS4_DIGITS5))


@query("exclude_invalid_few", oracle("""
select * from ox_staging where not exists (select 1 from ox_bad b where b.report_id = ox_staging.report_id)"""))
def exclude_invalid_few(spark, d):
    return enrich.exclude_invalid_reports(inputs.staging(spark, d), matches_pattern(LETTERS4_DIGITS5), words=bits.WORDS)


@query("load_accepted_rows", oracle("""
select site_id, catchment_id, report_id, case_id, field_name, field_value from ox_staging
where not exists (select 1 from ox_bad b where b.report_id = ox_staging.report_id)"""))
def load_accepted_rows(spark, d):
    return enrich.load_case_rows(inputs.eav(spark, d), words=bits.WORDS).rows


@query("join_site", oracle("""
select m.*, s.id as site_guid, s.name as site_name from ox_mart m join fx_site s on s.site_id = m.site_id"""))
def join_site(spark, d):
    return decode.join_site(inputs.mart(spark, d), fixture(spark, d, "fx_site"))


@query("join_prefix_key", oracle("""
select r.record, r.repeat_instance, r.kit_id, s.id as site_guid from fx_repeat r left join fx_site s on s.iso = left(r.record, 2)"""))
def join_prefix_key(spark, d):
    rows = fixture(spark, d, "fx_repeat").select("record", "repeat_instance", "kit_id")
    return decode.join_site_by_prefix(rows, fixture(spark, d, "fx_site"), "record")


@query("decode_all", oracle("select * from ox_decoded"))
def decode_all(spark, d):
    return inputs.decoded(spark, d)


@query("decode_report", oracle("select * from ox_report"))
def decode_report(spark, d):
    return inputs.report(spark, d)


@query("decode_registered", oracle("select * from ox_registered"))
def decode_registered(spark, d):
    return inputs.registered(spark, d)


@query("join_residual", oracle(f"""
select m.case_id, m.field_name, m.field_value, r.site_guid
from fx_repeat_mart m join fx_registration r on r.case_id = m.case_id and r.kind = 'O' and r.file_name = '{STUDY}' and r.active = 1
where m.is_deleted = 0"""))
def join_residual(spark, d):
    cases = decode.of_study(fixture(spark, d, "fx_registration"), STUDY, "O").select("case_id", "site_guid")
    rows = inputs.repeat_mart(spark, d).filter(F.col("is_deleted") == 0)
    return rows.join(cases, "case_id").select("case_id", "field_name", "field_value", "site_guid")


LAB_GROUPS = {
    "specimen_on": ["specimen_form"], "culture_on": ["culture_form"], "any_lab_on": ["specimen_form", "culture_form", "shipping_form"],
}


def procedures(spark, d):
    out = views.procedure(
        inputs.repeat_mart(spark, d), fixture(spark, d, "fx_site"),
        {"kit": "kit_id", "performed_on": "ship_dt"}, "linestatus", "O", STUDY, inputs.run_ts(),
    )
    return out


@query("status_rollup", oracle(f"""
select r.case_id, n.report_id, n.catchment_id, n.notified_on,
       datediff('day', try_cast(n.notified_on as date), date '{RUN_DATE}') as days_since_notification,
       n.site_id, n.site_guid, s.name as site_name, strftime(p.procedure_on, '%Y-%m-%d') as procedure_on,
       strftime(a.abstraction_on, '%Y-%m-%d') as abstraction_on, strftime(l.specimen_on, '%Y-%m-%d') as specimen_on,
       strftime(l.culture_on, '%Y-%m-%d') as culture_on, strftime(l.any_lab_on, '%Y-%m-%d') as any_lab_on
from ox_notification n
join fx_site s on n.site_guid = s.id
join fx_registration r on n.report_id = r.report_id and r.active = 1 and n.site_guid = r.site_guid and n.catchment_id = r.catchment_id
left join (select case_id, max(try_cast(created_on as date)) as abstraction_on from fx_repeat_mart group by case_id) a on r.case_id = a.case_id
left join (select case_id, site_guid, try_cast('{RUN_DATE}' as date) as procedure_on from ox_procedure where site_guid is not null) p
  on r.case_id = p.case_id and r.file_name = '{STUDY}'
left join (select case_id, max(case when form_name = 'specimen_form' then try_cast(created_on as date) end) as specimen_on,
                  max(case when form_name = 'culture_form' then try_cast(created_on as date) end) as culture_on,
                  max(try_cast(created_on as date)) as any_lab_on from ox_registered group by case_id) l on r.case_id = l.case_id"""))
def status_rollup(spark, d):
    notes = views.notification(inputs.decoded(spark, d), fixture(spark, d, "fx_site"), "form_a", "order_dt", STUDY, inputs.run_ts())
    mart, registrations = inputs.repeat_mart(spark, d), fixture(spark, d, "fx_registration")
    lab = rollup.lab_dates(
        mart, fixture(spark, d, "fx_repeat_dict"), registrations, STUDY, inputs.SUPPRESSED, LAB_GROUPS
    )
    out = rollup.status_rollup(
        notes, fixture(spark, d, "fx_site"), registrations, mart, procedures(spark, d), lab, F.to_date(F.lit(RUN_DATE)),
    )
    dates = ["procedure_on", "abstraction_on", *LAB_GROUPS]
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in dates})


@query("case_status_source", oracle("""
select r.case_id, r.site_guid, r.catchment_id, s.site_id as site_code
from fx_registration r
join (select cast(n_nationkey as string) as site_guid, lpad(cast(n_nationkey % 3 as string), 3, '0') as catchment_id,
             concat('Region ', cast(n_regionkey as string)) as description from nation) c
  on r.site_guid = c.site_guid and r.catchment_id = c.catchment_id and c.description = 'Region 1'
join fx_site s on c.site_guid = s.id"""))
def case_status_source(spark, d):
    key = F.col("n_nationkey")
    catchments = table(spark, d, "nation").select(
        key.cast("string").alias("site_guid"), F.lpad((key % 3).cast("string"), 3, "0").alias("catchment_id"),
        F.concat(F.lit("Region "), F.col("n_regionkey").cast("string")).alias("description"),
    )
    return rollup.case_status_source(fixture(spark, d, "fx_registration"), catchments, fixture(spark, d, "fx_site"), "Region 1")


@query("anti_missing", oracle("""
select t.id, t.case_id, t.kind, t.site from fx_target t
where t.active = 1 and not exists (select 1 from fx_source s where s.case_id = t.case_id and s.kind = t.kind
  and s.site is not distinct from t.site)"""))
def anti_missing(spark, d):
    live = fixture(spark, d, "fx_target").filter("active = 1").select("id", "case_id", "kind", "site")
    return upsert.missing_rows(live, fixture(spark, d, "fx_source"), ["case_id", "kind", "site"])


@query("report_links", oracle("""
select f.case_id, concat(coalesce(n.report_uri, ''), f.case_id) as report_uri, n.report_sequence, n.package_type
from (select distinct case_id, case form_name when 'form_a' then 'rep-a' when 'form_b' then 'rep-b' end as report_view_name
      from ox_report where case_id <> ''
      union all select distinct case_id, concat('lab-', form_name) from ox_registered) f
join fx_report_names n on f.report_view_name = n.report_view_name"""))
def report_links(spark, d):
    return decode.report_links(
        [
            (decode.forms_of(inputs.report(spark, d), non_blank_case=True), decode.named_reports({"form_a": "rep-a", "form_b": "rep-b"})),
            (decode.forms_of(inputs.registered(spark, d)), decode.prefixed_reports("lab-")),
        ],
        fixture(spark, d, "fx_report_names"),
    )
