"""The operational views as registered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from formflow.plans import views
from formflow.plans.catalog import inputs
from formflow.plans.catalog.joins import procedures
from formflow.plans.fixtures import RUN_TS, STUDY, fixture, oracle
from formflow.plans.registry import query

CONSENT = views.ConsentSpec(
    form="form_b", type_field="reason", type_code="C01", date_field="consent_dt", complete_field="form_b_complete",
    granted_field="segment", study=STUDY,
)


@query("view_consent", oracle(f"""
select sha256(concat_ws(chr(1), report_id, site_id, catchment_id, case_id, site_guid)) as id, site_id as consent_site_id, report_id,
       catchment_id, case_id, segment as consent_granted, reason as consent_type, consent_dt as consent_date, site_guid,
       '{STUDY}' as file_name, '{RUN_TS}' as created_on, 1 as active
from (select d.report_id, d.site_id, d.catchment_id, d.case_id, s.id as site_guid,
             max(case when field_name = 'segment' then field_value end) as segment, max(case when field_name = 'reason' then field_value end) as reason,
             max(case when field_name = 'consent_dt' then field_value end) as consent_dt,
             max(case when field_name = 'form_b_complete' then field_value end) as done
      from ox_decoded d join fx_site s on s.site_id = d.site_id
      where form_name = 'form_b' and field_name in ('segment', 'reason', 'consent_dt', 'form_b_complete') group by all)
where reason = 'C01' and done = '2'"""))
def view_consent(spark, d):
    return views.consent(inputs.decoded(spark, d), fixture(spark, d, "fx_site"), CONSENT, inputs.run_ts())


@query("view_authorization", oracle(f"""
select sha256(concat_ws(chr(1), case_id, site_guid)) as id, right(case_id, 5) as auth_id, case_id, site_guid, 'C01' as consent_type,
       consent_dt as event_date, '{STUDY}' as file_name, 1 as active, 1 as valid, '{RUN_TS}' as created_on, '{RUN_TS}' as modified_on,
       '{RUN_TS}' as uploaded_on, 'P-1' as protocol, 'A-1' as authorization_code
from (select case_id, site_guid, max(case when field_name = 'reason' then v end) as reason,
             max(case when field_name = 'consent_dt' then v end) as consent_dt, max(case when field_name = 'form_b_complete' then v end) as done
      from (select d.case_id, d.field_name, max(d.field_value) as v, max(s.id) as site_guid
            from ox_decoded d join fx_site s on s.site_id = d.site_id
            where form_name = 'form_b' and field_name in ('reason', 'consent_dt', 'form_b_complete') group by d.case_id, d.field_name)
      group by case_id, site_guid)
where reason = 'C01' and done = '2'"""))
def view_authorization(spark, d):
    return views.authorization(
        inputs.decoded(spark, d), fixture(spark, d, "fx_site"), CONSENT, {"protocol": "P-1", "authorization_code": "A-1"}, inputs.run_ts()
    )


@query("view_notification", oracle(f"""
select sha256(concat_ws(chr(1), site_guid, report_id, catchment_id)) as id, report_id, catchment_id, notified_on, site_guid, site_id,
       '{STUDY}' as file_name, 1 as active, '{RUN_TS}' as created_on, '{RUN_TS}' as modified_on, '{RUN_TS}' as uploaded_on
from ox_notification"""))
def view_notification(spark, d):
    return views.notification(inputs.decoded(spark, d), fixture(spark, d, "fx_site"), "form_a", "order_dt", STUDY, inputs.run_ts())


@query("view_procedure", oracle(f"""
select sha256(concat_ws(chr(1), case_id, coalesce(site_guid, chr(0)))) as id, site_guid, case_id, kit, performed_on,
       '{STUDY}' as file_name, 1 as active, '{RUN_TS}' as created_on, '{RUN_TS}' as modified_on, '{RUN_TS}' as uploaded_on
from ox_procedure"""))
def view_procedure(spark, d):
    return procedures(spark, d)


@query("view_specimens", oracle(f"""
select sha256(concat_ws(chr(1), case_id, site_guid)) as id, site_guid, case_id, kit_id, collection_date, 'YES' as collected,
       '{STUDY}' as file_name, 1 as active, '{RUN_TS}' as created_on, '{RUN_TS}' as modified_on, '{RUN_TS}' as uploaded_on,
       'etl' as created_by, 'etl' as modified_by, 'etl' as uploaded_by
from (select m.case_id, r.site_guid, max(case when field_name = 'linestatus' then field_value end) as performed,
             max(case when field_name = 'kit_id' then field_value end) as kit_id, max(case when field_name = 'ship_dt' then field_value end) as collection_date
      from fx_repeat_mart m join fx_registration r on r.case_id = m.case_id and r.kind = 'F' and r.file_name = '{STUDY}' and r.active = 1
      where m.is_deleted = 0 and m.field_name in ('linestatus', 'kit_id', 'ship_dt') group by all)
where performed = 'O'"""))
def view_specimens(spark, d):
    return views.specimens(
        inputs.repeat_mart(spark, d), fixture(spark, d, "fx_registration"), "kit_id", "ship_dt", "linestatus", "O",
        "YES", STUDY, "F", "etl", inputs.run_ts(),
    )
