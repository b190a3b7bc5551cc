"""Reshape, filter and projection queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from formflow.functions import row_id, select_text
from formflow.operators import reshape
from formflow.plans import views
from formflow.plans.catalog import inputs
from formflow.plans.fixtures import RUN_TS, fixture, oracle
from formflow.plans.registry import query



@query("eav_unpivot", oracle("select record, site_id, field_name, value from ox_raw"))
def eav_unpivot(spark, d):
    tall = reshape.unpivot_eav(fixture(spark, d, "fx_flat"))
    return tall.select("record", "site_id", "field_name", "value")


@query("eav_checkbox_decode", oracle("select record, site_id, field_name, value from ox_eav"))
def eav_checkbox_decode(spark, d):
    return inputs.eav(spark, d)


@query("eav_promote_field", oracle("""
select e.record, coalesce(s.value, '') as segment, e.field_name, e.value
from ox_eav e left join (select record, max(value) as value from ox_eav where field_name = 'segment' group by record) s
  on e.record = s.record
where e.field_name <> 'segment'"""))
def eav_promote_field(spark, d):
    return reshape.promote_field(inputs.eav(spark, d), "segment", "segment").select("record", "segment", "field_name", "value")


@query("eav_stringify", oracle("""
select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey, o_orderstatus,
       rtrim(rtrim(printf('%.6f', o_totalprice), '0'), '.') as o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as o_orderdate, o_orderpriority
from orders"""))
def eav_stringify(spark, d):
    from formflow.plans.fixtures import table

    return select_text(table(spark, d, "orders"))


PIVOT_FIELDS = ["status", "priority", "segment", "order_dt", "not_a_field"]


@query("pivot_static", oracle("""
select record, site_id, max(case when field_name = 'status' then value end) as status,
       max(case when field_name = 'priority' then value end) as priority,
       max(case when field_name = 'segment' then value end) as segment,
       max(case when field_name = 'order_dt' then value end) as order_dt, cast(null as varchar) as not_a_field
from ox_eav where field_name in ('status', 'priority', 'segment', 'order_dt') group by record, site_id"""))
def pivot_static(spark, d):
    return reshape.pivot_fields(inputs.eav(spark, d), ["record", "site_id"], PIVOT_FIELDS, value_col="value")


# One output column per line number and measure: 81 fields, 7 x 11 of them present in the data.
_SLOTS = [f"{m}_{n}" for m in ("part", "supp", "qty", "price", "disc", "tax", "flag", "state", "ship", "sum", "key") for n in range(1, 8)]
WIDE_FIELDS = _SLOTS + ["absent_1", "absent_2", "absent_3", "absent_4"]
_WIDE_EAV = " union all ".join(
    f"select cast(l_orderkey as string) as record, concat('{m}_', cast(l_linenumber as string)) as field_name, {e} as value from lineitem"
    for m, e in {
        "part": "cast(l_partkey as string)", "supp": "cast(l_suppkey as string)", "qty": "cast(cast(l_quantity as int) as string)",
        "price": "cast(cast(floor(l_extendedprice) as bigint) as string)", "disc": "cast(cast(round(l_discount * 100) as int) as string)",
        "tax": "cast(cast(round(l_tax * 100) as int) as string)", "flag": "l_returnflag", "state": "l_linestatus",
        "ship": "substr(cast(l_shipdate as string), 1, 10)", "sum": "cast(l_partkey + l_suppkey as string)",
        "key": "concat(l_returnflag, l_linestatus)",
    }.items()
)


@query("pivot_wide", f"""
with e as ({_WIDE_EAV})
select record, {', '.join(f"max(case when field_name = '{f}' then value end) as {f}" for f in WIDE_FIELDS)}
from e group by record""")
def pivot_wide(spark, d):
    # The wide slots of a line become EAV rows in one scan, then 81 named columns.
    from formflow.plans.fixtures import table

    li = table(spark, d, "lineitem")
    measures = {
        "part": F.col("l_partkey").cast("string"), "supp": F.col("l_suppkey").cast("string"),
        "qty": F.col("l_quantity").cast("int").cast("string"),
        "price": F.floor("l_extendedprice").cast("string"),
        "disc": F.round(F.col("l_discount") * 100).cast("int").cast("string"),
        "tax": F.round(F.col("l_tax") * 100).cast("int").cast("string"),
        "flag": F.col("l_returnflag"), "state": F.col("l_linestatus"),
        "ship": F.substring(F.col("l_shipdate").cast("string"), 1, 10),
        "sum": (F.col("l_partkey") + F.col("l_suppkey")).cast("string"),
        "key": F.concat("l_returnflag", "l_linestatus"),
    }
    wide = li.select(
        F.col("l_orderkey").cast("string").alias("record"), F.col("l_linenumber").cast("string").alias("slot"),
        *[c.alias(m) for m, c in measures.items()],
    )
    tall = wide.unpivot(["record", "slot"], list(measures), "measure", "value").select(
        "record", F.concat_ws("_", "measure", "slot").alias("field_name"), "value"
    )
    return reshape.pivot_fields(tall, ["record"], WIDE_FIELDS, value_col="value")


_EAV_FIELDS = ("case_id", "catchment_id_a", "consent_dt", "form_b_complete", "order_dt", "priority", "reason", "segment", "status")


@query("pivot_dynamic", oracle(f"""
select s.id, d.site_id, s.name, d.catchment_id, d.report_id, d.case_id,
       {', '.join(f"max(case when field_name = '{f}' then field_value end) as f_{f}" for f in _EAV_FIELDS)}
from ox_decoded d join fx_site s on s.site_id = d.site_id group by all"""))
def pivot_dynamic(spark, d):
    from formflow.sources import with_site_names

    rows = with_site_names(inputs.decoded(spark, d), fixture(spark, d, "fx_site"))
    # The fixture's key columns and its fields share names; prefix the fields.
    rows = rows.withColumn("field_name", F.concat(F.lit("f_"), "field_name"))
    return reshape.pivot_dynamic(rows, ["id", "site_id", "name", "catchment_id", "report_id", "case_id"])


@query("pivot_deidentified", oracle(f"""
select record, {', '.join(f"max(case when field_name = '{f}' then value end) as {f}" for f in _EAV_FIELDS if f != 'case_id')}
from ox_eav where field_name in (select field_name from fx_dict where identifier = '') group by record"""))
def pivot_deidentified(spark, d):
    return reshape.pivot_deidentified(inputs.eav(spark, d), fixture(spark, d, "fx_dict"), ["record"])


@query("stage_layout", oracle("select site_id, catchment_id, report_id, case_id, field_name, field_value from ox_staging"))
def stage_layout(spark, d):
    return inputs.staging(spark, d)


@query("mart_typed_projection", oracle(f"""
select sha256(concat_ws(chr(1), report_id, field_name, field_value)) as id, substr(site_id, 1, 10) as site_id,
       substr(catchment_id, 1, 10) as catchment_id, substr(report_id, 1, 100) as report_id, substr(case_id, 1, 9) as case_id,
       substr(field_name, 1, 255) as field_name, field_value, '{RUN_TS}' as last_updated, 0 as is_deleted
from ox_staging"""))
def mart_typed_projection(spark, d):
    rows = inputs.staging(spark, d).withColumn("id", row_id("report_id", "field_name", "field_value"))
    return views.case_mart(rows, inputs.run_ts())


@query("mart_full_refresh", oracle(f"""
select sha256(concat_ws(chr(1), packet_id, case_id, coalesce(repeat_instrument, chr(0)), coalesce(repeat_instance, chr(0)), field_name, field_value)) as id,
       packet_id, substr(case_id, 1, 9) as case_id, repeat_instrument, substr(repeat_instance, 1, 3) as repeat_instance,
       field_name, field_value, coalesce(created_on, '{RUN_TS}') as created_on, '{RUN_TS}' as last_updated, 0 as is_deleted
from (select concat('P-', case_id) as packet_id, case_id, repeat_instrument, repeat_instance, field_name, field_value,
             case when field_name = 'kit_id' then null else created_on end as created_on from fx_repeat_mart)"""))
def mart_full_refresh(spark, d):
    packets = inputs.repeat_mart(spark, d).withColumns({
        "packet_id": F.concat(F.lit("P-"), "case_id"),
        "created_on": F.when(F.col("field_name") == "kit_id", None).otherwise(F.col("created_on")),
    })
    from formflow.session import work_dir
    from formflow.sinks import overwrite_staging

    return overwrite_staging(views.packet_mart(packets, inputs.run_ts()), work_dir(spark, "packet-mart"))


@query("audit_columns", oracle(f"""
select sha256(concat_ws(chr(1), report_id, coalesce(case_id, chr(0)))) as id, report_id, case_id, 'study_a' as file_name,
       1 as active, 'P-1' as protocol, '{RUN_TS}' as created_on, '{RUN_TS}' as modified_on, '{RUN_TS}' as uploaded_on
from (select record as report_id, case_id from fx_flat)"""))
def audit_columns(spark, d):
    rows = fixture(spark, d, "fx_flat").select(F.col("record").alias("report_id"), "case_id")
    rows = reshape.with_constants(rows, {"file_name": "study_a", "active": 1, "protocol": "P-1"})
    return reshape.with_audit(rows, ["report_id", "case_id"], inputs.run_ts())


@query("filter_live_rows", oracle("select * from ox_mart where is_deleted = 0 and catchment_id <> ''"))
def filter_live_rows(spark, d):
    return reshape.live_rows(inputs.mart(spark, d), non_blank=["catchment_id"])


@query("filter_fields", oracle("""
select record, site_id, field_name, value from ox_eav
where field_name in ('status', 'segment') or starts_with(field_name, 'catchment_id') or starts_with(field_name, 'form_b_')"""))
def filter_fields(spark, d):
    return reshape.of_fields(inputs.eav(spark, d), ["status", "segment"], ["catchment_id", "form_b_"])


@query("pivot_complete_only", oracle("""
select * from (
 select record, max(case when field_name = 'reason' then value end) as reason,
        max(case when field_name = 'form_b_complete' then value end) as form_b_complete
 from ox_eav where field_name in ('reason', 'form_b_complete') group by record)
where reason = 'C01' and form_b_complete = '2'"""))
def pivot_complete_only(spark, d):
    wide = reshape.pivot_fields(inputs.eav(spark, d), ["record"], ["reason", "form_b_complete"], value_col="value")
    return reshape.complete_only(wide, {"reason": "C01", "form_b_complete": "2"})


@query("filter_form_answers", oracle("""
select m.case_id, m.repeat_instance, m.field_name, m.field_value, d.form_name
from fx_repeat_mart m join fx_repeat_dict d on m.field_name = d.field_name
where (d.form_name = 'specimen_form' and m.field_value <> 'N') or (d.form_name = 'culture_form' and m.field_value <> 'F')
   or d.form_name not in ('specimen_form', 'culture_form')"""))
def filter_form_answers(spark, d):
    forms = fixture(spark, d, "fx_repeat_dict").select("field_name", "form_name")
    rows = inputs.repeat_mart(spark, d).join(forms, "field_name")
    kept = reshape.suppress_answers(rows, inputs.SUPPRESSED)
    return kept.select("case_id", "repeat_instance", "field_name", "field_value", "form_name")


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Un-pivot, decode, label, and pivot back to one row per case."""
    labelled = inputs.report(spark, d)
    return reshape.pivot_fields(
        labelled, ["site_id", "catchment_id", "case_id"], ["status", "priority", "segment", "reason", "order_dt"],
        value_col="field_value_label",
    )


@query("flagship_report_pivot", oracle("""
select site_id, catchment_id, case_id,
       max(case when field_name = 'status' then field_value_label end) as status,
       max(case when field_name = 'priority' then field_value_label end) as priority,
       max(case when field_name = 'segment' then field_value_label end) as segment,
       max(case when field_name = 'reason' then field_value_label end) as reason,
       max(case when field_name = 'order_dt' then field_value_label end) as order_dt
from ox_report where field_name in ('status', 'priority', 'segment', 'reason', 'order_dt')
group by site_id, catchment_id, case_id"""))
def flagship_report_pivot(spark, d):
    return flagship(spark, d)
