"""Form-data inputs derived from the given tables.

The SQL text runs unchanged in Spark and in the oracle engine. Every view keeps
all rows of its tables; differences between a source and a target come from the
tables themselves (line status against order status), not from filters.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


# Tables that grow with the data; the given files hold one row group each.
FACTS = ("orders", "lineitem", "events", "documents", "part")

BASE_TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "conversations")

RUN_TS = "2024-02-01 00:00:00"
RUN_DATE = "2024-02-01"
STUDY = "study_a"


def case_id(k: str) -> str:
    """Four letters and five digits, unique per key; the first two letters name a site code."""
    return (
        f"concat(chr(cast(65 + {k} % 20 as int)), 'Q', chr(cast(65 + floor({k} / 2600000) % 26 as int)), "
        f"chr(cast(65 + floor({k} / 100000) % 26 as int)), lpad(cast({k} % 100000 as string), 5, '0'))"
    )


def day(c: str) -> str:
    return f"substr(cast({c} as string), 1, 10)"


VIEWS: dict[str, str] = {}

VIEWS["fx_site"] = """
select cast(n_nationkey as string) as id, lpad(cast(n_nationkey as string), 3, '0') as site_id,
       n_name as name, concat(chr(cast(65 + n_nationkey % 20 as int)), 'Q') as iso
from nation"""

# Wide form records: blank cells, multi-select columns, bad and missing case ids, missing catchments.
VIEWS["fx_flat"] = f"""
select cast(o.o_orderkey as string) as record,
       lpad(cast(c.c_nationkey as string), 3, '0') as site_id,
       case when o.o_orderkey % 101 = 0 then null
            when o.o_orderkey % 97 = 0 then 'ABCD007'
            else {case_id('o.o_orderkey')} end as case_id,
       case when o.o_orderkey % 13 = 0 then '' else lpad(cast(c.c_nationkey % 3 as string), 3, '0') end as catchment_id_a,
       o.o_orderstatus as status, o.o_orderpriority as priority,
       {day('o.o_orderdate')} as order_dt,
       case when o.o_orderkey % 5 = 0 then '' else c.c_mktsegment end as segment,
       case when o.o_orderkey % 2 = 0 then '1' else '0' end as reason___C01,
       case when o.o_orderkey % 3 = 0 then '1' when o.o_orderkey % 7 = 0 then 'unknown' else '0' end as reason___C02,
       case when o.o_orderkey % 6 = 0 then '  ' else {day('o.o_orderdate')} end as consent_dt,
       case when o.o_orderkey % 4 = 0 then '0' else '2' end as form_b_complete
from orders o join customer c on o.o_custkey = c.c_custkey"""

FLAT_FIELDS = (
    "case_id", "catchment_id_a", "status", "priority", "order_dt", "segment", "reason___C01", "reason___C02",
    "consent_dt", "form_b_complete",
)

# Dictionary, code list and report names of the fixture forms: lookups for joins with the rows above.
VIEWS["fx_dict"] = """
select * from (values
 (1, 'form_a', 'case_id', 'H1', 'Case', 'text', 1, 'y', 1), (2, 'form_a', 'status', '', 'Status', 'radio', 1, '', 1),
 (3, 'form_a', 'priority', '', 'Priority', 'dropdown', 1, '', 1), (4, 'form_a', 'order_dt', '', 'Date', 'text', 1, '', 1),
 (5, 'form_b', 'segment', 'H2', 'Segment', 'radio', 1, '', 2), (6, 'form_b', 'reason', '', 'Reason', 'checkbox', 1, '', 2),
 (7, 'form_b', 'consent_dt', '', 'Consent date', 'text', 1, '', 2),
 (8, 'form_b', 'form_b_complete', '', 'Complete', 'text', 0, '', 2),
 (9, 'form_c', 'catchment_id_a', 'H3', 'Catchment', 'radio', 1, '', 3)
) as t(sequence_id, form_name, field_name, section_header, field_label, field_type, active, identifier, form_sequence_id)"""
VIEWS["fx_dict_typed"] = "select *, case when form_name = 'form_a' then '1.1' else '1.2' end as report_type from fx_dict"

VIEWS["fx_codes"] = """
select * from (values ('F', 'Finished'), ('O', 'Open'), ('C01', 'Reason one'), ('BUILDING', 'Building'),
 ('1-URGENT', 'Urgent'), ('R', 'Returned'), ('A', 'Accepted')) as t(code, pref)"""

VIEWS["fx_report_names"] = """
select * from (values ('rep-a', 1, 'u/a?case=', '1.1'), ('rep-b', 2, 'u/b?case=', '1.1'),
 ('rep-b', 3, 'u/b2?case=', '1.1'), ('lab-specimen_form', 4, 'u/s?case=', '3.1'),
 ('lab-shipping_form', 5, 'u/l?case=', '3.1')) as t(report_view_name, report_sequence, report_uri, package_type)"""

# Wide repeating-form records; natural repeats of (record, instance), blank instance on the first one.
VIEWS["fx_repeat"] = f"""
select {case_id('l_orderkey')} as record, 'line' as repeat_instrument,
       case when l_linenumber = 1 then null else cast(l_linenumber as string) end as repeat_instance,
       l_returnflag as returnflag, l_linestatus as linestatus, {day('l_shipdate')} as ship_dt,
       concat('K', cast(l_partkey as string)) as kit_id, {day('l_shipdate')} as created_on
from lineitem"""

# The same records as a mart of EAV rows.
VIEWS["fx_repeat_mart"] = """
select record as case_id, repeat_instrument, repeat_instance, field_name, field_value, created_on,
       case when field_name = 'kit_id' and returnflag = 'N' then 1 else 0 end as is_deleted
from (
 select record, repeat_instrument, repeat_instance, created_on, returnflag, 'returnflag' as field_name, returnflag as field_value from fx_repeat
 union all select record, repeat_instrument, repeat_instance, created_on, returnflag, 'linestatus', linestatus from fx_repeat
 union all select record, repeat_instrument, repeat_instance, created_on, returnflag, 'ship_dt', ship_dt from fx_repeat
 union all select record, repeat_instrument, repeat_instance, created_on, returnflag, 'kit_id', kit_id from fx_repeat
) t"""

VIEWS["fx_repeat_dict"] = """
select * from (values
 (1, 'specimen_form', 'returnflag', 'S1', 'Flag', 'radio', 1, 1, '3.1.1'),
 (2, 'culture_form', 'linestatus', '', 'State', 'radio', 1, 2, '3.1.2'),
 (3, 'shipping_form', 'ship_dt', '', 'Shipped', 'text', 1, 3, null),
 (4, 'shipping_form', 'kit_id', '', 'Kit', 'text', 1, 3, null)
) as t(sequence_id, form_name, field_name, section_header, field_label, field_type, active, form_sequence_id, report_type)"""

# Registrations (consent target): one per order, some of another study, some inactive.
VIEWS["fx_registration"] = f"""
select cast(o.o_orderkey as string) as id, cast(o.o_orderkey as string) as report_id,
       lpad(cast(c.c_nationkey % 3 as string), 3, '0') as catchment_id, {case_id('o.o_orderkey')} as case_id,
       cast(c.c_nationkey as string) as site_guid, o.o_orderstatus as kind,
       case when o.o_orderpriority = '5-LOW' then 'other_study' else '{STUDY}' end as file_name,
       {day('o.o_orderdate')} as created_on,
       case when o.o_orderpriority = '1-URGENT' then 0 else 1 end as active
from orders o join customer c on o.o_custkey = c.c_custkey"""

# Registrations with older duplicates per person and kind.
VIEWS["fx_visits"] = """
select event_id as seq, cast(event_id as string) as id, cast(user_id as string) as case_id, event_type as kind,
       cast(ts as string) as created_on, case when event_id % 17 = 0 then 0 else 1 end as active, value as amount
from events"""

# Upsert target: one row per order and line status, NULL sites, some rows inactive.
VIEWS["fx_target"] = f"""
select concat('T', cast(l_orderkey as string), l_linestatus) as id, {case_id('l_orderkey')} as case_id, l_linestatus as kind,
       case when l_orderkey % 9 = 0 then null else cast(l_orderkey % 25 as string) end as site,
       max(l_returnflag) as seg, {day('max(l_shipdate)')} as event_date,
       case when count(*) > 2 then 'Pending' else 'Closed' end as status_text,
       case when max(l_returnflag) = 'A' then 2 else 1 end as active,
       {day('min(l_shipdate)')} as created_on, cast(null as string) as modified_on
from lineitem group by l_orderkey, l_linestatus"""

# Upsert source: one row per order with the order's status; matches, changes, new and missing keys against fx_target.
VIEWS["fx_source"] = f"""
select concat('S', cast(o_orderkey as string)) as id, {case_id('o_orderkey')} as case_id, o_orderstatus as kind,
       case when o_orderkey % 9 = 0 then null else cast(o_orderkey % 25 as string) end as site,
       case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'R' else 'N' end as seg,
       {day('o_orderdate')} as event_date, '{RUN_DATE}' as created_on
from orders"""

# Snapshot mart and its staging rows, keyed by (site_id, case_id, field_name, field_value).
VIEWS["fx_snapshot_target"] = f"""
select id, site as site_id, case_id, 'status' as field_name, kind as field_value, created_on,
       '2024-01-01 00:00:00' as last_updated, case when active = 2 then 1 else 0 end as is_deleted
from fx_target"""
VIEWS["fx_snapshot_source"] = """
select id, site as site_id, case_id, 'status' as field_name, kind as field_value, created_on from fx_source"""

# A dictionary that grows with the data: one field per part, sparse section headers, some with markup.
VIEWS["fx_fields"] = """
select p_partkey + 1 as seq, concat('f_', cast(p_partkey as string)) as field_name, lower(replace(p_brand, '#', '_')) as form_name,
       case when p_size = 1 then concat('<div class="rich"><p>Long ', p_name, '</p></div>')
            when p_size < 8 then p_name else '' end as section_header,
       case when p_type in ('PROMO', 'SMALL') then 'radio' when p_type = 'MEDIUM' then 'checkbox' else 'text' end as field_type,
       concat(p_name, ' "', p_type, '",', chr(10), cast(p_size as string)) as field_label,
       case when p_size % 10 = 0 then '' when p_size % 7 = 0 then '0' else '1' end as active,
       case when p_size % 5 = 0 then '' else cast(p_size as string) end as form_sequence_id,
       case when p_type = 'ECONOMY' then 'y' else '' end as identifier
from part"""

# Log events of a running job.
VIEWS["fx_log"] = """
select event_id, ts, case when event_type = 'error' then 'ERROR' when event_type = 'view' then 'WARNING' else 'INFO' end as level,
       concat(event_type, ' by ', cast(user_id as string), ' ', props) as message
from events"""

# Oracle-only views: what the operators make of fx_flat, written independently in SQL.
ORACLE_VIEWS: dict[str, str] = {}
ORACLE_VIEWS["ox_raw"] = f"""
select record, site_id, field_name, value from fx_flat
unpivot (value for field_name in ({', '.join(FLAT_FIELDS)})) where trim(value) <> ''"""
ORACLE_VIEWS["ox_eav"] = """
select record, site_id, regexp_replace(field_name, '___.*$', '') as field_name,
       case when contains(field_name, '___') and value = '1' then regexp_extract(field_name, '___(.+)$', 1) else value end as value
from ox_raw where not (contains(field_name, '___') and value = '0')"""
ORACLE_VIEWS["ox_keys"] = """
select record, site_id, coalesce(max(case when field_name = 'case_id' then value end), '') as case_id,
       coalesce(max(case when starts_with(field_name, 'catchment_id') then value end), '') as catchment_id
from ox_eav where field_name = 'case_id' or starts_with(field_name, 'catchment_id') group by record, site_id"""
ORACLE_VIEWS["ox_staging"] = """
select e.site_id, k.catchment_id, e.record as report_id, k.case_id, e.field_name, e.value as field_value
from ox_eav e join ox_keys k on e.record = k.record and e.site_id = k.site_id"""
ORACLE_VIEWS["ox_bad"] = """
select distinct report_id from ox_keyed_reports where not regexp_full_match(case_id, '[A-Za-z]{4}[0-9]{5}')"""
ORACLE_VIEWS["ox_keyed_reports"] = "select record as report_id, case_id from ox_keys"
ORACLE_VIEWS["ox_mart"] = """
select *, case when cast(report_id as bigint) % 23 = 0 then 1 else 0 end as is_deleted from ox_staging
where not exists (select 1 from ox_bad b where b.report_id = ox_staging.report_id)"""
ORACLE_VIEWS["ox_decoded"] = """
select m.site_id, m.report_id, m.catchment_id, m.case_id, m.field_name, m.field_value,
       case when d.field_type in ('radio', 'checkbox', 'dropdown') then coalesce(c.pref, m.field_value) else m.field_value end as field_value_label,
       d.form_name, d.field_label, d.field_type, d.sequence_id
from ox_mart m left join fx_codes c on m.field_value = c.code left join fx_dict d on m.field_name = d.field_name
where m.catchment_id <> '' and m.is_deleted = 0"""
ORACLE_VIEWS["ox_report"] = """
select m.site_id, m.catchment_id, m.case_id, m.field_name, m.field_value,
       case when d.field_type in ('radio', 'checkbox', 'dropdown') then coalesce(c.pref, m.field_value) else m.field_value end as field_value_label,
       d.form_name, d.form_sequence_id, d.section_header, d.field_label, d.field_type, d.sequence_id, d.report_type
from ox_mart m left join fx_codes c on m.field_value = c.code join fx_dict_typed d on m.field_name = d.field_name
where m.is_deleted = 0 and d.active = 1 and m.field_name <> concat(coalesce(d.form_name, ''), '_complete')"""
ORACLE_VIEWS["ox_registered"] = f"""
select r.site_guid, m.case_id, m.repeat_instrument, m.repeat_instance, m.field_name, m.field_value,
       case when d.field_type in ('radio', 'checkbox', 'dropdown') then coalesce(c.pref, m.field_value) else m.field_value end as field_value_label,
       d.form_name, d.form_sequence_id, d.section_header, d.field_label, d.field_type, d.sequence_id, d.report_type, m.created_on
from fx_repeat_mart m
join fx_registration r on r.case_id = m.case_id and r.file_name = '{STUDY}' and r.active = 1
join fx_repeat_dict d on m.field_name = d.field_name
left join fx_codes c on m.field_value = c.code
where m.is_deleted = 0 and d.active = 1
  and ((d.form_name = 'specimen_form' and m.field_value <> 'N') or (d.form_name = 'culture_form' and m.field_value <> 'F')
       or d.form_name not in ('specimen_form', 'culture_form'))"""
ORACLE_VIEWS["ox_notification"] = """
select d.report_id, d.catchment_id, d.field_value as notified_on, s.id as site_guid, d.site_id
from ox_decoded d join fx_site s on s.site_id = d.site_id
where d.form_name = 'form_a' and d.field_name = 'order_dt' and d.catchment_id <> ''"""
ORACLE_VIEWS["ox_procedure"] = """
select s.id as site_guid, p.case_id, p.kit, p.performed_on from (
  select case_id, max(case when field_name = 'linestatus' then field_value end) as performed,
         max(case when field_name = 'kit_id' then field_value end) as kit,
         max(case when field_name = 'ship_dt' then field_value end) as performed_on
  from fx_repeat_mart where is_deleted = 0 and field_name in ('linestatus', 'kit_id', 'ship_dt') group by case_id
) p left join fx_site s on s.iso = left(p.case_id, 2) where p.performed = 'O'"""

_NAME = re.compile(r"\b[fo]x_[a-z_]+\b")


def _closure(text: str, done: dict[str, str]) -> None:
    for name in dict.fromkeys(_NAME.findall(text)):
        if name not in done:
            body = VIEWS.get(name) or ORACLE_VIEWS[name]
            _closure(body, done)
            done[name] = body


def oracle(sql: str) -> str:
    """``sql`` with the fixture views it names put before it as CTEs."""
    views: dict[str, str] = {}
    _closure(sql, views)
    if not views:
        return sql.strip()
    # The views that others repeat are worked out once.
    once = {"ox_eav", "ox_keys", "ox_staging", "ox_bad", "ox_mart"}
    return "with " + ",\n".join(f"{n} as {'materialized ' if n in once else ''}({b.strip()})" for n, b in views.items()) + "\n" + sql.strip()


_TABLES: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _TABLES[key]


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view over the tables in ``sf_dir``."""
    views: dict[str, str] = {}
    _closure(name, views)
    text = "\n".join(views.values())
    for t in BASE_TABLES:
        if re.search(rf"\b{t}\b", text):
            table(spark, sf_dir, t).createOrReplaceTempView(t)
    ctes = ",\n".join(f"{n} as ({b.strip()})" for n, b in views.items())
    return spark.sql(f"with {ctes}\nselect * from {name}")
