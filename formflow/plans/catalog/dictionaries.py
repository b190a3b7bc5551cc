"""Dictionary curation queries over a dictionary with one field per part."""

from __future__ import annotations

from pyspark.sql import functions as F

from formflow.operators import dictionary
from formflow.plans import views
from formflow.plans.fixtures import RUN_DATE, RUN_TS, fixture, oracle, table
from formflow.plans.registry import query
from formflow.session import work_dir
from formflow.sources import read_dictionary, read_report_names

PREFIXES = {'<div class="rich"><p>Long red': "Long red section", '<div class="rich"><p>Long': "Long section"}
REPORT_TYPES = {"3.1.1": ["brand_1", "brand_2", "brand_3"], "3.1.2": ["brand_4", "brand_5"], "3.1.3": ["brand_6"]}
_TYPE_SQL = """case when form_name in ('brand_1', 'brand_2', 'brand_3') then '3.1.1'
 when form_name in ('brand_4', 'brand_5') then '3.1.2' when form_name = 'brand_6' then '3.1.3' end"""
_CSV = {"header": True, "escape": '"', "quoteAll": True}


def _write_csv(df, path):
    # Parts are written in sequence order; the reader numbers rows by file name and position.
    df.repartitionByRange(4, "seq").sortWithinPartitions("seq").drop("seq").write.options(**_CSV).csv(path)


_BUILT = f"""
select cast(row_number() over (order by part, seq) as bigint) as sequence_id, form_name, field_name,
       case when part = 0 then substr(section_header, 1, 200) else section_header end as section_header, field_label, field_type,
       'main.csv' as file_name, '{RUN_DATE}' as created_on,
       case when part = 1 then 0 else coalesce(try_cast(active as integer), 0) end as active,
       case when part = 1 then 0 else coalesce(try_cast(form_sequence_id as integer), 0) end as form_sequence_id,
       {_TYPE_SQL} as report_type
from (select 0 as part, seq, form_name, field_name, section_header, field_label, field_type, active, form_sequence_id from fx_fields
      union all select 1, min(seq), form_name, concat(form_name, '_complete'), '', 'Complete?', 'dropdown', '', '' from fx_fields group by form_name)"""


@query("dict_build", oracle(_BUILT))
def dict_build(spark, d):
    fields = fixture(spark, d, "fx_fields")
    path = work_dir(spark, "dictionary")
    main = fields.select(
        "seq", *[F.col(src).alias(out) for out, src in (
            ("Variable / Field Name", "field_name"), ("Form Name", "form_name"), ("Section Header", "section_header"),
            ("Field Type", "field_type"), ("Field Label", "field_label"), ("Identifier?", "identifier"),
            ("Active", "active"), ("form_sequence_id", "form_sequence_id"))],
    )
    append = fields.groupBy("form_name").agg(F.min("seq").alias("seq")).select(
        "seq", F.concat("form_name", F.lit("_complete")).alias("Variable / Field Name"), F.col("form_name").alias("Form Name"),
        F.lit("").alias("Section Header"), F.lit("dropdown").alias("Field Type"), F.lit("Complete?").alias("Field Label"),
    )
    _write_csv(main, f"{path}/main.csv")
    _write_csv(append, f"{path}/append.csv")
    return dictionary.build(
        read_dictionary(spark, f"{path}/main.csv"), read_dictionary(spark, f"{path}/append.csv"), f"{path}/main.csv",
        F.lit(RUN_DATE), dictionary.report_type(REPORT_TYPES),
    )


@query("mart_dictionary", oracle(f"""
select sequence_id, form_name, form_sequence_id, section_header, field_name, field_label, field_type, report_type, file_name, created_on, active
from ({_BUILT})"""))
def mart_dictionary(spark, d):
    return views.dictionary_mart(dict_build(spark, d))


_SEED_NAMES = """
select distinct concat('rep-', lower(replace(p_brand, '#', '_'))) as report_view_name, concat('v', substring(p_brand, 7)) as report_view_id,
       cast(substring(p_brand, 7) as tinyint) as report_sequence, concat('u/', substring(p_brand, 7), '?case=') as report_uri,
       case when cast(substring(p_brand, 7) as int) % 2 = 0 then 'Header, "quoted"' end as report_uri_header, '3.1' as package_type
from part"""


@query("mart_report_names", oracle(f"select *, '{RUN_TS}' as created_on from ({_SEED_NAMES})"))
def mart_report_names(spark, d):
    """One report per brand, landed as a seed file with NULL written out, read with declared types."""
    path = work_dir(spark, "report-names")
    table(spark, d, "part").createOrReplaceTempView("part")
    spark.sql(_SEED_NAMES).write.options(header=True, escape='"', nullValue="NULL").csv(path)
    return views.report_name_mart(read_report_names(spark, path), F.lit(RUN_TS))


@query("dict_form_sequence", oracle("""
select form_name, row_number() over (order by min(seq)) as form_sequence_id from fx_fields group by form_name"""))
def dict_form_sequence(spark, d):
    return dictionary.form_sequence(fixture(spark, d, "fx_fields"))


_GROUPED = "select *, sum(case when section_header <> '' then 1 else 0 end) over (order by seq) as g from fx_fields"


@query("dict_section_group", oracle(f"select seq, field_name, cast(g as bigint) as section_group from ({_GROUPED})"))
def dict_section_group(spark, d):
    return dictionary.section_group(fixture(spark, d, "fx_fields")).select("seq", "field_name", "section_group")


@query("dict_section_fill", oracle(f"""
select seq, field_name, form_name, first_value(section_header) over (partition by g order by seq) as section_header
from ({_GROUPED})"""))
def dict_section_fill(spark, d):
    return dictionary.fill_sections(fixture(spark, d, "fx_fields")).select("seq", "field_name", "form_name", "section_header")


_CLEAN = """case when starts_with(section_header, '<div class="rich"><p>Long red') then 'Long red section'
 when starts_with(section_header, '<div class="rich"><p>Long') then 'Long section' else section_header end"""


@query("dict_header_clean", oracle(f"select seq, field_name, {_CLEAN} as section_header from fx_fields"))
def dict_header_clean(spark, d):
    return dictionary.clean_headers(fixture(spark, d, "fx_fields"), PREFIXES).select("seq", "field_name", "section_header")


@query("dict_curate", oracle(f"""
select f.seq, f.field_name, f.form_name, {_CLEAN} as section_header, s.form_sequence_id
from (select seq, field_name, form_name, first_value(section_header) over (partition by g order by seq) as section_header from ({_GROUPED})) f
join (select form_name, row_number() over (order by min(seq)) as form_sequence_id from fx_fields group by form_name) s
  on f.form_name = s.form_name"""))
def dict_curate(spark, d):
    out = dictionary.curate(fixture(spark, d, "fx_fields"), PREFIXES)
    return out.select("seq", "field_name", "form_name", "section_header", "form_sequence_id")


@query("dict_report_type", oracle(f"select field_name, form_name, {_TYPE_SQL} as report_type from fx_fields"))
def dict_report_type(spark, d):
    fields = fixture(spark, d, "fx_fields").select("field_name", "form_name")
    return fields.withColumn("report_type", dictionary.report_type(REPORT_TYPES))
