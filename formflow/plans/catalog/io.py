"""Source and sink queries: land the given tables in each format, read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from formflow import sinks, sources
from formflow.operators import quality, reshape
from formflow.plans.catalog import inputs
from formflow.plans.fixtures import fixture, oracle, table
from formflow.plans.registry import query
from formflow.schemas import EAV_COLUMNS, ExportLayout
from formflow.session import work_dir
from formflow.sources import zones

EAV4 = ["record", "site_id", "field_name", "value"]


def _land_flat(spark, d):
    """Flat export: one JSON object per record and line."""
    path = work_dir(spark, "flat-json")
    flat = fixture(spark, d, "fx_flat")
    flat.select(F.to_json(F.struct(*flat.columns)).alias("value")).write.text(path)
    return path


@query("src_json_eav", oracle("select record, site_id, field_name, value from ox_eav"))
def src_json_eav(spark, d):
    path = work_dir(spark, "eav-json")
    inputs.eav(spark, d).write.json(path)
    return sources.read_eav_json(spark, path).select(*EAV4)


@query("src_json_flat_explode", oracle("select record, site_id, field_name, value from ox_eav"))
def src_json_flat_explode(spark, d):
    return reshape.decode_multiselect(sources.read_flat_json(spark, _land_flat(spark, d))).select(*EAV4)


@query("src_json_bad_lines", """
select count(*) as lines, cast(sum(case when o_orderkey % 7 = 3 then 1 else 0 end) as bigint) as broken from orders""")
def src_json_bad_lines(spark, d):
    """A landed file in which every seventh object is cut off: counted, not lost."""
    path = work_dir(spark, "cut-json")
    line = F.to_json(F.struct("o_orderkey", "o_orderstatus"))
    cut = F.when(F.col("o_orderkey") % 7 == 3, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    table(spark, d, "orders").select(line.alias("value"), "o_orderkey").select(cut.alias("value")).write.text(path)
    return sources.bad_json_lines(spark.read.text(path))


_ODD_TEXT = """case when field_name = 'priority' then concat(value, ' } "', record, '" {\\') else value end as value"""


def _by_array(spark, d):
    """Flat records with the number of their array in ``chunk``; a task gets the arrays of about 50,000 records, however many there are."""
    chunk = F.floor(F.col("record").cast("bigint") / 2000).cast("string")
    tasks = 1 + table(spark, d, "orders").count() // 50_000
    return fixture(spark, d, "fx_flat").withColumn("chunk", chunk).repartition(tasks, "chunk")


def _land_arrays(rows, path):
    """What a form server delivers: files of one JSON array each, here of 2,000 records, numbered in ``chunk``."""
    objects = rows.select("chunk", F.to_json(F.struct(*[c for c in rows.columns if c != "chunk"]), {"ignoreNullFields": "false"}).alias("o"))
    array = F.concat(F.lit("[\n "), F.array_join(F.collect_list("o"), ",\n "), F.lit("\n]\n"))
    objects.groupBy("chunk").agg(array.alias("value")).write.partitionBy("chunk").text(path)


@query("src_json_array", oracle(f"select record, site_id, field_name, {_ODD_TEXT} from ox_eav"))
def src_json_array(spark, d):
    """EAV export as JSON arrays whose texts hold braces, quotes and backslashes."""
    path = work_dir(spark, "eav-arrays")
    # Records move to their array before they become nine rows each.
    rows = reshape.wide_to_eav(_by_array(spark, d), ExportLayout(repeat_instance="chunk")).withColumnRenamed("repeat_instance", "chunk")
    _land_arrays(rows.select("record", "site_id", "field_name", F.expr(_ODD_TEXT.replace("\\", "\\\\")), "chunk"), path)
    return sources.read_eav_json(spark, path, array_files=True).select(*EAV4)


@query("src_json_array_flat", oracle("select record, site_id, field_name, value from ox_eav"))
def src_json_array_flat(spark, d):
    """Flat export as JSON arrays: same rows as from lines."""
    path = work_dir(spark, "flat-arrays")
    _land_arrays(_by_array(spark, d), path)
    return reshape.decode_multiselect(sources.read_flat_json(spark, path, array_files=True)).select(*EAV4)


@query("src_csv_multiline", """
select cast(row_number() over (order by o_orderkey) as bigint) as row_seq, cast(o_orderkey as varchar) as field_name,
       concat(o_orderstatus, chr(10), 'said "', o_orderpriority, '", twice', chr(10)) as field_label
from orders""")
def src_csv_multiline(spark, d):
    """Dictionary CSV with line breaks and quotes in every row, in file order."""
    path = work_dir(spark, "multiline-csv")
    label = F.concat("o_orderstatus", F.lit('\nsaid "'), "o_orderpriority", F.lit('", twice\n'))
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("field_name"), label.alias("field_label"))
    files = max(4, 1 + rows.count() // 500_000)  # what one task sorts
    ordered = rows.repartitionByRange(files, "o_orderkey").sortWithinPartitions("o_orderkey").drop("o_orderkey")
    ordered.write.options(header=True, escape='"', quoteAll=True, ignoreTrailingWhiteSpace=False).csv(path)
    return sources.read_dictionary(spark, path).select("row_seq", "field_name", "field_label")


@query("src_partitioned_parts", oracle("select record, site_id, field_name, value from ox_eav"))
def src_partitioned_parts(spark, d):
    path = work_dir(spark, "eav-parts")
    rows = reshape.wide_to_eav(fixture(spark, d, "fx_flat")).select(*EAV_COLUMNS)
    rows.write.option("maxRecordsPerFile", 50_000).parquet(path)
    return sources.read_parts(spark, path).select(*EAV4)


@query("src_record_batch", oracle("select record, site_id, field_name, value from ox_eav where record between '20' and '3999'"))
def src_record_batch(spark, d):
    """A range of records from part files, of which the zone map opens the ones it needs."""
    path = work_dir(spark, "zoned-parts")
    zones.write_zoned_parts(inputs.eav(spark, d), path, files=32)
    return zones.read_records(spark, path, "20", "3999").select(*EAV4)


@query("src_record_ids", oracle("select distinct record from fx_flat"))
def src_record_ids(spark, d):
    return sources.record_ids(spark, _land_flat(spark, d))


@query("src_csv_normalise_coerce", """
select cast(o_orderkey as varchar) as order_key, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as order_date,
       cast(null as varchar) as checked_dt, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as etl_load_dt, o_orderpriority as priority_code
from orders""")
def src_csv_normalise_coerce(spark, d):
    path = work_dir(spark, "csv")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    table(spark, d, "orders").select(
        F.col("o_orderkey").alias(" Order Key"), stamp.alias("Order-Date"), F.concat(F.lit("n/a "), "o_orderstatus").alias("Checked dt"),
        F.concat(stamp, F.lit("+02:00")).alias("ETL_Load_DT"), F.col("o_orderpriority").alias("Priority Code"),
    ).write.option("header", True).csv(path)
    df = sources.read_csv_coerced(spark, path)
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("order_date", "checked_dt", "etl_load_dt")})


@query("src_view_site_join", oracle("""
select s.id, d.site_id, s.name, d.catchment_id, d.report_id, d.case_id, d.field_name, d.field_value
from ox_decoded d join fx_site s on d.site_id = s.site_id"""))
def src_view_site_join(spark, d):
    return sources.with_site_names(inputs.decoded(spark, d), fixture(spark, d, "fx_site"))


@query("src_union_default_site", oracle("""
select record, site_id, field_name, value, cast(null as varchar) as repeat_instrument from ox_eav
union all
select record, coalesce(null, '001') as site_id, 'kit_id' as field_name, kit_id as value, repeat_instrument from fx_repeat"""))
def src_union_default_site(spark, d):
    repeat = fixture(spark, d, "fx_repeat").select(
        "record", "repeat_instrument", F.lit("kit_id").alias("field_name"), F.col("kit_id").alias("value")
    )
    return sources.union_projects({"main": inputs.eav(spark, d), "second": repeat}, {"second": "001"})


@query("snk_roundtrip", oracle("""
select f.record, f.case_id, f.catchment_id_a, f.segment, f.consent_dt, v.fmt from fx_flat f, (values ('csv'), ('parquet')) v(fmt)"""))
def snk_roundtrip(spark, d):
    rows = fixture(spark, d, "fx_flat").select("record", "case_id", "catchment_id_a", "segment", "consent_dt")
    paths = sinks.export(rows, work_dir(spark, "export"))
    csv = sinks.read_export_csv(spark, paths["csv"], rows.schema).withColumn("fmt", F.lit("csv"))
    return csv.unionByName(spark.read.parquet(paths["parquet"]).withColumn("fmt", F.lit("parquet")))


@query("snk_overwrite_staging", oracle("select * from ox_staging"))
def snk_overwrite_staging(spark, d):
    path = work_dir(spark, "staging")
    rows = inputs.staging(spark, d)
    sinks.overwrite_staging(rows.select(*[F.lit("old").alias(c) for c in rows.columns]), path)
    return sinks.overwrite_staging(rows, path)


@query("snk_record_partitions", oracle("select record, count(*) as row_count, 1 as chunk_count from ox_eav group by record"))
def snk_record_partitions(spark, d):
    chunks = sinks.write_chunks(inputs.eav(spark, d), work_dir(spark, "chunks"), chunks=8)
    return chunks.groupBy("record").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("chunk_id").cast("int").alias("chunk_count")
    )


@query("snk_load_counts", oracle("""
select 'case_rows' as table_name, (select count(*) from ox_staging) as source_rows, (select count(*) from ox_mart) as loaded_rows,
       (select count(*) from ox_staging) - (select count(*) from ox_mart) as filtered_rows, 0 as skipped"""))
def snk_load_counts(spark, d):
    loaded = sinks.overwrite_staging(inputs.mart(spark, d), work_dir(spark, "loaded"))
    return quality.load_counts(loaded, inputs.staging(spark, d), "case_rows")
