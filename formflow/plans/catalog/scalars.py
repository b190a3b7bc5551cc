"""Scalar function groups, over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from formflow.functions import LETTERS4_DIGITS5, content_hash, content_hash_utf16, matches_pattern, row_id, to_day
from formflow.plans.fixtures import fixture, oracle, table
from formflow.plans.registry import query


@query("fn_string", """
select c_custkey, right(c_name, 5) as tail, left(c_name, 2) as head, substr(c_name, 3, 4) as middle, length(c_name) as len,
       concat(c_name, '/', c_mktsegment) as joined, trim(concat('  ', c_name, ' ')) as trimmed, upper(c_name) as upper_name,
       replace(replace(lower(trim(concat(' ', c_mktsegment, '-', c_name))), ' ', '_'), '-', '_') as header,
       starts_with(c_mktsegment, 'B')::int as is_b, split_part(concat('a/b/', c_name), '/', 3) as last_part
from customer""")
def fn_string(spark, d):
    n, m = F.col("c_name"), F.col("c_mktsegment")
    header = F.lower(F.trim(F.concat(F.lit(" "), m, F.lit("-"), n)))
    return table(spark, d, "customer").select(
        "c_custkey", F.right(n, F.lit(5)).alias("tail"), F.left(n, F.lit(2)).alias("head"), F.substring(n, 3, 4).alias("middle"),
        F.length(n).cast("bigint").alias("len"), F.concat(n, F.lit("/"), m).alias("joined"),
        F.trim(F.concat(F.lit("  "), n, F.lit(" "))).alias("trimmed"), F.upper(n).alias("upper_name"),
        F.replace(F.replace(header, F.lit(" "), F.lit("_")), F.lit("-"), F.lit("_")).alias("header"),
        m.startswith("B").cast("int").alias("is_b"),
        F.element_at(F.split(F.concat(F.lit("a/b/"), n), "/"), -1).alias("last_part"),
    )


@query("fn_regex", """
select doc_id, regexp_matches(text, '[0-9]{5}')::int as has_digits, regexp_extract(text, '([A-Za-z]+)[0-9]+', 1) as code,
       md5(regexp_replace(text, '[0-9]+', '#', 'g')) as masked_md5, contains(text, '___')::int as has_marker,
       regexp_full_match(source, '[a-z]{3}[0-9]+')::int as source_ok
from documents""")
def fn_regex(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select(
        "doc_id", t.rlike("[0-9]{5}").cast("int").alias("has_digits"), F.regexp_extract(t, "([A-Za-z]+)[0-9]+", 1).alias("code"),
        F.md5(F.regexp_replace(t, "[0-9]+", "#")).alias("masked_md5"), t.contains("___").cast("int").alias("has_marker"),
        matches_pattern(r"^[a-z]{3}[0-9]+\z")(F.col("source")).cast("int").alias("source_ok"),
    )


@query("fn_null_conditional", oracle("""
select record, coalesce(case_id, 'none') as case_or_none, nullif(segment, '') as segment,
       case when case_id is null then 'missing' when regexp_full_match(case_id, '[A-Za-z]{4}[0-9]{5}') then 'valid' else 'invalid' end as verdict,
       coalesce(nullif(catchment_id_a, ''), '0') as catchment
from fx_flat"""))
def fn_null_conditional(spark, d):
    c = F.col("case_id")
    return fixture(spark, d, "fx_flat").select(
        "record", F.coalesce(c, F.lit("none")).alias("case_or_none"), F.nullif(F.col("segment"), F.lit("")).alias("segment"),
        F.when(c.isNull(), "missing").when(matches_pattern(LETTERS4_DIGITS5)(c), "valid").otherwise("invalid").alias("verdict"),
        F.coalesce(F.nullif(F.col("catchment_id_a"), F.lit("")), F.lit("0")).alias("catchment"),
    )


@query("fn_date", oracle("""
select record, datediff('day', try_cast(trim(consent_dt) as date), date '2024-02-01') as days,
       strftime(try_cast(order_dt as date), '%Y/%m/%d') as shown, strftime(try_cast(order_dt as timestamp), '%Y-%m-%dT%H:%M:%S') as iso,
       cast(try_cast(consent_dt as date) is null as int) as unreadable
from fx_flat"""))
def fn_date(spark, d):
    c, o = to_day("consent_dt"), F.try_to_timestamp("order_dt")
    return fixture(spark, d, "fx_flat").select(
        "record", F.datediff(F.to_date(F.lit("2024-02-01")), c).alias("days"),
        F.date_format(o, "yyyy/MM/dd").alias("shown"), F.date_format(o, "yyyy-MM-dd'T'HH:mm:ss").alias("iso"),
        c.isNull().cast("int").alias("unreadable"),
    )


@query("fn_hash", oracle("""
select record, md5(upper(concat_ws(chr(1), coalesce(case_id, ''), coalesce(status, ''), coalesce(segment, '')))) as content_md5,
       sha256(concat_ws(chr(1), record, coalesce(case_id, chr(0)))) as row_sha
from fx_flat"""))
def fn_hash(spark, d):
    return fixture(spark, d, "fx_flat").select(
        "record", content_hash("case_id", "status", "segment").alias("content_md5"), row_id("record", "case_id").alias("row_sha")
    )


@query("fn_hash_utf16", oracle("""
select record, upper(md5(unhex(regexp_replace(hex(upper(concat(coalesce(case_id, ''), status, segment))), '(..)', '\\100', 'g')))) as stored_md5
from fx_flat"""))
def fn_hash_utf16(spark, d):
    # The oracle widens ASCII to UTF-16LE by hand: a zero byte after each byte.
    return fixture(spark, d, "fx_flat").select("record", content_hash_utf16("case_id", "status", "segment").alias("stored_md5"))


@query("fn_cast", """
select o_orderkey, cast(o_orderkey as varchar) as key_text, try_cast(o_orderpriority as int) as priority_number,
       try_cast(substr(o_orderpriority, 1, 1) as int) as priority_rank, cast(trunc(o_totalprice) as bigint) as whole,
       cast(try_cast(cast(o_orderdate as varchar) as timestamp) is not null as int) as is_ts
from orders""")
def fn_cast(spark, d):
    p = F.col("o_orderpriority")
    return table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderkey").cast("string").alias("key_text"), p.try_cast("int").alias("priority_number"),
        F.substring(p, 1, 1).try_cast("int").alias("priority_rank"), F.col("o_totalprice").cast("bigint").alias("whole"),
        F.try_to_timestamp(F.col("o_orderdate").cast("string")).isNotNull().cast("int").alias("is_ts"),
    )


@query("fn_json", """
select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, json_extract_string(props, '$.absent') as absent,
       concat('{"id":', cast(event_id as varchar), ',"kind":"', event_type, '"}') as doc
from events""")
def fn_json(spark, d):
    props = F.col("props")
    return table(spark, d, "events").select(
        "event_id", F.from_json(props, "k bigint")["k"].alias("k"), F.get_json_object(props, "$.absent").alias("absent"),
        F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))).alias("doc"),
    )
