"""Small literal frames for each semantics trap of the data model."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from formflow import functions as fx, sources
from formflow.operators import decode, digest, dictionary, enrich, ordered, quality, reshape, upsert
from formflow.operators.upsert import MergeSpec
from formflow.schemas import ExportLayout


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# --- reshape --------------------------------------------------------------------------------


def test_unpivot_drops_blank_and_keeps_spaces(spark):
    wide = spark.createDataFrame([("1", " a ", "  ", None, "007")], "record string, a string, b string, c string, d string")
    got = reshape.unpivot_eav(wide)
    assert got.columns == ["record", "site_id", "repeat_instrument", "repeat_instance", "field_name", "value"]
    assert rows(got.select("field_name", "value"), "field_name") == [("a", " a "), ("d", "007")]


def test_optional_columns_and_own_record_name(spark):
    wide = spark.createDataFrame([("1", "s", "i", "2", "x")], "rid string, centre string, form string, turn string, f string")
    layout = ExportLayout("rid", "centre", "form", "turn")
    assert rows(reshape.wide_to_eav(wide, layout)) == [("1", "s", "i", "2", "f", "x")]


@pytest.mark.parametrize("name,value,want", [
    ("q___C1", "1", [("q", "C1")]), ("q___C1", "0", []), ("q___C1", "other", [("q", "other")]),
    ("q____x", "1", [("q", "_x")]), ("q__C1", "1", [("q__C1", "1")]), ("q___a___b", "1", [("q", "a___b")]),
])
def test_multiselect_both_forms_agree(spark, name, value, want):
    wide = spark.createDataFrame([("1", value)], f"record string, `{name}` string")
    for got in (reshape.wide_to_eav(wide), reshape.decode_multiselect(reshape.unpivot_eav(wide))):
        assert rows(got.select("field_name", "value")) == want


def test_json_explode_keeps_text_and_absent_keys(spark):
    lines = spark.createDataFrame([('{"record": 1, "site_id": "001", "n": 7, "z": "007", "e": "", "x": null}',)], "value string")
    got = rows(reshape.explode_eav(lines).select("record", "site_id", "field_name", "value"), "field_name")
    assert got == [("1", "001", "n", "7"), ("1", "001", "z", "007")]


def test_promote_last_value_wins(spark):
    eav = spark.createDataFrame(
        [("1", "site", "a", 1), ("1", "site", "b", 2), ("1", "f", "x", 3), ("2", "f", "y", 4)], "record string, field_name string, value string, seq int")
    got = reshape.promote_field(eav, "site", "site_id", order_col="seq").select("record", "site_id", "value")
    assert rows(got, "record") == [("1", "b", "x"), ("2", "", "y")]


def test_stringify_keeps_null_and_prints_plain_numbers(spark):
    df = spark.createDataFrame([(1, 12345678.5, dt.date(2024, 1, 2), None), (2, 100.0, None, "x")], "a int, b double, c date, d string")
    assert rows(fx.select_text(df), "a") == [("1", "12345678.5", "2024-01-02", None), ("2", "100", None, "x")]


def test_pivot_round_trip(spark):
    wide = spark.createDataFrame([("1", "a", None), ("2", None, "b"), ("3", "c", "d")], "record string, f string, g string")
    back = reshape.pivot_fields(reshape.wide_to_eav(wide), ["record"], ["f", "g"], value_col="value")
    assert rows(back, "record") == rows(wide, "record")


def test_pivot_forms_agree(spark):
    eav = spark.range(600).select((F.col("id") % 7).cast("string").alias("k"), F.concat(F.lit("f"), F.col("id") % 120).alias("field_name"), F.col("id").cast("string").alias("field_value"))
    fields = [f"f{i}" for i in range(121)]
    wide = reshape.pivot_fields(eav, ["k"], fields)
    parts = reshape.pivot_fields(eav, ["k"], fields[:60]).join(reshape.pivot_fields(eav, ["k"], fields[60:]), "k", "full")
    assert rows(wide, "k") == rows(parts.select(*wide.columns), "k")


def test_pivot_keep_empty(spark):
    eav = spark.createDataFrame([("1", "f", "a"), ("2", "other", "b")], "k string, field_name string, field_value string")
    assert rows(reshape.pivot_fields(eav, ["k"], ["f"]), "k") == [("1", "a")]
    assert rows(reshape.pivot_fields(eav, ["k"], ["f"], keep_empty=True), "k") == [("1", "a"), ("2", None)]


def test_dynamic_pivot_is_bounded(spark):
    eav = spark.range(20).select(F.lit("k").alias("k"), F.col("id").cast("string").alias("field_name"), F.lit("v").alias("field_value"))
    spark.conf.set("spark.sql.pivotMaxValues", "10")
    try:
        with pytest.raises(ValueError):
            reshape.pivot_dynamic(eav, ["k"])
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_prefix_underscore_is_plain(spark):
    df = spark.createDataFrame([("kit_state_a",), ("kitXstate_a",), ("case_id",)], "field_name string")
    assert rows(reshape.of_fields(df, prefixes=["kit_state"])) == [("kit_state_a",)]


def test_width_cut(spark):
    df = spark.createDataFrame([("abcdef", "xyz")], "a string, b string")
    got = reshape.typed_projection(df, {"a": 3, "b": None}, F.lit(0).cast("timestamp"))
    assert rows(got.select("a", "b", "is_deleted")) == [("abc", "xyz", 0)]


def test_suppressed_answers_and_nulls(spark):
    df = spark.createDataFrame([("s", "N"), ("s", "Y"), ("s", None), ("t", "N"), ("t", None), (None, "Y")], "form_name string, field_value string")
    got = reshape.suppress_answers(df, {"s": "N"})
    assert rows(got, "form_name", "field_value") == [("s", "Y"), ("t", None), ("t", "N")]


def test_null_form_keeps_row(spark):
    df = spark.createDataFrame([(None, "f"), ("a", "a_complete"), ("a", "b_complete")], "form_name string, field_name string")
    assert rows(reshape.drop_completion_field(df), "field_name") == [("a", "b_complete"), (None, "f")]


# --- ids, exclusion, decode -----------------------------------------------------------------


@pytest.mark.parametrize("value,ok", [
    ("ABCD00001", True), ("abcd00001", True), ("ABCD00001\n", False), ("ABCD0001", False), ("ABCÄ00001", False), ("ABCD0000١", False), (None, False), ("", False),
])
def test_case_id_rule(spark, value, ok):
    df = spark.createDataFrame([(value,)], "c string")
    assert df.select(fx.matches_pattern()(F.col("c"))).first()[0] is ok


def test_id_rules_differ(spark):
    df = spark.createDataFrame([("abcd00001",), (" 12345678 9 ",), (None,)], "case_id string")
    assert rows(quality.id_format_failures(df, "case_id"), "case_id") == [(" 12345678 9 ",), ("abcd00001",)]
    assert quality.keep_valid_length(df, "case_id").count() == 1


STAGED = "site_id string, catchment_id string, report_id string, case_id string, field_name string, field_value string"


def test_exclusion_by_report_across_sites(spark):
    df = spark.createDataFrame([("1", "", "r", "bad", "f", "x"), ("2", "", "r", "ABCD00001", "f", "x"), ("2", "", "q", "ABCD00002", "f", "x")], STAGED)
    assert rows(enrich.exclude_invalid_reports(df).select("site_id", "report_id")) == [("2", "q")]
    apart = enrich.exclude_invalid_reports(df, scope=("site_id", "report_id"))
    assert rows(apart.select("site_id", "report_id"), "report_id") == [("2", "q"), ("2", "r")]


def test_enrichment_drops_unkeyed_and_reports_them(spark):
    eav = spark.createDataFrame([
        ("1", "s", "case_id", "ABCD00001"), ("1", "s", "f", "x"), ("2", "s", "f", "y"), ("2", "s", "g", "z"), ("3", "s", "catchment_id_b", "7")],
        "record string, site_id string, field_name string, value string")
    got = enrich.enrich_keys(eav).select("record", "field_name", "case_id", "catchment_id")
    assert rows(got, "record", "field_name") == [
        ("1", "case_id", "ABCD00001", ""), ("1", "f", "ABCD00001", ""), ("3", "catchment_id_b", "", "7")]
    assert rows(enrich.count_unkeyed(eav)) == [(1, 2)]


def test_load_equals_step_by_step(spark):
    eav = spark.createDataFrame(
        [("1", "s", "case_id", "ABCD00001"), ("1", "t", "case_id", "bad"), ("1", "s", "f", "x"), ("2", "s", "case_id", "ABCD00002"), ("2", "s", "f", "y"), ("3", "s", "catchment_id_a", "1")],
        "record string, site_id string, field_name string, value string")
    load = enrich.load_case_rows(eav)
    staged = enrich.enrich_keys(eav).withColumnsRenamed({"record": "report_id", "value": "field_value"})
    want = enrich.exclude_invalid_reports(staged).select(*load.rows.columns)
    assert sorted(rows(load.rows)) == sorted(rows(want)) and load.rows.count() == 2
    assert sorted(rows(load.warnings)) == sorted(rows(enrich.invalid_digest(staged))) == [("s", "", 1), ("t", "bad", 1)]


def test_completion_visible_in_full_view_only(spark):
    mart = spark.createDataFrame([("1", "c", "r", "ABCD00001", "a_complete", "2", 0), ("1", "c", "r", "ABCD00001", "f", "X", 0), ("1", "c", "r", "ABCD00001", "zz", "v", 0)], STAGED + ", is_deleted int")
    codes = spark.createDataFrame([("X", "Label")], "code string, pref string")
    d = spark.createDataFrame([("a_complete", "a", "L", "radio", 2, 0, "h", 1, None), ("f", "a", "L", "radio", 1, 1, "h", 1, None)],
        "field_name string, form_name string, field_label string, field_type string, sequence_id int, active int, section_header string, form_sequence_id int, report_type string")
    full = decode.decode_all(mart, codes, d)
    assert rows(full.select("field_name", "field_value_label", "form_name"), "field_name") == [("a_complete", "2", "a"), ("f", "Label", "a"), ("zz", "v", None)]
    report = decode.decode_report(mart, codes, d, ["case_id"])
    assert rows(report.select("field_name")) == [("f",)]


def test_duplicate_code_fails(spark):
    codes = spark.createDataFrame([("X", "a"), ("X", "b")], "code string, pref string")
    with pytest.raises(Exception, match="duplicate key"):
        decode.assert_unique(codes, ["code"]).collect()


def test_hashes(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "x string, y string")
    assert len(set(rows(df.select(fx.content_hash("x", "y"))))) == 2
    stored = {r[0] for r in rows(df.select(fx.content_hash_utf16("x", "y")))}
    assert stored == {hashlib.md5("ABC".encode("utf-16le")).hexdigest().upper()}


def test_blank_date_is_null(spark):
    df = spark.createDataFrame([("",), ("x",), ("2024-02-30",), ("2024-02-03 10:11:12",)], "d string")
    assert [r[0] for r in rows(df.select(fx.to_day("d")))] == [None, None, None, dt.date(2024, 2, 3)]


def test_csv_dictionary_with_bom_and_multiline(spark, tmp_path):
    head = '"Variable / Field Name","Form Name","Section Header","Field Type","Field Label","Active","form_sequence_id"\n'
    (tmp_path / "main.csv").write_text("﻿" + head + f'f1,a,{"h" * 250},radio,"Line one\nline ""two""",1,\nf2,a,,text,L2,,2\n', encoding="utf-8")
    (tmp_path / "append.csv").write_text("﻿" + '"Variable / Field Name","Form Name","Section Header","Field Type","Field Label"\na_complete,a,,dropdown,Done?\n', encoding="utf-8")
    built = dictionary.build(
        sources.read_dictionary(spark, str(tmp_path / "main.csv")), sources.read_dictionary(spark, str(tmp_path / "append.csv")),
        str(tmp_path / "main.csv"), F.lit("2024-01-01"))
    got = rows(built.select("sequence_id", "field_name", F.length("section_header"), "field_label", "active", "form_sequence_id", "file_name"), "sequence_id")
    assert got == [
        (1, "f1", 200, 'Line one\nline "two"', 1, 0, "main.csv"), (2, "f2", 0, "L2", 0, 2, "main.csv"), (3, "a_complete", 0, "Done?", 0, 0, "main.csv")]


def test_report_names_seed(spark, tmp_path):
    (tmp_path / "seed.csv").write_text("report_view_name,report_view_id,report_sequence,report_uri,report_uri_header,package_type\nv,id,3,u?x=,NULL,1.1\n")
    df = sources.read_report_names(spark, str(tmp_path / "seed.csv"))
    assert dict(df.dtypes)["report_sequence"] == "tinyint" and rows(df) == [("v", "id", 3, "u?x=", None, "1.1")]


# --- order-dependent columns ----------------------------------------------------------------


@pytest.mark.parametrize("blocks", [1, 3, 7, 250])
def test_blocked_windows_equal_plain_windows(spark, blocks):
    df = spark.range(1, 500).select(
        "id", F.when(F.col("id") % 11 == 0, F.col("id")).alias("v"),
        F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") % 5 == 0, None).otherwise("cold").alias("k"))
    df.createOrReplaceTempView("ord")
    want = spark.sql("""select id, last_value(v) ignore nulls over (order by id) a, last_value(v) ignore nulls over (partition by k order by id) b,
        count_if(v is not null) over (order by id) c, row_number() over (order by id) d from ord""")
    whole = ordered.ordered_columns(
        df, "id", fills={"a": F.col("v")}, counts={"c": F.col("v").isNotNull(), "d": F.lit(True)}, blocks=blocks)
    assert rows(whole.select("id", "a", "c", "d"), "id") == rows(want.select("id", "a", "c", "d"), "id")
    keyed = ordered.fill_down(df, "id", F.col("v"), "b", keys=["k"], blocks=blocks)
    assert rows(keyed.select("id", "b"), "id") == rows(want.select("id", "b"), "id")


# --- merge ----------------------------------------------------------------------------------

T = "id string, k string, site string, v string, active int"
SPEC = dict(updates={"v": "s.v"}, inserts={"id": "s.id", "k": "s.k", "site": "s.site", "v": "s.v", "active": "1"})


def merged(spark, target, source, spec):
    return upsert.merge(spark.createDataFrame(target, T), spark.createDataFrame(source, "id string, k string, site string, v string"), spec)


def test_null_keys_match_only_when_null_safe(spark):
    target, source = [("t", "1", None, "old", 1)], [("s", "1", None, "new")]
    assert rows(merged(spark, target, source, MergeSpec(("k", "site"), **SPEC))) == [("t", "1", None, "new", 1, "update")]
    plain = merged(spark, target, source, MergeSpec(("k", "site"), **SPEC, null_safe=False))
    assert rows(plain, "id") == [("s", "1", None, "new", 1, "insert"), ("t", "1", None, "old", 1, "keep")]


def test_duplicate_source_key_raises(spark):
    with pytest.raises(Exception, match="more than one source row"):
        merged(spark, [("t", "1", "a", "x", 1)], [("s", "1", "a", "y"), ("s2", "1", "a", "z")], MergeSpec(("k",), **SPEC)).collect()


def test_returning_inactive_row(spark):
    target, source = [("t", "1", "a", "old", 2)], [("s", "1", "a", "new")]
    with_filter = merged(spark, target, source, MergeSpec(("k",), **SPEC, target_filter="active = 1"))
    assert rows(with_filter, "id") == [("s", "1", "a", "new", 1, "insert"), ("t", "1", "a", "old", 2, "keep")]
    without = merged(spark, target, source, MergeSpec(("k",), **SPEC))
    assert rows(without) == [("t", "1", "a", "new", 2, "update")]  # updated, still inactive


def test_null_against_value_is_no_difference(spark):
    target, source = [("t", "1", "a", None, 1)], [("s", "1", "a", "new")]
    assert rows(merged(spark, target, source, MergeSpec(("k",), **SPEC, update_when="t.v <> s.v")))[0][-1] == "keep"
    assert rows(merged(spark, target, source, MergeSpec(("k",), **SPEC, update_when="not (t.v <=> s.v)")))[0][-1] == "update"


def test_state_gate(spark):
    target = [("t", "1", "a", "Pending", 1), ("u", "2", "a", "Closed", 1)]
    source = [("s", "1", "a", "x"), ("r", "2", "a", "y")]
    got = merged(spark, target, source, MergeSpec(("k",), **SPEC, update_when="t.v = 'Pending'"))
    assert rows(got.select("id", "v", "_action"), "id") == [("t", "x", "update"), ("u", "Closed", "keep")]


def test_several_target_rows_of_a_hot_key(spark):
    target = [(f"t{i}", "hot", "a", "old", 1) for i in range(50)]
    got = merged(spark, target, [("s", "hot", "a", "new")], MergeSpec(("k",), **SPEC))
    assert {r[3] for r in rows(got)} == {"new"} and got.count() == 50


def test_merge_against_engine_merge(spark):
    duckdb = pytest.importorskip("duckdb")
    target = [(f"t{i}", str(i), None if i % 3 == 0 else "a", f"v{i % 4}", 1 if i % 5 else 2) for i in range(60)]
    source = [(f"s{i}", str(i), None if i % 3 == 0 else "a", f"v{i % 2}") for i in range(30, 90)]
    con = duckdb.connect()
    con.execute("create table t(id varchar, k varchar, site varchar, v varchar, active int)")
    con.execute("create table s(id varchar, k varchar, site varchar, v varchar)")
    con.executemany("insert into t values (?, ?, ?, ?, ?)", target)
    con.executemany("insert into s values (?, ?, ?, ?)", source)
    con.execute("""merge into t using s on t.k = s.k and t.site is not distinct from s.site and t.active = 1
        when matched and t.v <> s.v then update set v = s.v
        when not matched then insert (id, k, site, v, active) values (s.id, s.k, s.site, s.v, 1)""")
    got = merged(spark, target, source, MergeSpec(("k", "site"), **SPEC, target_filter="active = 1", update_when="t.v <> s.v"))
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    assert sorted(rows(got.drop("_action")), key=key) == sorted(con.execute("select * from t").fetchall(), key=key)


def test_merge_is_idempotent(spark):
    spec = MergeSpec(("k", "site"), **SPEC, target_filter="active = 1", update_when="not (t.v <=> s.v)")
    source = [("s1", "1", None, "x"), ("s2", "2", "a", None)]
    first = merged(spark, [("t", "1", None, "old", 1)], source, spec)
    again = upsert.merge(first.drop("_action"), spark.createDataFrame(source, "id string, k string, site string, v string"), spec)
    assert rows(upsert.action_counts(first)) == [(2, 1, 1, 0, 0)]
    assert rows(upsert.action_counts(again)) == [(0, 0, 0, 0, 0)]


def test_deactivation_codes_and_two_key_lists(spark):
    df = spark.createDataFrame([("1", "x", "a", "2024-01-01", 1), ("2", "x", "a", "2024-01-02", 1), ("3", "x", None, "2024-01-03", 0), ("4", "y", "b", "2024-01-01", 1)],
        "id string, k string, site string, created_on string, active int")
    deduped = upsert.deactivate_duplicates(df, ["k"], ["created_on", "id"], "active = 1")
    source = spark.createDataFrame([("x", "zzz")], "k string, site string")
    done = upsert.deactivate_missing(deduped, source, ["k"], "active = 1")
    assert rows(done.select("id", "active", "_action"), "id") == [("1", 0, "duplicate"), ("2", 1, "keep"), ("3", 0, "keep"), ("4", 2, "missing")]
    assert rows(upsert.action_counts(done)) == [(0, 0, 0, 1, 1)]


def test_dedup_ties_leave_one(spark):
    df = spark.createDataFrame([("1", "x", "d"), ("2", "x", "d"), ("3", None, "d"), ("4", None, "c")], "id string, k string, created_on string")
    assert rows(upsert.older_duplicates(df, ["k"], ["created_on", "id"]).select("id"), "id") == [("1",), ("4",)]


def test_snapshot_delete_then_revive(spark):
    schema = "id string, site_id string, case_id string, field_value string, created_on string"
    keys = ["site_id", "case_id", "field_value"]
    day = lambda n: F.lit(f"2024-01-0{n}")
    first = upsert.snapshot_initial(spark.createDataFrame([("a", None, "1", "v", "c1"), ("b", "s", "2", "v", "c1")], schema), day(1))
    second = upsert.snapshot_merge(first, spark.createDataFrame([("b2", "s", "2", "v", "c2"), ("c", "s", "3", "v", "c2")], schema), keys, day(2), ["site_id"])
    assert rows(second.select("id", "case_id", "created_on", "last_updated", "is_deleted", "_action"), "case_id") == [
        ("a", "1", "c1", "2024-01-01".replace("01-01", "01-02"), 1, "delete"), ("b2", "2", "c1", "2024-01-02", 0, "update"), ("c", "3", "c2", "2024-01-02", 0, "insert")]
    third = upsert.snapshot_merge(second.drop("_action"), spark.createDataFrame([("a3", "", "1", "v", "c3")], schema), keys, day(3), ["site_id"])
    assert rows(third.select("id", "site_id", "case_id", "is_deleted", "_action"), "case_id")[0] == ("a3", None, "1", 0, "update")


# --- quality, digest ------------------------------------------------------------------------


def test_digest_due_rules(spark):
    new = spark.createDataFrame([("1", "x", 2)], "site_id string, case_id string, report_count long")
    old = spark.createDataFrame([("1", "x", 3), ("2", "y", 1)], "site_id string, case_id string, report_count long")
    run = lambda last, n=new: rows(digest.weekly_digest(old, F.lit(last).cast("date"), n, F.lit("2024-01-10").cast("date")), "site_id")
    assert run("2024-01-03") == [("1", "x", 5, 1), ("2", "y", 1, 1)]
    assert run("2024-01-04") == [("1", "x", 5, 0), ("2", "y", 1, 0)]
    assert run(None)[0][-1] == 1
    assert run("2024-01-03", new.limit(0)) == []


def test_equal_null_counts_do_not_prove_equality(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (2, "x")], "a int, b string")
    b = spark.createDataFrame([(1, None), (2, "x"), (2, "y")], "a int, b string")
    assert all(r["passed"] for r in quality.compare_profiles(a, b).collect())
    assert quality.compare(a, b).first()["equal"] == 0 and quality.compare(a, a).first()["equal"] == 1
    assert rows(quality.compare(a, b)) == [(3, 3, 1, 1, 0)]


def test_soft_delete_threshold_and_empty_table(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "is_deleted int")
    assert rows(quality.soft_delete_percentage(df)) == [(1, 4, 25.0, 0)]
    assert rows(quality.soft_delete_percentage(df, 24))[0][-1] == 1
    assert quality.soft_delete_percentage(df.limit(0)).count() == 0


def test_a_dynamic_pivot_works_its_rows_out_once(spark):
    """The names and the cells were each read from the whole plan."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    eav = spark.createDataFrame([("1", "a", "x"), ("1", "b", None), ("2", None, "y")], "k string, field_name string, field_value string")
    df = reshape.pivot_dynamic(eav.mapInArrow(count, eav.schema), ["k"])
    assert df.columns == ["k", "a", "b"] and rows(df, "k") == [("1", "x", None), ("2", None, None)]
    assert seen.value == 3


def test_wide_pivot_holds_rows_against_few_fields(spark):
    fields = [f"f{i}" for i in range(100)] + ["absent"]
    rows = [(r, f"f{(r * 7 + i) % 103}", f"{r}-{i}") for r in range(6) for i in range(0, 60, 1 + r)]
    rows += [(0, "f0", "zz"), (0, "f0", None), (7, "other", "x"), (8, None, "x"), (None, "f1", "y"), (9, "f3", None)]
    eav = spark.createDataFrame(rows, "record long, field_name string, field_value string")
    for keep in (False, True):
        got = reshape.pivot_fields(eav, ["record"], fields, keep_empty=keep)
        want = {}
        for r, name, value in rows:
            if keep or name in fields:
                cells = want.setdefault(r, dict.fromkeys(fields))
                if name in fields and value is not None:
                    cells[name] = max(cells[name] or "", value)
        assert got.columns == ["record", *fields]
        assert {r.record: {f: r[f] for f in fields} for r in got.collect()} == want
    assert got._jdf.queryExecution().optimizedPlan().toString().count("max(") < 30


@pytest.mark.parametrize("keys", [["record"], ["site", "record"], []])
def test_cells_of_a_wide_pivot_move_once(spark, keys):
    """Blocks of cells were shuffled by (key, block), and again by key, each with room for a whole block."""
    fields = [f"f{i}" for i in range(30)]
    cells = [(s, r, f"f{(3 * r + i) % 33}", None if i == 4 else f"{s}{r}{i}") for s in ("a", None) for r in range(5) for i in range(20)]
    cells += [("a", None, "f1", v) for v in ("b", "", None, "a", "b")] + [(None, 9, "f2", None), ("a", 8, "other", "x"), ("a", 7, None, "x")]
    cells += [("a", 1, "f3", str(i)) for i in range(2000)]
    eav = spark.createDataFrame(cells, "site string, record int, field_name string, field_value string").repartition(4)
    for keep in (False, True):
        got = reshape.pivot_fields(eav, keys, fields, keep_empty=keep)
        want = {}
        for site, record, name, value in cells:
            if keep or name in fields:
                row = want.setdefault(tuple({"site": site, "record": record}[k] for k in keys), dict.fromkeys(fields))
                if name in fields and value is not None:
                    row[name] = value if row[name] is None else max(row[name], value)
        found = got.collect()
        assert len(found) == len(want) and {tuple(r[k] for k in keys): {f: r[f] for f in fields} for r in found} == want
        if keys:
            plan = reshape.pivot_fields(eav, keys, fields, keep_empty=keep)._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_a_wide_pivot_takes_values_of_any_type(spark):
    fields = [f"f{i}" for i in range(120)]
    eav = spark.range(700).select((F.col("id") % 3).alias("k"), F.concat(F.lit("f"), F.col("id") % 130).alias("field_name"), F.when(F.col("id") % 7 > 0, F.col("id") - 350).alias("field_value"))
    for kind in ("bigint", "string", "decimal(9,2)"):
        typed = eav.withColumn("field_value", F.col("field_value").cast(kind))
        got, cells = reshape.pivot_fields(typed, ["k"], fields), {}
        for k, name, value in typed.where("field_value is not null").collect():
            cells[k, name] = max(cells.get((k, name), value), value)
        assert {d for _, d in got.dtypes[1:]} == {kind}
        assert {r.k: r[1:] for r in got.collect()} == {k: tuple(cells.get((k, f)) for f in fields) for k in range(3)}


def test_values_keep_their_digits_and_blanks_in_a_wide_pivot(spark):
    fields = [f"f{i:02}" for i in range(40)]
    values = ["", " ", "0", "00", "12", "-1", "9" * 50, "\u00e4\n", "\U0001f600"]
    eav = spark.createDataFrame([("k", f, v) for f, v in zip(fields, values * 4)] + [("k", "f00", None)], "k string, field_name string, field_value string")
    assert reshape.pivot_fields(eav, ["k"], fields).collect()[0][1:] == (*(values * 4), *[None] * 4)
