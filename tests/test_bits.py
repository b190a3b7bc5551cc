"""Bit tables before joins, and ordered lists by ranges."""

import pytest
from pyspark.sql import functions as F

from formflow.functions import bits
from formflow.operators import enrich, quality


def test_possible_and_impossible_part_the_rows(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") > 0, F.col("id").cast("string")).alias("k"), F.lit("s").alias("s"), "id")
    keys = rows.where("id % 50 = 7").select("k", "s")
    maybe = {r.id for r in bits.possible(rows, keys, ["k", "s"], 1 << 12).collect()}
    never = {r.id for r in bits.impossible(rows, keys, ["k", "s"], 1 << 12).collect()}
    held = {i for i in range(20_000) if i % 50 == 7}
    assert held <= maybe and maybe | never == set(range(20_000)) and not maybe & never
    assert len(maybe) < 1.1 * len(held)
    full = bits.possible(rows, keys, ["k", "s"], 1)  # no room: everything may be held, nothing is lost
    assert held <= {r.id for r in full.collect()} and bits.bit_table(keys, ["k"], 1).count() == 1
    assert bits.possible(rows, keys.where("false"), ["k", "s"]).isEmpty()
    assert bits.impossible(rows, keys.where("false"), ["k", "s"]).count() == 20_000


def test_keys_must_be_comparable(spark):
    rows = spark.range(3)
    for other in ("int", "string"):
        with pytest.raises(ValueError, match="same type"):
            bits.possible(rows, rows.select(F.col("id").cast(other)), ["id"])
    floating = rows.select(F.col("id").cast("double").alias("id"))
    with pytest.raises(ValueError, match="floating"):
        bits.possible(floating, floating, ["id"])
    with pytest.raises(ValueError, match="power of two"):
        bits.bit_table(rows, ["id"], 3)


def eav(spark):
    """Of 300 records, every tenth has a valid id; some have none, one an id that differs between sites, one a NULL name."""
    r = F.col("id")
    case = F.when(r % 10 == 0, F.format_string("ABCD%05d", r)).when(r % 10 < 8, F.lit("bad"))
    base = spark.range(300).select(
        r.cast("string").alias("record"), F.when(r % 7 == 0, "t").otherwise("s").alias("site_id"), case.alias("case_id"), F.lit("c1").alias("catchment_id_1"), F.lit("v").alias("a"), F.lit("w").alias("b"))
    tall = base.unpivot(["record", "site_id"], ["case_id", "catchment_id_1", "a", "b"], "field_name", "value").where("value is not null")
    return tall.unionByName(spark.createDataFrame([("10", "s2", "case_id", "bad"), (None, "s", "a", "v"), ("20", "s", None, "v")], "record string, site_id string, field_name string, value string"))


def test_load_with_bits_equals_load(spark):
    rows = eav(spark)
    plain, quick = enrich.load_case_rows(rows), enrich.load_case_rows(rows, words=1 << 12)
    for name in ("rows", "warnings", "missing_catchment"):
        assert sorted(map(str, getattr(plain, name).collect())) == sorted(map(str, getattr(quick, name).collect())), name


def test_rows_of_excluded_records_are_not_in_the_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = enrich.load_case_rows(eav(spark), words=1 << 12).rows._jdf.queryExecution().sparkPlan().toString()
        semi = plan.index("LeftSemi")
        assert "SortMergeJoin" in plan[:semi] and "BroadcastHashJoin" in plan[:semi]  # the bits are asked below the join
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_exclusion_with_bits_equals_exclusion(spark):
    rows = spark.createDataFrame(
        [("s", "1", "ABCD00001", "x"), ("s", "1", "bad", "y"), ("t", "1", "ABCD00001", "z"), ("s", "2", "ABCD00002", "x"), ("s", "2", "ABCD00002", "x"),
         ("s", None, "bad", "x"), ("s", None, "ABCD00003", "y"), ("s", "3", None, "x")], "site_id string, report_id string, case_id string, value string")
    for scope in (("report_id",), ("site_id", "report_id")):
        want = sorted(map(str, enrich.exclude_invalid_reports(rows, scope=scope).select(*rows.columns).collect()))
        out = enrich.exclude_invalid_reports(rows, scope=scope, words=64)
        assert out.columns == rows.columns and sorted(map(str, out.collect())) == want
    assert enrich.exclude_invalid_reports(rows.where("false"), words=64).isEmpty()


def test_ordered_list_by_range(spark):
    hot = spark.range(40_000).select(F.when(F.col("id") % 8 > 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("k"), F.sha1((F.col("id") % 30_000).cast("string")).alias("v"))
    few = spark.createDataFrame([("n", None), ("m", None), ("m", "b"), ("m", "a"), ("m", "a"), (None, "z"), ("e", "")], "k string, v string")
    rows = hot.unionByName(few)
    got = {r.k: r.out for r in quality.ordered_list_by_range(rows, "k", "v", "out").collect()}
    assert got == {r.k: r.out for r in quality.ordered_list(rows, "k", "v", "out").collect()}
    assert (got["m"], got["n"], got[None], got["e"]) == ("a, b", None, "z", "")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r.n for r in quality.ordered_runs(rows, "k", "v").where("k = 'hot'").select((F.length("_run") / 42).cast("int").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 4 and max(sizes) < 0.4 * sum(sizes)
