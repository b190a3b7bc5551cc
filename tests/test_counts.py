"""Counts taken while writing, width limits, zone maps."""

import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from formflow import session, sinks
from formflow.operators import quality, reshape, upsert
from formflow.plans import jobs, views
from formflow.session import intermediates, materialise
from formflow.sinks import Snapshot, overwrite_staging_counted
from formflow.sources import zones

AT = datetime(2024, 1, 1)


def test_published_counts_are_those_of_the_written_version(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id"), F.element_at(F.array(*map(F.lit, upsert.ACTIONS)), (F.col("id") % 5 + 1).cast("int")).alias("_action"))
    shuffled = rows.repartition(7, "id").join(spark.range(0, 1000, 2), "id")  # shuffles before the write, none after the counts
    snapshot = Snapshot(str(tmp_path / "s"))
    counts = snapshot.publish_counted(shuffled, AT, upsert.ACTIONS)
    read = {r["_action"]: r["count"] for r in snapshot.changes(spark).groupBy("_action").count().collect()}
    assert counts == read and sum(counts.values()) == 500
    assert upsert.counts_row(counts) == upsert.action_counts(snapshot.changes(spark)).first()
    assert snapshot.version(spark) == 1


def test_nothing_is_read_back_for_the_counts(spark, tmp_path):
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    staged, n = overwrite_staging_counted(spark.range(100).toDF("x"), str(tmp_path / "t"))
    assert n == 100 and store.executionsCount() - before == 1
    assert staged.count() == 100
    empty, n = overwrite_staging_counted(spark.range(0).toDF("x"), str(tmp_path / "e"))
    assert n == 0 and empty.count() == 0


def test_widths_cut_count_or_fail(spark):
    df = spark.createDataFrame([("123456789", "abc"), ("1234567890", None), (None, "abcd")], "case_id string, note string")
    widths = {"case_id": 9, "note": None}
    got = {tuple(r) for r in quality.overlong_values(df, {"case_id": 9, "note": 3}).collect()}
    assert got == {("case_id", 9, 1, 10), ("note", 3, 1, 4)}
    cut = reshape.typed_projection(df, widths, F.lit("t")).select("case_id", "note").collect()
    assert sorted(map(tuple, cut), key=str) == sorted([("123456789", "abc"), ("123456789", None), (None, "abcd")], key=str)
    with pytest.raises(Exception, match="case_id is longer than 9"):
        reshape.typed_projection(df, widths, F.lit("t"), overlong="fail").collect()
    assert reshape.typed_projection(df.where("length(case_id) <= 9"), widths, F.lit("t"), overlong="fail").count() == 1
    with pytest.raises(ValueError):
        reshape.to_width("case_id", 3, "ignore")
    assert quality.overlong_values(df.limit(0), {"note": 3}).first().overlong == 0
    assert views.CASE_MART_WIDTHS["case_id"] == 9


def records(spark):
    return spark.range(20_000).select(F.format_string("r%05d", F.floor(F.col("id") / 2)).alias("record"), F.col("id").cast("string").alias("value"))


def test_a_batch_opens_few_files(spark, tmp_path):
    path = str(tmp_path / "z")
    map_ = zones.write_zoned_parts(records(spark), path, files=200)
    assert map_.count() >= 150 and map_.agg(F.sum("rows")).first()[0] == 20_000
    batch = zones.read_records(spark, path, "r05000", "r05049")
    assert batch.count() == 100 and batch.select("record").distinct().count() == 50
    assert len(batch.inputFiles()) <= 3
    assert zones.read_records(spark, path, "s", "t").count() == 0


def test_batches_cover_all_records_once(spark, tmp_path):
    path = str(tmp_path / "z")
    hot = records(spark).withColumn("record", F.when(F.col("record") < "r03000", "r01234").otherwise(F.col("record")))
    map_ = zones.write_zoned_parts(hot.unionByName(hot.limit(3).withColumn("record", F.lit(None).cast("string"))), path, files=30)
    ranges = zones.batches(map_, 2000)
    assert len(ranges) > 3 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert sum(zones.read_records(spark, path, *r).count() for r in ranges) == 20_000


# --- intermediate tables --------------------------------------------------------------------------------------------------


@pytest.fixture
def work(tmp_path, monkeypatch):
    """The work folder, as a place to look into."""
    folder = tmp_path / "work"
    folder.mkdir()
    monkeypatch.setattr(session, "work_dir", lambda spark, purpose: f"file://{folder}/{purpose}-{uuid.uuid4().hex}")
    return lambda: sorted(p.name.rsplit("-", 1)[0] for p in folder.iterdir())


def test_intermediate_tables_go_with_their_scope(spark, work):
    loose = materialise(spark.range(3), "loose")
    with intermediates(spark):
        with intermediates(spark):
            materialise(spark.range(5), "inner")
            kept = materialise(spark.range(7), "kept", keep=True)
        assert work() == ["kept", "loose"] and kept.count() == 7
        last = materialise(kept, "last", keep=True)
    assert work() == ["last", "loose"] and last.count() == 7 and loose.count() == 3
    with pytest.raises(ZeroDivisionError), intermediates(spark):
        materialise(spark.range(5), "failed")
        raise ZeroDivisionError
    assert work() == ["last", "loose"]


def test_an_upsert_leaves_its_version_only(spark, tmp_path, work):
    source = spark.createDataFrame([("1", "a"), ("2", "b")], "k string, v string")
    spec = upsert.MergeSpec(("k",), updates={"v": "s.v"}, inserts={"k": "s.k", "v": "s.v", "active": "1"})
    snapshot = Snapshot(str(tmp_path / "s"))
    schema = spark.createDataFrame([], "k string, v string, active int").schema
    for _ in range(2):
        counts = jobs.run_upsert(snapshot, source, schema, spec, AT, missing_keys=["k"], scope="active = 1")
    assert (counts.inserted, counts.updated) == (0, 2) and work() == [] and snapshot.current(spark).count() == 2


def test_a_range_of_parts_is_bounded_by_rows(spark, tmp_path):
    """The number of files was fixed: what one task sorts grew with the table."""
    rows = spark.range(1000).select(F.when(F.col("id") >= 5, F.lpad(F.col("id").cast("string"), 4, "0")).alias("record"), F.col("id").alias("value"))
    map_ = zones.write_zoned_parts(rows, str(tmp_path), files=2, rows_per_file=100)
    found = sorted(map_.collect(), key=lambda r: r.low or "")
    assert len(found) >= 9 and sum(r.rows for r in found) == 1000
    assert all(a.high <= b.low for a, b in zip(found, found[1:]) if a.high)
    assert min(r.low for r in found if r.low) == "0005" and max(r.high for r in found if r.high) == "0999"


def test_keys_of_a_uniqueness_test_are_dealt_by_rows(spark, monkeypatch):
    """One task's share of the keys followed the table, as the join before it had dealt the rows."""
    monkeypatch.setattr(quality, "KEYS_PER_TASK", 100)
    rows = spark.range(1000).select((F.col("id") % 999).alias("k"), F.lit(None).cast("string").alias("n"))
    df = quality.declared_tests(rows, [quality.Declared("n is set", "n is null")], {"k": ["k"], "n": ["k", "n"]})
    assert "hashpartitioning(k" in (plan := df._jdf.queryExecution().executedPlan().toString()) and ", 11), REPARTITION_BY_NUM" in plan
    assert [tuple(r) for r in df.collect()] == [("n is set", 1000, "error"), ("k", 1, "error"), ("n", 1, "error")]


def test_staging_tables_are_written_by_zstd(spark, tmp_path):
    """Hash ids are half of a mart's bytes under the default codec."""
    staged = sinks.overwrite_staging(spark.range(10), str(tmp_path / "t"))
    assert staged.count() == 10 and list((tmp_path / "t").glob("*.zstd.parquet"))
