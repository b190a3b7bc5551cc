"""Sources, sinks and the batch jobs end to end on small data."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from formflow import session, sinks, sources
from formflow.operators.upsert import MergeSpec
from formflow.plans import jobs
from formflow.schemas import ExportLayout

NOW = dt.datetime(2024, 2, 1)
EAV4 = "record string, site_id string, field_name string, value string"


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_snapshot_versions(spark, tmp_path):
    snap = sinks.Snapshot(str(tmp_path / "t"))
    assert snap.current(spark) is None and snap.version(spark) == 0
    assert snap.publish(spark.createDataFrame([(1, "insert")], "a int, _action string"), NOW) == 1
    old = snap.current(spark)
    assert snap.publish(old.withColumn("a", F.col("a") + 1).withColumn("_action", F.lit("update")), NOW) == 2
    assert rows(old) == [(1,)] and rows(snap.current(spark)) == [(2,)]
    assert rows(snap.at(spark, 1).select("a")) == [(1,)]


def test_failed_publish_keeps_current(spark, tmp_path):
    snap = sinks.Snapshot(str(tmp_path / "t"))
    snap.publish(spark.createDataFrame([(1,)], "a int"), NOW)
    with pytest.raises(Exception):
        snap.publish(spark.range(1).select(F.raise_error(F.lit("boom")).cast("int").alias("a")), NOW)
    assert snap.version(spark) == 1 and rows(snap.current(spark)) == [(1,)]


def test_snapshot_mart_job(spark, tmp_path):
    snap = sinks.Snapshot(str(tmp_path / "mart"))
    schema, keys = "id string, case_id string, field_name string, field_value string", ["case_id", "field_name", "field_value"]
    stage = lambda *r: spark.createDataFrame(list(r), schema)
    assert jobs.refresh_snapshot(snap, stage(("a", "1", "f", "x"), ("b", "2", "f", "y")), keys, NOW) == {"insert": 2}
    assert jobs.refresh_snapshot(snap, stage(("b", "2", "f", "y"), ("c", "2", "f", "z")), keys, NOW) == {"insert": 1, "update": 1, "delete": 1}
    assert jobs.refresh_snapshot(snap, stage(("a", "1", "f", "x")), keys, NOW) == {"update": 1, "delete": 2}
    assert rows(snap.current(spark).select("id", "is_deleted"), "id") == [("a", 0), ("b", 1), ("c", 1)]


def test_upsert_job_counts_add_up(spark, tmp_path):
    snap = sinks.Snapshot(str(tmp_path / "consent"))
    source = lambda *r: spark.createDataFrame(list(r), "id string, k string, v string, created_on string")
    schema = spark.createDataFrame([], "id string, k string, v string, created_on string, active int").schema
    spec = MergeSpec(("id",), {"v": "s.v"}, {"id": "s.id", "k": "s.k", "v": "s.v", "created_on": "s.created_on", "active": "1"}, target_filter="active = 1")
    run = lambda src: tuple(jobs.run_upsert(snap, src, schema, spec, NOW, missing_keys=["k"], scope="active = 1", duplicate_keys=["k"], duplicate_order=["created_on", "id"]))
    assert run(source(("1", "a", "x", "d1"), ("2", "b", "y", "d1"))) == (2, 2, 0, 0, 0)
    # A duplicate row for a, and b is gone.
    assert run(source(("3", "a", "z", "d2"))) == (1, 1, 0, 1, 1)
    assert rows(snap.current(spark).select("id", "active"), "id") == [("1", 0), ("2", 2), ("3", 1)]


def test_case_project_and_digest(spark, tmp_path):
    eav = spark.createDataFrame(
        [("1", "s", "case_id", "ABCD00001"), ("1", "s", "catchment_id_a", "7"), ("1", "s", "f", "x"), ("2", "s", "case_id", "bad"), ("2", "s", "f", "y")], EAV4)
    done = jobs.stage_case_project(eav, str(tmp_path / "stage"), "case_rows")
    assert done.counts.asDict() == {"table_name": "case_rows", "source_rows": 5, "loaded_rows": 3, "filtered_rows": 2, "skipped": 0}
    assert jobs.stage_case_project(eav.limit(0), str(tmp_path / "none"), "case_rows").staging is None
    root, day = str(tmp_path / "digest"), dt.date(2024, 2, 1)
    sent = jobs.run_digest(root, done.warnings, day)
    assert rows(sent.select("site_id", "case_id", "report_count")) == [("s", "bad", 1)]
    assert jobs.run_digest(root, done.warnings, day + dt.timedelta(days=3)) is None
    assert jobs.run_digest(root, done.warnings.limit(0), day + dt.timedelta(days=9)) is None
    later = jobs.run_digest(root, done.warnings, day + dt.timedelta(days=7))
    assert rows(later.select("case_id", "report_count")) == [("bad", 2)]


def test_other_projects(spark, tmp_path):
    eav = spark.createDataFrame(
        [("p1", "i", "1", "case_id", " ABCD00001 "), ("p1", "i", "1", "f", "x"), ("p2", None, None, "f", "y"), ("p1", "i", "1", "f", "x")],
        "record string, repeat_instrument string, repeat_instance string, field_name string, value string")
    packets = jobs.stage_packet_project(eav, str(tmp_path / "p"), "case_id", NOW)
    assert rows(packets.select("packet_id", "case_id").distinct()) == [("p1", "ABCD00001")]
    assert jobs.stage_repeat_project(eav, str(tmp_path / "r"), NOW).count() == 3
    sites = jobs.stage_abstraction_project(eav, str(tmp_path / "a"), "f", NOW).select("case_id", "site_id").distinct()
    assert rows(sites, "case_id") == [("p1", "x"), ("p2", "y")]


def test_projects_are_independent(spark):
    ran = []
    with pytest.raises(ExceptionGroup, match="bad"):
        jobs.run_projects({"bad": lambda s: 1 / 0, "good": lambda s: ran.append(s)}, spark)
    assert ran == [spark]


def test_record_never_split_over_chunks(spark, tmp_path):
    eav = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("record"), F.col("id").cast("string").alias("value"))
    # Real chunks are far above the advisory size; here it would merge all writers into one.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sinks.write_chunks(eav, str(tmp_path / "c"), chunks=6)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got.count() == 5000
    assert got.groupBy("record").agg(F.countDistinct("chunk_id").alias("n")).filter("n > 1").isEmpty()
    hot = got.filter("record = 'hot'").select(F.col("_metadata.file_path").alias("f")).distinct()
    assert hot.count() > 1, "a hot record is written by several tasks"


def test_json_array_and_own_names(spark, tmp_path):
    (tmp_path / "e.json").write_text('[{"rid": 1, "centre": "001", "field_name": "f", "value": "007"}, {"rid": "2", "field_name": "g", "value": 5}]')
    got = sources.read_eav_json(spark, str(tmp_path / "e.json"), ExportLayout("rid", "centre"), array_files=True)
    assert rows(got.select("record", "site_id", "field_name", "value"), "record") == [("1", "001", "f", "007"), ("2", None, "g", "5")]


def test_union_default_site(spark):
    a = spark.createDataFrame([("1", "f", "x")], "record string, field_name string, value string")
    b = spark.createDataFrame([("2", None, "f", "y"), ("3", "9", "f", "z")], EAV4)
    got = sources.union_projects({"a": a, "b": b}, {"b": "001"})
    assert rows(got.select("record", "site_id"), "record") == [("1", None), ("2", "001"), ("3", "9")]


def test_work_dir_uses_the_cluster_folder(spark):
    def cluster(folder):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=SimpleNamespace(master="yarn", applicationId="a"))

    assert session.work_dir(cluster("hdfs:///shared"), "x").startswith("hdfs:///shared/x-")
    with pytest.raises(ValueError):
        session.work_dir(cluster(None), "x")
    assert session.work_dir(spark, "x") != session.work_dir(spark, "x")


def test_empty_exports_change_nothing(spark, tmp_path):
    eav = spark.createDataFrame([("r1", "s", None, None, "f", "x"), ("r2", "s", None, None, "case_id", "ABCD12345")],
                                "record string, site_id string, repeat_instrument string, repeat_instance string, field_name string, value string")
    loaders = {
        "repeat": lambda e, p: jobs.stage_repeat_project(e, p, NOW), "packet": lambda e, p: jobs.stage_packet_project(e, p, "case_id", NOW),
        "abstraction": lambda e, p: jobs.stage_abstraction_project(e, p, "site", NOW),
        "case": lambda e, p: jobs.stage_case_project(e, p, "t").staging,
    }
    for name, load in loaders.items():
        path = str(tmp_path / name)
        before = load(eav, path).count()
        assert load(eav.limit(0), path) is None
        assert spark.read.parquet(path).count() == before > 0, name


def test_an_empty_staging_table_does_not_empty_the_mart(spark, tmp_path):
    snap = sinks.Snapshot(str(tmp_path / "mart"))
    staging = spark.createDataFrame([("a", "1")], "id string, case_id string")
    jobs.refresh_snapshot(snap, staging, ["case_id"], NOW)
    with pytest.raises(ValueError, match="empty"):
        jobs.refresh_snapshot(snap, staging.limit(0), ["case_id"], NOW)
    assert rows(snap.current(spark).select("id", "is_deleted")) == [("a", 0)]
    assert jobs.refresh_snapshot(snap, staging.limit(0), ["case_id"], NOW, allow_empty=True) == {"delete": 1}


def test_broken_lines_fail_or_are_counted(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.createDataFrame([('{"record": "1", "f": "x"}',), ('{"record": "2", "f": ',), ("",), ("[1]",)], "value string").coalesce(1).write.text(path)
    layout = ExportLayout()
    assert rows(sources.bad_json_lines(spark.read.text(path))) == [(3, 2)]
    for read in (lambda: sources.read_flat_json(spark, path, layout), lambda: sources.read_eav_json(spark, path, layout), lambda: sources.record_ids(spark, path, layout)):
        with pytest.raises(Exception, match="(?i)malformed"):
            read().collect()
    csv = tmp_path / "short.csv"
    csv.write_text("a,b\n1,2\n3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        sources.read_csv_coerced(spark, str(csv)).collect()


def test_sequences_of_any_width(spark):
    from formflow.operators import ordered

    step = 5 * 10**17
    df = spark.createDataFrame([(-(2**63) + i * step, i) for i in range(36)], "at long, i int")
    for size in (36, 7, 1):
        out = ordered.ordered_columns(df, "at", counts={"n": F.lit(True)}, fills={"even": F.when(F.col("i") % 2 == 0, F.col("i"))}, blocks=size)
        assert rows(out.select("i", "n", "even"), "i") == [(i, i + 1, i - i % 2) for i in range(36)]
