"""Fingerprints, hash-tree comparison, bucketed marts and equal-depth blocks."""

import re
import statistics
import time

import pytest
from pyspark.sql import functions as F

from formflow.operators import fingerprints, ordered, quality, upsert
from formflow.session import materialise
from formflow.sinks.buckets import BucketedMart

SCHEMA = "k long, a string, b string, x double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


BASE = [(i, None if i % 7 == 0 else f"a{i % 5}", f"b{i}", float(i)) for i in range(200)]


@pytest.mark.parametrize("change", [
    lambda r: r, lambda r: r[::-1], lambda r: r[1:], lambda r: r + r[:3], lambda r: [(r[0][0], r[0][1], "other", 0.0), *r[1:]],
    lambda r: [(k, b, a, x) for k, a, b, x in r], lambda r: [(k, "", b, x) if a is None else (k, a, b, x) for k, a, b, x in r], lambda r: []])
@pytest.mark.parametrize("keys", [None, ["k"]])
def test_tree_gives_the_figures_of_the_full_comparison(spark, change, keys):
    left, right = frame(spark, BASE), frame(spark, change(BASE))
    got = fingerprints.compare_tree(left, right, keys, fanout=8)
    assert rows(got.figures.select("left_rows", "right_rows", "only_left", "only_right", "equal")) == rows(quality.compare(left, right))
    sign = left.withColumn("n", F.lit(1)).unionByName(right.withColumn("n", F.lit(-1)))
    assert rows(got.differing) == rows(sign.groupBy("k", "a", "b", "x").agg(F.sum("n").alias("s")).where("s <> 0"))


def test_both_sides_empty(spark):
    got = fingerprints.compare_tree(frame(spark, []), frame(spark, [])).figures.first()
    assert tuple(got) == (0, 0, 0, 0, 1)


def test_nulls_and_their_place_count(spark):
    one = frame(spark, [(1, None, "x", 0.0)])
    assert one.select(fingerprints.row_hash(["a", "b"], 1)).first() != frame(spark, [(1, "x", None, 0.0)]).select(fingerprints.row_hash(["a", "b"], 1)).first()


def test_equal_inputs_shuffle_fingerprints_only(spark, tmp_path):
    """Rows written to shuffles by the whole comparison, from the plans' metrics."""
    spark.range(50_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v")).write.parquet(str(tmp_path / "t"))
    rows_ = spark.read.parquet(str(tmp_path / "t"))
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    assert fingerprints.compare_tree(rows_, rows_.select("*"), fanout=16).figures.first()["equal"] == 1
    time.sleep(1)  # for the listener
    moved = 0
    executions = store.executionsList(before, 1000)
    for i in range(executions.size()):
        e = executions.apply(i)
        values = store.executionMetrics(e.executionId())
        for j in range(e.metrics().size()):
            m = e.metrics().apply(j)
            if m.name() == "shuffle records written" and values.contains(m.accumulatorId()):
                moved += int(re.sub(r"\D", "", values.apply(m.accumulatorId()).split("\n")[0]) or 0)
    assert moved < 2_000  # of 100,000 rows: one per bucket and task


# --- bucketed marts -------------------------------------------------------------------------------------------------------

MART = "id string, k string, note string"
KEYS = ["k"]


def source(spark, keys, ids="i"):
    return spark.createDataFrame([(f"{ids}{k}", str(k), f"first {k}") for k in keys], MART)


def plain_runs(spark, runs):
    """The same runs with the whole-table merge."""
    table = None
    for df, ts in runs:
        table = upsert.snapshot_initial(df, F.lit(ts)) if table is None else upsert.snapshot_merge(table, df, KEYS, F.lit(ts)).drop("_action")
    return rows(table.select("id", "k", "note", "last_updated", "is_deleted"))


def test_bucketed_runs_equal_whole_table_runs(spark, tmp_path):
    steps = [range(100), range(100), [*range(5, 100), 200], [*range(5), *range(50, 120)], [], [3, 4], range(10)]
    mart, runs = BucketedMart(str(tmp_path / "m"), KEYS, buckets=7), []
    assert mart.read(spark) is None
    for i, keys in enumerate(steps):
        df = source(spark, keys, "i" if i < 5 else "j")
        runs.append((df, f"2024-01-0{i + 1} 00:00:00"))
        counts = mart.refresh(df, runs[-1][1])
        assert counts["live"] == len(list(keys)) and counts["version"] == i + 1
        assert rows(mart.read(spark).select("id", "k", "note", "last_updated", "is_deleted")) == plain_runs(spark, runs), i
    assert counts["rewritten"] == 7


def test_one_percent_of_the_keys_rewrites_five_percent_of_the_buckets(spark, tmp_path):
    mart = BucketedMart(str(tmp_path / "m"), KEYS, buckets=100, bucket_of="floor(cast(k as bigint) / 100)")
    first = mart.refresh(source(spark, range(10_000)), "2024-01-01 00:00:00")
    assert first["rewritten"] == 100 and first["inserted"] == 10_000
    again = mart.refresh(source(spark, range(10_000)), "2024-01-02 00:00:00")
    assert again["rewritten"] == 0 and again["live"] == 10_000
    late = mart.refresh(source(spark, [*range(9_900), *range(10_000, 10_100)]), "2024-01-03 00:00:00")
    assert late["rewritten"] <= 5 and late["deleted"] == 100 and late["inserted"] == 100
    # Untouched buckets keep their files; all live rows carry the stamp of the last run.
    paths = {r.path for r in mart.manifest(spark).collect()}
    assert len(paths) == 2
    assert {tuple(r) for r in mart.read(spark).groupBy("is_deleted", "last_updated").count().collect()} == {
        (0, "2024-01-03 00:00:00", 10_000), (1, "2024-01-03 00:00:00", 100)}


def test_duplicate_keys_fail_and_leave_the_version(spark, tmp_path):
    mart = BucketedMart(str(tmp_path / "m"), KEYS, buckets=3)
    mart.refresh(source(spark, range(10)), "2024-01-01 00:00:00")
    with pytest.raises(Exception, match="more than one source row"):
        mart.refresh(source(spark, [1, 1, 2]), "2024-01-02 00:00:00")
    assert mart.read(spark).count() == 10 and mart.manifest(spark).first()["version"] == 1


# --- equal-depth blocks ---------------------------------------------------------------------------------------------------


def test_clumped_sequences_give_blocks_of_equal_size(spark):
    """Nine tenths of the rows in a hundredth of the range."""
    at = F.when(F.col("id") < 18_000, F.col("id")).otherwise(F.col("id") * 100 - 1_600_000)
    df = spark.range(20_000).select(at.alias("at"))
    sizes = [r["count"] for r in ordered.with_block(df, "at", 16).groupBy("_block").count().collect()]
    assert len(sizes) == 16 and max(sizes) <= 2 * statistics.median(sizes)
    numbered = ordered.row_number(df, "at", "n", blocks=16)
    assert numbered.where("n <> case when at < 18000 then at + 1 else (at + 1600000) / 100 + 1 end").isEmpty()


@pytest.mark.parametrize("changed, levels", [(500, 1), (3, 2), (0, 2)])
def test_a_second_level_is_left_out_where_most_rows_differ(spark, monkeypatch, changed, levels):
    """It was made in any case, and kept no row in place where the differences lie in all parts."""
    written = []
    monkeypatch.setattr(fingerprints, "materialise", lambda df, purpose: written.append(purpose) or materialise(df, purpose))
    left = spark.range(500).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    right = left.withColumn("v", F.when(F.col("k") < changed, F.lit(None)).otherwise(F.col("v")))
    got = fingerprints.compare_tree(left, right, ["k"], fanout=64)
    assert tuple(got.figures.first()) == (500, 500, changed, changed, int(not changed))
    assert written.count("hash-tree") == levels
    assert got.differing.where("left_surplus = 1 and v is not null").count() == changed
    assert got.differing.where("left_surplus = -1 and v is null").count() == changed
