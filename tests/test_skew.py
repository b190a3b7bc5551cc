"""Joins in which one key holds most rows are split: ``skew=true`` in the final plan."""

import pytest
from pyspark.sql import functions as F

from formflow.operators import enrich, reshape, upsert

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def rows(spark):
    """Key 'hot' holds 80 % of the rows; several map tasks, as AQE splits a partition between them."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    hot = F.col("id") % 5 != 0
    key = F.when(hot, "hot").otherwise(F.concat(F.lit("r"), F.col("id").cast("string")))
    df = spark.range(0, 60_000, 1, 12).select(
        key.alias("record"), F.lit("s").alias("site_id"), F.concat(F.lit("f"), (F.col("id") % 3).cast("string")).alias("field_name"),
        F.sha2(F.col("id").cast("string"), 256).alias("value"), "id")
    yield df
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def targets(df):
    return df.select(F.col("record").alias("k"), F.col("value").alias("v"), F.lit(1).alias("active"), F.lit(0).alias("is_deleted"), "id")


CASES = {
    "enrich_keys": lambda df: enrich.enrich_keys(df, "f0", "f1"),
    "packet_map": lambda df: enrich.packet_map(df, "f0"),
    "exclude_invalid_reports": lambda df: enrich.exclude_invalid_reports(
        df.select(F.col("record").alias("report_id"), "site_id", "value", F.col("record").alias("case_id")), lambda c: c != "r5"),
    "promote_field": lambda df: reshape.promote_field(df, "f0", "x"),
    "latest_flag": lambda df: upsert.latest_flag(targets(df), ["k"], ["id"]),
    "deactivate_missing": lambda df: upsert.deactivate_missing(targets(df), targets(df).where("k <> 'r5'").select("k"), ["k"], "active = 1"),
    "missing_rows": lambda df: upsert.missing_rows(targets(df), targets(df).where("k <> 'r5'").select("k"), ["k"]),
    "snapshot_deleted": lambda df: upsert.snapshot_deleted(targets(df), targets(df).where("k <> 'r5'").select("k"), ["k"]),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_hot_key_is_split(rows, name):
    out = CASES[name](rows)
    out.write.format("noop").mode("overwrite").save()
    out.collect()
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
