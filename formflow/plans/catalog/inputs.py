"""Frames the registered queries start from: fixture views run through the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from formflow.operators import decode, enrich, reshape
from formflow.plans.fixtures import RUN_TS, STUDY, fixture

SUPPRESSED = {"specimen_form": "N", "culture_form": "F"}


def run_ts():
    """Run time of the registered queries; text, so that both engines print it alike."""
    return F.lit(RUN_TS)


def eav(spark: SparkSession, d: str) -> DataFrame:
    return reshape.wide_to_eav(fixture(spark, d, "fx_flat")).select("record", "site_id", "field_name", "value")


def staging(spark: SparkSession, d: str) -> DataFrame:
    """Enriched rows in staging layout, bad ids included."""
    return reshape.to_layout(
        enrich.enrich_keys(eav(spark, d)),
        {"site_id": "site_id", "catchment_id": "catchment_id", "report_id": "record", "case_id": "case_id",
         "field_name": "field_name", "field_value": "value"},
    )


def mart(spark: SparkSession, d: str) -> DataFrame:
    """Case mart: valid reports only, a few marked deleted."""
    rows = enrich.load_case_rows(eav(spark, d)).rows
    deleted = F.when(F.col("report_id").cast("bigint") % 23 == 0, 1).otherwise(0)
    return rows.withColumn("is_deleted", deleted)


def decoded(spark: SparkSession, d: str) -> DataFrame:
    return decode.decode_all(mart(spark, d), fixture(spark, d, "fx_codes"), fixture(spark, d, "fx_dict"))


def report(spark: SparkSession, d: str) -> DataFrame:
    return decode.decode_report(
        mart(spark, d), fixture(spark, d, "fx_codes"), fixture(spark, d, "fx_dict_typed"),
        ["site_id", "catchment_id", "case_id"],
    )


def repeat_mart(spark: SparkSession, d: str) -> DataFrame:
    """Mart of repeating-form rows (``fx_repeat_mart``): one scan, un-pivoted."""
    wide = fixture(spark, d, "fx_repeat").withColumn("_flag", F.col("returnflag"))
    tall = wide.unpivot(
        ["record", "repeat_instrument", "repeat_instance", "created_on", "_flag"],
        ["returnflag", "linestatus", "ship_dt", "kit_id"], "field_name", "field_value",
    )
    gone = (F.col("field_name") == "kit_id") & (F.col("_flag") == "N")
    return tall.select(
        F.col("record").alias("case_id"), "repeat_instrument", "repeat_instance", "field_name", "field_value", "created_on",
        F.when(gone, 1).otherwise(0).alias("is_deleted"),
    )


def registered(spark: SparkSession, d: str) -> DataFrame:
    return decode.decode_registered(
        repeat_mart(spark, d), fixture(spark, d, "fx_codes"), fixture(spark, d, "fx_repeat_dict"),
        fixture(spark, d, "fx_registration"), STUDY, SUPPRESSED,
    )
