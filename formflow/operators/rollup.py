"""Case status roll-up over notification, site, registration, abstraction, procedure and lab dates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from formflow.functions import to_day
from formflow.operators.decode import of_study
from formflow.operators.reshape import live_rows, suppress_answers


def conditional_max(rows: DataFrame, key: str, groups: Mapping[str, Sequence[str]], date_col: str = "created_on") -> DataFrame:
    """Latest date per key for each named group of forms, all in one pass.

    Only forms of some group are read; the filter reaches the scan or the
    dictionary side of the decode join.
    """
    day = to_day(date_col)
    forms = sorted({f for names in groups.values() for f in names})
    return (
        rows.filter(F.col("form_name").isin(forms))
        .groupBy(key)
        .agg(*[F.max(F.when(F.col("form_name").isin(list(names)), day)).alias(out) for out, names in groups.items()])
    )


def lab_dates(
    mart: DataFrame, dictionary: DataFrame, registrations: DataFrame, study: str, suppressed: Mapping[str, str],
    groups: Mapping[str, Sequence[str]],
) -> DataFrame:
    """``conditional_max`` over the registered report view, without building that view.

    The dates need neither labels nor the registration's columns: rows are
    reduced to one per case on the map side first, and only those meet the
    registrations, as a semi join.
    """
    forms = sorted({f for names in groups.values() for f in names})
    active = dictionary.filter((F.col("active") == 1) & F.col("form_name").isin(forms)).select("field_name", "form_name")
    rows = suppress_answers(live_rows(mart).join(active, "field_name"), suppressed)
    cases = of_study(registrations, study).select("case_id")
    return conditional_max(rows, "case_id", groups).join(cases, "case_id", "left_semi")


def last_date(rows: DataFrame, key: str, out: str, date_col: str = "created_on") -> DataFrame:
    return rows.groupBy(key).agg(F.max(to_day(date_col)).alias(out))


def status_rollup(
    notifications: DataFrame, sites: DataFrame, registrations: DataFrame, abstraction: DataFrame,
    procedures: DataFrame, lab: DataFrame, run_date: Column,
) -> DataFrame:
    """One row per notified and registered case with the last date of each later step.

    ``lab`` has one row per case (``lab_dates``). The date inputs are reduced to
    one row per case before they are joined, so the joins after registration
    cluster on the case id.
    """
    n = notifications.alias("n")
    r = registrations.filter(F.col("active") == 1).alias("r")
    site = sites.select(F.col("id").alias("_sid"), F.col("name").alias("site_name"))
    base = (
        n.join(site, F.col("n.site_guid") == F.col("_sid"))
        .join(
            r,
            (F.col("n.report_id") == F.col("r.report_id"))
            & (F.col("n.site_guid") == F.col("r.site_guid"))
            & (F.col("n.catchment_id") == F.col("r.catchment_id")),
        )
        .select(
            "r.case_id", "n.report_id", "n.catchment_id", "n.notified_on", "n.site_id", "n.site_guid",
            "site_name", F.col("r.file_name").alias("file_name"),
        )
    )
    abstracted = last_date(abstraction, "case_id", "abstraction_on")
    proc = procedures.filter(F.col("site_guid").isNotNull()).select(
        "case_id", "file_name", to_day("created_on").alias("procedure_on")
    )
    out = (
        base.join(abstracted, "case_id", "left")
        .join(proc, ["case_id", "file_name"], "left")
        .join(lab, "case_id", "left")
    )
    return out.select(
        "case_id", "report_id", "catchment_id", "notified_on",
        F.datediff(run_date, to_day("notified_on")).alias("days_since_notification"),
        "site_id", "site_guid", "site_name", "procedure_on", "abstraction_on",
        *[c for c in lab.columns if c != "case_id"],
    )


def case_status_source(widgets: DataFrame, catchments: DataFrame, sites: DataFrame, description: str) -> DataFrame:
    """Widget rows whose catchment carries the description, with the site's code."""
    c = catchments.filter(F.col("description") == description).select("site_guid", "catchment_id")
    s = sites.select(F.col("id").alias("site_guid"), F.col("site_id").alias("site_code"))
    return widgets.join(c, ["site_guid", "catchment_id"]).join(s, "site_guid").select(
        "case_id", "site_guid", "catchment_id", "site_code"
    )
