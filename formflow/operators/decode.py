"""EAV rows joined with dictionary, code list, sites and registrations.

No broadcast hints: dictionary, code list and site tables are read from tables
whose size Catalyst knows, so it broadcasts them while they are below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles them once they are not.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from formflow.functions import label_of
from formflow.operators.reshape import drop_completion_field, live_rows, map_names, suppress_answers

DICT_COLUMNS = ("form_name", "form_sequence_id", "section_header", "field_label", "field_type", "sequence_id", "report_type")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself, failing at run time when two rows share a key."""
    others = [c for c in df.columns if c not in keys]
    n = F.count(F.lit(1))
    checked = df.groupBy(*keys).agg(n.alias("_n"), *[F.any_value(c).alias(c) for c in others])
    message = F.concat(F.lit("duplicate key "), F.to_json(F.struct(*keys)))
    # Guard a column every consumer reads, or column pruning would remove the check.
    guarded = F.when(F.col("_n") == 1, F.col(keys[0])).otherwise(F.raise_error(message).cast(df.schema[keys[0]].dataType))
    return checked.withColumn(keys[0], guarded).select(*df.columns)


def _with_label(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """Add ``field_value_label``; the code list must hold every code once."""
    labels = assert_unique(codes.select(F.col("code").alias("_code"), F.col("pref").alias("_pref")), ["_code"])
    joined = rows.join(labels, rows["field_value"] == labels["_code"], "left")
    label = label_of(F.col("field_type"), F.col("_pref"), F.col("field_value"))
    return joined.withColumn("field_value_label", label).drop("_code", "_pref")


def decode_all(mart: DataFrame, codes: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Live rows with a catchment, labelled; fields without a dictionary row stay (NULL form)."""
    dict_cols = dictionary.select("field_name", "form_name", "field_label", "field_type", "sequence_id")
    rows = live_rows(mart, non_blank=["catchment_id"]).join(dict_cols, "field_name", "left")
    return _with_label(rows, codes).select(
        "site_id", "report_id", "catchment_id", "case_id", "field_name", "field_value", "field_value_label",
        "form_name", "field_label", "field_type", "sequence_id",
    )


def decode_report(mart: DataFrame, codes: DataFrame, dictionary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Report view: live rows of active dictionary fields, without completion flags.

    The active filter on the dictionary makes the join an inner one; it runs
    before the label join, so only rows that stay are labelled.
    """
    active = dictionary.filter(F.col("active") == 1).select("field_name", *DICT_COLUMNS)
    rows = drop_completion_field(live_rows(mart).join(active, "field_name"))
    return _with_label(rows, codes).select(*keys, "field_name", "field_value", "field_value_label", *DICT_COLUMNS)


def decode_registered(
    mart: DataFrame, codes: DataFrame, dictionary: DataFrame, registrations: DataFrame,
    study: str, suppressed: Mapping[str, str],
) -> DataFrame:
    """Report view of repeating forms: only cases with an active registration of the study.

    ``suppressed`` names one answer per form that is not shown. The site comes
    from the registration.
    """
    active = dictionary.filter(F.col("active") == 1).select("field_name", *DICT_COLUMNS)
    rows = suppress_answers(live_rows(mart).join(active, "field_name"), suppressed)
    cases = of_study(registrations, study).select("case_id", F.col("site_guid").alias("registered_site"))
    return _with_label(rows.join(cases, "case_id"), codes).select(
        F.col("registered_site").alias("site_guid"), "case_id", "repeat_instrument", "repeat_instance",
        "field_name", "field_value", "field_value_label", *DICT_COLUMNS, "created_on",
    )


def of_study(registrations: DataFrame, study: str, kind: str | None = None) -> DataFrame:
    """Active registrations of one study (and of one kind)."""
    out = registrations.filter((F.col("file_name") == study) & (F.col("active") == 1))
    return out.filter(F.col("kind") == kind) if kind is not None else out


def join_site(rows: DataFrame, sites: DataFrame) -> DataFrame:
    """Inner join to the site table by site code; adds the site's guid, name."""
    s = sites.select("site_id", F.col("id").alias("site_guid"), F.col("name").alias("site_name"))
    return rows.join(s, "site_id")


def join_site_by_prefix(rows: DataFrame, sites: DataFrame, id_col: str = "case_id", length: int = 2) -> DataFrame:
    """Left join where the first characters of an id name the site's code.

    Sites that share a code fan the row out, as the join does.
    """
    s = sites.select(F.col("iso").alias("_iso"), F.col("id").alias("site_guid"))
    return rows.join(s, F.left(F.col(id_col), F.lit(length)) == F.col("_iso"), "left").drop("_iso")


def forms_of(decoded: DataFrame, non_blank_case: bool = False) -> DataFrame:
    """Distinct (case, form) pairs of a report view."""
    rows = decoded.filter(F.col("case_id") != "") if non_blank_case else decoded
    return rows.select("case_id", "form_name").distinct()


def report_links(forms: Sequence[tuple[DataFrame, Column]], report_names: DataFrame) -> DataFrame:
    """Report links per case: each form list with its report-name expression, joined to the names.

    A form whose expression gives NULL has no report.
    """
    parts = [df.select("case_id", name.alias("report_view_name")) for df, name in forms]
    all_forms = parts[0]
    for p in parts[1:]:
        all_forms = all_forms.unionByName(p)
    return all_forms.join(report_names, "report_view_name").select(
        "case_id", F.concat(F.coalesce(F.col("report_uri"), F.lit("")), F.coalesce(F.col("case_id"), F.lit(""))).alias("report_uri"),
        "report_sequence", "package_type",
    )


def named_reports(names: Mapping[str, str]) -> Column:
    return map_names(F.col("form_name"), names)


def prefixed_reports(prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.coalesce(F.col("form_name"), F.lit("")))
