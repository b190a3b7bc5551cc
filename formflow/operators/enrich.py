"""Record-level keys on every EAV row, id validation, and exclusion of bad reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window as W, functions as F

from formflow.functions import IdRule, bits, matches_pattern, reshuffled


def record_keys(eav: DataFrame, case_field: str, catchment_prefix: str) -> DataFrame:
    """One row per (record, site) that holds a case id or any catchment field."""
    name, value = F.col("field_name"), F.col("value")
    is_case, is_catchment = name == case_field, name.startswith(catchment_prefix)
    return (
        eav.filter(is_case | is_catchment)
        .groupBy("record", "site_id")
        .agg(
            F.max(F.when(is_case, value)).alias("case_id"),
            F.max(F.when(is_catchment, value)).alias("catchment_id"),
        )
    )


def enrich_keys(eav: DataFrame, case_field: str = "case_id", catchment_prefix: str = "catchment_id") -> DataFrame:
    """Add case id and catchment to every row of the record.

    Records with neither are dropped (inner join); a missing case id or catchment
    becomes ''. The key side has one row per record, so a record with very many
    rows only grows the streamed side, which AQE can split.
    """
    keys = record_keys(eav, case_field, catchment_prefix).fillna("", ["case_id", "catchment_id"])
    return eav.join(reshuffled(keys, "record", "site_id"), ["record", "site_id"])


def count_unkeyed(eav: DataFrame, case_field: str = "case_id", catchment_prefix: str = "catchment_id") -> DataFrame:
    """How many records and rows ``enrich_keys`` drops without a trace."""
    name = F.col("field_name")
    keyed = F.coalesce(F.max((name == case_field) | name.startswith(catchment_prefix)), F.lit(False))
    per_record = eav.groupBy("record", "site_id").agg(keyed.alias("keyed"), F.count(F.lit(1)).alias("n"))
    return per_record.agg(
        F.count_if(~F.col("keyed")).alias("records"),
        F.coalesce(F.sum(F.when(~F.col("keyed"), F.col("n"))), F.lit(0)).cast("bigint").alias("rows"),
    )


def left_lookup(eav: DataFrame, field: str, out: str) -> DataFrame:
    """Left join the non-blank value of one field to all rows of its record.

    A record with several such values gives one row per value, as a join does.
    """
    found = eav.filter((F.col("field_name") == field) & (F.col("value") != "")).select(
        "record", F.col("value").alias(out)
    )
    return eav.drop(out).join(found, "record", "left")


def packet_map(eav: DataFrame, field: str = "case_id", out: str = "case_id") -> DataFrame:
    """Case id of the whole packet: largest value per record, '' when absent, trimmed."""
    found = eav.filter(F.col("field_name") == field).groupBy("record").agg(F.max("value").alias("_found"))
    joined = eav.drop(out).join(reshuffled(found, "record"), "record", "left")
    return joined.withColumn(out, F.trim(F.coalesce(F.col("_found"), F.lit("")))).drop("_found")


def exclude_invalid_reports(
    rows: DataFrame, rule: IdRule = matches_pattern(), scope: Sequence[str] = ("report_id",), id_col: str = "case_id",
    words: int | None = None,
) -> DataFrame:
    """Drop every row of a report that has any invalid id.

    By default a report id counts across sites; ``scope=("site_id", "report_id")``
    keeps sites apart. With ``words``, a bit table of that many words is asked
    first: rows of reports that cannot be bad do not move, the others meet the
    bad reports in the join. For tables in which bad reports are few.
    """
    scope = list(scope)
    bad = rows.filter(~rule(F.col(id_col))).select(*scope).distinct()
    if words is None:
        return rows.join(reshuffled(bad, *scope), scope, "left_anti")
    suspect = bits.possible(rows, bad, scope, words).join(reshuffled(bad, *scope), scope, "left_anti")
    return bits.impossible(rows, bad, scope, words).unionByName(suspect.select(*rows.columns))


def invalid_digest(rows: DataFrame, rule: IdRule = matches_pattern(), id_col: str = "case_id") -> DataFrame:
    """Reports per (site, invalid id)."""
    return (
        rows.filter(~rule(F.col(id_col)))
        .groupBy("site_id", id_col)
        .agg(F.countDistinct("report_id").alias("report_count"))
    )


def missing_key_counts(rows: DataFrame, key: str = "catchment_id") -> DataFrame:
    """Rows per (site, report) whose key column is ''."""
    return rows.filter(F.col(key) == "").groupBy("site_id", "report_id").agg(F.count(F.lit(1)).alias("missing_rows"))


@dataclass(frozen=True)
class CaseLoad:
    """Result of loading case rows: what goes on, and what was set aside."""

    rows: DataFrame
    warnings: DataFrame
    missing_catchment: DataFrame


def load_case_rows(
    eav: DataFrame, case_field: str = "case_id", catchment_prefix: str = "catchment_id",
    rule: IdRule = matches_pattern(), words: int | None = None,
) -> CaseLoad:
    """Enrich, validate and exclude with one pass over the wide side.

    The id belongs to the record, so validity and the digest are worked out on
    the per-record keys; the EAV rows move once, to meet the accepted keys. With
    ``words``, a bit table of that many words keeps the rows of excluded records
    in the scan stage; for exports of which much is excluded.
    """
    keys = record_keys(eav, case_field, catchment_prefix).fillna("", ["case_id", "catchment_id"])
    # The window holds one row per site of a record, never the record's EAV rows.
    checked = keys.withColumn("valid", F.bool_and(rule(F.col("case_id"))).over(W.partitionBy("record")))
    accepted = checked.filter("valid").drop("valid")
    bad = keys.filter(~rule(F.col("case_id")))
    met = eav if words is None else bits.possible(eav, accepted, ["record", "site_id"], words)
    rows = met.join(accepted, ["record", "site_id"]).select(
        "site_id", "catchment_id", F.col("record").alias("report_id"), "case_id", "field_name",
        F.col("value").alias("field_value"),
    )
    # (record, site) is the key of ``keys``: a plain count is the distinct report count.
    warnings = bad.groupBy("site_id", "case_id").agg(F.count(F.lit(1)).alias("report_count"))
    return CaseLoad(rows, warnings, missing_key_counts(rows))
