"""Data dictionary curation: sequence, form order, section headers, types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from formflow.operators import ordered
from formflow.operators.reshape import to_width

# Width of the stored section header and the CSV's column names.
HEADER_WIDTH = 200
CSV_COLUMNS = {
    "Variable / Field Name": "field_name",
    "Form Name": "form_name",
    "Section Header": "section_header",
    "Field Type": "field_type",
    "Field Label": "field_label",
    "Active": "active",
    "form_sequence_id": "form_sequence_id",
}


def build(main: DataFrame, append: DataFrame, file_name: str, created_on: Column, report_type: Column | None = None, overlong: str = "cut") -> DataFrame:
    """Typed dictionary table of a main CSV followed by an append CSV.

    Both inputs come from ``sources.read_dictionary`` and carry ``row_seq``. The
    main file's headers are cut to the stored width (or fail, see ``to_width``); blank or absent numbers
    become 0; the sequence runs on through the append file.
    """
    main = main.withColumn("Section Header", to_width("Section Header", HEADER_WIDTH, overlong))
    parts = [(main, 0), (append, 1)]
    rows = None
    for df, part in parts:
        df = df.withColumn("_part", F.lit(part))
        rows = df if rows is None else rows.unionByName(df, allowMissingColumns=True)
    main_rows = main.select("row_seq").agg(F.coalesce(F.max("row_seq"), F.lit(0))).scalar()
    seq = F.when(F.col("_part") == 0, F.col("row_seq")).otherwise(F.col("row_seq") + main_rows)
    for c in CSV_COLUMNS:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    text = {out: F.coalesce(F.col(f"`{src}`"), F.lit("")) for src, out in CSV_COLUMNS.items()}
    number = {c: F.coalesce(F.nullif(text[c], F.lit("")), F.lit("0")).cast("int") for c in ("active", "form_sequence_id")}
    return rows.select(
        seq.cast("bigint").alias("sequence_id"),
        *[text[c].alias(c) for c in ("form_name", "field_name", "section_header", "field_label", "field_type")],
        F.lit(file_name.rsplit("/", 1)[-1]).alias("file_name"),
        created_on.alias("created_on"),
        number["active"].alias("active"),
        number["form_sequence_id"].alias("form_sequence_id"),
        (report_type if report_type is not None else F.lit(None).cast("string")).alias("report_type"),
    )


def form_sequence(fields: DataFrame, seq_col: str = "seq") -> DataFrame:
    """Forms numbered by their first appearance."""
    first = fields.groupBy("form_name").agg(F.min(seq_col).alias("first_seq"))
    return ordered.row_number(first, "first_seq", "form_sequence_id").select("form_name", "form_sequence_id")


def section_group(fields: DataFrame, seq_col: str = "seq") -> DataFrame:
    """Running number of the section a field belongs to; 0 before the first header."""
    has_header = F.coalesce(F.col("section_header") != "", F.lit(False))
    return ordered.running_count(fields, seq_col, has_header, "section_group")


def fill_sections(fields: DataFrame, seq_col: str = "seq") -> DataFrame:
    """Sparse section headers carried down to the rows below them, '' before the first.

    Sections run on across forms, in file order.
    """
    header = F.nullif(F.col("section_header"), F.lit(""))
    filled = ordered.fill_down(fields, seq_col, header, "_header")
    return filled.withColumn("section_header", F.coalesce(F.col("_header"), F.col("section_header"))).drop("_header")


def clean_headers(fields: DataFrame, prefixes: Mapping[str, str]) -> DataFrame:
    """Replace headers that start with a known marked-up prefix by a plain title; first rule wins."""
    header = F.col("section_header")
    clean = header
    for prefix, title in reversed(prefixes.items()):
        clean = F.when(header.startswith(prefix), F.lit(title)).otherwise(clean)
    return fields.withColumn("section_header", clean)


def curate(fields: DataFrame, prefixes: Mapping[str, str], seq_col: str = "seq") -> DataFrame:
    """Form order, filled and cleaned section headers in one result, in file order."""
    filled = clean_headers(fill_sections(fields.drop("form_sequence_id"), seq_col), prefixes)
    return filled.join(form_sequence(fields, seq_col), "form_name")


def report_type(forms: Mapping[str, Sequence[str]]) -> Column:
    """Report type by form list: ``{type: forms}``; unlisted forms give NULL."""
    out = F.lit(None).cast("string")
    for kind, names in reversed(forms.items()):
        out = F.when(F.col("form_name").isin(list(names)), F.lit(kind)).otherwise(out)
    return out
