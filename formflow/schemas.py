"""Column layouts of the data model: EAV rows, staging, marts, dictionaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


@dataclass(frozen=True)
class ExportLayout:
    """Names the landed export uses for its key columns.

    The form server's own names differ per product, so they are parameters. Only
    ``record`` must exist; the other columns are optional in the input and always
    present (nullable) in the EAV output.
    """

    record: str = "record"
    site: str = "site_id"
    repeat_instrument: str = "repeat_instrument"
    repeat_instance: str = "repeat_instance"

    @property
    def optional(self) -> dict[str, str]:
        return {
            "site_id": self.site,
            "repeat_instrument": self.repeat_instrument,
            "repeat_instance": self.repeat_instance,
        }


EAV_COLUMNS = ("record", "site_id", "repeat_instrument", "repeat_instance", "field_name", "value")
EAV = _text(*EAV_COLUMNS)

STAGING_COLUMNS = ("site_id", "catchment_id", "report_id", "case_id", "field_name", "field_value")

# Business keys (one row per key) of the tables kept by snapshot or merge.
REPORT_KEY = ("site_id", "catchment_id", "report_id")
REPEAT_ROW_KEY = ("case_id", "repeat_instrument", "repeat_instance", "field_name", "field_value")
ABSTRACTION_ROW_KEY = ("site_id", "case_id", "field_name", "field_value")

DICTIONARY_CSV = _text(
    "Variable / Field Name", "Form Name", "Section Header", "Field Type", "Field Label",
    "Identifier?", "Active", "form_sequence_id",
)

REPORT_NAMES = T.StructType([
    T.StructField("report_view_name", T.StringType()),
    T.StructField("report_view_id", T.StringType()),
    T.StructField("report_sequence", T.ByteType()),
    T.StructField("report_uri", T.StringType()),
    T.StructField("report_uri_header", T.StringType()),
    T.StructField("package_type", T.StringType()),
])

WARNINGS = T.StructType([
    T.StructField("site_id", T.StringType()),
    T.StructField("case_id", T.StringType()),
    T.StructField("report_count", T.LongType()),
])
DIGEST_STATE = T.StructType([
    T.StructField("last_notified", T.StringType()),
    T.StructField("warnings", T.ArrayType(WARNINGS)),
])
