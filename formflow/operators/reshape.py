"""Wide form records to EAV rows and back, plus filters and projections."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from formflow.functions import completion_field, is_blank, reshuffled, row_id
from formflow.schemas import EAV_COLUMNS, ExportLayout
from formflow.session import materialise

MULTI = "___"
#: Up to so many fields a pivot holds each row against every field.
FEW_FIELDS = 16


def _keys(wide: DataFrame, layout: ExportLayout) -> tuple[list[Column], list[str]]:
    """Key columns in their fixed order (absent optional ones as NULL), and the field names."""
    used = {layout.record}
    keys = [F.col(f"`{layout.record}`").cast("string").alias("record")]
    for name, source in layout.optional.items():
        if source in wide.columns:
            used.add(source)
            keys.append(F.col(f"`{source}`").cast("string").alias(name))
        else:
            keys.append(F.lit(None).cast("string").alias(name))
    return keys, [c for c in wide.columns if c not in used]


def unpivot_eav(wide: DataFrame, layout: ExportLayout = ExportLayout()) -> DataFrame:
    """One row per non-blank cell. Blank means NULL or only spaces; values keep their spaces."""
    keys, fields = _keys(wide, layout)
    cells = [F.col(f"`{f}`").cast("string").alias(f) for f in fields]
    tall = wide.select(*keys, *cells).unpivot(list(EAV_COLUMNS[:4]), fields, "field_name", "value")
    return tall.filter(~is_blank(F.col("value")))


def decode_multiselect(eav: DataFrame) -> DataFrame:
    """Turn ``name___CODE`` = '1' into (name, CODE); '0' is dropped, other values are kept."""
    name, value = F.col("field_name"), F.col("value")
    multi = name.contains(MULTI)
    code = F.nullif(F.regexp_extract(name, MULTI + "(.+)$", 1), F.lit(""))
    return (
        eav.filter(~(multi & (value == "0")))
        .withColumn("value", F.when(multi & (value == "1"), code).otherwise(value))
        .withColumn("field_name", F.regexp_replace(name, MULTI + ".*$", ""))
    )


def wide_to_eav(wide: DataFrame, layout: ExportLayout = ExportLayout()) -> DataFrame:
    """Un-pivot and multi-select decode in one pass.

    The column names are known when the plan is built, so the multi-select part
    becomes a CASE per column instead of a regular expression per row. Equal to
    ``decode_multiselect(unpivot_eav(wide))``.
    """
    keys, fields = _keys(wide, layout)
    cells = []
    for f in fields:
        name, found, code = f.partition(MULTI)
        value = F.col(f"`{f}`").cast("string")
        if found:
            value = F.when(value == "1", F.lit(code or None)).when(value != "0", value)
        cells.append(F.struct(F.lit(name).alias("field_name"), value.alias("value")))
    # Two multi-select columns share one output name, which a plain unpivot cannot express.
    tall = wide.select(*keys, F.inline(F.array(*cells)))
    return tall.filter(~is_blank(F.col("value")))


def explode_eav(lines: DataFrame, layout: ExportLayout = ExportLayout(), column: str = "value") -> DataFrame:
    """EAV rows of landed JSON objects, one object per text row, at any width.

    Parsing to a map only emits the keys an object holds and never infers types,
    so leading zeros survive and new form fields need no schema change. Blank lines
    are skipped; any other line that is no JSON object is an error, never lost.
    """
    filled = lines.filter(F.trim(column) != "")
    parsed = filled.select(F.from_json(F.col(column), "map<string,string>", {"mode": "FAILFAST"}).alias("cells"))
    used = [layout.record, *layout.optional.values()]
    keys = [F.col("cells")[layout.record].alias("record")]
    keys += [F.col("cells")[src].alias(name) for name, src in layout.optional.items()]
    tall = parsed.select(*keys, F.explode("cells").alias("field_name", "value"))
    return tall.filter(~F.col("field_name").isin(used) & ~is_blank(F.col("value")))


def promote_field(
    eav: DataFrame, field: str, out: str, order_col: str | None = None, default: str = "",
) -> DataFrame:
    """Move one field's value to a column on every row of its record.

    The field's own rows go; records without it get ``default``. Where a record
    holds the field more than once, the last row by ``order_col`` wins (largest
    value when there is no order).
    """
    value = F.col("value")
    last = F.max_by(value, F.col(order_col)) if order_col else F.max(value)
    promoted = eav.filter(F.col("field_name") == field).groupBy("record").agg(last.alias("_promoted"))
    rest = eav.filter(F.col("field_name") != field).drop(out)
    joined = rest.join(reshuffled(promoted, "record"), "record", "left")
    return joined.withColumn(out, F.coalesce(F.col("_promoted"), F.lit(default))).drop("_promoted")


def pivot_fields(
    eav: DataFrame, keys: Sequence[str], fields: Sequence[str], *,
    name_col: str = "field_name", value_col: str = "field_value", keep_empty: bool = False,
) -> DataFrame:
    """One row per key, one column per field holding its largest value (NULL when absent).

    ``keep_empty`` keeps keys that have none of the fields. Beyond ``FEW_FIELDS``
    the fields are dealt to blocks: values are placed within the block of a key,
    then the blocks within the key. Each row is thus held against two square roots
    of the number of fields instead of every field. The cells move once, by key, and
    are sorted once for both steps; of a text and its field's name one short text is
    made, the value behind the digits of block and place. Blocks are not moved: most
    of their places are empty. All cells of a key meet in one task, whose memory
    holds its sort (which may spill) and one row.
    """
    name, value = F.col(name_col), F.col(value_col)
    rows = eav.select(*keys, name_col, value_col)
    if len(fields) <= FEW_FIELDS:
        if not keep_empty:
            rows = rows.filter(name.isin(list(fields)))
        return rows.groupBy(*keys).pivot(name_col, list(fields)).agg(F.max(value))
    width = math.isqrt(len(fields) - 1) + 1
    digits = len(str(width - 1))
    marks = [(f, f"{i // width:0{digits}}{i % width:0{digits}}") for i, f in enumerate(fields)]
    slots = eav.sparkSession.createDataFrame(marks, "__name string, __mark string")
    placed = rows.join(F.broadcast(slots), name == F.col("__name"), "left" if keep_empty else "inner")
    text = rows.schema[value_col].dataType == T.StringType()
    cell = F.col("__cell")
    cells = placed.select(*keys, (F.concat("__mark", value) if text else F.struct("__mark", value.alias("value"))).alias("__cell"))
    if keys:
        cells = cells.repartition(*keys)
    mark = cell if text else cell["__mark"]
    block, place = (F.substring(mark, 1 + at, digits).cast("int") for at in (0, digits))
    largest = [F.max(F.when(place == p, cell)) for p in range(width)]  # of cells with the same mark
    contents = [F.substring(c, 1 + 2 * digits, 2**31 - 1) if text else c["value"] for c in largest]
    blocks = cells.withColumn("__block", block).groupBy(*keys, "__block").agg(*[c.alias(f"__{p}") for p, c in enumerate(contents)])
    parts = F.struct(*[f"__{p}" for p in range(width)])
    wide = blocks.groupBy(*keys).agg(*[F.any_value(F.when(F.col("__block") == b, parts), F.lit(True)).alias(f"__b{b}") for b in range(-(-len(fields) // width))])
    return wide.select(*keys, *[F.col(f"__b{i // width}")[f"__{i % width}"].alias(f) for i, f in enumerate(fields)])


def field_names(eav: DataFrame, name_col: str = "field_name") -> list[str]:
    """Sorted distinct field names. The list becomes columns, so it is bounded by the pivot limit."""
    limit = int(eav.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    names = eav.select(name_col).filter(F.col(name_col).isNotNull()).distinct().limit(limit + 1).collect()
    if len(names) > limit:
        raise ValueError(f"more than {limit} field names; raise spark.sql.pivotMaxValues or name the fields")
    return sorted(r[0] for r in names)


def pivot_dynamic(
    eav: DataFrame, keys: Sequence[str], *, name_col: str = "field_name", value_col: str = "field_value",
) -> DataFrame:
    """Pivot over every field name in the data, columns in name order; the rows are written first, because the names are read from them too."""
    eav = materialise(eav.select(*keys, name_col, value_col), "pivot-rows")
    names = field_names(eav, name_col)
    return pivot_fields(eav, keys, names, name_col=name_col, value_col=value_col, keep_empty=True)


def non_identifying(dictionary: DataFrame) -> DataFrame:
    """Dictionary rows whose identifier mark is blank."""
    return dictionary.filter(is_blank(F.col("identifier")))


def pivot_deidentified(eav: DataFrame, dictionary: DataFrame, keys: Sequence[str], value_col: str = "value") -> DataFrame:
    """Pivot only the fields the dictionary does not mark as identifying."""
    allowed = non_identifying(dictionary).select("field_name")
    return pivot_dynamic(eav.join(allowed, "field_name", "left_semi"), keys, value_col=value_col)


def to_layout(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Rename and reorder: ``{output name: input name}``."""
    return df.select(*[F.col(src).alias(out) for out, src in columns.items()])


def to_width(c: str, width: int | None, overlong: str = "cut") -> Column:
    """Text of at most ``width`` characters. A longer one is cut or, with ``overlong="fail"``, fails the job.

    The cut is explicit because Spark's ``cast as varchar(n)`` keeps the whole text. ``quality.overlong_values`` counts what
    it would take away.
    """
    if overlong not in ("cut", "fail"):
        raise ValueError(f"overlong must be 'cut' or 'fail', not {overlong!r}")
    if not width:
        return F.col(c)
    cut = F.substring(F.col(c), 1, width)
    if overlong == "cut":
        return cut
    message = F.concat(F.lit(f"{c} is longer than {width} characters: "), F.col(c))
    return F.when(F.length(c) > width, F.raise_error(message).cast("string")).otherwise(F.col(c))


def typed_projection(df: DataFrame, widths: Mapping[str, int | None], run_ts: Column, deleted: int = 0, overlong: str = "cut") -> DataFrame:
    """Mart projection: text of the declared widths (``to_width``), plus the audit columns."""
    cols = [to_width(c, n, overlong).cast("string").alias(c) for c, n in widths.items()]
    return df.select(*cols, run_ts.alias("last_updated"), F.lit(deleted).cast("int").alias("is_deleted"))


def with_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def with_audit(df: DataFrame, id_cols: Sequence[str], run_ts: Column, columns: Sequence[str] = ("created_on", "modified_on", "uploaded_on")) -> DataFrame:
    """Deterministic id plus the run time in the audit columns; both are inputs, never drawn anew."""
    return df.withColumns({"id": row_id(*id_cols), **{c: run_ts for c in columns}})


def live_rows(df: DataFrame, non_blank: Sequence[str] = ()) -> DataFrame:
    """Rows not marked deleted whose key columns are not ''."""
    out = df.filter(F.col("is_deleted") == 0)
    for c in non_blank:
        out = out.filter(F.col(c) != "")
    return out


def of_fields(df: DataFrame, names: Sequence[str] = (), prefixes: Sequence[str] = (), name_col: str = "field_name") -> DataFrame:
    """Rows of the named fields or of fields that start with a prefix ('_' is a plain character)."""
    name = F.col(name_col)
    keep = name.isin(list(names)) if names else F.lit(False)
    for p in prefixes:
        keep = keep | name.startswith(p)
    return df.filter(keep)


def complete_only(df: DataFrame, required: Mapping[str, str]) -> DataFrame:
    """Pivoted rows in which every named column holds the given code."""
    for c, code in required.items():
        df = df.filter(F.col(c) == code)
    return df


def suppress_answers(df: DataFrame, rules: Mapping[str, str], value_col: str = "field_value") -> DataFrame:
    """Drop one answer per form: ``{form: answer}``.

    On a form with a rule a NULL answer is dropped too, as ``<>`` does in SQL;
    rows without a form are dropped.
    """
    form, value = F.col("form_name"), F.col(value_col)
    keep = ~form.isin(list(rules))
    for f, answer in rules.items():
        keep = keep | ((form == f) & (value != answer))
    return df.filter(keep)


def drop_completion_field(df: DataFrame) -> DataFrame:
    return df.filter(F.col("field_name") != completion_field(F.col("form_name")))


def map_names(c: Column, names: Mapping[str, str]) -> Column:
    """CASE over fixed names without ELSE: unknown names give NULL."""
    out = F.lit(None).cast(T.StringType())
    for key, value in reversed(names.items()):
        out = F.when(c == key, F.lit(value)).otherwise(out)
    return out
