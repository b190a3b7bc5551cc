"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Id rules and field types that must match the existing data.
LETTERS4_DIGITS5 = r"^[A-Za-z]{4}[0-9]{5}\z"
UPPER4_DIGITS5 = r"^[A-Z]{4}[0-9]{5}\z"
CASE_ID_LENGTH = 9
CHOICE_TYPES = ("radio", "checkbox", "dropdown")

_SEP = "\u0001"

IdRule = Callable[[Column], Column]


def matches_pattern(pattern: str = LETTERS4_DIGITS5) -> IdRule:
    """Rule: the id matches ``pattern`` in full (NULL is invalid).

    Patterns end in ``\\z``; a ``$`` would also accept a trailing newline.
    """
    return lambda c: F.coalesce(c.rlike(pattern), F.lit(False))


def has_length(n: int = CASE_ID_LENGTH) -> IdRule:
    """Rule: the trimmed id has exactly ``n`` characters (NULL is invalid)."""
    return lambda c: F.coalesce(F.length(F.trim(c)) == n, F.lit(False))


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def null_safe_key(*cols: str | Column, blank_is_null: Sequence[str] = ()) -> Column:
    """One struct column that compares equal also where its fields are NULL.

    Grouping and joining by the struct gives the ``<=>`` meaning and lets an
    aggregate and the join after it share one shuffle. Columns named in
    ``blank_is_null`` treat '' and NULL as the same value.
    """
    fields = []
    for i, c in enumerate(cols):
        col = F.col(c) if isinstance(c, str) else c
        if isinstance(c, str) and c in blank_is_null:
            col = F.nullif(col, F.lit(""))
        fields.append(col.alias(f"k{i}"))
    return F.struct(*fields)


def row_id(*cols: str | Column) -> Column:
    """Deterministic row id; survives recomputation, unlike a random UUID."""
    parts = [F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("\u0000")) for c in cols]
    return F.sha2(F.concat_ws(_SEP, *parts), 256)


def content_hash(*cols: str | Column) -> Column:
    """Case-insensitive change hash; the separator keeps ('ab','c') from ('a','bc')."""
    parts = [F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in cols]
    return F.md5(F.upper(F.concat_ws(_SEP, *parts)))


def content_hash_utf16(*cols: str | Column) -> Column:
    """Hash equal to the one stored by the existing database: no separator, UTF-16LE, upper hex."""
    parts = [F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in cols]
    return F.upper(F.md5(F.encode(F.upper(F.concat(*parts)), "UTF-16LE")))


def to_day(c: str | Column) -> Column:
    """Leading yyyy-MM-dd of a text or timestamp as a date; NULL when unreadable."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_date(F.substring(col.cast("string"), 1, 10), "yyyy-MM-dd")


def label_of(field_type: Column, label: Column, value: Column) -> Column:
    """Choice answers show the code list's label, everything else the value itself."""
    return F.when(field_type.isin(*CHOICE_TYPES), F.coalesce(label, value)).otherwise(value)


def completion_field(form: Column) -> Column:
    """Name of a form's own completion flag; a NULL form gives '_complete'."""
    return F.concat(F.coalesce(form, F.lit("")), F.lit("_complete"))


def clean_header(name: str) -> str:
    """Column name of a landed CSV in lower snake case."""
    return name.strip().replace(" ", "_").replace("-", "_").lower()


def select_text(df: DataFrame) -> DataFrame:
    """All columns as text. NULL stays NULL (never 'None' or 'nan')."""
    return df.select(*[_as_text(f).alias(f.name) for f in df.schema.fields])


def _as_text(field) -> Column:
    kind = field.dataType.typeName()
    c = F.col(f"`{field.name}`")
    if kind == "date":
        return F.date_format(c, "yyyy-MM-dd")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    if kind in ("double", "float"):
        # A plain decimal number: Spark's own cast would print 1.23456785E7.
        return F.rtrim(F.rtrim(F.format_string("%.6f", c), F.lit("0")), F.lit("."))
    return c.cast("string")


def reshuffled(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` (one row per key, from an aggregate) made to shuffle again for the join that follows.

    An aggregate's own partitioning would serve the join, but AQE splits a hot
    key only where both sides of a join come straight from shuffles made for it.
    The keys keep their values; the largest of a value and itself only hides the
    partitioning. What moves again is one row per key.
    """
    return df.withColumns({k: F.greatest(F.col(k), F.col(k)) for k in keys})
