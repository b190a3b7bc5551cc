"""Data-quality assertions: each returns the failing rows, or one row of figures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from formflow.functions import CASE_ID_LENGTH, UPPER4_DIGITS5, has_length, matches_pattern
from formflow.session import materialise

SAMPLE_ROWS = 100  # fixed value: size of a failure sample
MAX_DELETED_PCT = 25  # fixed value: default soft-delete threshold
KEYS_PER_TASK = 1_000_000  # rows whose keys one task of a uniqueness test counts


def min_rows(df: DataFrame, minimum: int = 1) -> DataFrame:
    """Row count against a minimum: (row_count, min_rows, passed)."""
    n = F.count(F.lit(1))
    return df.agg(n.alias("row_count"), F.lit(minimum).cast("bigint").alias("min_rows"), (n >= minimum).cast("int").alias("passed"))


def not_null_failures(df: DataFrame, column: str, condition: str | None = None) -> DataFrame:
    """All rows in which the column is NULL, within an optional row condition."""
    out = df.filter(F.col(column).isNull())
    return out.filter(F.expr(condition)) if condition else out


def not_null_sample(df: DataFrame, column: str, order: Sequence[str], condition: str | None = None, n: int = SAMPLE_ROWS) -> DataFrame:
    """First ``n`` failing rows by ``order`` (a top-n report, so each task keeps n rows)."""
    return not_null_failures(df, column, condition).orderBy(*order).limit(n)


def id_format_failures(df: DataFrame, column: str, pattern: str = UPPER4_DIGITS5) -> DataFrame:
    """Non-NULL ids that are not four upper-case letters and five digits."""
    return df.filter(F.col(column).isNotNull() & ~matches_pattern(pattern)(F.col(column)))


def length_failures(df: DataFrame, column: str, n: int = CASE_ID_LENGTH) -> DataFrame:
    """Distinct ids whose trimmed length differs from ``n``, with their row counts."""
    bad = df.filter(~has_length(n)(F.col(column)))
    return bad.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def keep_valid_length(df: DataFrame, column: str, n: int = CASE_ID_LENGTH) -> DataFrame:
    return df.filter(has_length(n)(F.col(column)))


def future_dates(df: DataFrame, column: str, run_ts: Column) -> DataFrame:
    """Rows dated after the run time."""
    return df.filter(F.col(column) > run_ts)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def top_duplicates(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    return duplicate_keys(df, keys).orderBy(F.desc("row_count"), *keys).limit(n)


def flag_counts(df: DataFrame, flag: str = "is_deleted") -> DataFrame:
    return df.groupBy(flag).agg(F.count(F.lit(1)).alias("row_count"))


def soft_delete_percentage(df: DataFrame, max_pct: float = MAX_DELETED_PCT) -> DataFrame:
    """Deleted rows, all rows, percentage and whether it exceeds the threshold; no row for an empty table."""
    out = df.agg(
        F.coalesce(F.sum(F.when(F.col("is_deleted") == 1, 1).otherwise(0)), F.lit(0)).cast("bigint").alias("deleted_records"),
        F.count(F.lit(1)).alias("total_records"),
    ).filter(F.col("total_records") > 0)
    pct = F.col("deleted_records") * F.lit(100.0) / F.col("total_records")
    return out.withColumns({"deleted_percentage": pct, "failed": (pct > max_pct).cast("int")})


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row count and NULL count per column, one output row per column, one scan."""
    names = list(columns or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("row_count"), *[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return counts.unpivot(["row_count"], names, "column_name", "null_count").select("column_name", "row_count", "null_count")


def overlong_values(df: DataFrame, widths: Mapping[str, int | None]) -> DataFrame:
    """What a projection to the widths would cut: (column_name, width, overlong, longest) per column with a width, one scan."""
    limited = {c: n for c, n in widths.items() if n}
    size = {c: F.length(F.col(c).cast("string")) for c in limited}
    counts = df.agg(*[F.struct(
        F.lit(c).alias("column_name"), F.lit(n).alias("width"), F.count_if(size[c] > n).alias("overlong"),
        F.coalesce(F.max(size[c]), F.lit(0)).alias("longest")).alias(f"c{i}") for i, (c, n) in enumerate(limited.items())])
    return counts.select(F.inline(F.array(*counts.columns)))


def compare(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bag equality of two results in one shuffle: (left_rows, right_rows, only_left, only_right, equal).

    Rows are tagged +1 / -1 and summed per distinct row. Equal NULL counts would
    not prove equal values; this does.
    """
    tagged = left.withColumns({"_l": F.lit(1), "_r": F.lit(0)}).unionByName(
        right.withColumns({"_l": F.lit(0), "_r": F.lit(1)})
    )
    per_row = tagged.groupBy(*left.columns).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    d = F.col("_l") - F.col("_r")
    zero = F.lit(0).cast("bigint")
    return per_row.agg(
        F.coalesce(F.sum("_l"), zero).alias("left_rows"),
        F.coalesce(F.sum("_r"), zero).alias("right_rows"),
        F.coalesce(F.sum(F.greatest(d, zero)), zero).alias("only_left"),
        F.coalesce(F.sum(F.greatest(-d, zero)), zero).alias("only_right"),
    ).withColumn("equal", ((F.col("only_left") == 0) & (F.col("only_right") == 0)).cast("int"))


def compare_profiles(left: DataFrame, right: DataFrame) -> DataFrame:
    """Row and NULL counts of two results side by side, with a verdict per column."""
    l = null_profile(left).withColumnsRenamed({"row_count": "left_rows", "null_count": "left_nulls"})
    r = null_profile(right).withColumnsRenamed({"row_count": "right_rows", "null_count": "right_nulls"})
    same = (F.col("left_rows") == F.col("right_rows")) & (F.col("left_nulls") == F.col("right_nulls"))
    return l.join(r, "column_name").withColumn("passed", same.cast("int"))


def load_counts(loaded: DataFrame, source: DataFrame, table: str) -> DataFrame:
    """Rows offered, loaded and filtered out of one load."""
    src = source.agg(F.count(F.lit(1)).alias("n")).scalar()
    return loaded.agg(F.count(F.lit(1)).alias("loaded_rows")).select(
        F.lit(table).alias("table_name"), src.alias("source_rows"), "loaded_rows",
        (src - F.col("loaded_rows")).alias("filtered_rows"),
        (F.col("loaded_rows") == 0).cast("int").alias("skipped"),
    )


def preflight(source: DataFrame, target: DataFrame, keys: Sequence[str], active: str) -> DataFrame:
    """What a merge would meet: source rows and duplicate keys, target rows and active rows."""
    per_key = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    src = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("source_rows"),
        F.count_if(F.col("n") > 1).alias("source_duplicate_keys"),
    )
    tgt = target.agg(
        F.struct(F.count(F.lit(1)).alias("rows"), F.count_if(F.expr(active)).alias("active")).alias("t")
    ).scalar()
    return src.withColumns({"target_rows": tgt["rows"], "target_active_rows": tgt["active"]})


def ordered_list(df: DataFrame, key: str, value: str, out: str, separator: str = ", ") -> DataFrame:
    """Distinct values per key as one ordered text.

    Duplicates go before the rows are grouped, so a group holds the distinct
    values (names, codes) and not the rows.
    """
    return df.select(key, value).distinct().groupBy(key).agg(
        F.expr(f"listagg({value}, '{separator}') within group (order by {value})").alias(out)
    )


def ordered_runs(df: DataFrame, key: str, value: str, separator: str = ", ") -> DataFrame:
    """(key, _range, _run): distinct values by ranges of (key, value), each range of a key as one ordered text."""
    ranged = df.select(key, value).distinct().repartitionByRange(key, value)
    runs = ranged.groupBy(key, F.spark_partition_id().alias("_range"))
    return runs.agg(F.expr(f"listagg({value}, '{separator}') within group (order by {value})").alias("_run"))


def ordered_list_by_range(df: DataFrame, key: str, value: str, out: str, separator: str = ", ") -> DataFrame:
    """``ordered_list`` for keys with very many distinct values.

    Values are dealt to tasks by ranges of (key, value) with about equal rows, so
    no task sorts more than its range, whatever a key holds. What meets per key
    is one text per range, in range order; the key's whole text is one row of the
    result in any case. NULL values are left out; a key with NULLs only has NULL.
    """
    return ordered_runs(df, key, value, separator).groupBy(key).agg(
        F.expr(f"listagg(_run, '{separator}') within group (order by _range)").alias(out)
    )


def run_checks(checks: Mapping[str, DataFrame]) -> DataFrame:
    """Failure counts of several checks as one table: (check_name, failures, passed)."""
    out = None
    for name, failing in checks.items():
        one = failing.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check_name"), "failures")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no checks given")
    return out.withColumn("passed", (F.col("failures") == 0).cast(T.IntegerType()))


@dataclass(frozen=True)
class Declared:
    """A declared test: rows that meet ``failing`` (SQL) fail it. Over ``warn_after`` and ``error_after`` failures it warns or fails."""

    name: str
    failing: str
    warn_after: int = 0
    error_after: int | None = 0


def declared_tests(df: DataFrame, tests: Sequence[Declared], unique: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """All declared tests of a table: (test, failures, status), status being pass, warn or error.

    The row tests are counted in one scan; each ``unique`` key list costs one
    aggregate, whose failures are the keys that occur more than once. The scan is
    written first: its row count says over how many tasks the keys are dealt, so
    that what one task holds does not follow the table.
    """
    status = lambda n, t: F.when(n > t.error_after, "error").when(n > t.warn_after, "warn").otherwise("pass") if t.error_after is not None else (
        F.when(n > t.warn_after, "warn").otherwise("pass"))
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.expr(t.failing)).alias(f"n{i}") for i, t in enumerate(tests)])
    if unique:
        counts = materialise(counts, "declared-tests")
        tasks = 1 + counts.first()["rows"] // KEYS_PER_TASK
    cells = [F.struct(F.lit(t.name).alias("test"), F.col(f"n{i}").alias("failures"), status(F.col(f"n{i}"), t).alias("status")) for i, t in enumerate(tests)]
    out = counts.select(F.inline(F.array(*cells)))
    for name, keys in (unique or {}).items():
        n = F.count(F.lit(1))
        dealt = df.select(*keys).repartition(tasks, *keys)
        out = out.unionByName(duplicate_keys(dealt, keys).agg(n.alias("failures"), F.when(n > 0, "error").otherwise("pass").alias("status")).withColumn("test", F.lit(name)))
    return out
