"""Readers for landed exports, dictionaries, lookups and tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from formflow.functions import clean_header
from formflow.operators.reshape import explode_eav
from formflow.schemas import DICTIONARY_CSV, EAV, REPORT_NAMES, ExportLayout
from formflow.sources import splits

# RFC 4180 quoting: a quote inside a quoted cell is doubled.
_CSV = {"header": True, "escape": '"', "quote": '"', "encoding": "UTF-8"}


def read_eav_json(spark: SparkSession, path: str, layout: ExportLayout = ExportLayout(), array_files: bool = False) -> DataFrame:
    """Landed EAV-mode export, everything as text.

    Files hold one object per line or, with ``array_files``, one JSON array each;
    both are read by as many tasks as they have splits. A broken object fails the read.
    """
    landed = "".join(f", `{src}` string" for src in layout.optional.values())
    schema = f"`{layout.record}` string{landed}, field_name string, value string"
    if array_files:
        parsed = F.from_json("value", schema, {"mode": "FAILFAST"})
        raw = splits.json_array_objects(spark, path).select(parsed.alias("o")).select("o.*")
    else:
        raw = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    renamed = {"record": layout.record, **layout.optional, "field_name": "field_name", "value": "value"}
    return raw.select(*[F.col(f"`{src}`").alias(out) for out, src in renamed.items()])


def read_flat_json(spark: SparkSession, path: str, layout: ExportLayout = ExportLayout(), array_files: bool = False) -> DataFrame:
    """Landed flat-mode export as EAV rows, before multi-select decode: one JSON object per line or,
    with ``array_files``, one JSON array per file.

    A line that is no JSON object fails the read; ``bad_json_lines`` counts such lines beforehand.
    """
    lines = splits.json_array_objects(spark, path).select("value") if array_files else spark.read.text(path)
    return explode_eav(lines, layout)


def bad_json_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row: non-blank lines, and how many of them are no JSON object."""
    line = F.col(column)
    broken = F.from_json(line, "map<string,string>").isNull()
    return lines.filter(F.trim(line) != "").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(broken).alias("broken"))


def record_ids(spark: SparkSession, path: str, layout: ExportLayout = ExportLayout()) -> DataFrame:
    """Record ids only; the schema keeps the parser from building any other column."""
    rows = spark.read.schema(f"`{layout.record}` string").option("mode", "FAILFAST").json(path)
    return rows.select(F.col(f"`{layout.record}`").alias("record")).distinct()


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """EAV part files of one directory; partitions take the place of batches."""
    return spark.read.schema(EAV).parquet(path)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Dictionary CSV (multi-line cells, optional BOM), all text, with ``row_seq`` in file order.

    A file is read by as many tasks as it has splits (``splits.csv_records``);
    files of one directory follow each other by name. Only one row per split
    goes through the windows that number the records.
    """
    header = spark.read.options(**_CSV, multiLine=True).csv(path).columns
    blocks = splits.csv_blocks(spark, path)
    records = splits.csv_records(spark, path, blocks)
    per_file = blocks.groupBy("file").agg(F.greatest(F.sum("records") - 1, F.lit(0)).alias("n"))
    before = F.sum("n").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1))
    offsets = per_file.select("file", F.coalesce(before, F.lit(0)).alias("offset"))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    cells = F.from_csv("value", F.lit(schema.toDDL()), {"quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST"})
    numbered = records.where("row > 1").join(F.broadcast(offsets), "file")  # one row per file
    rows = numbered.select(cells.alias("c"), (F.col("row") - 1 + F.col("offset")).cast("bigint").alias("row_seq")).select("c.*", "row_seq")
    for field in DICTIONARY_CSV.fields:
        if field.name not in header:
            rows = rows.withColumn(field.name, F.lit(None).cast("string"))
    return rows.select(*[c for c in rows.columns if c != "row_seq"], "row_seq")


def read_report_names(spark: SparkSession, path: str) -> DataFrame:
    """Report-name lookup with its declared types; the text NULL is a NULL, an unreadable line an error."""
    return spark.read.options(**_CSV, nullValue="NULL", mode="FAILFAST").schema(REPORT_NAMES).csv(path)


def is_date_like(name: str) -> bool:
    return "date" in name or "dt" in name


def read_csv_coerced(spark: SparkSession, path: str, load_stamp: str = "etl_load_dt") -> DataFrame:
    """CSV with cleaned header names; date-like columns become timestamps, unreadable ones NULL.

    A line with too few or too many cells fails the read.

    The load stamp loses its zone offset and keeps its wall-clock time.
    """
    raw = spark.read.options(**_CSV, multiLine=False, mode="FAILFAST").csv(path)
    df = raw.toDF(*[clean_header(c) for c in raw.columns])
    cols = []
    for c in df.columns:
        text = F.col(f"`{c}`")
        if c == load_stamp:
            text = F.regexp_replace(text, r"(Z|[+-][0-9]{2}:?[0-9]{2})$", "")
        cols.append((F.try_to_timestamp(text) if is_date_like(c) else text).alias(c))
    return df.select(*cols)


def with_site_names(view: DataFrame, sites: DataFrame) -> DataFrame:
    """View rows joined to their site: guid, code, name, then the row's own columns."""
    s = sites.select(F.col("id"), F.col("site_id"), F.col("name"))
    return view.join(s, "site_id").select(
        "id", "site_id", "name", "catchment_id", "report_id", "case_id", "field_name", "field_value"
    )


def union_projects(projects: Mapping[str, DataFrame], default_sites: Mapping[str, str] | None = None) -> DataFrame:
    """Exports of several projects in one frame.

    Columns a project lacks are NULL; a project listed in ``default_sites`` gets
    its site code where it has none.
    """
    out = None
    for name, df in projects.items():
        if "site_id" not in df.columns:
            df = df.withColumn("site_id", F.lit(None).cast("string"))
        default = (default_sites or {}).get(name)
        if default is not None:
            df = df.withColumn("site_id", F.coalesce(F.col("site_id"), F.lit(default)))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no projects given")
    return out


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, bounds: Sequence[int], partitions: int) -> DataFrame:
    """Database table or view, read by ``partitions`` tasks over ranges of a numeric key."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions)
        .load()
    )
