"""Part files with a zone map, so that a batch of records opens only the files that can hold it.

The parts are written in record order. The map is a small table beside them: for each file the least and the greatest record id
and the number of rows. A reader of a range of record ids looks the files up in it; no other file is opened, not even for its
footer, which with thousands of parts is most of the cost of a small batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

ROWS_PER_FILE = 1_000_000  # about what one task sorts and writes


def write_zoned_parts(df: DataFrame, path: str, record_col: str = "record", files: int | None = None, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Write ``df`` in record order below ``path`` and return its zone map (file, low, high, rows).

    ``files`` is the least number of ranges; there are more where one would hold over ``rows_per_file`` rows, because a
    range is sorted by one task. Rows without a record id go to the first files; their zone has NULL bounds only if a file
    holds nothing else. A record with very many rows may fill several files.
    """
    number = max(files or 1, -(-df.count() // rows_per_file))
    # The hash spreads the rows of one record over neighbouring ranges.
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    ordered = df.withColumn("_spread", spread).repartitionByRange(number, record_col, "_spread").sortWithinPartitions(record_col).drop("_spread")
    ordered.write.mode("overwrite").parquet(f"{path}/parts")
    record = F.col(record_col)
    rows = df.sparkSession.read.schema(df.select(record_col).schema).parquet(f"{path}/parts").select(
        record, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    # A file is in record order, so its bounds are its first row with an id and its last row: counting needs no sort.
    sizes = rows.groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.min(F.when(record.isNotNull(), F.col("at"))).alias("first"), F.max("at").alias("last"))
    ends = rows.join(F.broadcast(sizes), "file").where((F.col("at") == F.col("first")) | (F.col("at") == F.col("last")))  # one row per file
    zones = ends.groupBy("file").agg(F.min(record).alias("low"), F.max(record).alias("high"), F.first("rows").alias("rows"))
    zones.coalesce(1).write.mode("overwrite").parquet(f"{path}/zones")
    return read_zones(df.sparkSession, path)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/zones")


def read_records(spark: SparkSession, path: str, low: str, high: str, record_col: str = "record") -> DataFrame:
    """Rows of the records from ``low`` to ``high``, both included, from the files whose zone meets that range."""
    found = read_zones(spark, path).where((F.col("high") >= low) & (F.col("low") <= high)).select("file").collect()
    inside = F.col(record_col).between(low, high)
    if not found:
        return spark.read.parquet(f"{path}/parts").where(F.lit(False))
    return spark.read.parquet(*sorted(r.file for r in found)).where(inside)


def batches(zones: DataFrame, rows: int) -> list[tuple[str, str]]:
    """Ranges of record ids (low, high) that cover all records, of about ``rows`` rows each: neighbouring zones put together.

    Ranges overlap in no record: a record that fills several files is in one range. The map has one row per file.
    """
    out: list[tuple[str, str]] = []
    low = high = None
    held = 0
    for z in zones.where("low is not null").orderBy("low", "high").collect():
        if low is not None and held >= rows and z.low > high:
            out.append((low, high))
            low, high, held = None, None, 0
        low, high, held = z.low if low is None else low, z.high if high is None else max(high, z.high), held + z.rows
    return out + ([(low, high)] if low is not None else [])
