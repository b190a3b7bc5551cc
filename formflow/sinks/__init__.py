"""Writers: exports, staging tables, record-preserving chunks, versioned snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

# Everything quoted and NULL spelled out, so that NULL, '' and blanks survive the round trip.
_CSV = {
    "header": True, "escape": '"', "quote": '"', "quoteAll": True, "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def export(df: DataFrame, path: str) -> dict[str, str]:
    """CSV and parquet copies below ``path``; '' and NULL stay distinct in both."""
    paths = {"csv": f"{path}/csv", "parquet": f"{path}/parquet"}
    df.write.mode("overwrite").options(**_CSV).csv(paths["csv"])
    df.write.mode("overwrite").parquet(paths["parquet"])
    return paths


def read_export_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.options(**_CSV, multiLine=True).schema(schema).csv(path)


def overwrite_staging(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Truncate-and-load: replace the staging table and return it as read back; compressed by zstd, which halves hash ids."""
    df.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def overwrite_staging_counted(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """``overwrite_staging`` and the number of rows, observed while they are written."""
    counts = Observation()
    staged = overwrite_staging(df.observe(counts, F.count(F.lit(1)).alias("rows")), path, partition_by)
    return staged, counts.get["rows"]


def overwrite_staging_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 1000) -> None:
    """The same into a database table, kept in place (truncate) and filled in batches."""
    df.write.format("jdbc").mode("overwrite").options(url=url, dbtable=table, truncate=True, batchsize=batch_size).save()


def assign_chunks(df: DataFrame, chunks: int, record_col: str = "record") -> DataFrame:
    """Add ``chunk_id``: all rows of a record get the same chunk."""
    return df.withColumn("chunk_id", F.pmod(F.xxhash64(record_col), F.lit(chunks)).cast("int"))


def write_chunks(df: DataFrame, path: str, chunks: int, record_col: str = "record", max_rows_per_file: int = 5_000_000, salts: int = 16) -> DataFrame:
    """One directory per chunk, no record split over two chunks.

    The chunk is a directory, not a task: rows of a chunk are salted over several
    writers, so one very large record does not end up in one task.
    """
    chunked = assign_chunks(df, chunks, record_col)
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts))
    (
        chunked.repartition(F.col("chunk_id"), salt)
        .write.mode("overwrite").option("maxRecordsPerFile", max_rows_per_file).partitionBy("chunk_id").parquet(path)
    )
    return df.sparkSession.read.schema(chunked.schema).parquet(path)


@dataclass(frozen=True)
class Snapshot:
    """A table kept as immutable versions below ``root``.

    A version is written to its own directory and becomes current by one row
    appended to ``versions``; readers of the old version are not disturbed and a
    failed write leaves no trace in the log. One writer at a time.
    """

    root: str

    def _log(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("version bigint, path string, published_at string").json(f"{self.root}/versions")

    def version(self, spark: SparkSession) -> int:
        try:
            return self._log(spark).agg(F.max("version")).first()[0] or 0
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0

    def current(self, spark: SparkSession) -> DataFrame | None:
        """The current version, without ``_action``; None before the first load."""
        df = self.changes(spark)
        return None if df is None else df.drop("_action")

    def changes(self, spark: SparkSession) -> DataFrame | None:
        """The current version with the ``_action`` column of the step that wrote it."""
        v = self.version(spark)
        return self.at(spark, v) if v else None

    def at(self, spark: SparkSession, version: int) -> DataFrame:
        return spark.read.parquet(self._path(version))

    def publish(self, df: DataFrame, published_at: datetime) -> int:
        spark = df.sparkSession
        v = self.version(spark) + 1
        # A failed run may have left files of the same number behind.
        df.write.mode("overwrite").parquet(self._path(v))
        row = spark.range(1).select(
            F.lit(v).cast("bigint").alias("version"), F.lit(self._path(v)).alias("path"),
            F.lit(published_at.isoformat()).alias("published_at"),
        )
        row.write.mode("append").json(f"{self.root}/versions")
        return v

    def publish_counted(self, df: DataFrame, published_at: datetime, actions: Sequence[str]) -> dict[str, int]:
        """Publish, and return the rows per ``_action`` as they were written: nothing is read back.

        The counts are observed on the last step of the plan, in the tasks that write. Spark takes such a task's counts
        once per partition, so a retried or repeated task adds nothing.
        """
        counts = Observation()
        each = [F.count_if(F.col("_action") == a).alias(a) for a in actions]
        self.publish(df.observe(counts, *each), published_at)
        return {a: n for a, n in counts.get.items() if n}

    def _path(self, v: int) -> str:
        return f"{self.root}/data/version={v:08d}"
