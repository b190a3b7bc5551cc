"""A snapshot mart kept in key buckets, of which a run rewrites only those that changed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from formflow.functions import null_safe_key
from formflow.operators import fingerprints, upsert


@dataclass(frozen=True)
class BucketedMart:
    """The mart of ``upsert.snapshot_merge``, stored by bucket.

    keys     business key of a row; its bucket is ``pmod(hash, buckets)`` or, if given, the SQL expression ``bucket_of``
             over source columns, such as a range of record numbers: what is entered together then changes together
    columns  what makes a known row new: by default the key and ``id_col``. Others keep their first value, as in the merge

    Every version has a manifest with one row per bucket: where its files are, the fingerprint of its live rows and counts.
    A run adds up the source's fingerprints in one pass, in which nothing else is shuffled, and merges the buckets that differ.
    All live rows carry the stamp of the last run, so it is kept once in the manifest and not in the files. A version becomes
    current when its manifest is complete; a failed run leaves the current one as it is. One writer at a time.
    """

    root: str
    keys: Sequence[str]
    buckets: int = 256
    bucket_of: str | None = None
    blank_is_null: Sequence[str] = ()
    id_col: str = "id"

    def _key(self) -> Column:
        return null_safe_key(*self.keys, blank_is_null=self.blank_is_null)

    def bucket(self) -> Column:
        spread = F.expr(self.bucket_of) if self.bucket_of else F.xxhash64(self._key())
        return F.coalesce(F.pmod(spread.cast("bigint"), F.lit(self.buckets)), F.lit(0)).cast("int")

    def _fingerprints(self, rows: DataFrame) -> DataFrame:
        keyed = rows.select(self._key().alias("_key"), F.col(self.id_col).alias("_id"), self.bucket().alias("bucket"))
        return fingerprints.fingerprints(keyed.select(F.to_json("_key").alias("_key"), "_id", "bucket"), ["_key", "_id"], F.col("bucket"))

    def manifest(self, spark: SparkSession) -> DataFrame | None:
        """(bucket, path, n, s0, s1, deleted, run_ts) of the current version; None before the first load."""
        try:
            logged = spark.read.parquet(f"{self.root}/manifest")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None
        last = logged.agg(F.max("version").alias("version")).first()["version"]
        return logged.where(F.col("version") == last)

    def _read(self, spark: SparkSession, manifest: DataFrame, buckets: list[int] | None = None) -> DataFrame | None:
        entries = manifest.select("bucket", "path", "run_ts").collect()  # at most ``buckets`` rows
        paths = sorted({f"{e.path}/bucket={e.bucket}" for e in entries if e.path and (buckets is None or e.bucket in set(buckets))})
        if not paths:
            return None
        stamp = F.when(F.col("is_deleted") == 0, F.lit(entries[0].run_ts)).otherwise(F.col("last_updated"))
        rows = spark.read.option("basePath", f"{self.root}/data").parquet(*paths)
        return rows.withColumn("last_updated", stamp).drop("version", "bucket", "_action")

    def read(self, spark: SparkSession) -> DataFrame | None:
        """The current version; None before the first load."""
        manifest = self.manifest(spark)
        return None if manifest is None else self._read(spark, manifest)

    def refresh(self, source: DataFrame, run_ts: str) -> dict[str, int]:
        """Merge the source (written table or cheap to read twice). Returns buckets rewritten and rows inserted, deleted, live."""
        spark, old = source.sparkSession, self.manifest(source.sparkSession)
        new = {r.bucket: r for r in self._fingerprints(source).collect()}  # at most ``buckets`` rows
        known = {} if old is None else {r.bucket: r for r in old.collect()}
        same = lambda a, b: (a.n, a.s0, a.s1) == (b.n, b.s0, b.s1) if a and b else (b.n == 0 if b else False)
        changed = sorted(b for b in {*new, *known} if not same(new.get(b), known.get(b)))
        version = 1 if old is None else old.first()["version"] + 1
        path = f"{self.root}/data/version={version:08d}"
        counts = {}
        if changed:
            part = source.where(self.bucket().isin(changed))
            target = None if old is None else self._read(spark, old, changed)
            if target is None:
                done = upsert.snapshot_initial(part, F.lit(run_ts)).withColumn("_action", F.lit(upsert.INSERT))
            else:
                done = upsert.snapshot_merge(target, part, self.keys, F.lit(run_ts), self.blank_is_null, self.id_col)
            # Large buckets are split over several tasks and files, small ones share a task.
            done.withColumn("bucket", self.bucket()).hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket", "_action").parquet(path)
            written = spark.read.schema("bucket int, _action string, is_deleted int").parquet(path)
            counts = {r.bucket: r for r in written.groupBy("bucket").agg(
                F.count_if(F.col("_action") == upsert.INSERT).alias("inserted"), F.count_if(F.col("_action") == upsert.DELETE).alias("deleted"),
                F.count_if(F.col("is_deleted") == 1).alias("gone")).collect()}
        rows = []
        for b in sorted({*new, *known}):
            moved, live = b in set(changed), new.get(b)
            rows.append((version, b, (path if b in counts else None) if moved else known[b].path, live.n if live else 0, live.s0 if live else None, live.s1 if live else None,
                         (counts[b].gone if b in counts else 0) if moved else known[b].deleted, run_ts))
        schema = "version int, bucket int, path string, n bigint, s0 decimal(30,0), s1 decimal(30,0), deleted bigint, run_ts string"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")
        total = lambda c: sum(getattr(r, c) for r in counts.values())
        return {"version": version, "rewritten": len(changed), "inserted": total("inserted"), "deleted": total("deleted"), "live": sum(r.n for r in new.values())}
