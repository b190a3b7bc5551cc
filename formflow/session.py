"""Session defaults and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_BASE: dict[str, str] = {}
#: The innermost scope's folders, and the scope around it.
_SCOPE: ContextVar[tuple | None] = ContextVar("intermediates", default=None)


def build_session(app: str = "formflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on.

    AQE does the run-time part of the skew story: it splits hot partitions of
    sort-merge joins, coalesces small shuffle partitions and switches to a
    broadcast join when a side turns out small enough.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables, reachable by every executor.

    The base is the folder the cluster names in ``spark.checkpoint.dir``. Only a
    local session may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_BASE:
            _LOCAL_BASE[app] = tempfile.mkdtemp(prefix="formflow-")
            atexit.register(shutil.rmtree, _LOCAL_BASE[app], ignore_errors=True)
        base = "file://" + _LOCAL_BASE[app]
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialise`` writes inside are deleted at the end, also after a failure.

    What is used afterwards must be written by then: an output, a published version, or a table materialised with
    ``keep=True``, which belongs to the scope around this one.
    """
    outer, own = _SCOPE.get(), []
    token = _SCOPE.set((own, outer))
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in own:
            _delete(spark, path)


@contextmanager
def arrow_batches(spark: SparkSession, size: int = 2 << 20) -> Iterator[None]:
    """Python functions of jobs that run inside get batches of about ``size`` bytes, one row at least.

    Spark's own limit is 64 MB. A batch lies in the executor's and in the worker's memory at once, for each running task.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _delete(spark: SparkSession, path: str) -> None:
    """Through Hadoop's file system, so that any shared store will do."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialise(df: DataFrame, purpose: str, keep: bool = False) -> DataFrame:
    """Write ``df`` once and read it back, for sources that are used several times.

    The written table survives the loss of executors and cuts the lineage. Inside ``intermediates`` it is deleted at the
    end, unless it is to be kept.
    """
    spark = df.sparkSession
    path, scope = work_dir(spark, purpose), _SCOPE.get()
    if keep and scope is not None:
        scope = scope[1]
    if scope is not None:
        scope[0].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
