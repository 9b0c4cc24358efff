"""Spark session settings and the shared working folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def build_session(
    app_name: str = "fieldweave",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the library is written for.

    No shuffle partition count is set here: on a cluster it belongs to the
    cluster's configuration and AQE coalesces what is too small.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for written tables and checkpoints that every executor sees.

    Taken from ``spark.checkpoint.dir``. A temporary folder stands in for it
    only in local mode, where driver and executors share one disk.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="fieldweave-")
    return _local_dirs[app]


def new_work_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/fieldweave/{name}-{uuid.uuid4().hex}"


def settle(rows: DataFrame, name: str) -> DataFrame:
    """Rows written to the shared folder and read back, so that what is built on
    them more than once does not compute them again and sees the same rows."""
    return settle_at(rows, new_work_dir(rows.sparkSession, name))


def settle_at(rows: DataFrame, path: str) -> DataFrame:
    """Rows written to a path and read back; the caller can ``remove`` it once
    nothing that is still to be computed reads it."""
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@contextlib.contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, Spark deletes the shuffle files of a query when it ends, not at some time after the driver has collected its
    plan. For steps that are each written and read back: a plan that is run again would have to shuffle again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in any file system that Spark reads."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
