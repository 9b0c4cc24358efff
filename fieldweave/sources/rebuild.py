"""Documents that are served from a folder and rebuilt into another: full build, catch-up from the change log, one swap."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldweave.catalog import FieldCatalog
from fieldweave.operators.changes import apply_changes
from fieldweave.sources.versions import current, publish


def read_served(spark: SparkSession, path: str) -> DataFrame:
    """The documents in force."""
    state = current(spark, path)
    if state is None:
        raise ValueError(f"nothing is served at {path}")
    return spark.read.parquet(f"{path}/{state['folder']}")


def served_until(spark: SparkSession, path: str) -> dt.datetime:
    """Time of the last event that the documents in force hold."""
    return dt.datetime.fromisoformat(current(spark, path)["until"])


def _until(changes: DataFrame, since: dt.datetime) -> dt.datetime:
    """Time of the newest event; events are taken up to it, so that those that come while this runs are left to the next run."""
    return max(since, changes.agg(F.max("event_time")).first()[0] or since)


def _moment(time: dt.datetime) -> Column:
    return F.lit(time.isoformat(sep=" ")).cast("timestamp_ntz")


def rebuild(
    documents: DataFrame,
    path: str,
    name: str,
    as_of: dt.datetime,
    changes: DataFrame,
    catalog: FieldCatalog | None = None,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> dt.datetime:
    """Serve newly built documents. They hold the contacts as of a time; events after it are applied to them before
    they are put in force, and the time of the last one is given back. Until then readers see the documents before,
    and a run that fails leaves them in force; it can be run again under its name."""
    spark = documents.sparkSession
    built = f"{path}/{name}/built"
    documents.write.mode("overwrite").parquet(built)
    return _serve(spark, built, path, f"{name}/served", as_of, changes, catalog, derive)


def catch_up(
    spark: SparkSession,
    path: str,
    name: str,
    changes: DataFrame,
    catalog: FieldCatalog | None = None,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> dt.datetime:
    """Apply the events after those that the documents in force hold, and serve the result."""
    state = current(spark, path)
    return _serve(spark, f"{path}/{state['folder']}", path, f"{name}/served", dt.datetime.fromisoformat(state["until"]), changes, catalog, derive)


def _serve(spark, built: str, path: str, folder: str, since: dt.datetime, changes: DataFrame, catalog, derive) -> dt.datetime:
    until = _until(changes, since)
    time = F.col("event_time")
    newer = changes.where((time > _moment(since)) & (time <= _moment(until)))
    applied = apply_changes(spark.read.parquet(built), newer, derive, catalog)
    applied.documents.write.mode("overwrite").parquet(f"{path}/{folder}")
    applied.rejected.write.mode("overwrite").parquet(f"{path}/{folder}-rejected")
    publish(spark, path, {"folder": folder, "until": until.isoformat()})
    return until
