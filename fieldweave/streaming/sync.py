"""Continuous sync of the document table from the change log.

Each micro-batch writes its newest change per contact into a folder of its own,
named by the batch id; running a batch again replaces that folder by the same
rows. A batch costs what it brings, not the size of the table. Readers take the
newest change per contact over all folders, so neither the order of arrival nor
a repeated event matters, and a deleted contact leaves a row that keeps an older
event from reviving it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fieldweave import schema as S
from fieldweave.catalog import FieldCatalog
from fieldweave.operators.changes import divided, merged_type, newest_changes, read_once, to_change, widened, widened_type
from fieldweave.session import new_work_dir, remove, settle_at
from fieldweave.sources.versions import current, publish


def stream_sync(
    outbox: DataFrame,
    document: T.StructType,
    target: str,
    checkpoint: str,
    continuous_every: str | None = None,
    catalog: FieldCatalog | None = None,
    fan: int | None = None,
) -> StreamingQuery:
    """Start the sync. Without an interval it takes what is there and ends. Fields
    of the catalog are added to the document type. ``fan``: see ``write_batch``."""
    document = widened_type(document, catalog)
    writer = outbox.writeStream.foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, document, target, fan))
    writer = writer.option("checkpointLocation", checkpoint)
    if continuous_every:
        return writer.trigger(processingTime=continuous_every).start()
    return writer.trigger(availableNow=True).start()


def write_batch(batch: DataFrame, batch_id: int, document: T.StructType, target: str, fan: int | None = None) -> None:
    """One batch of the log, read and parsed once, as a run of changes and a folder
    of what was set aside. With ``fan``, runs are merged in tiers: as soon as a tier
    has so many, they become one run of the next. Then a reader merges fewer than
    ``fan`` runs for each tier, and a change is written again once for each tier,
    of which there are as many as the logarithm of the number of batches."""
    spark = batch.sparkSession
    path = new_work_dir(spark, "sync-batch")
    good, rejected = divided(settle_at(read_once(to_change(batch), document), path), document)
    newest_changes(good).write.mode("overwrite").parquet(f"{target}/changes/batch_id={batch_id}")
    rejected.write.mode("overwrite").parquet(f"{target}/rejected/batch_id={batch_id}")
    remove(spark, path)
    if fan:
        _add_run(spark, target, batch_id, fan)


def _add_run(spark: SparkSession, target: str, batch_id: int, fan: int) -> None:
    """The batch as a run in force, and tiers that are full merged. Folders are named
    by the batches they hold: a merge that is run again writes the same."""
    if fan < 2:
        raise ValueError("runs are merged from two on")
    runs = live_runs(spark, target)
    if any(r["first"] <= batch_id <= r["last"] for r in runs):
        return
    runs.append({"folder": f"changes/batch_id={batch_id}", "tier": 0, "first": batch_id, "last": batch_id})
    tier = 0
    while len(full := [r for r in runs if r["tier"] == tier]) >= fan:
        first, last = min(r["first"] for r in full), max(r["last"] for r in full)
        merged = {"folder": f"runs/tier={tier + 1}/{first}-{last}", "tier": tier + 1, "first": first, "last": last}
        rows = newest_changes(_read_runs(spark, target, full))
        rows.repartition("contact_id").sortWithinPartitions("contact_id").write.mode("overwrite").parquet(f"{target}/{merged['folder']}")
        runs = [r for r in runs if r["tier"] != tier] + [merged]
        tier += 1
    publish(spark, target, {"runs": runs})


def live_runs(spark: SparkSession, target: str) -> list[dict]:
    """The runs that make up the state of a target that is merged in tiers."""
    return (current(spark, target) or {"runs": []})["runs"]


def _read_runs(spark: SparkSession, target: str, runs: list[dict]) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(*(f"{target}/{r['folder']}" for r in runs))


def written_changes(spark: SparkSession, target: str) -> DataFrame:
    """All changes in force: of the live runs, or of all batches if these are not
    merged. Batches from before a field was defined have null for it."""
    runs = live_runs(spark, target)
    if runs:
        return _read_runs(spark, target, runs)
    return spark.read.option("mergeSchema", True).parquet(f"{target}/changes")


def current_state(spark: SparkSession, target: str) -> DataFrame:
    """The newest change per contact over all batches, deletes included."""
    return newest_changes(written_changes(spark, target))


def synced_documents(
    spark: SparkSession,
    target: str,
    base: DataFrame | None = None,
    derive: Callable[[DataFrame], DataFrame] | None = None,
    catalog: FieldCatalog | None = None,
) -> DataFrame:
    """The document table as of the last finished batch, over an optional base
    table that no change has touched yet. ``derive`` adds the columns that are
    stored with documents but computed from them. Custom fields are those of the
    base table, the batches and the catalog."""
    state = current_state(spark, target)
    live = state.where(F.col("type") != S.DELETED).select("payload.*")
    document = (live if base is None else base).schema
    custom = widened_type(document, catalog)["custom_fields"].dataType
    if isinstance(custom, T.StructType) and isinstance(live.schema["custom_fields"].dataType, T.StructType):
        custom = merged_type(custom, live.schema["custom_fields"].dataType)
    live = widened(live, custom)
    if derive is not None:
        live = derive(live)
    if base is None:
        return live
    touched = state.select(F.col("contact_id").alias("id"))
    return widened(base, custom).join(touched, "id", "left_anti").unionByName(live)


def compact(spark: SparkSession, target: str, into: str) -> None:
    """Write one change per contact of all batches as the first batch of a new
    target; batches that come later win over it by their version. What was set
    aside goes along."""
    current_state(spark, target).write.mode("errorifexists").parquet(f"{into}/changes/batch_id=-1")
    rejected = spark.read.parquet(f"{target}/rejected").drop("batch_id")
    rejected.write.mode("errorifexists").parquet(f"{into}/rejected/batch_id=-1")
