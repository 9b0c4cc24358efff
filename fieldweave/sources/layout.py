"""Tables on disk, and the step from one layout to the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldweave import schema as S
from fieldweave.catalog import FieldCatalog
from fieldweave.functions.values import typed_value
from fieldweave.operators.eav import pivot
from fieldweave.operators.predicates import base_columns
from fieldweave.session import settle

def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored table. The schemas of ``fieldweave.schema`` have text keys; leave
    the schema out for tables with other key types."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def stream_outbox(
    spark: SparkSession, path: str, schema: T.StructType = S.OUTBOX, files_per_batch: int | None = None
) -> DataFrame:
    """The change log as a stream over its files."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def read_jdbc_table(
    spark: SparkSession, url: str, name: str, key: str, lower: str, upper: str, partitions: int, **options: str
) -> DataFrame:
    """A live database table, read in parallel over ranges of a numeric or date key."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=name, partitionColumn=key, lowerBound=lower, upperBound=upper)
        .options(numPartitions=str(partitions), **options)
        .load()
    )


def melt(wide: DataFrame, catalog: FieldCatalog, keep_missing: bool = False) -> DataFrame:
    """EAV rows of a wide table with one column per custom field."""
    stamps = [c for c in ("created_at", "updated_at") if c in wide.columns]
    by_id = wide.select(
        "id", *stamps, *[F.col(f.api_name).cast("string").alias(f.id) for f in catalog.fields]
    )
    rows = by_id.unpivot(["id", *stamps], [f.id for f in catalog.fields], "field_id", "value")
    if not keep_missing:
        rows = rows.where(F.col("value").isNotNull())
    return rows.select(
        F.concat_ws(":", "id", "field_id").alias("id"),
        F.col("id").alias("record_id"),
        "field_id",
        "value",
        *stamps,
    )


def build_documents(
    contacts: DataFrame, values: DataFrame, catalog: FieldCatalog, lenient: bool = False, base_fields: bool = False
) -> DataFrame:
    """The document table from the EAV tables: every contact once, its present
    values typed, empty text dropped. Numbers are read as strictly as the EAV
    filters read them; ``lenient`` reads a numeric prefix. With ``base_fields``
    the other columns of contacts are stored too, for requests that name them."""
    wide = pivot(values.where(F.col("value") != ""), catalog)
    fields = [typed_value(F.col(f.api_name), f.kind, lenient).alias(f.api_name) for f in catalog.fields]
    return contacts.join(wide, contacts["id"] == wide["record_id"], "left").select(
        "id",
        "email",
        F.concat_ws(" ", "first_name", "last_name").alias("name"),
        F.struct(*fields).alias("custom_fields"),
        "created_at",
        "updated_at",
        *(base_columns(contacts) if base_fields else []),
    )


def write_values(values: DataFrame, path: str) -> None:
    """EAV rows in one folder per field, so that a field filter reads its files only.

    The range split lets a frequent field spread over many files and keeps the
    rows of a file sorted by record.
    """
    (
        values.repartitionByRange("field_id", "record_id", "id")
        .sortWithinPartitions("field_id", "record_id")
        .write.mode("overwrite")
        .partitionBy("field_id")
        .parquet(path)
    )


def write_values_by_record(values: DataFrame, table: str, path: str, buckets: int) -> None:
    """EAV rows bucketed by record: a pivot or record join needs no shuffle."""
    (
        values.write.mode("overwrite")
        .bucketBy(buckets, "record_id")
        .sortBy("record_id")
        .option("path", path)
        .saveAsTable(table)
    )


def write_documents(documents: DataFrame, path: str) -> None:
    documents.write.mode("overwrite").parquet(path)


def append_batch(rows: DataFrame, path: str, batch: str) -> None:
    """Rows of a batch added to a table, in a folder of the batch's own: writing
    the batch again replaces its rows and no others."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def upsert(target: DataFrame, changes: DataFrame, key: str, version: list[str]) -> DataFrame:
    """Target rows with changed rows put in by key; of several changes to one
    key the one with the greatest version holds.

    ``changes`` has the columns of ``target`` and the version columns. Changes
    are reduced before the shuffle, so a key changed very often is no hot spot.
    """
    columns = target.columns
    newest = (
        changes.groupBy(key)
        .agg(F.max_by(F.struct(*columns), F.struct(*version)).alias("row"))
        .select("row.*")
    )
    # Written once: it is read for the rows and for the keys that they replace.
    newest = settle(newest, "newest-rows")
    return target.join(newest.select(key), key, "left_anti").select(columns).unionByName(newest)


def missing_documents(contacts: DataFrame, documents: DataFrame) -> DataFrame:
    """Contacts that have no document yet: what a resumed build still has to write."""
    return contacts.join(documents.select("id"), "id", "left_anti")


def reconcile_counts(
    contacts: DataFrame, definitions: DataFrame, values: DataFrame, documents: DataFrame
) -> DataFrame:
    """Row counts of the four tables, and ids that only one layout has."""

    def counted(name: str, rows: DataFrame) -> DataFrame:
        return rows.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("measure"), "n_rows")

    parts = [
        counted("contacts", contacts),
        counted("definitions", definitions),
        counted("values", values),
        counted("documents", documents),
        counted("contacts_without_document", missing_documents(contacts, documents)),
        counted("documents_without_contact", missing_documents(documents, contacts)),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
