"""Table-wide validation and integrity checks. Each gives stable reason codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldweave import schema as S
from fieldweave.catalog import FieldCatalog
from fieldweave.functions.values import is_custom_name, kind_of_data_type, to_day, to_number
from fieldweave.operators.eav import with_definitions
from fieldweave.operators.keys import listed, spread


def _judged(rows: DataFrame, reason: Column) -> DataFrame:
    return rows.withColumn("reason", reason).withColumn("is_valid", F.col("reason").isNull())


def value_reason(value: Column, data_type: Column, options: Column, is_required: Column) -> Column:
    """Why a value breaks its definition, null if it does not."""
    kind = kind_of_data_type(data_type)
    allowed = F.coalesce(F.array_contains(options, value), F.lit(False))
    return (
        F.when(value.isNull(), F.when(is_required, "required_missing"))
        .when((kind == S.NUMBER) & to_number(value).isNull(), "not_number")
        .when((kind == S.DATE) & ~value.rlike(S.DATE_PATTERN), "bad_date")
        .when((kind == S.DATE) & to_day(value).isNull(), "no_such_day")
        .when((kind == S.SELECT) & ~allowed, "not_in_options")
    )


def validate_values(values: DataFrame, definitions: DataFrame) -> DataFrame:
    rows = with_definitions(values, definitions)
    reason = value_reason(F.col("value"), F.col("data_type"), F.col("options"), F.col("is_required"))
    return _judged(rows, reason)


def validate_definitions(definitions: DataFrame) -> DataFrame:
    options = F.coalesce(F.size("options"), F.lit(0))
    is_select = kind_of_data_type(F.col("data_type")) == S.SELECT
    reason = F.when(~F.col("api_name").rlike(S.API_NAME_PATTERN), "bad_api_name").when(
        is_select & (options <= 0), "options_missing"
    )
    return _judged(definitions, reason)


def contact_reason(email: Column, name: Column) -> Column:
    good = F.coalesce(email.rlike(S.EMAIL_PATTERN), F.lit(False))
    blank = F.coalesce(F.trim(name) == "", F.lit(True))
    return F.when(~good, "bad_email").when(blank, "blank_name")


def validate_contacts(contacts: DataFrame, name: Column) -> DataFrame:
    return _judged(contacts, contact_reason(F.col("email"), name))


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that more than one row has."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)


def orphan_values(values: DataFrame, contacts: DataFrame, definitions: DataFrame) -> DataFrame:
    """Value rows whose record or definition is gone."""
    record = contacts.select(F.col("id").alias("record_id"), F.lit(True).alias("has_record"))
    field = definitions.select(F.col("id").alias("field_id"), F.lit(True).alias("has_field"))
    reason = F.when(F.col("has_record").isNull(), "no_record").when(F.col("has_field").isNull(), "no_definition")
    return (
        values.join(field, "field_id", "left")
        .join(record, "record_id", "left")
        .withColumn("reason", reason)
        .where(F.col("reason").isNotNull())
        .drop("has_record", "has_field")
    )


def definition_use(definitions: DataFrame, values: DataFrame) -> DataFrame:
    """Definitions with the number of values that use them; one in use may not be deleted."""
    used = values.groupBy(F.col("field_id").alias("id")).agg(F.count(F.lit(1)).alias("n_values"))
    count = F.coalesce("n_values", F.lit(0))
    return definitions.join(used, "id", "left").select(
        "id", "api_name", count.alias("n_values"), (count == 0).alias("deletable")
    )


def null_out_parent(contacts: DataFrame, removed: DataFrame) -> DataFrame:
    """Contacts of removed accounts stay without an account."""
    gone = listed(removed, "id", "account_id").withColumn("_gone", F.lit(True))
    kept = F.when(F.col("_gone").isNull(), F.col("account_id"))
    return contacts.join(gone, "account_id", "left").withColumn("account_id", kept).drop("_gone")


def missing_required(contacts: DataFrame, values: DataFrame, catalog: FieldCatalog) -> DataFrame:
    """(record_id, api_name) of required fields a contact has no value for."""
    required = [f for f in catalog.fields if f.is_required]
    if not required:
        return contacts.select(F.col("id").alias("record_id"), F.lit("").alias("api_name")).limit(0)
    present = (
        values.where(F.col("field_id").isin([f.id for f in required]) & F.col("value").isNotNull())
        .groupBy(F.col("record_id").alias("id"))
        .agg(*[F.max(F.col("field_id") == f.id).alias(f.api_name) for f in required])
    )
    absent = F.array(*[F.when(~F.coalesce(f.api_name, F.lit(False)), F.lit(f.api_name)) for f in required])
    return (
        contacts.select("id")
        .join(present, "id", "left")
        .select(F.col("id").alias("record_id"), F.explode(F.array_compact(absent)).alias("api_name"))
    )


def upsert_definitions(definitions: DataFrame, batch: DataFrame, by_api_name: bool = False) -> DataFrame:
    """Definitions after a batch with unique keys. By id only label and the
    required flag of an existing one change; by API name, as a bulk load does,
    its label, type and options change and id and flags stay."""
    key = "api_name" if by_api_name else "id"
    open_columns = ("label", "data_type", "options") if by_api_name else ("label", "is_required")
    old, new = definitions.alias("old"), batch.alias("new")
    known = F.col(f"old.{key}").isNotNull()
    given = F.col(f"new.{key}").isNotNull()
    columns = [
        F.when(known & ~(given & F.lit(c in open_columns)), F.col(f"old.{c}")).otherwise(F.col(f"new.{c}")).alias(c)
        for c in definitions.columns
    ]
    return old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full").select(*columns)


def set_active(definitions: DataFrame, ids: DataFrame, flag: bool) -> DataFrame:
    """Switch the listed definitions on or off."""
    listed = ids.select("id").distinct().withColumn("_listed", F.lit(True))
    now = F.when(F.col("_listed"), F.lit(flag)).otherwise(F.col("is_active"))
    return definitions.join(listed, "id", "left").withColumn("is_active", now).drop("_listed")


def list_active(definitions: DataFrame) -> DataFrame:
    """Active definitions, oldest first."""
    return definitions.where("is_active").orderBy("created_at", "id")


def definition_view(definitions: DataFrame) -> DataFrame:
    """The public columns of active definitions in display order."""
    return (
        definitions.where("is_active")
        .select(
            "id",
            "label",
            "api_name",
            kind_of_data_type(F.col("data_type")).alias("field_type"),
            "options",
            "is_required",
            "is_active",
            "display_order",
        )
        .orderBy("display_order", "api_name", "id")
    )


def new_only(batch: DataFrame, existing: DataFrame, key: str, order: str) -> DataFrame:
    """Batch rows with a ``reason`` where the key exists already or an earlier
    row of the batch has it. The first row per key is found by an aggregate, so
    a key repeated very often is reduced before the shuffle."""
    first = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("_first"))
    known = existing.select(key).distinct().withColumn("_known", F.lit(True))
    marks = spread(first.join(known, key, "left"))
    reason = F.when(F.col("_known"), f"known_{key}").when(F.col("_first") < F.col(order), f"repeated_{key}")
    return batch.join(marks, key, "left").withColumn("reason", reason).drop("_first", "_known")


def field_reason(is_active: Column) -> Column:
    """Why a field takes no values, by its flag after a left join; null if it does."""
    return F.when(is_active.isNull(), "unknown_field").when(~is_active, "inactive_field")


def known_active_fields(changes: DataFrame, definitions: DataFrame) -> DataFrame:
    """Changes with a ``reason`` where the named field is unknown or switched off."""
    fields = definitions.select("api_name", "is_active")
    reason = field_reason(F.col("is_active"))
    return changes.join(fields, "api_name", "left").withColumn("reason", reason).drop("is_active")


def route_fields(names: DataFrame) -> DataFrame:
    """Distinct field names of a request log or table with the layout part they belong to."""
    return names.select("api_name").distinct().withColumn("is_custom", is_custom_name(F.col("api_name")))

