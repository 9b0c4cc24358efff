"""Operators on the entity-attribute-value layout.

A record may own a large share of the value rows, so every operator reduces the
value rows per record with a partial aggregate before they are shuffled, and a
join against them is written so that the repeating side is one AQE can split.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldweave.catalog import FieldCatalog
from fieldweave.functions.values import typed_value
from fieldweave.operators.predicates import Filter, all_of, value_condition

# List length up to which the Parquet reader tests single values.
PUSHED_GROUP = 10


def of_fields(values: DataFrame, catalog: FieldCatalog, names: Sequence[str]) -> DataFrame:
    ids = [catalog.by_name[n].id for n in names]
    return values.where(F.col("field_id").isin(ids))


def record_ids(values: DataFrame) -> DataFrame:
    """The records that own any of the rows, each once."""
    return values.select(F.col("record_id").alias("id")).distinct()


def having_field(contacts: DataFrame, values: DataFrame, catalog: FieldCatalog, name: str) -> DataFrame:
    """Contacts with any value row of the field."""
    return contacts.join(record_ids(of_fields(values, catalog, [name])), "id", "left_semi")


def having_values(
    contacts: DataFrame, values: DataFrame, catalog: FieldCatalog, filters: Sequence[Filter]
) -> DataFrame:
    """Contacts for which every filter finds a value row, one semi-join per filter."""
    for flt in filters:
        contacts = contacts.join(record_ids(values.where(value_condition(flt, catalog))), "id", "left_semi")
    return contacts


def matches(
    values: DataFrame,
    catalog: FieldCatalog,
    filters: Sequence[Filter],
    sort_fields: Sequence[str] = (),
) -> DataFrame:
    """Records that meet all filters, with the typed values of the sort fields,
    from one pass and one shuffle of the value rows.

    Rows that neither meet a filter nor carry a sort field are dropped before
    the shuffle. The sort values are named like their fields.
    """
    tests = [value_condition(f, catalog) for f in filters]
    wanted = F.lit(False)
    for test in tests:
        wanted = wanted | test
    if sort_fields:
        wanted = wanted | F.col("field_id").isin([catalog.by_name[n].id for n in sort_fields])
    found = [F.max(F.coalesce(test, F.lit(False))).alias(f"_met{n}") for n, test in enumerate(tests)]
    sorts = [F.max(_typed(catalog, n)).alias(n) for n in dict.fromkeys(sort_fields)]
    grouped = values.where(wanted).groupBy(F.col("record_id").alias("id")).agg(*found, *sorts)
    met = all_of(F.col(f"_met{n}") for n in range(len(tests)))
    return grouped.where(met).drop(*[f"_met{n}" for n in range(len(tests))])


def _typed(catalog: FieldCatalog, name: str) -> Column:
    definition = catalog.by_name[name]
    return F.when(F.col("field_id") == definition.id, typed_value(F.col("value"), definition.kind))


def pivot(values: DataFrame, catalog: FieldCatalog, names: Sequence[str] | None = None) -> DataFrame:
    """One row per record with one text column per field, the greatest value of
    each field. The columns are known, so no job has to look for them."""
    chosen = catalog.fields if names is None else [catalog.by_name[n] for n in names]
    rows = values if names is None else of_fields(values, catalog, names)
    wide = rows.groupBy("record_id").pivot("field_id", [f.id for f in chosen]).agg(F.max("value"))
    return wide.toDF("record_id", *[f.api_name for f in chosen])


def wide_contacts(
    contacts: DataFrame, values: DataFrame, catalog: FieldCatalog, names: Sequence[str] | None = None
) -> DataFrame:
    """Every contact with its pivoted fields, null where it has none."""
    wide = pivot(values, catalog, names).withColumnRenamed("record_id", "id")
    return contacts.join(wide, "id", "left")


def pivot_equal(
    contacts: DataFrame, values: DataFrame, catalog: FieldCatalog, name: str, value: str
) -> DataFrame:
    """Contacts whose pivoted field equals a value."""
    return wide_contacts(contacts, values, catalog, [name]).where(F.col(name) == value)


def with_definitions(values: DataFrame, definitions: DataFrame, how: str = "inner") -> DataFrame:
    """Value rows with their definition. ``inner`` drops rows of unknown fields.

    The definition table is broadcast by its size in bytes if it is small; if it
    is not, the value rows are on the side that AQE splits for a hot field.
    """
    attributes = definitions.select(
        F.col("id").alias("field_id"), "api_name", "data_type", "options", "is_required", "is_active"
    )
    return values.join(attributes, "field_id", how)


def left_values(contacts: DataFrame, values: DataFrame, definitions: DataFrame) -> DataFrame:
    """Contacts with their value rows and definitions; contacts without values stay.

    An inner join plus the contacts without values: unlike a left join with the
    value rows on the right, this lets AQE split the rows of a hot record.
    """
    details = values.select("record_id", "field_id", "value").withColumnRenamed("record_id", "id")
    held = details.join(contacts, "id", "inner")
    empty = contacts.join(record_ids(values), "id", "left_anti")
    rows = held.unionByName(empty, allowMissingColumns=True)
    names = definitions.select(F.col("id").alias("field_id"), "api_name", "data_type")
    return rows.join(names, "field_id", "left")


def any_of(column: Column, wanted: Sequence) -> Column:
    """Membership in a short list, in groups small enough for the Parquet reader
    to skip row groups by each value and not by the range of all of them."""
    groups = [wanted[n : n + PUSHED_GROUP] for n in range(0, len(wanted), PUSHED_GROUP)]
    return reduce(lambda a, b: a | b, [column.isin(list(g)) for g in groups], F.lit(False))


def values_of_page(values: DataFrame, page: DataFrame) -> DataFrame:
    """The value rows of the records on a page that is sorted and cut already, one
    plan for any length of page: the optimizer broadcasts it by its size or not."""
    return values.join(page.select(F.col("id").alias("record_id")), "record_id", "left_semi")


def present_entries(values: DataFrame, catalog: FieldCatalog) -> DataFrame:
    """Per record the entries (api_name, data_type, value) of its present fields.

    The fields are reduced to one value each before entries are built, so an
    array is never longer than the catalog.
    """
    wide = pivot(values, catalog)
    entries = F.array(
        *[
            F.when(
                F.col(f.api_name).isNotNull(),
                F.struct(
                    F.lit(f.api_name).alias("api_name"),
                    F.lit(f.data_type).alias("data_type"),
                    F.col(f.api_name).alias("value"),
                ),
            )
            for f in sorted(catalog.fields, key=lambda f: f.api_name)
        ]
    )
    return wide.select("record_id", F.array_compact(entries).alias("entries"))


def values_per_contact(contacts: DataFrame, values: DataFrame, catalog: FieldCatalog) -> DataFrame:
    """Every contact with the list of its field entries, empty if it has none."""
    entries = present_entries(values, catalog).withColumnRenamed("record_id", "id")
    joined = contacts.join(entries, "id", "left")
    empty = F.array().cast(entries.schema["entries"].dataType)
    return joined.withColumn("entries", F.coalesce("entries", empty))


def full_map(catalog: FieldCatalog) -> Column:
    """A map of all fields from pivoted columns, null where absent."""
    return F.map_from_arrays(F.lit(catalog.names), F.array(*catalog.names))


def present_map(catalog: FieldCatalog) -> Column:
    """A map of the present fields from pivoted columns."""
    return F.map_filter(full_map(catalog), lambda _, value: value.isNotNull())


def custom_map(values: DataFrame, catalog: FieldCatalog) -> DataFrame:
    """Per record a map of its present fields."""
    return pivot(values, catalog).select("record_id", present_map(catalog).alias("custom_fields"))


def pack_values(values: DataFrame, catalog: FieldCatalog) -> DataFrame:
    """Per record one text ``api:type:value||api:type:value``, for interchange."""
    text = F.transform("entries", lambda e: F.concat_ws(":", e["api_name"], e["data_type"], e["value"]))
    return present_entries(values, catalog).select("record_id", F.array_join(text, "||").alias("packed"))


def unpack_values(packed: DataFrame) -> DataFrame:
    """The entries of packed text: split at ``||`` and at the first two colons."""
    entry = packed.select("record_id", F.explode(F.split("packed", r"\|\|")).alias("entry"))
    part = F.split("entry", ":", 3)
    return entry.select(
        "record_id", part[0].alias("api_name"), part[1].alias("data_type"), part[2].alias("value")
    )


def field_grid(contacts: DataFrame, values: DataFrame, catalog: FieldCatalog) -> DataFrame:
    """Every contact with every field, the value null where it has none."""
    wide = wide_contacts(contacts.select("id"), values, catalog)
    cells = F.array(
        *[
            F.struct(
                F.lit(f.id).alias("field_id"),
                F.lit(f.api_name).alias("api_name"),
                F.col(f.api_name).alias("value"),
            )
            for f in catalog.fields
        ]
    )
    return wide.select(F.col("id").alias("record_id"), F.inline(cells))
