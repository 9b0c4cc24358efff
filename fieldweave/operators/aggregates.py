"""Totals, group counts and their shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldweave import schema as S
from fieldweave.catalog import FieldCatalog
from fieldweave.operators.eav import wide_contacts


def total(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("total"))


def page_info(totals: DataFrame, page: int, size: int) -> DataFrame:
    """Number of pages, and the first and last row shown on one of them."""
    first = F.lit((page - 1) * size + 1).cast("long")
    return totals.select(
        "total",
        F.ceil(F.col("total") / size).alias("total_pages"),
        F.least(first, F.col("total")).alias("first_row"),
        F.least(F.lit(page * size).cast("long"), F.col("total")).alias("last_row"),
    )


def _largest(counts: DataFrame, size: int) -> DataFrame:
    return counts.orderBy(F.col("cnt").desc(), F.col("key").asc()).limit(size)


def group_counts(rows: DataFrame, key: Column, size: int = S.GROUP_LIMIT) -> DataFrame:
    """Largest groups; a missing or empty key counts under ``'null'``."""
    text = F.coalesce(F.nullif(key.cast("string"), F.lit("")), F.lit("null"))
    counts = rows.groupBy(text.alias("key")).agg(F.count(F.lit(1)).alias("cnt"))
    return _largest(counts, size)


def group_counts_eav(
    contacts: DataFrame, values: DataFrame, catalog: FieldCatalog, name: str, size: int = S.GROUP_LIMIT
) -> DataFrame:
    """Contacts per value of a custom field, from a pivot of that field alone."""
    wide = wide_contacts(contacts.select("id"), values, catalog, [name])
    return group_counts(wide, F.col(name), size)


def terms(rows: DataFrame, key: Column, size: int = S.DEFAULT_TERMS) -> DataFrame:
    """Most frequent values with their row counts; missing values are not counted."""
    counts = (
        rows.select(key.cast("string").alias("key"))
        .where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    return _largest(counts, size)


def terms_share(groups: DataFrame) -> DataFrame:
    """Percent of the shown total and of the largest group. ``groups`` is a cut
    list of terms, so one window over all of it is small."""
    shown = Window.partitionBy()
    return groups.select(
        "key",
        "cnt",
        F.round(F.col("cnt") * 100 / F.sum("cnt").over(shown), 1).alias("percent"),
        F.round(F.col("cnt") * 100 / F.max("cnt").over(shown), 1).alias("bar"),
        F.sum("cnt").over(shown).alias("shown_total"),
    )


def status_counts(outbox: DataFrame) -> DataFrame:
    """Change rows per state, zero for a state without rows."""
    counted = [F.count_if(F.col("status") == s).alias(s) for s in S.OUTBOX_STATES]
    return outbox.agg(*counted).unpivot([], list(S.OUTBOX_STATES), "status", "cnt")
