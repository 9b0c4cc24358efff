"""Single rows and listed rows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldweave.operators.eav import any_of, left_values
from fieldweave.operators.keys import listed
from fieldweave.operators.predicates import literal


def by_column(rows: DataFrame, column: str, value: Any) -> DataFrame:
    """All rows whose column has a value; none if there is none."""
    return rows.where(F.col(column) == literal(value, "ID"))


def contact_by_id(contacts: DataFrame, values: DataFrame, definitions: DataFrame, contact_id: Any) -> DataFrame:
    """One contact with its values. The contact is one row, so it is broadcast
    by its size and its value rows are read where they are."""
    theirs = values.where(F.col("record_id") == literal(contact_id, "ID"))
    return left_values(by_column(contacts, "id", contact_id), theirs, definitions)


def by_ids(rows: DataFrame, ids: Sequence | DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is listed: a Python list becomes a pushed-down filter, a table
    with an ``id`` is joined."""
    if not isinstance(ids, DataFrame):
        return rows.where(any_of(F.col(key), ids))
    return rows.join(listed(ids, "id", key), key, "left_semi")
