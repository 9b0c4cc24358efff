"""Key lists for joins whose other side may have a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(rows: DataFrame) -> DataFrame:
    """Grouped rows on no partitioning a join could take over. The join then
    shuffles them itself, which is what AQE needs to split a hot key of its
    other side; joined as they are grouped, it cannot. Small rows are shuffled
    twice to keep the large side even."""
    return rows.hint("rebalance")


def listed(rows: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """The distinct keys of a table that may repeat them, for a join against a
    table that may repeat them as well."""
    return spread(rows.select(rows[key].alias(name or key)).distinct())
