"""Sort orders and pages."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldweave import schema as S


@dataclass(frozen=True)
class Sort:
    field: str
    direction: str = "asc"

    def __post_init__(self) -> None:
        if self.direction not in ("asc", "desc"):
            raise ValueError(f"unknown direction {self.direction!r}")


def last_direction_wins(sorts: Iterable[Sort]) -> list[Sort]:
    """One entry per field at its first place, with its last direction."""
    return [Sort(field, direction) for field, direction in {s.field: s.direction for s in sorts}.items()]


def missing_last(column: Column, direction: str) -> Column:
    """Order of the document layout: typed, missing values last both ways."""
    return column.asc_nulls_last() if direction == "asc" else column.desc_nulls_last()


def missing_lowest(column: Column, direction: str) -> Column:
    """Order of the EAV layout: by text, missing values below all others."""
    return column.asc_nulls_first() if direction == "asc" else column.desc_nulls_last()


def order_of(
    sorts: Iterable[Sort],
    column: Callable[[str], Column],
    rule: Callable[[Column, str], Column] = missing_last,
) -> list[Column]:
    """Sort columns in request order, newest first without any, then by id."""
    keys = [rule(column(s.field), s.direction) for s in sorts]
    return [*(keys or [F.col("created_at").desc_nulls_last()]), F.col("id").asc()]


def page_of(rows: DataFrame, order: list[Column], page: int = S.DEFAULT_PAGE, size: int = S.DEFAULT_PAGE_SIZE) -> DataFrame:
    """One page of the sorted rows, planned as a top-k of offset plus size rows."""
    if page < 1 or size < 1:
        raise ValueError("page and page size start at 1")
    return rows.orderBy(*order).offset((page - 1) * size).limit(size)


def page_after(
    rows: DataFrame, key: str, last_key: Column, last_id: Column, size: int, descending: bool = False
) -> DataFrame:
    """The page after a known last row, at the cost of a top-k of one page however
    deep it lies. ``key`` must not be null in ``rows``."""
    column = F.col(key)
    beyond = column < last_key if descending else column > last_key
    order = column.desc() if descending else column.asc()
    return (
        rows.where(beyond | ((column == last_key) & (F.col("id") > last_id)))
        .orderBy(order, F.col("id").asc())
        .limit(size)
    )
