"""Search requests."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from fieldweave import schema as S
from fieldweave.catalog import is_custom
from fieldweave.operators.predicates import Filter, equalities
from fieldweave.operators.sorting import Sort


@dataclass(frozen=True)
class SearchSpec:
    search: str | None = None
    filters: tuple[Filter, ...] = ()
    sort: tuple[Sort, ...] = ()
    page: int = S.DEFAULT_PAGE
    page_size: int = S.DEFAULT_PAGE_SIZE
    group_by: str | None = None
    #: Instead of a page number: the sort values of the last row seen, in the order of
    #: ``sort`` (``created_at`` without one), then its id.
    after: tuple[Any, ...] | None = None

    def __post_init__(self) -> None:
        if self.page < 1 or self.page_size < 1:
            raise ValueError("page and page size start at 1")
        if self.after is not None and (self.page != 1 or (self.search and not self.sort)):
            raise ValueError("a cursor goes with a sort order, not with a page number or relevance")

    @property
    def custom_filters(self) -> list[Filter]:
        return [f for f in self.filters if is_custom(f.field)]

    @property
    def base_filters(self) -> list[Filter]:
        return [f for f in self.filters if not is_custom(f.field)]

    @property
    def custom_sort_fields(self) -> list[str]:
        return [s.field for s in self.sort if is_custom(s.field)]

    @property
    def needs_pivot(self) -> bool:
        """A custom sort or a custom group needs pivoted columns on the EAV layout."""
        return bool(self.custom_sort_fields) or bool(self.group_by and is_custom(self.group_by))

    @classmethod
    def from_request(cls, request: Mapping[str, str]) -> SearchSpec:
        """A list request: ``sort`` and ``filter`` are JSON arrays."""
        sort = json.loads(request.get("sort") or "[]")
        filters = json.loads(request.get("filter") or "[]")
        return cls(
            search=request.get("search") or None,
            filters=tuple(Filter(f["field"], f["operator"], f["value"]) for f in filters),
            sort=tuple(Sort(s["field"], s["direction"]) for s in sort),
            page=int(request.get("page") or S.DEFAULT_PAGE),
            page_size=int(request.get("pageSize") or S.DEFAULT_PAGE_SIZE),
            group_by=request.get("groupBy") or None,
        )

    @classmethod
    def from_query(cls, query: Mapping[str, str]) -> SearchSpec:
        """A simple search: ``filter[field]`` and ``sort[field]`` parameters."""
        filters, sort = {}, []
        for key, value in query.items():
            named = re.fullmatch(r"(filter|sort)\[(.*)\]", key)
            if named and named[1] == "filter":
                filters[named[2]] = value
            elif named and value in ("asc", "desc"):
                sort.append(Sort(named[2], value))
        return cls(
            search=query.get("keyword") or None,
            filters=tuple(equalities(filters)),
            sort=tuple(sort),
            page=int(query.get("page") or S.DEFAULT_PAGE),
            page_size=int(query.get("size") or S.DEFAULT_PAGE_SIZE),
        )
