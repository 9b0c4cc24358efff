"""The search requests on both layouts, each as lazy DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldweave import schema as S
from fieldweave.catalog import FieldCatalog, is_custom
from fieldweave.functions.values import full_name, value_to_text
from fieldweave.operators import aggregates as A
from fieldweave.operators import eav as E
from fieldweave.operators import predicates as P
from fieldweave.operators import textsearch as X
from fieldweave.operators.ranking import FieldIndex, RankedKeys, cursor_keys, page_after_keys, store_ranked
from fieldweave.operators.sorting import Sort, last_direction_wins, missing_last, order_of, page_of
from fieldweave.plans.spec import SearchSpec


PAGE_COLUMNS = ("id", "email", "first_name", "last_name", "created_at", "updated_at")


@dataclass(frozen=True)
class SearchResult:
    """``page`` is the sorted page, ``matched`` all matching rows before it."""

    page: DataFrame
    matched: DataFrame
    groups: DataFrame | None
    spec: SearchSpec

    @property
    def total(self) -> DataFrame:
        return A.total(self.matched)

    @property
    def info(self) -> DataFrame:
        return A.page_info(self.total, self.spec.page, self.spec.page_size)


def search_columns(catalog: FieldCatalog) -> Mapping[str, Column]:
    """The searched fields of contact documents, as far as they are defined."""
    names = [n for n in S.SEARCH_FIELDS if not is_custom(n) or catalog.get(n)]
    return {n: P.document_column(n, catalog) for n in names}


def search_documents(
    docs: DataFrame,
    catalog: FieldCatalog,
    spec: SearchSpec,
    columns: Mapping[str, Column] | None = None,
) -> SearchResult:
    """A request on the document layout. Rows are scored only if the score
    decides the order; groups count the whole table, as the request's filters
    do not apply to them. Names that no one has defined are answered as on the
    EAV layout: a sort by one is left out, groups of one are a single ``'null'``.
    Base fields need documents that store them."""
    P.check_stored(docs.columns, _names(spec))
    lengths = X.LENGTHS if columns is None and X.LENGTHS in docs.columns else None
    columns = search_columns(catalog) if columns is None else columns
    keep = P.document_condition(spec.filters, catalog)
    words = X.words_of(docs.sparkSession, spec.search) if spec.search else []
    if spec.search:
        matched = docs.where(X.keyword_condition(list(columns.values()), words)).where(keep)
    else:
        matched = docs.where(keep)
    if spec.search and not spec.sort:
        scored = X.with_score(docs, columns, words, keep, lengths)
        page = page_of(scored, X.by_relevance(), spec.page, spec.page_size)
    else:
        page = _sorted_page(matched, _known_sorts(spec, catalog), lambda n: P.document_column(n, catalog), spec)
    groups = None
    if spec.group_by and is_custom(spec.group_by) and catalog.get(spec.group_by) is None:
        groups = A.group_counts(docs, F.lit(None))
    elif spec.group_by:
        groups = A.terms(docs, P.document_column(spec.group_by, catalog), S.GROUP_LIMIT)
    return SearchResult(page, matched, groups, spec)


def _names(spec: SearchSpec) -> list[str]:
    """The fields that a request names."""
    return [*(f.field for f in spec.filters), *(s.field for s in spec.sort), *([spec.group_by] if spec.group_by else [])]


def _known_sorts(spec: SearchSpec, catalog: FieldCatalog) -> list[Sort]:
    return last_direction_wins(s for s in spec.sort if not is_custom(s.field) or catalog.get(s.field))


def _sorted_page(rows: DataFrame, sorts: list[Sort], column: Callable[[str], Column], spec: SearchSpec) -> DataFrame:
    if spec.after is not None:
        return page_after_keys(rows, cursor_keys(sorts, column), spec.after, spec.page_size)
    return page_of(rows, order_of(sorts, column, missing_last), spec.page, spec.page_size)


def search_eav(
    contacts: DataFrame,
    values: DataFrame,
    catalog: FieldCatalog,
    spec: SearchSpec,
    indexes: Mapping[str, FieldIndex] | None = None,
) -> SearchResult:
    """A request on the EAV layout.

    Filters and sort values come from one pass over the value rows before
    anything is pivoted; the page is cut on ids and sort values, and only its
    records' values are read and pivoted into ``custom_fields``. That map has
    the present fields, or all of them for a request that needs pivoted columns.
    All is lazy: no job runs when this is called.

    A request without filters that is sorted by one indexed field takes the rows up
    to its page from the index.
    """
    base = _eav_base(contacts, spec)
    groups = _eav_groups(base, values, catalog, spec.group_by) if spec.group_by else None
    matched, keys, sorts = _eav_keys(base, values, catalog, spec)
    index = (indexes or {}).get(sorts[0].field) if len(sorts) == 1 else None
    if index is not None and not spec.filters and not spec.search and spec.after is None:
        top = index.top(base, sorts[0].direction, spec.page * spec.page_size)
        keys = top.select(*PAGE_COLUMNS, F.col("value").alias(f"_key_{index.name}"))
    page = _sorted_page(keys, sorts, _key, spec)
    return SearchResult(_eav_rows(page, sorts, values, catalog, spec), matched, groups, spec)


def _key(name: str) -> Column:
    return F.col(f"_key_{name}")


def _eav_base(contacts: DataFrame, spec: SearchSpec) -> DataFrame:
    base = contacts.where(P.contact_condition(spec.base_filters))
    return base.where(P.text_contains(spec.search)) if spec.search else base


def _eav_keys(
    base: DataFrame, values: DataFrame, catalog: FieldCatalog, spec: SearchSpec
) -> tuple[DataFrame, DataFrame, list[Sort]]:
    """(matching contacts, the same with their sort values, the sorts that count)."""
    unknown = [f for f in spec.custom_filters if catalog.get(f.field) is None]
    filters = P.usable([f for f in spec.custom_filters if catalog.get(f.field)])
    sort_fields = [n for n in spec.custom_sort_fields if catalog.get(n)]
    matched = base
    if unknown:
        matched = matched.where(F.lit(False))
    if filters:
        found = E.matches(values, catalog, filters)
        matched = matched.join(found, "id", "left_semi")
    ordered = matched
    if filters and sort_fields:
        ordered = base.join(E.matches(values, catalog, filters, sort_fields), "id", "inner")
        if unknown:
            ordered = ordered.where(F.lit(False))
    elif sort_fields:
        ordered = matched.join(E.matches(values, catalog, [], sort_fields), "id", "left")
    sorts = _known_sorts(spec, catalog)
    return matched, ordered.select(*PAGE_COLUMNS, *[_sort_key(s.field) for s in sorts]), sorts


def _eav_rows(page: DataFrame, sorts: list[Sort], values: DataFrame, catalog: FieldCatalog, spec: SearchSpec) -> DataFrame:
    """The page's contacts with their fields, in order."""
    wide = E.pivot(E.values_of_page(values, page), catalog)
    fields = E.full_map(catalog) if spec.needs_pivot else E.present_map(catalog)
    return (
        page.join(wide.withColumnRenamed("record_id", "id"), "id", "left")
        .orderBy(*order_of(sorts, _key))
        .limit(spec.page_size)
        .select(
            "id",
            F.coalesce("email", F.lit("")).alias("email"),
            full_name(F.col("first_name"), F.col("last_name")).alias("name"),
            fields.alias("custom_fields"),
            "created_at",
            "updated_at",
        )
    )


@dataclass(frozen=True)
class RankedSearch:
    """A request's matches in order, stored once; any page of them reads only the parts that hold it."""

    keys: RankedKeys
    spec: SearchSpec
    rows_of: Callable[[DataFrame], DataFrame]

    @property
    def total(self) -> int:
        return self.keys.total

    @property
    def last_page(self) -> int:
        return max(1, -(-self.total // self.spec.page_size))

    def page(self, number: int) -> DataFrame:
        return self.rows_of(self.keys.page(number, self.spec.page_size))


def rank_documents(docs: DataFrame, catalog: FieldCatalog, spec: SearchSpec, path: str) -> RankedSearch:
    """A sorted request on documents, its matches ranked below ``path``."""
    sorts = _known_sorts(spec, catalog)
    matched = search_documents(docs, catalog, replace(spec, group_by=None)).matched
    keys = matched.select("id", "created_at", *[P.document_column(s.field, catalog).alias(f"_key_{s.field}") for s in sorts])
    ranked = store_ranked(keys, order_of(sorts, _key), path)
    return RankedSearch(ranked, spec, lambda page: docs.join(page.select("id", "rank"), "id").orderBy("rank").drop("rank"))


def rank_contacts(contacts: DataFrame, values: DataFrame, catalog: FieldCatalog, spec: SearchSpec, path: str) -> RankedSearch:
    """A sorted request on the EAV layout, its matches ranked below ``path``."""
    _, keys, sorts = _eav_keys(_eav_base(contacts, spec), values, catalog, spec)
    ranked = store_ranked(keys, order_of(sorts, _key), path)
    return RankedSearch(ranked, spec, lambda page: _eav_rows(page, sorts, values, catalog, spec))


def _sort_key(name: str) -> Column:
    column = F.col(name) if is_custom(name) else P.contact_column(name)
    return column.alias(f"_key_{name}")


def _eav_groups(base: DataFrame, values: DataFrame, catalog: FieldCatalog, name: str) -> DataFrame:
    if not is_custom(name):
        return A.group_counts(base, P.contact_column(name))
    if catalog.get(name) is None:
        return A.group_counts(base, F.lit(None))
    return A.group_counts_eav(base, values, catalog, name)


def search(
    layout: str,
    spec: SearchSpec,
    catalog: FieldCatalog,
    *,
    documents: DataFrame | None = None,
    contacts: DataFrame | None = None,
    values: DataFrame | None = None,
) -> SearchResult:
    """The request on the named layout, ``'doc'`` or ``'eav'``."""
    if layout == "doc":
        return search_documents(documents, catalog, spec)
    if layout == "eav":
        return search_eav(contacts, values, catalog, spec)
    raise ValueError(f"unknown layout {layout!r}")


def flat_documents(matched: DataFrame, catalog: FieldCatalog) -> DataFrame:
    """Documents as text columns, to compare with the EAV layout."""
    return matched.select(
        "id",
        F.coalesce("email", F.lit("")).alias("email"),
        F.trim("name").alias("name"),
        *[value_to_text(F.col(f"custom_fields.{f.api_name}"), f.kind).alias(f.api_name) for f in catalog.fields],
    )


def flat_contacts(matched: DataFrame, values: DataFrame, catalog: FieldCatalog) -> DataFrame:
    """Contacts with their fields as text columns, numbers and dates written as
    the document layout writes them."""
    wide = E.wide_contacts(matched.select("id", "email", "first_name", "last_name"), values, catalog)
    return wide.select(
        "id",
        F.coalesce("email", F.lit("")).alias("email"),
        full_name(F.col("first_name"), F.col("last_name")).alias("name"),
        *[
            value_to_text(E.typed_value(F.col(f.api_name), f.kind), f.kind).alias(f.api_name)
            for f in catalog.fields
        ],
    )


def layout_parity(
    spec: SearchSpec, catalog: FieldCatalog, documents: DataFrame, contacts: DataFrame, values: DataFrame
) -> DataFrame:
    """Rows that only one layout gives for all matches of a request, with the
    layout's name. Empty if the layouts agree."""
    doc = flat_documents(search_documents(documents, catalog, spec).matched, catalog)
    eav = flat_contacts(search_eav(contacts, values, catalog, spec).matched, values, catalog)
    return (
        eav.exceptAll(doc)
        .withColumn("only_in", F.lit("eav"))
        .unionByName(doc.exceptAll(eav).withColumn("only_in", F.lit("doc")))
    )
