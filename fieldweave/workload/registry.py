"""Collects the queries and the SQL twin of each."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldweave.catalog import FieldCatalog
from fieldweave.sources import lens as L

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents conversations".split()
)


def _twin(text: str, **texts: str) -> str:
    for name in _BASE_TABLES:
        text = text.replace("{" + name + "}", name)
    for key, value in texts.items():
        text = text.replace("{" + key + "}", value)
    return text.strip()


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _definition_rows(catalog: FieldCatalog) -> str:
    rows = []
    for f in catalog.fields:
        options = "[" + ", ".join(map(_quoted, f.options)) + "]" if f.options else "null::varchar[]"
        rows.append(
            f"({_quoted(f.id)}, {_quoted(f.label)}, {_quoted(f.api_name)}, {_quoted(f.data_type)}, {options}, "
            f"{str(f.is_required).lower()}, {str(f.is_active).lower()}, {f.display_order}, "
            f"timestamp '{f.created_at.isoformat(sep=' ')}')"
        )
    columns = "id, label, api_name, data_type, options, is_required, is_active, display_order, created_at"
    return f"select * from (values {', '.join(rows)}) t({columns})"


def _long(source: str, catalog: FieldCatalog, stamps: str) -> str:
    named = ", ".join(f"{f.api_name} as {f.id}" for f in catalog.fields)
    ids = ", ".join(f.id for f in catalog.fields)
    return (
        f"select concat(id, ':', field_id) as id, id as record_id, field_id, value, {stamps} "
        f"from (unpivot (select id, {stamps}, {named} from {source}) on {ids} into name field_id value value)"
    )


def _typed(catalog: FieldCatalog) -> str:
    cast = {"NUMBER": "try_cast({} as double) as {}", "DATE": "try_cast({} as date) as {}"}
    return ", ".join(cast.get(f.kind, "{} as {}").format(f.api_name, f.api_name) for f in catalog.fields)


# Tables of the library as DuckDB text; a query's SQL gets those it names.
TABLES: dict[str, str] = {
    "profile": _twin(L.PROFILE_SQL),
    "contacts": "select id, first_name, last_name, email, status, account_id, created_at, updated_at from profile",
    "vals": _long("profile", L.CONTACT_CATALOG, "created_at, updated_at"),
    "defs": _definition_rows(L.CONTACT_CATALOG),
    "eav": "select v.record_id, v.field_id, d.api_name, d.data_type, v.value from vals v join defs d on d.id = v.field_id",
    "docs": "select id, email, concat_ws(' ', first_name, last_name) as name, created_at, updated_at, "
    + _typed(L.CONTACT_CATALOG)
    + " from profile",
    "order_profile": _twin(L.ORDER_SQL),
    "order_vals": _long("order_profile", L.ORDER_CATALOG, "created_at"),
    "outbox": _twin(L.OUTBOX_SQL),
    "tenant_defs": _twin(
        L.TENANT_FIELDS_SQL,
        options="['F', p_brand]",
        created_at="cast(date '2020-01-01' + p_size as timestamp)",
    ),
    "tenant_vals": _twin(L.TENANT_VALUES_SQL),
    "new_contacts": _twin(L.NEW_CONTACTS_SQL),
    "new_vals": _twin(L.NEW_VALUES_SQL),
    "upd": _twin(L.UPDATES_SQL),
    "patches": _twin(L.PATCHES_SQL),
}


def _named_tables(text: str) -> list[str]:
    return [name for name in TABLES if re.search(rf"\b(from|join)\s+\(*{name}\b", text)]


def with_tables(sql: str) -> str:
    """The SQL preceded by the tables it names, directly or through others."""
    needed: dict[str, None] = {}

    def visit(text: str) -> None:
        for name in _named_tables(text):
            if name not in needed:
                visit(TABLES[name])
                needed[name] = None

    visit(sql)
    if not needed:
        return sql.strip()
    tables = ",\n".join(f"{name} as ({TABLES[name]})" for name in needed)
    body = sql.strip()
    if re.match(r"with\b", body):
        return f"with {tables},\n{body[4:].strip()}"
    return f"with {tables}\n{body}"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with its SQL twin if there is one."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered already")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return fn

    return register
