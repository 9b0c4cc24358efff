"""Request filters as Spark conditions."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldweave import schema as S
from fieldweave.catalog import FieldCatalog, is_custom
from fieldweave.functions.values import full_name, typed_value

OPERATORS = ("eq", "contains", "gt", "lt", "gte", "lte", "between")


@dataclass(frozen=True)
class Filter:
    field: str
    operator: str
    value: Any

    def __post_init__(self) -> None:
        if self.operator not in OPERATORS:
            raise ValueError(f"unknown operator {self.operator!r}, expected one of {OPERATORS}")


def base_name(name: str) -> str:
    """The base column a request field names."""
    name = S.REQUEST_ALIASES.get(name, name)
    if name not in S.BASE_KINDS:
        raise ValueError(f"unknown field {name!r}")
    return name


def contact_column(name: str) -> Column:
    """A base field of the contacts table; ``name`` is made of its two parts."""
    name = base_name(name)
    return full_name(F.col("first_name"), F.col("last_name")) if name == "name" else F.col(name)


def base_columns(contacts: DataFrame) -> list[str]:
    """The columns of contacts that a document has only if asked for."""
    return [c for c in contacts.columns if c in S.BASE_KINDS and c not in S.DOCUMENT_COLUMNS]


def check_stored(columns: Iterable[str], names: Iterable[str]) -> None:
    """An error for base fields of a request that the document table does not store."""
    missing = sorted({base_name(n) for n in names if not is_custom(n)} - set(columns))
    if missing:
        raise ValueError(f"these documents do not store {', '.join(missing)}; build them with base_fields=True")


def document_column(name: str, catalog: FieldCatalog) -> Column:
    return F.col(f"custom_fields.{name}") if is_custom(name) else F.col(base_name(name))


def kind_of(name: str, catalog: FieldCatalog) -> str:
    return catalog.by_name[name].kind if is_custom(name) else S.BASE_KINDS[base_name(name)]


def _number_text(value: Any) -> str:
    return str(int(value)) if isinstance(value, float) and value.is_integer() else str(value)


def literal(value: Any, kind: str) -> Column:
    """A request value, which may arrive as text, as a literal of the field's type."""
    if value is None:
        raise ValueError("a filter needs a value")
    if kind == S.NUMBER:
        return F.lit(float(value))
    if kind == S.DATE:
        return F.lit(value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value)))
    if kind == "TIMESTAMP":
        moment = value if isinstance(value, dt.datetime) else dt.datetime.fromisoformat(str(value))
        return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
    if kind == "ID":
        return F.lit(value)
    return F.lit(_number_text(value))


def contains(column: Column, part: str) -> Column:
    """``part`` anywhere in the text, case-sensitive; ``*`` and ``?`` in it are wildcards."""
    if not re.search(r"[*?]", part):
        return F.contains(column, F.lit(part))
    wild = {"*": ".*", "?": "."}
    pattern = "".join(wild.get(p) or re.escape(p) for p in re.split(r"([*?])", part))
    return column.rlike("(?s)" + pattern)


def condition(column: Column, kind: str, flt: Filter) -> Column:
    if flt.operator == "between":
        low, high = flt.value
        return column.between(literal(low, kind), literal(high, kind))
    if flt.operator == "contains":
        if kind not in (S.TEXT, S.SELECT):
            raise ValueError(f"contains needs a text field, {flt.field!r} is {kind}")
        return contains(column, str(flt.value))
    compare: dict[str, Callable[[Column, Column], Column]] = {
        "eq": lambda a, b: a == b,
        "gt": lambda a, b: a > b,
        "lt": lambda a, b: a < b,
        "gte": lambda a, b: a >= b,
        "lte": lambda a, b: a <= b,
    }
    return compare[flt.operator](column, literal(flt.value, kind))


def usable(filters: Iterable[Filter], lenient: bool = False) -> list[Filter]:
    """Filters to apply. ``between`` without exactly two values is an error, or
    is dropped if ``lenient``."""
    kept = []
    for flt in filters:
        pair = isinstance(flt.value, (list, tuple)) and len(flt.value) == 2
        if flt.operator == "between" and not pair:
            if lenient:
                continue
            raise ValueError("between needs exactly two values")
        kept.append(flt)
    return kept


def all_of(conditions: Iterable[Column]) -> Column:
    """Conjunction; true for no conditions at all."""
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def document_condition(filters: Iterable[Filter], catalog: FieldCatalog, lenient: bool = False) -> Column:
    """All filters on the document layout. A field nobody defined matches no row."""
    parts = []
    for flt in usable(filters, lenient):
        if is_custom(flt.field) and catalog.get(flt.field) is None:
            parts.append(F.lit(False))
        else:
            parts.append(condition(document_column(flt.field, catalog), kind_of(flt.field, catalog), flt))
    return all_of(parts)


def contact_condition(filters: Iterable[Filter]) -> Column:
    """Base-field filters on the contacts table."""
    return all_of(
        condition(contact_column(f.field), S.BASE_KINDS[base_name(f.field)], f) for f in filters
    )


def value_condition(flt: Filter, catalog: FieldCatalog) -> Column:
    """A custom filter on EAV rows: the right field, its text read as the field's type."""
    definition = catalog.by_name[flt.field]
    return (F.col("field_id") == definition.id) & condition(
        typed_value(F.col("value"), definition.kind), definition.kind, flt
    )


def equalities(pairs: Mapping[str, Any]) -> list[Filter]:
    return [Filter(field, "eq", value) for field, value in pairs.items()]


def text_contains(query: str, ignore_accents: bool = False) -> Column:
    """``query`` inside "first last" or inside the address, ignoring case."""
    name = F.concat_ws(" ", "first_name", "last_name")
    if ignore_accents:
        rule = "UNICODE_CI_AI"
        part = F.collate(F.lit(query), rule)
        return F.contains(F.collate(name, rule), part) | F.contains(F.collate("email", rule), part)
    part = F.lit(query.lower())
    return F.contains(F.lower(name), part) | F.contains(F.lower("email"), part)


def equal_ignoring_case(column: Column, value: str) -> Column:
    """Equality of a case-, accent- and trailing-blank-insensitive collation."""
    rule = "UNICODE_CI_AI_RTRIM"
    return F.collate(column, rule) == F.collate(F.lit(value), rule)
